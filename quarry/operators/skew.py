"""Hot keys, split by their size, and shuffles sized by the rows they move.

A single key may hold a large share of all rows (one user, one node).  Its rows
are cut into ``ceil(rows / block_rows)`` blocks, whatever the share, so the work
of one join key stays bounded as the data grows.  Ordinary keys are one block:
there is one plan for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def block_counts(df: DataFrame, key: str, block_rows: int, counted: Column | None = None) -> DataFrame:
    """``key, _blocks`` for the keys that need more than one block (at most
    ``rows / block_rows`` of them); the count (of all rows, or of ``counted`` ones) is
    combined map-side."""
    count = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    blocks = F.ceil(F.col("_n") / F.lit(block_rows)).cast("int")
    return (df.groupBy(key).agg(count.alias("_n"))
              .where(F.col("_n") > F.lit(block_rows)).select(key, blocks.alias("_blocks")))


def block_of(spread: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(spread), blocks).cast("int")


def block_tags(df: DataFrame, key: str, spread: str, block_rows: int
               ) -> tuple[DataFrame, DataFrame]:
    """Copies ``(left, right)`` of ``df`` with ``_x, _y`` for a self-join on the key.

    With b blocks per key a left row of block x takes ``(x, 0..b-1)`` and a right
    row of block y ``(0..b-1, y)``: joining on ``(key, _x, _y)`` every left row
    meets every right row of its key exactly once, and a join key holds about
    ``block_rows`` rows on either side.
    """
    tagged = df.join(block_counts(df, key, block_rows), key, "left").withColumn(
        "_b", F.coalesce(F.col("_blocks"), F.lit(1)))
    own = block_of(F.col(spread), F.col("_b"))
    every = F.explode(F.sequence(F.lit(0), F.col("_b") - 1))
    left = tagged.withColumn("_x", own).withColumn("_y", every)
    right = tagged.withColumn("_y", own).withColumn("_x", every)
    return left.drop("_blocks", "_b"), right.drop("_blocks", "_b")


#: Rows that one task of a sized shuffle takes, and the most partitions it is cut into.
ROWS_PER_TASK, MAX_PARTITIONS = 1_000_000, 20_000


@contextmanager
def sized_shuffles(spark: SparkSession, rows: float) -> Iterator[None]:
    """Jobs run inside the block shuffle into as many partitions as ``rows`` need at about
    ``ROWS_PER_TASK`` each (the session's number at least), so the memory of a task does not
    grow with the input.  What adaptive execution would coalesce by bytes stays apart: rows
    of few bytes may meet many others.  Only jobs are bound, so results are written inside."""
    wanted = {"spark.sql.shuffle.partitions": str(max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        min(math.ceil(rows / ROWS_PER_TASK), MAX_PARTITIONS))),
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    usual = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)
