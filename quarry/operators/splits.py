"""Train/test splits of a rating-like table.

Row order must be explicit: a DataFrame has no file order, so callers pass a
total order (``order_cols``, unique; add a tie-breaker if needed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | position


def row_index(df: DataFrame, order_cols: Sequence[str], alias: str = "row_index") -> DataFrame:
    """1-based position of each row in the total order ``order_cols``.

    A global ``row_number()`` window would move every row into one task.
    Instead: range partitioning into a fixed number of partitions, sorted
    within each; each row's position inside its partition; one count per
    partition; a running sum over those counts (one row per partition, so the
    small window and its broadcast are bounded by the partition count).

    The numbered rows are written once as a table in the shared checkpoint
    folder and both the counts and the final numbers are read from it.  Two
    independent evaluations of the sort could disagree: the range
    partitioner re-samples unbalanced inputs with a seed tied to the
    evaluation, so partition boundaries, and with them partition ids, may
    differ between plan branches.  The table fixes them once (this call
    therefore runs a job).
    """
    from quarry.operators.lineage import write_table
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = write_table(
        df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
          .withColumn("_pid", F.spark_partition_id())
          .withColumn("_local", F.monotonically_increasing_id()
                      - F.shiftleft(F.spark_partition_id().cast("bigint"), _LOCAL_BITS)),
        "row-index")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(alias, F.col("_off") + F.col("_local") + F.lit(1))
                  .drop("_pid", "_local", "_off"))


def contiguous_folds(df: DataFrame, order_cols: Sequence[str], k: int = 5,
                     fold_size: int | None = None, alias: str = "fold") -> DataFrame:
    """Assign rows, in order, to ``k`` contiguous folds of ``fold_size`` rows
    (default ``ceil(n / k)``).  Fold ``i`` is the test set of split ``i``
    and every other row is its base set."""
    indexed = row_index(df, order_cols, "_rn")
    if fold_size is None:
        size = F.ceil(df.select(F.count(F.lit(1))).scalar() / F.lit(k))
    else:
        size = F.lit(fold_size)
    fold = (F.floor((F.col("_rn") - 1) / size) + 1).cast("int")
    return indexed.withColumn(alias, fold).drop("_rn")


def write_folds(folded: DataFrame, path: str, order_cols: Sequence[str], fold: str = "fold") -> None:
    """Store rows tagged by ``contiguous_folds`` as one table, partitioned by fold and sorted by
    ``order_cols`` inside each: every row is written once, and ``read_fold`` gives the test and
    base tables of any split from it.

    The sort ranges over (fold, order), so a fold is spread over tasks by order, and a file
    holds one range of one fold."""
    parts = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (folded.repartitionByRange(parts, fold, *order_cols).sortWithinPartitions(fold, *order_cols)
     .write.mode("error").partitionBy(fold).parquet(path))


def read_fold(spark: SparkSession, path: str, i: int, order_cols: Sequence[str], fold: str = "fold"
              ) -> tuple[DataFrame, DataFrame]:
    """``(test, base)`` of split ``i`` in ``order_cols`` order: the fold and all others, each
    read through partition pruning."""
    rows = spark.read.parquet(path)
    test, base = rows.where(F.col(fold) == i), rows.where(F.col(fold) != i)
    return test.drop(fold).orderBy(*order_cols), base.drop(fold).orderBy(*order_cols)


def per_user_holdout(df: DataFrame, user: str, order_cols: Sequence[str], row_key: str,
                     start: int = 1, stop: int = 10, max_test: int = 0,
                     alias: str = "split") -> DataFrame:
    """Per user, the ``start``-th … ``stop``-th rows (in ``order_cols`` order)
    go to ``test``, all others to ``base``; ``max_test > 0`` caps the test set
    at its first ``max_test`` rows in that order (ranked with ``row_index``, so
    a large cap never gathers in one task).

    ``row_number() ≤ stop`` lets Spark insert a partial window group limit
    before the shuffle, so a user with a third of all rows sends at most
    ``stop`` rows per map task; the flags are joined back on the unique
    ``row_key``.
    """
    w = Window.partitionBy(user).orderBy(*order_cols)
    keep = list(dict.fromkeys([row_key, user, *order_cols]))
    ranked = (df.select(*keep, F.row_number().over(w).alias("_rn"))
                .where(F.col("_rn") <= F.lit(stop)))
    test = ranked.where(F.col("_rn") >= F.lit(start))
    if max_test > 0:
        # rank the test rows globally without a single-task top-k merge
        test = (row_index(test, list(dict.fromkeys([*order_cols, row_key])), "_g")
                .where(F.col("_g") <= F.lit(max_test)))
    flags = test.select(row_key, F.lit("test").alias("_t"))
    return (df.join(flags, row_key, "left")
              .withColumn(alias, F.coalesce(F.col("_t"), F.lit("base"))).drop("_t"))
