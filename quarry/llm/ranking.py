"""Running sums and positions over a sorted table without a global window.

Rows are range-partitioned by the order columns and sorted inside each partition; the sorted
partitions are written once to the shared folder, so every later step sees the same
partition numbers.  A partition's offset is the sum over the partitions before it, taken
from one row per (group, partition); rows inside a partition are summed by a window over
that partition.  No group, however large, gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import scratch


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str,
                before: str = "before") -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the same group that come first
    in ``order``.  ``order`` should identify a row up to identical rows; group columns may be
    null."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = scratch(
        df.repartitionByRange(parts, *group, *order)
          .withColumn("_part", F.spark_partition_id())
          .sortWithinPartitions(*group, *order)
          .withColumn("_row", F.monotonically_increasing_id()), "ranged")
    sums = ranged.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)),
                          F.col("_part").alias("_p"),
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part", *group).orderBy("_row").rowsBetween(
        Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (local.join(offsets, same)
            .withColumn(before, (F.col("_local") + F.col("_offset")).cast("long"))
            .drop("_part", "_p", "_row", "_local", "_offset",
                  *(f"_g{i}" for i in range(len(group)))))
