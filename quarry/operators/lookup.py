"""Name lookups and ranked results.

A lookup is a left join against a dimension with a unique key.  No broadcast
hint is given for dimensions whose size grows with the data: Spark then
broadcasts only below ``spark.sql.autoBroadcastJoinThreshold`` (a checked
estimate), and AQE switches to a broadcast at run time when the measured
shuffle output is small; otherwise the join stays a shuffle join.  The hint is
used only for sides with a proven bound, e.g. the k rows of a top-k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a bounded side up to which its keys are broadcast by hint.
MAX_HINTED_ROWS = 100_000


def attach_name(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
                name_col: str, small_side_rows: int | None = None) -> DataFrame:
    """Left join ``dim[name_col]`` onto ``df`` by ``key = dim_key``; a missing
    id yields a null name.

    ``small_side_rows`` states a proven upper bound on the rows of ``df``
    (e.g. after ``limit(k)``).  A left join cannot broadcast its preserved
    side, so then the ≤ k keys are broadcast into an inner join that streams
    the dimension once without shuffling it, and the ≤ k rows are left-joined
    with their ≤ k names (both sides bounded).  ``df`` is read twice then, so
    it must be deterministic (top-k results here always break ties by id).  A bound
    above ``MAX_HINTED_ROWS`` is no reason to broadcast and goes the ordinary way.
    """
    right = dim.select(F.col(dim_key).alias("_dim_key"), F.col(name_col))
    if small_side_rows is None or small_side_rows > MAX_HINTED_ROWS:
        return df.join(right, df[key] == right["_dim_key"], "left").drop("_dim_key")
    keys = df.select(F.col(key).alias("_want")).distinct()
    names = (right.join(F.broadcast(keys), right["_dim_key"] == keys["_want"])
                  .select("_dim_key", name_col))
    return df.join(F.broadcast(names), df[key] == names["_dim_key"], "left").drop("_dim_key")


def count_unmatched(df: DataFrame, name_col: str) -> DataFrame:
    """Strict check after ``attach_name``: one row with the number of ids
    that found no name (the reference failed on them)."""
    return df.agg(F.count_if(F.col(name_col).isNull()).alias("unmatched"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Ordered limit; planned as TakeOrderedAndProject (per-partition top-k,
    then a merge of k rows per partition), never a full global sort."""
    return df.orderBy(*order).limit(k)


def popularity(df: DataFrame, key: str) -> DataFrame:
    """Row count per key (map-side combined), column ``count``."""
    return df.groupBy(key).count()
