"""Lineage cuts for iterative jobs.

Iterative plans grow by one join per round and, without a cut, re-run every
earlier round.  A cut writes the round's result as a parquet table into the
shared folder named by ``spark.checkpoint.dir`` and reads it back: a lost
executor then re-reads files instead of recomputing earlier rounds (a local
checkpoint would die with the executor).  Parquet is columnar and
compressed, and the table read back carries size statistics that let the
planner choose a broadcast for small results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quarry.session import checkpoint_dir


_FOLDER = "quarry-tables"


def scratch_path(df_or_spark, name: str) -> str:
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/{_FOLDER}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


#: Open ``scratch_scope`` blocks, each with the paths handed out inside it.
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written inside the block when it ends, whatever file system the
    shared folder is on.  Results that still read them must be consumed inside it."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not paths]
        for path in paths:
            _remove(spark, spark._jvm.org.apache.hadoop.fs.Path(path))
            spark.sql(f"DROP TABLE IF EXISTS `{_table_name(path)}`")


def _remove(spark: SparkSession, at) -> None:
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_table(table: DataFrame) -> None:
    """Deletes a table just as ``write_table`` or ``write_through`` returned it, once nothing
    reads it any more."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
        if at.getParent().getName() != _FOLDER:
            raise ValueError(f"{at} is not a table of the shared folder")
        _remove(spark, at)


#: Spark's own setting; off by default.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the block remove their shuffle files when they end.  Otherwise these
    stay until the driver happens to collect garbage, and the jobs of a query add up on disk."""
    usual = spark.conf.get(_REMOVE_SHUFFLES, "false")
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, usual)


def write_through(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``write_table`` of what ``build()`` returns; tables written inside ``build`` and the
    shuffles behind the result go as soon as it is stored."""
    path = scratch_path(spark, name)  # before the scope, which removes what is named inside it
    with scratch_scope(spark), shuffles_removed(spark):
        build().write.mode("error").parquet(path)
    return spark.read.parquet(path)


def _table_name(path: str) -> str:
    return "quarry_" + path.rsplit("-", 1)[-1]


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder; return the
    table read back (lineage = one file scan)."""
    path = scratch_path(df, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, cols: Sequence[str], buckets: int) -> DataFrame:
    """Materialise ``df`` as a table bucketed by ``cols`` and sorted by the first, one file per bucket.

    Unlike a checkpoint (whose adaptive plan does not tell its partitioning) the table read
    back is known to be partitioned by ``cols`` into ``buckets``: a join on these columns reads
    it in place, and so does one with the union of several such tables."""
    path = scratch_path(df, name)
    table = _table_name(path)
    # one column sorts by its prefix alone; a sorted bucket in the writer would sort all rows again
    (df.repartition(buckets, *cols).sortWithinPartitions(cols[0]).write.bucketBy(buckets, *cols)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (keeps the physical
    partitioning of ``df``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
