"""Session helpers.

Library functions never start a session; they take DataFrames.  These helpers
are for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra_conf: dict[str, str] | None = None
                ) -> SparkSession:
    """Return the active session, or build a local one for tests and benches.

    On a cluster the caller's session is returned untouched; settings below
    only apply when this call creates the session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cores = os.cpu_count() or 8
    master = master or f"local[{cores}]"
    parts = shuffle_partitions or max(8, cores)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **(extra_conf or {}),
    }
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session and only pick our own folder when it is unset on a local master
    (tests).  On a cluster an unset value is an error: a machine-local folder
    would be lost with its executor.
    """
    sc = spark.sparkContext
    path = (spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
            or sc.getCheckpointDir())
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; on a cluster it must name a shared "
                "folder (HDFS/S3/...), a machine-local folder would be lost with "
                "its executor")
        path = tempfile.mkdtemp(prefix="quarry-ckpt-")
        try:
            spark.conf.set(_CHECKPOINT_KEY, path)
        except AnalysisException:  # some sessions refuse runtime changes of core settings
            sc.setCheckpointDir(path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scale_settings(input_bytes: int, total_cores: int,
                   partition_bytes: int = 512 << 20, max_partitions: int | None = None) -> dict[str, str]:
    """Session settings sized for a job that reads ``input_bytes``.

    Shuffle partitions are sized so one partition holds about
    ``partition_bytes`` of the input (at least two waves of ``total_cores``,
    at most ``max_partitions`` if the caller sets it);
    AQE starts from that count, coalesces small partitions towards half of
    that size and splits skewed join partitions.  File splits stay at
    ``partition_bytes`` or less so a scan task's batch fits executor memory.
    Apply with ``SparkSession.builder.config(map=...)`` before the session
    starts, or ``spark.conf.set`` for the runtime (SQL) entries.
    """
    import math
    shuffle = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    if max_partitions is not None:
        shuffle = min(shuffle, max_partitions)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 512 << 20)),
    }
