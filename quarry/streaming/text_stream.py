"""Word count over a stream of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.text import word_count


def stream_word_count(spark: SparkSession, path: str, keep_empty: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of running word counts over the text files that
    arrive in ``path``.  Write it with ``outputMode("complete")`` (or
    ``"update"``); the aggregation state is kept per word by Structured
    Streaming and recovered from the query's checkpoint location."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return word_count(reader.load(path), "value", keep_empty=keep_empty)
