"""Helpers shared by the operators: task-side Arrow plumbing and shared scratch tables."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.lineage import write_table

#: Words are the maximal runs without these bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents handed to a Python task at a time; a batch of whole texts stays small.
BATCH_ROWS = 512

__all__ = ["WORD", "columns_of", "map_batches", "scratch", "table", "text_bytes",
           "process_state", "document_key", "n_words", "packed", "unpacked"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared checkpoint folder and read back."""
    return write_table(df, f"llm-{name}")


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), as a built-in expression."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_key(id_col: str, text_col: str) -> Column:
    """Key of a row's content: rows that repeat an id with the same text share it, rows that
    repeat an id with another text do not."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit("document"))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_key, _id, _text, _row``: the whole row travels as one struct, so no column of it can
    clash with the names an operator works with."""
    return docs.select(document_key(id_col, text_col).alias("_key"),
                       F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def unpacked(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of the packed rows, some of them changed."""
    changed = changed or {}
    return df.select(*((changed[c] if c in changed else F.col("_row").getField(c)).alias(c)
                       for c in columns))


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in pc.cast(column, pa.large_binary()).to_pylist()]


def columns_of(batch: pa.RecordBatch, names: list[str]) -> dict:
    return {n: batch.column(batch.schema.get_field_index(n)) for n in names}


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``fn`` over slices of at most ``BATCH_ROWS`` rows of each Arrow batch."""
    rows = BATCH_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def process_state(name: str, make: Callable):
    """A value kept for the life of a Python worker (tokenizers, caches)."""
    holder = sys.modules.setdefault("_quarry_llm_state", types.ModuleType("_quarry_llm_state"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
