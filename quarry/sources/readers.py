"""Readers for delimited files and text lines.

Three schema modes are supported, as in the jobs this library re-implements:
an explicit DDL/StructType schema for header-less files, header + inference,
and a single ``value`` column of raw text lines that later stages parse.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, *,
                   sep: str = ",", header: bool = False, infer_schema: bool = False,
                   encoding: str | None = None, quote: str | None = None) -> DataFrame:
    """Read a delimited text file.

    With ``schema`` the file is read without an inference scan; fields beyond
    the schema are dropped and short lines give nulls (PERMISSIVE mode).
    ``infer_schema`` costs one extra pass over the data and should be kept
    for exploration.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if encoding:
        reader = reader.option("encoding", encoding)
    if quote is not None:
        reader = reader.option("quote", quote)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file as a table with one string column ``value`` per line."""
    return spark.read.text(path)


_POS = "_file_pos"


def _with_position(df: DataFrame) -> DataFrame:
    """Tag rows straight after the scan with their place in file order: the
    file, the start of the block they were read from, and the id Spark numbers
    rows with, which grows with the line inside a block whatever order the
    blocks are dealt to tasks in."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("f"),
                                   F.col("_metadata.file_block_start").alias("b"),
                                   F.monotonically_increasing_id().alias("p")).alias(_POS))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their true position: ``value, file, line`` (``line`` from 1 in each
    file), however many blocks a file is read in.

    A block's lines are numbered where they are read; the numbers of the lines before it are
    sums over one count per block.  The tagged lines are stored once, so the counts and the
    numbers see the same blocks."""
    from quarry.operators.lineage import write_table
    tagged = write_table(_with_position(spark.read.text(path)).select(
        "value", F.col(f"{_POS}.f").alias("file"), F.col(f"{_POS}.b").alias("_block"),
        F.col(f"{_POS}.p").alias("_at")), "numbered-lines")
    counts = tagged.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("file").orderBy("_block")  # one row per block
    offsets = counts.select("file", "_block", (F.sum("_n").over(before) - F.col("_n") - F.col("_first") + 1)
                            .alias("_shift"))
    return tagged.join(offsets, ["file", "_block"]).select(
        "value", "file", (F.col("_at") + F.col("_shift")).alias("line"))


def parse_strict(lines: DataFrame, fields: Sequence[tuple[str, int, str]], sep: str = ",",
                 col: str = "value", malformed: str = "quarantine") -> DataFrame:
    """Lines parsed field by field: other columns of ``lines``, the fields' columns, the line
    itself and ``problem``.

    ``fields`` holds (name, position from 0, type).  A line is good (``problem`` null) if it is
    valid UTF-8, reaches the last position asked for and every typed field parses; otherwise
    ``problem`` names the first thing wrong and the fields are null.  ``malformed="replace"``
    puts replacement characters for malformed bytes and parses on.  Nothing is dropped:
    ``good_rows`` and ``quarantined`` split the result.
    """
    line = F.col(col)
    valid = F.is_valid_utf8(line)
    if malformed == "replace":
        line, valid = F.make_valid_utf8(line), F.lit(True)
    elif malformed != "quarantine":
        raise ValueError(f"malformed must be 'quarantine' or 'replace', not {malformed!r}")
    raw = lines.select("*", valid.alias("_valid"), F.split(line, re.escape(sep), -1).alias("_f"))
    typed = [(name, F.get("_f", F.lit(at)).try_cast(kind)) for name, at, kind in fields]
    most = max(at for _, at, _ in fields)
    problem = F.when(~F.col("_valid"), F.lit("malformed bytes")).when(
        F.size("_f") <= most, F.lit("missing fields"))
    for name, value in typed:
        problem = problem.when(value.isNull(), F.lit(f"bad {name}"))
    other = [c for c in lines.columns if c != col]
    return (raw.withColumn("problem", problem)
            .select(*other, *(F.when(F.col("problem").isNull(), value).alias(name) for name, value in typed),
                    F.col(col), "problem"))


def good_rows(parsed: DataFrame, col: str = "value") -> DataFrame:
    """The typed columns of the lines without a problem."""
    return parsed.where(F.col("problem").isNull()).drop(col, "problem")


def quarantined(parsed: DataFrame, col: str = "value") -> DataFrame:
    """The other lines as they were read, with their problem."""
    return parsed.where(F.col("problem").isNotNull()).select(col, "problem")


def _unique_key(dim: DataFrame, id_col: str, name_col: str, keep: str) -> DataFrame:
    # A name table must have one row per id or a lookup join would multiply
    # rows.  max_by / min_by are algebraic aggregates, so a frequent id costs
    # one partial row per task.
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    pick = F.min_by if keep == "first" else F.max_by
    return dim.groupBy(id_col).agg(pick(name_col, _POS).alias(name_col))


def _decoded_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    # the text source takes bytes as they are, whatever its encoding option says;
    # malformed UTF-8 is replaced, as the original codecs do
    value = F.col("value")
    if encoding.upper().replace("-", "") == "UTF8":
        value = F.make_valid_utf8(value)
    else:
        value = F.decode(value.cast("binary"), encoding)
    return _with_position(spark.read.text(path)).withColumn("value", value)


def read_dimension(spark: SparkSession, path: str, *, sep: str = "|",
                   encoding: str = "ISO-8859-1", id_col: str = "id",
                   name_col: str = "name", dedupe: bool = True, quoted: bool = False,
                   keep: str = "last") -> DataFrame:
    """id → name table from a delimited file whose first two fields are id and name.

    Lines with fewer than two fields are skipped, an empty name stays (as ""),
    ids are cast once here (``try_cast``: a malformed id becomes null and is
    dropped), and for a repeated id the last (or first, ``keep``) line in file
    order wins.  ``quoted`` reads the file as CSV with quoted fields instead,
    where a bare id has no name and its line is skipped.
    """
    if quoted:
        raw = _with_position(read_delimited(spark, path, f"{id_col} string, {name_col} string",
                                            sep=sep, encoding=encoding))
    else:
        lines = _decoded_lines(spark, path, encoding)
        parts = F.split(F.col("value"), re.escape(sep))
        raw = lines.where(F.size(parts) >= 2).select(
            F.get(parts, 0).alias(id_col), F.get(parts, 1).alias(name_col), _POS)
    dim = (raw.select(F.expr(f"try_cast(trim({id_col}) AS INT)").alias(id_col), name_col, _POS)
              .where(F.col(id_col).isNotNull() & F.col(name_col).isNotNull()))
    return _unique_key(dim, id_col, name_col, keep) if dedupe else dim.drop(_POS)


def read_quoted_dimension(spark: SparkSession, path: str, *, encoding: str = "ISO-8859-1",
                          id_col: str = "id", name_col: str = "name",
                          require_quotes: bool = True, dedupe: bool = True,
                          keep: str = "last") -> DataFrame:
    """id → name table from lines like ``12 "SOME NAME"``.

    ``require_quotes`` keeps only lines that carry a quoted name, the rule of
    the quote-splitting loader; otherwise the space-separated CSV reading
    applies and a bare id yields a null name.
    """
    lines = _decoded_lines(spark, path, encoding)
    parts = F.split(F.col("value"), '"')
    dim = lines.select(
        F.expr("try_cast(trim(split(value, '\"')[0]) AS INT)").alias(id_col),
        F.when(F.size(parts) > 1, F.get(parts, 1)).alias(name_col),
        _POS,
    ).where(F.col(id_col).isNotNull())
    if require_quotes:
        dim = dim.where(F.col(name_col).isNotNull())
    return _unique_key(dim, id_col, name_col, keep) if dedupe else dim.drop(_POS)
