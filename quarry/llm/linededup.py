"""Line dedup by winnowing over line hashes.

A line is a ``\\n``-separated part of a text that holds a word; others (blank ones) are
neutral and stay.  From each line on, the shortest run of lines that holds ``min_words`` words
is a window, so a window is one line that is long enough, or several short ones.  Winnowing
takes the line with the smallest hash of every window as a fingerprint: documents that share
``min_words`` words of consecutive lines share one, whatever stands around them.  Fingerprints
are joined by value; around those that occur more than once the matches are extended to both
sides, window by window, as long as the window occurs earlier.  Earlier means a smaller
(doc_id, position); a line goes if it lies in a window that occurs earlier, in another document
or in its own.  Fingerprints only find candidates; windows are equal by a 128-bit digest of
their lines' digests.

Defined results: a null text is empty and has no line; a null doc_id sorts first; rows that
repeat a doc_id with the same text are one document and get the same result, with another
text they are two; texts of any length are read whole; an empty table gives an empty result;
extra columns are ignored by ``repeated_lines`` and kept by ``dedup_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (columns_of, document_key, map_batches, packed, scratch,
                               text_bytes, unpacked)
from quarry.llm.hashing import covered, digest

MIN_WORDS = 8
_WIDE = 16  # bytes of a line's digest


def split_lines(text: bytes) -> list[tuple[bytes, bool]]:
    """The parts between newlines, and whether each is a line (holds a word)."""
    return [(x, bool(x) and not x.isspace()) for x in text.split(b"\n")] if text else []


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest runs of lines that hold ``least`` words."""
    upto = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(upto, upto[:-1] + least)
    starts = np.flatnonzero(ends < len(upto))
    return starts, ends[starts]


def minima(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The place of the smallest hash of each window, the first of equal ones."""
    return np.array([a if b == a + 1 else a + int(hashes[a:b].argmin())
                     for a, b in zip(starts.tolist(), ends.tolist())], dtype=np.int64)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``_key, found``: per document with repeated windows, the (start, length) in lines of
    those that occur earlier."""

    def lines_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "_text"])
        rows, lines, counts, prints = [], [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            full = [x for x, is_line in split_lines(text) if is_line]
            words = np.array([len(x.split()) for x in full], dtype=np.int32)
            starts, ends = windows(words, min_words)
            if len(starts):
                digests = b"".join(digest(x) for x in full)
                hashes = np.frombuffer(digests, dtype="<u8")[::2]
                rows.append(i)
                lines.append(digests)
                counts.append(words)
                prints.append(np.unique(hashes[minima(hashes, starts, ends)]).view(np.int64))
        take = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [col["_key"].take(take), col["_id"].take(take), pa.array(lines, pa.binary()),
             pa.array(counts, pa.list_(pa.int32())), pa.array(prints, pa.list_(pa.int64()))],
            names=["_key", "_id", "lines", "words", "prints"])

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(document_key(id_col, text_col).alias("_key"), F.col(id_col).alias("_id"),
                         F.col(text_col).alias("_text"))
    lined = scratch(map_batches(
        source, lines_of, f"_key long, _id {id_type}, lines binary, words array<int>, "
        "prints array<long>").dropDuplicates(["_key"]), "lines")
    prints = lined.select("_key", F.explode("prints").alias("print"))
    # a print that one document holds may still be repeated inside it: its windows are compared
    inside = lined.select("_key", "lines", "words", "prints")

    def repeats(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Prints that several windows of one document with different places share."""
        col = columns_of(batch, ["_key", "lines", "words"])
        rows, own = [], []
        for i in range(batch.num_rows):
            hashes = np.frombuffer(col["lines"][i].as_py(), dtype="<u8")[::2]
            at = minima(hashes, *windows(np.asarray(col["words"][i].values), min_words))
            value, count = np.unique(hashes[np.unique(at)], return_counts=True)
            rows += [i] * int((count > 1).sum())
            own.append(value[count > 1].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [col["_key"].take(pa.array(rows, pa.int64())),
             pa.array(np.concatenate(own) if own else [], pa.int64())], names=["_key", "print"])
    # stored, like the first places below: a join of two plain tables lets Spark split the rows
    # of a line or window that very many documents hold
    shared = scratch(prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select("print"), "prints")
    common = prints.join(shared, "print").select("_key", "print")
    own = map_batches(inside, repeats, "_key long, print long")
    chosen = (common.unionByName(own).groupBy("_key").agg(F.collect_set("print").alias("shared")))

    def extend(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Every window that holds a shared fingerprint, to both sides of it."""
        col = columns_of(batch, ["_key", "_id", "lines", "words", "shared"])
        rows, starts, lengths, runs = [], [], [], []
        for i in range(batch.num_rows):
            lines = col["lines"][i].as_py()
            hashes = np.frombuffer(lines, dtype="<u8")[::2]
            first, last = windows(np.asarray(col["words"][i].values), min_words)
            known = np.asarray(col["shared"][i].values, dtype=np.int64).view(np.uint64)
            hit = np.isin(hashes[minima(hashes, first, last)], known)
            for a, b in zip(first[hit].tolist(), last[hit].tolist()):
                rows.append(i)
                starts.append(a)
                lengths.append(b - a)
                runs.append(digest(lines[a * _WIDE:b * _WIDE]))
        take = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [col["_key"].take(take), col["_id"].take(take), pa.array(starts, pa.int32()),
             pa.array(lengths, pa.int32()), pa.array(runs, pa.binary())],
            names=["_key", "_id", "start", "length", "run"])

    runs = scratch(map_batches(
        lined.select("_key", "_id", "lines", "words").join(chosen, "_key"), extend,
        f"_key long, _id {id_type}, start int, length int, run binary"), "runs")
    place = F.struct("_id", "_key", "start")
    first = scratch(runs.groupBy("run").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("run", "_first"), "first-runs")
    return (runs.join(first, "run").where(~place.eqNullSafe(F.col("_first")))
            .groupBy("_key").agg(F.collect_list(F.struct("start", "length")).alias("found")))


def _cut_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Packed rows with ``n_lines, n_removed, kept_text``."""
    found = repeated_lines(docs, id_col, text_col, min_words)
    joined = packed(docs, id_col, text_col).join(found, "_key", "left").select(
        "_id", "_text", "_row", F.col("found.start").alias("starts"), F.col("found.length").alias("lengths"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_id", "_text", "_row", "starts", "lengths"])
        counts, removed, kept = [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            parts = split_lines(text)
            n = sum(full for _, full in parts)
            gone = (covered(np.array(col["starts"][i].values), np.array(col["lengths"][i].values), n)
                    if col["starts"][i].is_valid else np.zeros(n, dtype=bool))
            counts.append(n)
            removed.append(int(gone.sum()))
            if removed[-1]:
                flag = iter(gone.tolist())
                text = b"\n".join(x for x, full in parts if not (full and next(flag)))
            kept.append(text.decode("utf-8", "replace"))
        return pa.RecordBatch.from_arrays(
            [col["_id"], col["_row"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string())],
            names=["_id", "_row", "n_lines", "n_removed", "kept_text"])
    schema = (joined.select("_id", "_row").schema.add("n_lines", "long").add("n_removed", "long")
              .add("kept_text", "string"))
    return map_batches(joined, cut, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``id_col, n_lines, n_removed, kept_text``, one row per document row."""
    slim = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return _cut_lines(slim, id_col, text_col, min_words).select(
        F.col("_id").alias(id_col), "n_lines", "n_removed", "kept_text")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str | None = "n_chars", min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with their columns and the shortened text; one of which every line went is
    left out."""
    rows = _cut_lines(docs, id_col, text_col, min_words).where(
        "n_removed = 0 OR n_removed < n_lines")
    cut, row = F.col("n_removed") > 0, F.col("_row")
    changed = {text_col: F.when(cut, F.col("kept_text")).otherwise(row.getField(text_col))}
    if length_col in docs.columns:
        changed[length_col] = (F.when(cut, F.length("kept_text")).otherwise(row.getField(length_col))
                               .cast(docs.schema[length_col].dataType))
    return unpacked(rows, docs.columns, changed)
