"""Substring dedup by relative Lempel-Ziv parsing.

Reference index: in every document the hashes of ``GRAM`` consecutive words are winnowed, so
any ``span`` consecutive words contain an anchor that their content alone decides.  An anchor
and the words up to the next one form a reference block; the index keeps, per anchor, the
first document that holds it, the place there and the hash of its block.  Only anchors that
two documents share remain.

Parse: a document is factored greedily from anchor to anchor against every indexed block; a
factor goes on while its next block equals the block at the same place of the same earlier
document.  A factor of at least ``span`` words is a duplicate span.  At factor boundaries,
and wherever no factor is long enough, each window of ``span`` words around a shared anchor
is checked by itself against the same windows of all documents, so that text which comes
from several earlier documents, or from one that is not the first holder of an anchor, is
found as well.  The document that holds a window first never has it inside a factor, hence
it always offers it for these checks, and the result is exact: a word goes if a window that
covers it also starts in a document with a smaller id.

Defined results: a null text has no words; a document with a null id neither loses words nor
takes any from others; rows that repeat an id do not take words from each other; texts of any
length are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, document_key, map_batches, scratch, text_bytes
from quarry.llm.hashing import Windows, _sliding, covered, mix, winnow, word_hashes

SPAN = 50
GRAM = 10
_WHOLE = np.uint64(0x5851F42D4C957F2D)


class _Anchors:
    """Anchors of one document: their places, hashes and block hashes."""

    def __init__(self, words: np.ndarray, span: int, gram: int):
        self.words = Windows(words)
        self.hashes = self.words.all(gram)
        self.at = winnow(self.hashes, span - gram + 1)
        self.prints = self.hashes[self.at]
        ends = np.append(self.at[1:], [len(words) - gram]) + gram
        self.blocks = self.words.at(self.at, ends)


def _index_rows(docs: DataFrame, id_type: str, span: int, gram: int) -> DataFrame:
    """One row per document: word count, digest of its words, and its anchors.  The anchor at
    place -1 stands for the whole document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "_text"])
        count, digest, places, prints, blocks = [], [], [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            words = word_hashes(text)
            count.append(len(words))
            digest.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
            if len(words) < span or not col["_id"][i].is_valid:
                places.append([])
                prints.append([])
                blocks.append([])
                continue
            a = _Anchors(words, span, gram)
            n = np.array([len(words)])
            whole = mix(a.words.at(n * 0, n) ^ _WHOLE)
            places.append(np.append(a.at, -1).astype(np.int32))
            prints.append(np.append(a.prints, whole).view(np.int64))
            blocks.append(np.append(a.blocks, n.astype(np.uint64)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["_id"], pa.array(count, pa.int64()), pa.array(digest),
             pa.array(places, pa.list_(pa.int32())), pa.array(prints, pa.list_(pa.int64())),
             pa.array(blocks, pa.list_(pa.int64()))],
            names=["_key", "_id", "n_words", "digest", "at", "print", "block"])
    return map_batches(docs, run, f"_key long, _id {id_type}, n_words long, digest string, "
                       "at array<int>, print array<long>, block array<long>")


def _factors(own: _Anchors, hits: dict, gram: int):
    """Greedy factors (start, end) of one document, from anchor to anchor.  ``hits``: by place,
    the earlier document that holds the anchor first, the place there and its block."""
    out = []
    at, blocks = own.at.tolist(), own.blocks.tolist()
    i, n = 0, len(at)
    while i < n:
        hit = hits.get(at[i])
        if hit is None:
            i += 1
            continue
        start, key, shift, end = at[i], hit[0], hit[1] - at[i], at[i] + gram
        while hit is not None and hit[0] == key and hit[1] - at[i] == shift \
                and hit[2] == blocks[i]:
            end = (at[i + 1] if i + 1 < n else own.words.n - gram) + gram
            i += 1
            hit = hits.get(at[i]) if i < n else None
        out.append((start, end))
        if end == start + gram:
            i += 1
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document row: ``id_col, n_words, n_removed, spans`` (start and length in
    words of what goes), ``kept_text`` (kept words joined by a space; null where nothing
    goes) and ``kept_sha256`` (digest of the kept words joined by a space)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(document_key(id_col, text_col).alias("_key"), F.col(id_col).alias("_id"),
                         F.col(text_col).alias("_text"))
    indexed = scratch(_index_rows(source, id_type, span, gram), "anchors")
    anchors = indexed.select("_key", "_id", F.explode(F.arrays_zip("at", "print", "block")).alias("a")) \
        .select("_key", "_id", F.col("a.at").alias("at"), F.col("a.print").alias("print"),
                F.col("a.block").alias("block"))
    first = (anchors.groupBy("print").agg(F.min(F.struct("_id", "_key", "at", "block")).alias("ref"),
                                          F.max("_id").alias("_last"))
             .where(F.col("ref._id") < F.col("_last")).select("print", "ref"))
    # stored: a join of two plain tables lets Spark split an anchor that very many documents hold
    first = scratch(first, "index")
    hits = (anchors.select("_key", "at", "print").join(first, "print")
            .groupBy("_key").agg(F.collect_list(F.struct(
                "at", "print", F.col("ref._id").alias("id"), F.col("ref._key").alias("key"),
                F.col("ref.at").alias("place"), F.col("ref.block").alias("block"))).alias("hits")))

    def parse(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "_text", "hits"])
        whole, starts, ends, places, windows, text_out = [], [], [], [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            own_id = col["_id"][i].as_py()
            cell = col["hits"][i].values
            field = {n: cell.field(n).to_numpy(zero_copy_only=False)
                     for n in ("at", "print", "key", "place", "block")}
            ids = cell.field("id").to_pylist()
            top = np.flatnonzero(field["at"] == -1)
            duplicate = any(ids[k] < own_id for k in top.tolist())
            whole.append(duplicate)
            text_out.append(None if duplicate else text.decode("utf-8", "replace"))
            if duplicate:
                for x in (starts, ends, places, windows):
                    x.append([])
                continue
            words = word_hashes(text)
            own = _Anchors(words, span, gram)
            before = {int(a): k < own_id for a, k in zip(field["at"], ids)}
            unsigned = field["block"].astype(np.int64).view(np.uint64).tolist()
            table = {int(a): (int(key), int(place), block) for a, key, place, block in
                     zip(field["at"], field["key"], field["place"], unsigned) if a >= 0}
            found = _factors(own, {a: h for a, h in table.items() if before[a]}, gram)
            long = [(a, b) for a, b in found if b - a >= span]
            shared = field["print"].astype(np.int64).view(np.uint64)
            open_ = np.isin(_sliding(np.minimum, own.hashes, span - gram + 1), shared)
            for a, b in long:
                open_[a:b - span + 1] = False
            at = np.flatnonzero(open_)
            starts.append(np.array([a for a, _ in long], dtype=np.int32))
            ends.append(np.array([b for _, b in long], dtype=np.int32))
            places.append(at.astype(np.int32))
            windows.append(own.words.all(span)[at].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["_id"], pa.array(whole), pa.array(starts, pa.list_(pa.int32())),
             pa.array(ends, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32())),
             pa.array(windows, pa.list_(pa.int64())), pa.array(text_out, pa.string())],
            names=["_key", "_id", "whole", "starts", "ends", "places", "windows", "text"])

    parsed = scratch(map_batches(
        source.join(hits, "_key"), parse,
        f"_key long, _id {id_type}, whole boolean, starts array<int>, ends array<int>, "
        "places array<int>, windows array<long>, text string"), "parsed")
    checks = parsed.select("_key", "_id", F.explode(F.arrays_zip("places", "windows")).alias("w")) \
        .select("_key", "_id", F.col("w.places").alias("place"), F.col("w.windows").alias("window"))
    # stored for the same reason: one window may be in very many documents
    known = scratch(checks.groupBy("window").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"))
                    .where("_low < _high").select("window", "_low"), "windows")
    repeats = (checks.join(known, "window").where("_id > _low")
               .groupBy("_key").agg(F.collect_set("place").alias("found")))

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "whole", "starts", "ends", "found", "text"])
        removed, spans, texts, digests = [], [], [], []
        for i, text in enumerate(text_bytes(col["text"])):
            if col["whole"][i].as_py():
                removed.append(-1)
                spans.append([])
                texts.append("")
                digests.append(hashlib.sha256(b"").hexdigest())
                continue
            words = text.split()
            a = np.array(col["starts"][i].values, dtype=np.int64)
            lengths = np.array(col["ends"][i].values, dtype=np.int64) - a
            gone = covered(a, lengths, len(words))
            if col["found"][i].is_valid:
                gone |= covered(np.array(col["found"][i].values), span, len(words))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            removed.append(int(gone.sum()))
            spans.append([{"start": int(s), "length": int(e - s)}
                          for s, e in zip(edges[0::2], edges[1::2])])
            texts.append(kept.decode("utf-8", "replace") if removed[-1] else None)
            digests.append(hashlib.sha256(kept).hexdigest())
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [col["_key"], pa.array(removed, pa.int64()), pa.array(spans, span_type),
             pa.array(texts, pa.string()), pa.array(digests, pa.string())],
            names=["_key", "n_removed", "spans", "kept_text", "kept_sha256"])

    changed = map_batches(
        parsed.select("_key", "whole", "starts", "ends", "text").join(repeats, "_key", "left"), remove,
        "_key long, n_removed long, spans array<struct<start: int, length: int>>, "
        "kept_text string, kept_sha256 string").dropDuplicates(["_key"])
    everything = indexed.select("_key", "_id", "n_words", "digest").join(changed, "_key", "left")
    whole = F.col("n_removed") == -1
    return everything.select(
        F.col("_id").alias(id_col), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
         .cast("long").alias("n_removed"),
        F.when(whole, F.array(F.struct(F.lit(0).alias("start"),
                                       F.col("n_words").cast("int").alias("length"))))
         .otherwise(F.coalesce("spans", F.array().cast(
             "array<struct<start: int, length: int>>"))).alias("spans"),
        "kept_text", F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
