"""Importance resampling towards a target distribution of hashed n-grams.

A text is lower-cased (A-Z only) and its separators, every ASCII byte but letters and digits,
collapse to single spaces.  One overlapped regex scan per n-gram length then walks the text:
boundary lookarounds let a match start and end only at whole words, so each match's span is an
n-gram as it stands and goes straight into the CRC count.  A document keeps its sparse bucket
counts; their sums over the whole corpus and over the target texts give each bucket's gain, the
log ratio of the smoothed shares.  A document's weight is the floored mean gain of its
features, its score the weight plus Gumbel noise from a hash of its id, and the highest scores
are a draw without replacement in proportion to the exponential of the weights.

The only thing that is not a table is the gain per bucket, an array of ``buckets`` numbers.
Ranks come from a range sort and prefix sums of counts per partition.

Defined results: a null text has no words and weight 0; a null id draws its noise as an empty
id; rows that repeat an id are separate rows with the same noise, ties go to the smaller id,
then to the smaller hash of the text; an empty target or an empty corpus only leaves the
smoothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, document_key, map_batches, process_state, scratch, text_bytes
from quarry.operators.splits import row_index

LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

_UPPER = bytes(range(0x41, 0x5B))
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_PLAIN = bytes.maketrans(_UPPER + _SEPARATORS, _UPPER.lower() + b" " * len(_SEPARATORS))
_GAP = regex.compile(rb" {2,}")


def plain_words(text: bytes) -> bytes:
    """Lower-cased words with one space between them."""
    return _GAP.sub(b" ", text.translate(_PLAIN)).strip(b" ")


def scanner(n: int):
    """Matches ``n`` whole words in a row."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def bucket_counts(words: bytes, longest: int, buckets: int) -> dict[int, int]:
    """Features per bucket of one text of ``plain_words``."""
    out: Counter = Counter()
    for n in range(1, longest + 1):
        scan = process_state(f"scanner-{n}", lambda: scanner(n))
        spans = Counter(words[m.start():m.end()] for m in scan.finditer(words, overlapped=True))
        for feature, count in spans.items():
            out[zlib.crc32(feature) % buckets] += count
    return out


def hashed_features(docs: DataFrame, id_col: str, text_col: str, longest: int = LONGEST,
                    buckets: int = BUCKETS) -> DataFrame:
    """``_key, _id, n_words, n_features, bucket, count`` (the last two: arrays)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "_text"])
        n_words, n_features, bucket, count = [], [], [], []
        for text in text_bytes(col["_text"]):
            words = plain_words(text)
            found = bucket_counts(words, longest, buckets)
            n_words.append(words.count(b" ") + 1 if words else 0)
            n_features.append(sum(found.values()))
            bucket.append(list(found.keys()))
            count.append(list(found.values()))
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["_id"], pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
             pa.array(bucket, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int32()))],
            names=["_key", "_id", "n_words", "n_features", "bucket", "count"])
    id_type = docs.schema[id_col].dataType.simpleString()
    return map_batches(
        docs.select(document_key(id_col, text_col).alias("_key"), F.col(f"`{id_col}`").alias("_id"),
                    F.col(f"`{text_col}`").alias("_text")), run,
        f"_key long, _id {id_type}, n_words long, n_features long, bucket array<int>, count array<int>")


def bucket_sums(features: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features per bucket over all rows (``buckets`` numbers reach the driver)."""
    sums = (features.select(F.explode(F.arrays_zip("bucket", "count")).alias("f"))
            .groupBy(F.col("f.bucket").alias("bucket"))
            .agg(F.sum(F.col("f.count").cast("long")).alias("n")))
    out = [0] * buckets
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Floored thousandfold log ratio of the smoothed shares, per bucket."""
    b, all_source, all_target = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log(float(t + 1) * float(all_source + b)
                                       / (float(s + 1) * float(all_target + b))))
            for s, t in zip(source, target)]


def noise(id_text: Column, seed: int) -> Column:
    """Thousandfold Gumbel noise from a hash of the id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_id: str = "item_id", target_text: str = "text", longest: int = LONGEST,
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_features, weight, score, rank``; ``rank`` from 1
    for the drawn ``percent`` of the rows with ``least_words`` words, null for others."""
    id_type = docs.schema[id_col].dataType.simpleString()
    features = scratch(hashed_features(docs, id_col, text_col, longest, buckets), "features")
    aim = hashed_features(target, target_id, target_text, longest, buckets)
    gain = np.array(gains(bucket_sums(features, buckets), bucket_sums(aim, buckets)), dtype=np.int64)

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "n_words", "n_features", "bucket", "count"])
        n = col["n_features"].to_numpy()
        sizes = np.diff(col["bucket"].offsets.to_numpy())
        parts = gain[col["bucket"].flatten().to_numpy()] * col["count"].flatten().to_numpy()
        sums = np.zeros(len(n), dtype=np.int64)
        np.add.at(sums, np.repeat(np.arange(len(n)), sizes), parts)
        weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["_id"], col["n_words"], col["n_features"], pa.array(weight, pa.int64())],
            names=["_key", "_id", "n_words", "n_features", "weight"])
    weighed = map_batches(features, weigh,
                          f"_key long, _id {id_type}, n_words long, n_features long, weight long")
    scored = scratch(weighed.withColumn(
        "score", F.col("weight") + noise(F.col("_id").cast("string"), seed)), "scores")
    large = scored.where(F.col("n_words") >= least_words)
    drawn = large.count() * percent // 100
    placed = row_index(large.withColumn("_down", -F.col("score")), ["_down", "_id", "_key"], "_place")
    ranked = placed.withColumn("rank", F.when(F.col("_place") <= drawn, F.col("_place")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    out = [F.col("_id").alias(id_col), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")]
    return ranked.select(*out).unionByName(rest.select(*out))
