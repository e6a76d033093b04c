"""Best-fit packing of tokenised documents by large-item matching.

Each document becomes its token ids and an end id; one longer than a sequence is cut into
full pieces, a shorter remainder coming first.  Pieces above one third of a sequence are
large: at most two of them share a sequence, matched greedily, the largest with the largest
that still fits.  The smaller pieces then go, largest first, to the tightest gap.

The matching runs on the histogram of piece lengths (as many rows as a sequence has tokens,
whatever the corpus), which yields sequence patterns with a multiplicity; so it sees the
whole corpus and the driver holds only the histogram and the patterns.  Pieces find their
place by their rank among the pieces of their length, a distributed running count, in a
broadcast table of slots bounded by the patterns.

Defined results: a null or empty text is one piece, the end id alone; texts of any length are
tokenised whole; repeated rows are packed as often as they occur; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns_of, map_batches, process_state, scratch, text_bytes
from quarry.llm.ranking import running_sum

CAPACITY = 2048
END_ID = 0
#: Entries of a worker's cache of tokenised words; it starts afresh when full.
CACHE_WORDS = 200_000


class WordEncoder:
    """Byte-level BPE ids of a text, from the vocabulary's ranks.

    The pattern that splits a text before BPE never joins a space with what stands before it
    unless that is white space too, so a text whose single spaces follow non-space text can
    be encoded piece by piece (a piece: a space and what follows it) and the pieces cached.
    Other texts are encoded whole.  The strings of ``added`` become their ids and cut the text,
    the longest first where several begin; the ids equal those of the vocabulary's JSON form,
    without ``added`` those with the strings of special tokens read as ordinary text.
    """

    def __init__(self, ranks_path: str, added: dict[str, int] | None = None):
        import base64
        import re

        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self._encode = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={}).encode_ordinary
        self._after_space = re.compile(r"\s ").search
        self._cache: dict[str, bytes] = {}
        self._added = {t: np.array([i], dtype="<u4").tobytes() for t, i in (added or {}).items()}
        self._at_added = re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self._added, key=len, reverse=True)) + ")").split

    def _ids(self, text: str) -> bytes:
        return np.array(self._encode(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not any(t in text for t in self._added):
            return self._plain(text)
        parts = self._at_added(text)  # text, token, text, ...
        return b"".join(self._added[x] if k % 2 else self._plain(x) for k, x in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        if self._after_space(text):
            return self._ids(text)
        cache, parts = self._cache, text.split(" ")
        if len(cache) > CACHE_WORDS:
            cache.clear()
        out = [self._ids(parts[0])]
        for part in parts[1:]:
            ids = cache.get(part)
            if ids is None:
                ids = cache[part] = self._ids(" " + part)
            out.append(ids)
        return b"".join(out)


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(json_path: str | None = None) -> dict[str, int]:
    """String and id of the tokens a vocabulary's JSON form finds in any text."""
    import json

    import public_tokenizers
    with open(json_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("added tokens that depend on the text around them are not supported")
    return {t["content"]: t["id"] for t in tokens}


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           ranks_path: str | None = None, capacity: int = CAPACITY,
           with_ids: bool = False, added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32`` and, if wanted, ``ids``.

    ``added``: strings that are one token wherever they stand; by default the vocabulary's, none
    for other ranks."""
    if added is None:
        added = {} if ranks_path else added_tokens()
    ranks_path = ranks_path or default_ranks()
    end = np.array([END_ID], dtype="<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = process_state(f"encoder {ranks_path} {sorted(added.items())}",
                               lambda: WordEncoder(ranks_path, added))
        col = columns_of(batch, ["_id", "_text"])
        row, number, start, length, crc, ids = [], [], [], [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            coded = encode(text.decode("utf-8", "replace")) + end
            n, at, k = len(coded) // 4, 0, 0
            while at < n:
                size = min(capacity, n) if at or n % capacity == 0 else n % capacity
                part = coded[4 * at:4 * (at + size)]
                row.append(i)
                number.append(k)
                start.append(at)
                length.append(size)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(part)
                at, k = at + size, k + 1
        arrays = [col["_id"].take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                  pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                  pa.array(crc, pa.int64())]
        names = [id_col, "piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays.append(pa.array(ids, pa.binary()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)
    schema = (f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long"
              + (", ids binary" if with_ids else ""))
    return map_batches(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")),
                       run, schema)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY):
    """Histogram of lengths -> [(multiplicity, lengths in a sequence), ...].

    Large lengths (above a third of the capacity) are matched in pairs, then every smaller
    length, largest first, goes into the tightest gap; whole groups of equal sequences move
    together, so the work follows the number of distinct lengths, not of pieces.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    large = sorted(s for s in left if 3 * s > capacity)
    small = sorted((s for s in left if 3 * s <= capacity), reverse=True)
    groups: dict[int, list[list]] = defaultdict(list)  # gap -> [[count, lengths], ...]
    gaps: list[int] = []

    def put(count: int, lengths: tuple[int, ...]) -> None:
        gap = capacity - sum(lengths)
        if gap not in groups or not groups[gap]:
            at = bisect.bisect_left(gaps, gap)
            if at == len(gaps) or gaps[at] != gap:
                gaps.insert(at, gap)
        for group in groups[gap]:
            if group[1] == lengths:
                group[0] += count
                return
        groups[gap].append([count, lengths])

    while large:
        s = large[-1]
        n = left[s]
        at = bisect.bisect_right(large, capacity - s) - 1
        if at < 0:
            put(n, (s,))
            large.pop()
            continue
        mate = large[at]
        if mate == s:
            if n > 1:
                put(n // 2, (s, s))
            left[s] = n % 2
            if left[s]:  # an odd one out takes the next smaller length
                if at > 0:
                    mate = large[at - 1]
                    put(1, (s, mate))
                    left[mate] -= 1
                    if not left[mate]:
                        large.remove(mate)
                else:
                    put(1, (s,))
            large.pop()
            continue
        k = min(n, left[mate])
        put(k, (s, mate))
        left[s] -= k
        left[mate] -= k
        if not left[mate]:
            del large[at]
        if not left[s]:
            large.remove(s)
    for s in small:
        n = left[s]
        while n:
            at = bisect.bisect_left(gaps, s)
            while at < len(gaps) and not groups[gaps[at]]:
                del gaps[at]
            if at == len(gaps):
                per = capacity // s
                if n >= per:
                    put(n // per, (s,) * per)
                if n % per:
                    put(1, (s,) * (n % per))
                break
            group = groups[gaps[at]][-1]
            k = min(n, group[0])
            if k == group[0]:
                groups[gaps[at]].pop()
            else:
                group[0] -= k
            put(k, group[1] + (s,))
            n -= k
    return [(g[0], g[1]) for gap in sorted(groups) for g in groups[gap]]


def slots(plan) -> dict[str, np.ndarray]:
    """Per length, ranges of ranks and where they go: the pieces of a length with ranks
    ``rank .. rank + count - 1`` go to sequences ``sequence, sequence + 1, ...`` at ``offset``."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in plan:
        offset = 0
        for s in lengths:
            rows.append((s, used[s], sequence, offset))
            used[s] += count
            offset += s
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2],
            "offset": table[:, 3]}


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (any columns, ``length`` among
    them, each 1 .. capacity).  The table should be stored (it is read three times)."""
    spark = parts.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = spark.sparkContext.broadcast(slots(plan_sequences(histogram, capacity)))
    ranked = running_sum(
        parts.withColumn("_one", F.lit(1).cast("long"))
             .withColumn("_order", F.xxhash64(*(F.col(f"`{c}`") for c in parts.columns))),
        ["length"], ["_order"], "_one", "_rank")

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def find(length, rank):
        import pandas as pd
        t = place.value
        key = t["length"].astype(np.int64) << 44 | t["rank"]
        at = np.searchsorted(key, length.to_numpy() << 44 | rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": t["sequence"][at] + rank.to_numpy() - t["rank"][at],
                             "offset": t["offset"][at]})
    return (ranked.withColumn("_slot", find("length", "_rank"))
            .select(*(F.col(f"`{c}`") for c in parts.columns),
                    "_slot.sequence_id", "_slot.offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   ranks_path: str | None = None, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece."""
    return pack(scratch(pieces(docs, id_col, text_col, ranks_path, capacity, with_ids),
                        "pieces"), capacity)
