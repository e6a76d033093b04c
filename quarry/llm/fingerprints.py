"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut without loss: into paragraphs at line ends, paragraphs into pieces of a few words
at punctuation and at words that their own hash elects, and paragraphs are gathered into
sections at headings, after blank lines and where a paragraph's digest elects an end.  Every
cut depends on the text near it alone, so an edit changes the nodes it touches and their
parents and leaves the others.  A piece's digest covers its exact characters, a node's digest
its children's, and the root all of them: equal roots mean equal texts.

The fingerprint writes the tree down: the root in full, sections and paragraphs with 16 hex
digits, pieces with 6.  Two fingerprints are compared from the top: equal roots are alike,
equal sections match whole, among the rest equal paragraphs match, then equal pieces.  The
likeness is the matched share of the pieces of both; what does not match is where the texts
differ (``differing_branches``).

``edit_fingerprints`` compares each row with the next one by id.  Documents are dealt to
buckets by split points of a range sort of (id, hash), one per partition; the first row of
each bucket goes to the bucket before it too, so a task streams its sorted rows and always has
the next one at hand.  Texts move once.

Defined results: a null text is empty; the empty text has a root and no section; a null id comes
first; rows that repeat an id are ordered by the hash of their content, equal rows follow each other; a
lone row is its own next one; texts of any length are read whole; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import document_key, text_bytes

#: Words of a piece at least, and the share (one in so many) of words and paragraphs that end
#: a piece or a section by their hash.
PIECE_WORDS, PIECE_ONE_IN, SECTION_ONE_IN = 3, 4, 4
_BATCH = 256

# a word with the white space behind it; runs without white space are cut after 24 characters
_WORD = re.compile(r"[ \t\r\f\v]*[^ \t\r\f\v\n]{1,24}[ \t\r\f\v]*\n?|[ \t\r\f\v]*\n|[ \t\r\f\v]+")
_ENDS = re.compile(r"[.!?;:,。，！？][\"')\]]?\s*\Z")
_HEADING = re.compile(r"#{1,6} |\d+(?:\.\d+)*\.? \S|[A-Z][A-Z \d]+$")


def _digest(kind: bytes, content: bytes) -> bytes:
    return hashlib.sha256(kind + content).digest()


def _pieces(paragraph: str) -> list[str]:
    out, current = [], []
    for word in _WORD.findall(paragraph):
        current.append(word)
        if len(current) >= PIECE_WORDS and (
                _ENDS.search(word) or zlib.crc32(word.strip().encode()) % PIECE_ONE_IN == 0):
            out.append("".join(current))
            current = []
    if current:
        out.append("".join(current))
    return out


def tree(text: str) -> tuple[str, list]:
    """``(root, sections)``: root in hex; a section is ``(digest, paragraphs)``, a paragraph
    ``(digest, pieces)``, a piece its digest.  The pieces' texts join to the whole text."""
    sections: list[tuple[bytes, list]] = []
    current: list[tuple[bytes, list[bytes]]] = []

    def close():
        if current:
            sections.append((_digest(b"s", b"".join(d for d, _ in current)), current.copy()))
            current.clear()
    blank = False
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        if current and (blank or _HEADING.match(line)):
            close()
        pieces = [_digest(b"l", p.encode("utf-8", "surrogatepass")) for p in _pieces(line)]
        digest = _digest(b"p", b"".join(pieces))
        current.append((digest, pieces))
        blank = not line.strip()
        if digest[0] % SECTION_ONE_IN == 0:
            close()
    close()
    root = _digest(b"r", b"".join(d for d, _ in sections))
    return root.hex(), [(d.hex()[:16], [(p.hex()[:16], [x.hex()[:6] for x in pieces])
                                        for p, pieces in paragraphs]) for d, paragraphs in sections]


def fingerprint(text: str) -> str:
    """``root/section/section``; a section ``digest.paragraph.paragraph``, a paragraph
    ``digest-pieces``."""
    root, sections = tree(text)
    return "/".join([root, *(".".join([d, *(f"{p}-{''.join(x)}" for p, x in paragraphs)])
                             for d, paragraphs in sections)])


def parse(mark: str) -> tuple[str, list]:
    """The tree of a fingerprint."""
    root, *sections = mark.split("/")
    out = []
    for section in sections:
        digest, *paragraphs = section.split(".")
        out.append((digest, [(p[:16], [p[i:i + 6] for i in range(17, len(p), 6)]) for p in paragraphs]))
    return root, out


def _size(node) -> int:
    return sum(len(x) for _, x in node[1]) if node[1] and isinstance(node[1][0], tuple) else len(node[1])


def _unmatched(one: list, two: list) -> tuple[int, list, list]:
    """Pieces in the nodes of equal digest, and the other nodes of both lists."""
    left = Counter(d for d, _ in two)
    rest, matched = [], 0
    for node in one:
        if left[node[0]] > 0:
            left[node[0]] -= 1
            matched += _size(node)
        else:
            rest.append(node)
    other = []
    for node in reversed(two):
        if left[node[0]] > 0:
            left[node[0]] -= 1
            other.append(node)
    return matched, rest, other[::-1]


def likeness(one: str, two: str) -> float:
    """Share of the pieces of two fingerprints that lie in equal branches (0 to 1)."""
    if one == two:
        return 1.0
    (root, a), (other, b) = parse(one), parse(two)
    if root == other:
        return 1.0
    total = sum(map(_size, a)) + sum(map(_size, b))
    if not total:
        return 0.0
    matched, a, b = _unmatched(a, b)
    more, a, b = _unmatched([p for _, s in a for p in s], [p for _, s in b for p in s])
    pieces = Counter(x for _, p in a for x in p) & Counter(x for _, p in b for x in p)
    # equal pieces only: the whole matches when its root does
    return min(2 * (matched + more + sum(pieces.values())) / total, 1.0)


def differing_branches(one: str, two: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the first text, from 0, that the second does not hold; a text
    that only gained something differs nowhere here, but its counterpart does."""
    (root, a), (other, b) = parse(one), parse(two)
    if root == other:
        return []
    sections = Counter(d for d, _ in b)
    open_, taken = [], Counter()
    for i, (d, paragraphs) in enumerate(a):
        if taken[d] < sections[d]:
            taken[d] += 1
        else:
            open_.append((i, paragraphs))
    left = Counter()
    for d, paragraphs in b:
        if taken[d] > 0:
            taken[d] -= 1
        else:
            left.update(p for p, _ in paragraphs)
    out = []
    for i, paragraphs in open_:
        for j, (p, _) in enumerate(paragraphs):
            if left[p] > 0:
                left[p] -= 1
            else:
                out.append((i, j))
    return out


def _place(row_id, key) -> tuple:
    return (row_id is not None, 0 if row_id is None else row_id, key)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_bucket, _look, _id, _key, _text`` such that, sorted by the first four, each row with
    ``_look = 0`` is followed by the next row by (id, key) of the whole table, cyclically."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), document_key(id_col, text_col).alias("_key"),
                       F.col(f"`{text_col}`").alias("_text"))
    # one split point per partition reaches the driver
    firsts = (rows.select("_id", "_key").repartitionByRange(parts, "_id", "_key")
              .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("_id", "_key")).alias("m"))
              .select("m._id", "m._key").collect())
    splits = sorted(_place(r["_id"], r["_key"]) for r in firsts)
    n = max(len(splits), 1)

    @F.arrow_udf("array<struct<bucket: int, look: int>>")
    def homes(ids: pa.Array, keys: pa.Array) -> pa.Array:
        out = []
        for place in map(_place, ids.to_pylist(), keys.to_pylist()):
            bucket = max(bisect_right(splits, place) - 1, 0)
            own = [{"bucket": bucket, "look": 0}]
            if splits and splits[bucket] == place:
                own.append({"bucket": (bucket - 1) % n, "look": 1})
            out.append(own)
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int32()), ("look", pa.int32())])))
    return (rows.withColumn("_h", F.explode(homes("_id", "_key")))
            .select(F.col("_h.bucket").alias("_bucket"), F.col("_h.look").alias("_look"),
                    "_id", "_key", "_text")
            .repartitionById(n, F.col("_bucket"))
            .sortWithinPartitions("_bucket", "_look", "_id", "_key"))


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def pairs(batches):
        """Rows that follow each other, as (bucket, look, id, text, fingerprint), lazily."""
        last = None
        for batch in batches:
            cols = {n: batch.column(batch.schema.get_field_index(n))
                    for n in ("_bucket", "_look", "_id", "_text")}
            types[0] = cols["_id"].type
            meta = zip(cols["_bucket"].to_pylist(), cols["_look"].to_pylist(), cols["_id"].to_pylist())
            for (bucket, look, row_id), raw in zip(meta, text_bytes(cols["_text"])):
                if last is not None and last[0] == bucket and last[1] and look:
                    continue  # copies of the next row: one is enough
                text = raw.decode("utf-8", "replace")
                row = (bucket, look, row_id, text, fingerprint(text))
                if last is not None and last[0] == bucket and not last[1]:
                    yield last, row
                last = row

    def run(batches):
        out = [[] for _ in names]

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types)], names=names)
            for v in out:
                v.clear()
            return batch
        for (_, _, row_id, text, mark), (_, _, _, following, next_mark) in pairs(batches):
            changed = edited(text, following)
            changed_mark = fingerprint(changed)
            values = (row_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                      mark, changed_mark, likeness(mark, changed_mark), likeness(mark, next_mark))
            for column, value in zip(out, values):
                column.append(value)
            if len(out[0]) >= _BATCH:
                yield flush()
        if out[0]:
            yield flush()
    return with_next(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
