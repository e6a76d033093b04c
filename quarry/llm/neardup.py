"""N-gram Jaccard join with a MinHash LSH forest.

A document is its set of ``shingle``-word windows (of all its words if it has fewer).  Texts
with the same word sequence (by a 128-bit digest) form one representative with a multiplicity.
Each of ``trees`` trees keeps the representatives' own MinHash signatures, ``longest`` values of
16 bits, as byte strings in sorted order: a sorted prefix trie, in which the representatives
below a node are neighbours and the node's depth is their common prefix.  Matching begins at
the longest prefix and shortens it, one value at a time, until a pair at the similarity
threshold is found with the target recall (``prefix_depth``); one pass over the sorted order
then tells every representative's longest common prefix with the one before it and links those
that still match to the first of their node.  A node of any size gives a star of candidate
edges, never all its pairs; tries are range-sorted, so a node may span tasks.  The stars'
components gather what can be linked, and inside each component every pair of representatives
is verified exactly, block against block, by intersection counts; only counts and a spanning
forest of the links leave a task.

Defined results: a text without words links with nothing, and so does a row with a null id;
texts of any length give all their shingles; rows that repeat a document are linked with each
other like copies; an empty table gives an empty result; extra columns are ignored by
``jaccard_classes`` and kept by ``one_per_class``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (columns_of, document_key, map_batches, packed, scratch,
                               text_bytes, unpacked)
from quarry.llm.graphs import block_pairs, components, local_roots
from quarry.llm.hashing import Windows, digest, mix, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
TREES = 20
LONGEST_PREFIX = 8
TARGET_RECALL = 0.999
#: Representatives of a component compared in one task at a time (two blocks of these).
BLOCK_ROWS = 512

_U = np.uint64


def shingles(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word windows (of the whole text if shorter)."""
    words = word_hashes(text)
    if not len(words):
        return np.zeros(0, dtype=_U)
    return np.unique(Windows(words).all(min(k, len(words))))


def sequence_hash(text: bytes) -> tuple[int, int]:
    """128-bit digest of a text's word sequence, as two signed numbers."""
    whole = digest(b" ".join(text.split()))
    return tuple(int.from_bytes(whole[i:i + 8], "little", signed=True) for i in (0, 8))


def prefix_depth(similarity: float = SIMILARITY, trees: int = TREES,
                 longest: int = LONGEST_PREFIX, recall: float = TARGET_RECALL) -> int:
    """Shorten the matched prefix until a pair at ``similarity`` meets in some tree with
    probability ``recall``."""
    depth = longest
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


class Forest:
    """Signatures of the trees: ``longest`` MinHash values of each, as big-endian 16-bit digits."""

    def __init__(self, trees: int, longest: int):
        state = np.random.default_rng(7)
        self.trees, self.longest = trees, longest
        n = (trees * longest + 1) // 2  # every product gives two 32-bit hashes
        self.a = state.integers(1, 1 << 63, n, dtype=np.uint64) | _U(1)
        self.b = state.integers(0, 1 << 63, n, dtype=np.uint64)

    def keys(self, items: np.ndarray) -> bytes:
        """The keys of all trees, one after the other, of a non-empty set."""
        low = np.full(2 * len(self.a), np.iinfo(np.uint32).max, dtype=np.uint32)
        for at in range(0, len(items), 1024):
            part = items[at:at + 1024, None] * self.a
            part += self.b
            np.minimum(low, part.view(np.uint32).min(axis=0), out=low)
        digits = mix(low.astype(_U)) >> _U(48)
        # neighbouring values come from one product and go to different trees
        return (digits[:self.trees * self.longest].reshape(self.longest, self.trees).T
                .astype(">u2").tobytes())


def _common(keys: np.ndarray) -> np.ndarray:
    """Values that each key (row of bytes) shares with the one before it, from the front."""
    same = (keys[1:] == keys[:-1]).reshape(len(keys) - 1, -1, 2).all(axis=2)
    return np.cumprod(same, axis=1).sum(axis=1)


def _tries(entries: DataFrame, depth: int) -> DataFrame:
    """Sorted tries of ``tree, key, rep``: ``rep, hub, level`` for every entry that shares at
    least ``depth`` values (``level`` of them) with the one before it; ``hub`` is the first
    entry of their node.

    Tasks hold consecutive ranges of the order.  What a task cannot see, whether its first
    entry continues the node that ended the task before, is told by the first and last entry of
    each partition; these few rows are compared on the driver."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None  # tree, key, hub of the entry before

        def rows(kind, tree, key, rep, hub, level):
            n = len(rep)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.asarray(tree, np.int32)), pa.array(key, pa.binary()),
                 pa.array(np.asarray(rep, np.int64)), pa.array(np.asarray(hub, np.int64)),
                 pa.array(np.asarray(level, np.int32))],
                names=["kind", "part", "tree", "key", "rep", "hub", "level"])
        for batch in batches:
            if not batch.num_rows:
                continue
            col = columns_of(batch, ["tree", "key", "rep"])
            tree, rep, texts = (np.asarray(col["tree"]), np.asarray(col["rep"]), col["key"].to_pylist())
            if last is None:
                yield rows(1, tree[:1], texts[:1], rep[:1], rep[:1], [0])
            else:
                tree, texts = np.concatenate([[last[0]], tree]), [last[1], *texts]
                rep = np.concatenate([[last[2]], rep])
            keys = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), -1)
            level = _common(keys)
            linked = (tree[1:] == tree[:-1]) & (level >= depth)
            start = np.concatenate([[0], np.where(linked, 0, np.arange(1, len(tree)))])
            hub = rep[np.maximum.accumulate(start)]
            at = np.flatnonzero(linked) + 1
            if len(at):
                yield rows(0, tree[at], [None] * len(at), rep[at], hub[at], level[at - 1])
            last = (tree[-1], texts[-1], hub[-1])
        if last is not None:
            yield rows(2, [last[0]], [last[1]], [last[2]], [last[2]], [0])
    found = scratch(
        entries.repartitionByRange(parts, "tree", "key", "rep")
        .sortWithinPartitions("tree", "key", "rep").mapInArrow(
            run, "kind int, part int, tree int, key binary, rep long, hub long, level int"), "tries")
    ends = sorted((r["part"], r["kind"], r["tree"], bytes(r["key"]), r["rep"])
                  for r in found.where("kind > 0").collect())  # two rows a partition
    across = []
    for (_, _, tree, key, hub), (_, _, next_tree, next_key, rep) in zip(ends[1::2], ends[2::2]):
        level = int(_common(np.frombuffer(key + next_key, np.uint8).reshape(2, -1))[0])
        if tree == next_tree and level >= depth:
            across.append((rep, hub, level))
    edges = found.where("kind = 0").select("rep", "hub", "level")
    return edges.unionByName(entries.sparkSession.createDataFrame(across, edges.schema))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(document_key(id_col, text_col).alias("_key"), F.col(id_col).alias("_id"),
                       F.col(text_col).alias("_text"))


def _signed(source: DataFrame, id_type: str, shingle: int, forest: Forest) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "_id", "_text"])
        first, second, keys = [], [], []
        for i, text in enumerate(text_bytes(col["_text"])):
            words = word_hashes(text)
            a, b = sequence_hash(text)
            first.append(a)
            second.append(b)
            if len(words) and col["_id"][i].is_valid:
                items = np.unique(Windows(words).all(min(shingle, len(words))))
                keys.append(forest.keys(items))
            else:
                keys.append(None)
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["_id"], pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array(keys, pa.binary())], names=["_key", "_id", "s1", "s2", "keys"])
    return map_batches(source, run, f"_key long, _id {id_type}, s1 long, s2 long, keys binary")


def _verify(similarity: float):
    """Task-side comparison of one pair of blocks: links per member and a spanning forest."""
    ratio = Fraction(str(similarity)).limit_denominator(10_000)

    def compare(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        sets = [np.array(x.values, dtype=np.int64) for x in part.column("items")]
        weight = part.column("copies").to_numpy()
        n = len(sets)
        size = np.array([len(x) for x in sets], dtype=np.int64)
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), size)
        often = np.bincount(codes, minlength=len(values)) > 1
        dense = np.cumsum(often) - 1
        keep = often[codes]
        column, owner = dense[codes[keep]], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        common = np.zeros((n, n), dtype=np.float64)
        width = 4096
        for at in range(0, int(often.sum()), width):
            lo, hi = np.searchsorted(column, [at, at + width])
            block = np.zeros((n, width), dtype=np.float32)
            block[owner[lo:hi], column[lo:hi] - at] = 1
            common += block @ block.T
        common = common.astype(np.int64)
        union = size[:, None] + size[None, :] - common
        linked = common * ratio.denominator >= ratio.numerator * union
        np.fill_diagonal(linked, False)
        if part.column("_i")[0].as_py() != part.column("_j")[0].as_py():
            side = part.column("_block").to_numpy()
            linked &= side[:, None] != side[None, :]
        roots = local_roots(linked)
        ids = part.column("rep")
        return pa.table({"rep": ids, "links": pa.array(linked @ weight, pa.int64()),
                         "root": ids.take(pa.array(roots))})
    return compare


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, similarity: float = SIMILARITY, trees: int = TREES,
                    recall: float = TARGET_RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document row: ``id_col, _key, _class`` (one value per class), ``class_id``
    (smallest id reachable by links), ``n_links`` (other rows linked directly) and ``kept`` (its
    id is the class's)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    forest = Forest(trees, LONGEST_PREFIX)
    source = _documents(docs, id_col, text_col)
    signed = scratch(_signed(source, id_type, shingle, forest), "signed")
    valid = signed.where("keys IS NOT NULL")
    reps = scratch(valid.groupBy("s1", "s2").agg(
        F.min(F.struct("_id", "_key")).alias("m"), F.count(F.lit(1)).alias("copies"),
        F.first("keys").alias("keys")).select(
        "s1", "s2", F.col("m._id").alias("rep"), F.col("m._key").alias("rep_key"), "copies",
        "keys"), "representatives")
    # one number per representative: two texts may repeat an id
    width = 2 * LONGEST_PREFIX
    entries = reps.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "keys",
                          F.col("rep_key").alias("rep")).select(
        "tree", F.expr(f"substring(keys, tree * {width} + 1, {width})").alias("key"), "rep")
    stars = _tries(entries, prefix_depth(similarity, trees, recall=recall))
    candidates = components(stars, "rep", "hub")
    chosen = (reps.select(F.col("rep_key").alias("_key"), "copies")
              .join(candidates.withColumnRenamed("node", "_key"), "_key"))

    def items_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_key", "copies", "component", "_text"])
        items = [shingles(t, shingle).view(np.int64) for t in text_bytes(col["_text"])]
        return pa.RecordBatch.from_arrays(
            [col["_key"], col["copies"], col["component"], pa.array(items, pa.list_(pa.int64()))],
            names=["rep", "copies", "component", "items"])
    members = scratch(map_batches(
        source.drop("_id").join(chosen, "_key"), items_of,
        "rep long, copies long, component long, items array<long>").dropDuplicates(["rep"]),
        "members")
    compared = scratch(
        block_pairs(members, ["component"], "rep", block_rows)
        .select("rep", "copies", "items", "component", "_i", "_j", "_block")
        .groupBy("component", "_i", "_j")
        .applyInArrow(_verify(similarity), "rep long, links long, root long"), "compared")
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(compared.where("rep <> root").select("rep", "root"), "rep", "root")
    named = (reps.select("rep_key", "rep", "s1", "s2", "copies")
             .join(linked.select(F.col("node").alias("rep_key"), "component"), "rep_key", "left")
             .join(links.withColumnRenamed("rep", "rep_key"), "rep_key", "left")
             .withColumn("component", F.coalesce("component", "rep_key")))
    named = scratch(named, "named")
    lowest = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    known = named.join(lowest, "component").select(
        "s1", "s2", F.concat(F.lit("linked "), F.col("component")).alias("_class"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .cast("long").alias("n_links"))
    rows = signed.withColumn("_valid", F.col("keys").isNotNull()).drop("keys")
    joined = rows.where("_valid").join(known, ["s1", "s2"]).select(
        "_key", "_id", "_class", "class_id", "n_links")
    alone = rows.where("NOT _valid").select(
        "_key", "_id", F.concat(F.lit("alone "), F.col("_key")).alias("_class"),
        F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return joined.unionByName(alone).select(
        F.col("_id").alias(id_col), "_key", "_class", "class_id", "n_links",
        F.col("_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The row of ``docs`` with the smallest id of each class, columns unchanged (of rows that
    repeat this id and the class the one with the smallest key); rows that share an id are
    different documents unless they are in one class."""
    kept = (jaccard_classes(docs, id_col, text_col, **options).groupBy("_class")
            .agg(F.min(F.struct(id_col, "_key")).alias("_first")).select("_first._key"))
    once = packed(docs, id_col, text_col).join(kept, "_key").dropDuplicates(["_key"])
    return unpacked(once, docs.columns)
