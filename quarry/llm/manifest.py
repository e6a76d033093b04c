"""Merkle manifest of a dataset by sibling-shift self-joins.

A row's leaf is the SHA-256 of its fields, each written as its length in bytes and its value.
Leaves of one group (``lang``) form a tree in id order; groups' roots, in group order, form the
last tree.  A level is a table of nodes ``(tree, place, n, digest)`` with ``n`` nodes in the
tree.  Every live node (``n > 1``) computes the places of its siblings, by XOR in binary trees
and by offsets of its slot otherwise, and an equijoin of the level with itself on
``(tree, place)`` brings their digests.  Slot-zero rows then emit the parents.  On the way back
each node takes its parent's path, so a row ends with the siblings of every level between its
leaf and the root, enough to prove the row without any other.

Places come from a range sort by (group, id, leaf) and prefix sums over one count per
partition and group; no group meets in one task.  Levels are tables in the shared folder;
the driver learns one number, the size of the largest tree.

Defined results: a null field is ``-``; a null group is a group of its own and comes first, so
do null ids; rows that repeat an id are ordered by their leaves, identical rows take a place
each; a lone leaf is its group's root, a lone group's root the root; an empty table gives an
empty result; texts of any length count whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import scratch

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def field(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` if null, else its UTF-8 length, ``:`` and its value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _placed(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_tree`` (a number per value of ``tree``), ``_place`` (from 0, by ``order``, nulls
    first) and ``_n`` (rows of the tree) to each row."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored once: a second evaluation of a range sort may draw other boundaries
    tagged = scratch(rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
                     .withColumn("_at", F.monotonically_increasing_id()), "manifest-order")
    tagged = tagged.withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    counts = tagged.groupBy("_part", tree).agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    own = Window.partitionBy(tree)  # at most one row per partition
    offsets = counts.select(
        F.col("_part").alias("_p"), F.col(tree).alias("_t"), F.min("_first").over(own).alias("_tree"),
        F.sum("_c").over(own).alias("_n"),
        (F.sum("_c").over(own.orderBy("_part")) - F.col("_c") - F.col("_first")).alias("_shift"))
    return (tagged.join(offsets, (F.col("_part") == F.col("_p")) & F.col(tree).eqNullSafe(F.col("_t")))
            .withColumn("_place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_p", "_t", "_shift"))


def _siblings(place: Column, n: Column, fanout: int) -> Column:
    """Places of a node's siblings in a tree of ``n`` nodes."""
    if fanout == 2:
        places = F.array(place.bitwiseXOR(F.lit(1).cast("long")))
    else:
        slot = place % fanout
        places = F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)),
                             lambda offset: place - slot + (slot + offset) % fanout)
    return F.filter(places, lambda sibling: sibling < n)


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Live nodes with ``left`` and ``right``: the digests of the siblings before and after."""
    live = nodes.where("_n > 1")
    asked = live.select("_tree", "_place", F.explode(_siblings(
        F.col("_place"), F.col("_n"), fanout)).alias("_sibling"))
    given = live.select("_tree", F.col("_place").alias("_sibling"), F.col("digest").alias("_digest"))
    found = (asked.join(given, ["_tree", "_sibling"]).groupBy("_tree", "_place")
             .agg(F.array_sort(F.collect_list(F.struct("_sibling", "_digest"))).alias("_all")))

    def side(keep) -> Column:
        return F.array_join(F.transform(F.filter("_all", keep), lambda s: s["_digest"]), "")
    place = F.col("_place")
    return live.join(found, ["_tree", "_place"], "left").select(
        *live.columns, F.coalesce(side(lambda s: s["_sibling"] < place), F.lit("")).alias("left"),
        F.coalesce(side(lambda s: s["_sibling"] > place), F.lit("")).alias("right"))


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Levels of all trees, lowest first, each as (live nodes with siblings, finished trees),
    and the finished trees ``_tree, digest`` of all levels."""
    most = nodes.agg(F.max("_n")).first()[0] or 0
    levels, tops = [], None
    while True:
        done = nodes.where("_n = 1")
        top = done.select("_tree", "digest")
        tops = top if tops is None else tops.unionByName(top)
        if most <= 1:
            return levels + [(None, done)], tops
        live = scratch(_with_siblings(nodes, fanout), "manifest-level")
        levels.append((live, done))
        nodes = live.where(F.col("_place") % fanout == 0).select(
            "_tree", F.floor(F.col("_place") / fanout).alias("_place"),
            F.floor((F.col("_n") + fanout - 1) / fanout).alias("_n"),
            F.sha2(F.concat("digest", "right"), 256).alias("digest"))
        most = -(-most // fanout)


def _paths(levels, tops: DataFrame, fanout: int) -> DataFrame:
    """Lowest nodes with ``path``: (left, right) of every level up to the root.  ``tops`` has
    the path above each tree; its other columns come down with the path."""
    extra = [c for c in tops.columns if c not in ("_tree", "path")]
    above = None
    for live, done in reversed(levels):
        here = done.join(tops, "_tree")
        if live is not None:
            up = above.select("_tree", F.col("_place").alias("_up"), F.col("path").alias("_path"), *extra)
            step = F.array(F.struct("left", "right"))
            here = here.unionByName(
                live.withColumn("_up", F.floor(F.col("_place") / fanout)).join(up, ["_tree", "_up"])
                .withColumn("path", F.concat(step, "_path")).drop("_up", "_path", "left", "right"))
        above = here
    return above


_PATH = "array<struct<left: string, right: string>>"


def merkle_manifest(leaves: DataFrame, tree: str, order: Sequence[str], leaf: str,
                    fanout: int = FANOUT) -> DataFrame:
    """Rows of ``leaves`` with ``subroot``, ``root`` and ``path``, the digests beside the row on
    every level from its leaf to the root (those before it and those after it, joined)."""
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    rows = leaves.select(F.col(leaf).alias("digest"), F.col(tree).alias("_key"),
                         F.struct(*(F.col(f"`{c}`") for c in leaves.columns)).alias("_row"),
                         *(F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)))
    placed = scratch(_placed(rows, "_key", [f"_o{i}" for i in range(len(order))] + ["digest"]).drop(
        *(f"_o{i}" for i in range(len(order)))), "manifest-leaves")
    levels, tops = _climb(placed, fanout)
    # the groups' roots, in group order, are the leaves of the last tree
    names = placed.where("_place = 0").select("_tree", "_key")
    roots = scratch(tops.join(names, "_tree").withColumnRenamed("_tree", "_group")
                    .withColumn("_one", F.lit(0)), "manifest-subroots")
    last = scratch(_placed(roots, "_one", ["_key"]), "manifest-last")
    last_levels, root = _climb(last, fanout)
    upper = _paths(last_levels, root.select("_tree", F.col("digest").alias("root"),
                                            F.array().cast(_PATH).alias("path")), fanout)
    tops = scratch(upper.select(F.col("_group").alias("_tree"), F.col("digest").alias("subroot"),
                                "root", "path"), "manifest-tops")
    return _paths(levels, tops, fanout).select(
        *(F.col("_row").getField(c).alias(c) for c in leaves.columns), "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(
        F.concat(step["left"], node, step["right"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, lowest level first."""
    return F.sha2(F.array_join(F.transform(
        path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(docs: DataFrame, tampered: Column, changed_text: Column, id_col: str = "doc_id",
             tree: str = "lang", fields: Sequence[str] = FIELDS, text_col: str = "text",
             fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``docs``: ``id_col, leaf, subroot, root, proof_sha256, folded_root,
    verified``.  ``folded_root`` starts from the row as it is found: with ``changed_text`` for
    its text where ``tampered`` holds."""
    values = {c: F.col(f"`{c}`") for c in fields}
    found = leaf_of([changed_text if c == text_col else v for c, v in values.items()])
    leaf = leaf_of(list(values.values()))
    leaves = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{tree}`").alias("_lang"),
                         leaf.alias("leaf"),
                         F.when(F.coalesce(tampered, F.lit(False)), found).otherwise(leaf).alias("_found"))
    # stored: the range sort samples its input, and the texts should be hashed once
    leaves = scratch(leaves, "manifest-rows")
    rows = merkle_manifest(leaves, "_lang", ["_id"], "leaf", fanout)
    return (rows.withColumn("folded_root", folded(F.col("_found"), F.col("path")))
            .select(F.col("_id").alias(id_col), "leaf", "subroot", "root",
                    proof(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
