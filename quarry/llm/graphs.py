"""Connected components and block-wise comparison of groups, for the joins on pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import scratch


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges (ids of one type, no nulls) -> ``node, component`` for every id that an edge
    names; the component is its smallest id.

    Contraction: every node hooks to its smallest neighbour, two pointer jumps shorten the
    chains, and edges move to the nodes' parents, dropping those inside a parent.  Each round
    at least halves the nodes that still have edges, so rounds grow with the logarithm of the
    input.  Everything stays in tables (shared folder); the driver only learns whether edges
    are left.
    """
    pairs = scratch(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                    .where("x <> y").distinct(), "edges")
    nodes = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    labels = nodes.withColumn("component", F.col("node"))
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parent = scratch(both.groupBy("x").agg(F.min("y").alias("p"))
                         .select("x", F.least("x", "p").alias("p")), "parents")
        for _ in range(2):
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("q"))
            parent = scratch(parent.join(up, "p").select("x", F.col("q").alias("p")), "parents")
        labels = scratch(
            labels.join(parent.select(F.col("x").alias("component"), "p"), "component", "left")
                  .select("node", F.coalesce("p", "component").alias("component")), "labels")
        to = parent.select(F.col("x").alias("_x"), "p")
        pairs = scratch(
            pairs.join(to, F.col("x") == F.col("_x")).select(F.col("p").alias("x"), "y")
                 .join(to.withColumnRenamed("p", "q"), F.col("y") == F.col("_x"))
                 .select("x", F.col("q").alias("y")).where("x <> y").distinct(), "edges")
    return labels


def block_pairs(members: DataFrame, group: list[str], spread: str, block_rows: int) -> DataFrame:
    """Lay out groups for comparison of all their members: adds ``_i, _j, _block``.

    A group is cut into blocks of about ``block_rows`` members (by a hash of ``spread``), and
    a copy of a member goes to every pair of blocks that holds its own.  Tasks that handle
    one ``(group, _i, _j)`` see at most two blocks whatever the group's size; a pair of
    members meets exactly once if the task compares a block with itself where ``_i = _j`` and
    only across the two blocks elsewhere.  ``members`` is read twice.
    """
    names = [f"_g{i}" for i in range(len(group))]
    sizes = (members.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select(*(F.col(g).alias(n) for g, n in zip(group, names)),
                     F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")))
    # stored: a join of two plain tables lets Spark split the members of a very large group
    sizes = scratch(sizes, "sizes")
    same = None
    for g, n in zip(group, names):
        same = F.col(g) == F.col(n) if same is None else same & (F.col(g) == F.col(n))
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(spread)), F.col("_blocks")).cast("int")
    return (members.join(sizes, same).withColumn("_block", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("_i", F.least("_block", "_other"))
            .withColumn("_j", F.greatest("_block", "_other"))
            .drop("_other", "_blocks", *names))


def local_roots(linked):
    """Smallest member reachable from each member, for a boolean link matrix of one task."""
    import numpy as np
    n = len(linked)
    root = np.arange(n)
    while True:
        best = np.minimum(root, np.where(linked, root[None, :], n).min(axis=1, initial=n))
        best = best[best]
        if (best == root).all():
            return root
        root = best
