"""Graphs given as adjacency text: ``"<id> <nbr> <nbr> ..."`` per line.

A node may span several lines; its degree is the sum over its lines of the
number of neighbour tokens (multiplicity counts).  Edges are kept as a table
``(src, dst, n)`` of distinct pairs with their multiplicity, so a hub never
becomes one giant row: no neighbour list is ever collected per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import adjacency_tokens
from quarry.operators.lineage import write_bucketed, write_table
from quarry.operators.skew import block_counts, block_of

# Node colours of the breadth-first search, lightest to darkest,
# the distance of an unreached node and the default round cap.
WHITE, GRAY, BLACK = "WHITE", "GRAY", "BLACK"
UNREACHED = 9999


def parse_lines(lines: DataFrame, col: str = "value", trim: bool = True) -> DataFrame:
    """One row per line: ``id`` (bigint; lines without a numeric id dropped)
    and ``n_tokens`` (neighbour tokens on the line, non-numeric ones included).

    A line is split once: a filter on the id itself would be pushed below the split and
    repeat it, one on what a generator gives out is not."""
    toks = lines.select(adjacency_tokens(col, trim).alias("_t"))
    line = F.struct(F.get("_t", F.lit(0)).try_cast("bigint").alias("id"),
                    (F.size("_t") - 1).alias("n_tokens"))
    return (toks.select(F.explode_outer(F.array(line)).alias("_p"))
                .where(F.col("_p.id").isNotNull()).select("_p.id", "_p.n_tokens"))


def occurrences(lines: DataFrame, col: str = "value", trim: bool = True) -> DataFrame:
    """One row per neighbour token: ``src, dst`` (non-numeric tokens dropped).

    The token array is built once per line and exploded with an outer
    generator; one filter on ``dst``, null also without a numeric id, keeps the
    optimiser from re-evaluating the split in a pre-filter, and columns that
    cannot be null keep joins from inferring another one."""
    toks = lines.select(adjacency_tokens(col, trim).alias("_t"))
    ids = toks.select(F.get("_t", F.lit(0)).try_cast("bigint").alias("_id"), "_t")
    dst = F.when(F.col("_id").isNotNull(), F.col("_tok").try_cast("bigint"))
    return (ids.select("_id", F.posexplode_outer("_t").alias("_pos", "_tok"))
               .where((F.col("_pos") > 0) & dst.isNotNull())
               .select(F.coalesce("_id", F.lit(0)).alias("src"),
                       F.coalesce(F.col("_tok").try_cast("bigint"), F.lit(0)).alias("dst")))


def edges(lines: DataFrame, col: str = "value", trim: bool = True) -> DataFrame:
    """Distinct directed edges with multiplicity: ``src, dst, n``.

    Partial aggregation combines repeated edges before the shuffle on
    ``(src, dst)``, which also spreads a hub's edges over many partitions."""
    return (occurrences(lines, col, trim)
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def degree(lines: DataFrame, col: str = "value", trim: bool = True) -> DataFrame:
    """``id, degree``: sum over the node's lines of its neighbour tokens."""
    parsed = parse_lines(lines, col, trim)
    return parsed.groupBy("id").agg(F.sum("n_tokens").alias("degree"))


def most_connected(deg: DataFrame) -> DataFrame:
    """The node of highest degree, ties to the smallest id (one row)."""
    return deg.orderBy(F.desc("degree"), F.asc("id")).limit(1)


def least_connected(deg: DataFrame) -> DataFrame:
    """Every node whose degree equals the minimum degree.

    The minimum is a one-row aggregate joined back on equality, so the plan
    never brings a scalar to the driver; the one-row side is broadcast."""
    low = deg.agg(F.min("degree").alias("_min"))
    return deg.join(F.broadcast(low), deg["degree"] == low["_min"]).drop("_min")


def _start_frame(spark, start: int) -> DataFrame:
    # a range row, not a literal: a literal id would be constant-folded into
    # the join conditions and turn the equi-joins into nested-loop joins
    return spark.range(start, start + 1).select("id", F.lit(0).alias("distance"))


def _buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _edge_table(edge_table: DataFrame, block_edges: int) -> tuple[DataFrame, DataFrame]:
    """Edges as a table bucketed by ``(src, block)``, and the sources of more than
    one block (``_hub, _blocks``).

    One write: a source's edge count and its edges come from the same aggregate, whose
    exchange Spark reuses within the plan (the count reads ``n``, or the two aggregates would
    differ).  A source with more than ``block_edges`` edges is
    cut into blocks by destination before anything is gathered by source."""
    raw = edge_table.select("src", "dst", "n")
    blocks = F.coalesce(F.col("_blocks"), F.lit(1))
    e = write_bucketed(
        raw.join(block_counts(raw, "src", block_edges, F.col("n") > 0), "src", "left")
        .select("src", "dst", "n", blocks.alias("_blocks"), block_of(F.col("dst"), blocks).alias("_block")),
        "bfs-edges", ["src", "_block"], _buckets(raw))
    hubs = write_table(e.where("_blocks > 1").select(F.col("src").alias("_hub"), "_blocks").distinct(),
                       "bfs-hubs")
    return e.drop("_blocks"), hubs


def _reach(frontier: DataFrame, e: DataFrame, hubs: DataFrame) -> DataFrame:
    """The frontier's edges (``src, dst, n``); only the frontier moves, a hub once per block,
    and the edges stream past its hash tables, unsorted."""
    last = F.coalesce(F.col("_blocks"), F.lit(1)) - 1
    asked = (frontier.select("id").join(hubs, F.col("id") == F.col("_hub"), "left")
             .select("id", F.explode(F.sequence(F.lit(0), last)).alias("_at")))
    return asked.hint("shuffle_hash").join(e, (asked["id"] == e["src"]) & (asked["_at"] == e["_block"]))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _level(reached: DataFrame, levels: list[DataFrame], keep=None) -> DataFrame:
    """The next level as a table bucketed by node: ``id, parents, edge_hits, _seen``.

    The visited check stays above the per-destination aggregate: as a left join + IS NULL it
    is not pushed into the edge scan.  Every level stays bucketed by node where it was
    written, and the union of the visited ones is read in place: neither they nor the
    aggregate move for the check.  ``keep``: rows that stay although visited."""
    # a source's blocks are split by destination, so a parent counts once
    cand = (reached.groupBy(F.col("dst").alias("id"))
            .agg(F.count(F.lit(1)).alias("parents"), F.sum("n").alias("edge_hits")))
    seen = _union([lv.select(F.col("id").alias("_seen")) for lv in levels])
    fresh = F.col("_seen").isNull()
    return write_bucketed(cand.join(seen, cand["id"] == seen["_seen"], "left")
                          .where(fresh if keep is None else fresh | keep),
                          "bfs-level", ["id"], _buckets(reached))


def _start_level(spark, node: int) -> DataFrame:
    start = _start_frame(spark, node).select("id")
    return write_bucketed(start, "bfs-level", ["id"], _buckets(start))


def bfs(edge_table: DataFrame, start: int, target: int | None = None,
        max_rounds: int | None = None, block_edges: int = 1_000_000
        ) -> tuple[DataFrame, dict | None]:
    """Breadth-first search from ``start`` until no new node is reached, or for
    at most ``max_rounds`` rounds where the caller sets them.

    Returns ``(levels, hit)``.  ``levels`` has ``id, distance, color`` for
    every reached node (nodes seen only as neighbours included).  When a
    ``target`` is given the search stops at the first round in which a
    frontier edge reaches it, and ``hit`` is ``{hops, parents, edge_hits}``:
    distinct frontier nodes with an edge to the target, and edge
    occurrences (parallel edges counted).  Reaching ``start`` itself counts
    only through such an edge, never as zero hops.

    The edges of a source are cut into blocks of about ``block_edges`` by
    destination; the edges are written once, as a table bucketed by
    ``(src, block)`` in the shared folder.
    Each round: frontier (a hub repeated once per block) ⋈ edges, hash-joined in
    place, so only the frontier moves → per-``dst`` counts (combined map-side) → check
    against the visited nodes, which stay where they are (``_level``).  Each
    round's level is a table in the shared folder, so lineage stays one round
    long and a lost executor never replays earlier rounds.
    """
    spark = edge_table.sparkSession
    e, hubs = _edge_table(edge_table, block_edges)
    levels = [_start_level(spark, start)]
    hit = None
    rounds = 0
    is_target = None if target is None else F.col("id") == F.lit(target)
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        # the target's row is kept even if visited: it can then only be the start
        found = _level(_reach(levels[-1], e, hubs), levels, is_target)
        # one small job over the new level: its size and the target's row
        at = F.lit(False) if is_target is None else is_target
        row = found.agg(F.count_if(F.col("_seen").isNull()).alias("size"),
                        F.max(F.when(at, F.col("parents"))).alias("parents"),
                        F.max(F.when(at, F.col("edge_hits"))).alias("hits")).first()
        if row["parents"]:
            hit = {"hops": rounds, "parents": row["parents"], "edge_hits": row["hits"]}
        if row["size"] == 0:
            break
        levels.append(found.where(F.col("_seen").isNull()).select("id"))
        if hit is not None:
            break
    out = _union([lv.withColumn("distance", F.lit(d)) for d, lv in enumerate(levels)])
    color = F.when(F.col("distance") < F.lit(rounds), F.lit(BLACK)).otherwise(F.lit(GRAY))
    return out.withColumn("color", color), hit


def bfs_hit(edge_table: DataFrame, start: int, target: int, symmetric: bool = False,
            max_rounds: int | None = None, block_edges: int = 1_000_000) -> dict | None:
    """The hit report of ``bfs`` by search from both ends: ``{hops, parents, edge_hits,
    expanded}`` (``expanded``: frontier nodes whose edges were read), None if not reached.

    The backward search reads the edges by destination, a second table laid out like the
    first; ``symmetric`` says that every edge also runs the other way, as often, and one table
    serves both.  Each round expands the smaller frontier.  The first time the two frontiers
    share a node the path's length is known; from the shared nodes the backward levels lead
    to those that stand one step before the target on a shortest path, which are the parents.
    ``start = target`` has no two ends and goes to ``bfs``.
    """
    spark = edge_table.sparkSession
    if start == target:
        hit = bfs(edge_table, start, target, max_rounds, block_edges)[1]
        return None if hit is None else hit | {"expanded": None}
    ahead = _edge_table(edge_table, block_edges)
    back = ahead if symmetric else _edge_table(
        edge_table.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"), block_edges)
    tables, ends = (ahead, back), (start, target)
    levels = [[_start_level(spark, node)] for node in ends]
    sizes, expanded = [1, 1], 0
    while max_rounds is None or len(levels[0]) + len(levels[1]) - 2 < max_rounds:
        side = int(sizes[1] < sizes[0])
        found = _level(_reach(levels[side][-1], *tables[side]), levels[side]).select("id")
        expanded += sizes[side]
        other = levels[1 - side][-1].select(F.col("id").alias("_other"))
        row = found.join(other, found["id"] == other["_other"], "left").agg(
            F.count(F.lit(1)).alias("size"), F.count("_other").alias("met")).first()
        if row["size"] == 0:
            return None
        levels[side].append(found)
        sizes[side] = row["size"]
        if row["met"]:
            break
    else:
        return None
    forward, backward = levels
    if len(backward) == 1:
        parents = forward[-2]
    else:  # the shared nodes, then step by step along the backward levels
        parents = forward[-1].join(backward[-1], "id", "left_semi")
        for level in reversed(backward[1:-1]):
            steps = _reach(parents, *ahead).select(F.col("dst").alias("id")).distinct()
            parents = steps.join(level, "id", "left_semi")
    before = _reach(levels[1][0], *back).select(F.col("dst").alias("id"), "n")
    row = before.join(parents, "id", "left_semi").agg(
        F.count(F.lit(1)).alias("parents"), F.sum("n").alias("hits")).first()
    return {"hops": len(forward) + len(backward) - 2, "parents": row["parents"],
            "edge_hits": row["hits"], "expanded": expanded}


def with_unreached(levels: DataFrame, lines: DataFrame, col: str = "value",
                   trim: bool = True) -> DataFrame:
    """Add every node that has a line but was not reached, with distance 9999
    and colour WHITE (the full node table of the state-passing search)."""
    nodes = parse_lines(lines, col, trim).select("id").distinct()
    missing = (nodes.join(levels.select("id"), "id", "left_anti")
                    .select("id", F.lit(UNREACHED).alias("distance"), F.lit(WHITE).alias("color")))
    return levels.unionByName(missing)


def hit_frame(spark, start: int, target: int, hit: dict | None) -> DataFrame:
    """The BFS hit report as a one-row DataFrame (no row when not reached)."""
    schema = "start bigint, target bigint, hops int, parents bigint, edge_hits bigint"
    rows = [] if hit is None else [(start, target, hit["hops"], hit["parents"],
                                    hit["edge_hits"])]
    return spark.createDataFrame(rows, schema)


def bfs_round_states(lines: DataFrame, start: int, col: str = "value",
                     trim: bool = True) -> DataFrame:
    """One expansion round in node-state form, merged per node.

    State rows: every line gives ``(id, its neighbour count, 0 | 9999,
    GRAY | WHITE)``; the start's lines expand into ``(nbr, 0, 1, GRAY)`` and
    turn BLACK.  Merging keeps the summed neighbour count, the smallest
    distance and the darkest colour (WHITE < GRAY < BLACK) — the per-node
    reduce of the state-passing BFS, without concatenating neighbour lists.
    """
    is_start = F.col("id") == F.lit(start)
    own = parse_lines(lines, col, trim).select(
        "id", F.col("n_tokens").cast("bigint").alias("n_connections"),
        F.when(is_start, 0).otherwise(UNREACHED).alias("distance"),
        F.when(is_start, 2).otherwise(0).alias("_rank"))
    spawned = (occurrences(lines, col, trim).where(F.col("src") == F.lit(start))
               .select(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("n_connections"),
                       F.lit(1).alias("distance"), F.lit(1).alias("_rank")))
    return merge_node_states(own.unionByName(spawned))


def merge_node_states(states: DataFrame) -> DataFrame:
    """``id, n_connections, distance, _rank`` → one row per id (all algebraic
    aggregates, combined map-side)."""
    merged = states.groupBy("id").agg(F.sum("n_connections").alias("n_connections"),
                                      F.min("distance").alias("distance"),
                                      F.max("_rank").alias("_rank"))
    color = (F.when(F.col("_rank") == 2, F.lit(BLACK))
              .when(F.col("_rank") == 1, F.lit(GRAY)).otherwise(F.lit(WHITE)))
    return merged.select("id", "n_connections", "distance", color.alias("color"))


def search_states(lines: DataFrame, start: int, col: str = "value", trim: bool = True,
                  max_rounds: int | None = None) -> DataFrame:
    """The state-passing search run to its fixed point: ``id, n_connections, distance, color``
    of every node with a line or reached.

    The original loop passes every node's state through every round's map and reduce, changed
    or not.  Here the evaluation is semi-naive: only nodes whose state changed in a round
    expand in the next (``bfs``), and as merging is a minimum, a maximum and a sum, the
    unchanged states and those of all rounds are merged once, at the end.
    """
    levels, _ = bfs(edges(lines, col, trim), start, max_rounds=max_rounds)
    own = parse_lines(lines, col, trim).select(
        "id", F.col("n_tokens").cast("bigint").alias("n_connections"),
        F.lit(UNREACHED).alias("distance"), F.lit(0).alias("_rank"))
    reached = levels.select("id", F.lit(0).cast("bigint").alias("n_connections"), "distance",
                            F.when(F.col("color") == BLACK, 2).otherwise(1).alias("_rank"))
    return merge_node_states(own.unionByName(reached))
