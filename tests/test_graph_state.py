"""Search state kept in place, search from both ends, the state-passing search at its end."""

import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from quarry.operators import graph, lineage


def _edges(spark, pairs):
    count = defaultdict(int)
    for p in pairs:
        count[p] += 1
    return spark.createDataFrame([(a, b, n) for (a, b), n in count.items()], "src long, dst long, n long")


@pytest.mark.parametrize("seed, symmetric", [(0, False), (1, True)])
def test_hit_from_both_ends_equals_the_plain_search(spark, seed, symmetric):
    r = random.Random(seed)
    pairs = [(r.randrange(40), r.randrange(40)) for _ in range(70)]
    pairs += [(0, i) for i in range(1, 12)] + [(60, 61)]
    if symmetric:
        pairs += [(b, a) for a, b in pairs]
    e = _edges(spark, pairs)
    for target in (39, 61, 0):
        want = graph.bfs(e, 0, target=target)[1]
        got = graph.bfs_hit(e, 0, target, symmetric=symmetric, block_edges=3)
        assert want == (got and {k: got[k] for k in ("hops", "parents", "edge_hits")}), target


def test_both_ends_expand_fewer_nodes(spark):
    # a chain of stars: from one side alone nearly every leaf is expanded
    pairs = [(i, i + 1) for i in range(5)] + [(i, 100 * (i + 1) + j) for i in range(5) for j in range(30)]
    pairs += [(b, a) for a, b in pairs]
    e = _edges(spark, pairs)
    levels, hit = graph.bfs(e, 0, target=5)
    got = graph.bfs_hit(e, 0, 5, symmetric=True)
    assert hit == {"hops": 5, "parents": 1, "edge_hits": 1} == {k: got[k] for k in hit}
    assert got["expanded"] < levels.where("color = 'BLACK'").count()
    assert graph.bfs_hit(e, 0, 5, symmetric=True, max_rounds=4) is None


def test_rounds_move_neither_edges_nor_visited_nodes(spark, monkeypatch):
    plans = []
    write = graph.write_bucketed

    def spy(df, name, cols, buckets):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, cols, buckets)
    monkeypatch.setattr(graph, "write_bucketed", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graph.bfs(_edges(spark, [(i, i + 1) for i in range(4)]), 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rounds = [p for name, p in plans if name == "bfs-level"][2:]
    assert len(rounds) >= 2
    for plan in rounds:
        lines = plan.split("== Initial Plan ==")[-1].split("\n")
        for i, line in enumerate(lines):
            if "Scan parquet" in line and ("[src#" in line or "_seen" in lines[i - 1] or "_seen" in lines[i - 2]):
                assert "Bucketed: true" in line
                depth = len(line) - len(line.lstrip(" :+-"))
                above = []
                for up in reversed(lines[:i]):
                    d = len(up) - len(up.lstrip(" :+-"))
                    if d < depth:
                        above.append(up.strip(" :+-"))
                        depth = d
                    if above and "Join" in above[-1]:
                        break
                assert not any(x.startswith("Exchange") for x in above), plan


def test_states_at_the_fixed_point(spark):
    lines = spark.createDataFrame([("1 2 3",), ("2 4 4",), ("1 5",), ("8 9",), ("7",), ("",), ("x 1",)], "value string")
    got = {r.id: (r.n_connections, r.distance, r.color) for r in graph.search_states(lines, 1).collect()}
    assert got == {1: (3, 0, "BLACK"), 2: (2, 1, "BLACK"), 3: (0, 1, "BLACK"), 4: (0, 2, "BLACK"),
                   5: (0, 1, "BLACK"), 8: (1, 9999, "WHITE"), 7: (0, 9999, "WHITE")}
    levels, _ = graph.bfs(graph.edges(lines), 1)
    want = {r.id: (r.distance, r.color) for r in graph.with_unreached(levels, lines).collect()}
    assert {k: v[1:] for k, v in got.items()} == want
    capped = {r.id: r.color for r in graph.search_states(lines, 1, max_rounds=1).collect()}
    assert capped[1] == "BLACK" and capped[2] == "GRAY" and capped[8] == "WHITE"


def test_scratch_scope_removes_its_tables(spark):
    import os
    with lineage.scratch_scope(spark):
        one = lineage.write_table(spark.range(5), "scope-test").inputFiles()[0]
        table = lineage.write_bucketed(spark.range(5), "scope-test", ["id"], 2)
        two = table.inputFiles()[0]
        assert table.count() == 5
    outside = lineage.write_table(spark.range(3), "scope-test")
    folder = lambda f: os.path.dirname(f.removeprefix("file://").replace("file:", ""))
    assert not os.path.exists(folder(one)) and not os.path.exists(folder(two))
    assert outside.count() == 3


def test_each_line_is_split_once(spark):
    """Parsing took the id out of a line three times; and the edge counts parsed all lines again."""
    lines = spark.createDataFrame([("1 2 3",), ("2 x 1",), ("y 1",), (" 4 ",), (None,), ("",)], "value string")
    split = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower()
    for parsed in (graph.parse_lines(lines), graph.occurrences(lines)):
        assert split(parsed).count("split(") == 1 and "regexp" not in split(parsed)
    raw = graph.edges(lines)
    joined = raw.join(graph.block_counts(raw, "src", 1, F.col("n") > 0), "src", "left")
    joined.collect()
    assert "ReusedExchange" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, graph.parse_lines(lines).collect())) == [(1, 2), (2, 2), (4, 0)]
    assert sorted(map(tuple, graph.occurrences(lines).collect())) == [(1, 2), (1, 3), (2, 1)]
