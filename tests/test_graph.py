"""Adjacency-text graph fixture (FIXTURES §3.5)."""

import pytest

from quarry.operators import graph
from quarry.sources import read_lines

GRAPH = ["1 2 3", "1 4 ", "2 1 5", "3 1 5", "4 1", "5 3 6 6", "7"]


@pytest.fixture
def lines(spark, write_text):
    return read_lines(spark, write_text(GRAPH))


def test_degree_trim(lines):
    got = {r.id: r.degree for r in graph.degree(lines).collect()}
    assert got == {1: 3, 2: 2, 3: 2, 4: 1, 5: 3, 7: 0}


def test_degree_literal_counts_trailing_space(lines):
    got = {r.id: r.degree for r in graph.degree(lines, trim=False).collect()}
    assert got == {1: 4, 2: 2, 3: 2, 4: 1, 5: 3, 7: 0}


def test_most_and_least_connected(lines):
    deg = graph.degree(lines)
    assert tuple(graph.most_connected(deg).first()) == (1, 3)
    assert [tuple(r) for r in graph.least_connected(deg).collect()] == [(7, 0)]


def test_edges_keep_multiplicity(lines):
    got = {(r.src, r.dst): r.n for r in graph.edges(lines).collect()}
    assert got[(5, 6)] == 2 and got[(1, 2)] == 1 and len(got) == 10


def test_bfs_distances(lines):
    levels, hit = graph.bfs(graph.edges(lines), 1)
    assert hit is None
    got = {r.id: r.distance for r in levels.collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 2, 6: 3}


@pytest.mark.parametrize("target,expected", [
    (5, {"hops": 2, "parents": 2, "edge_hits": 2}),
    (6, {"hops": 3, "parents": 1, "edge_hits": 2}),
    (7, None),
    (1, {"hops": 2, "parents": 3, "edge_hits": 3}),
])
def test_bfs_hit(lines, target, expected):
    _, hit = graph.bfs(graph.edges(lines), 1, target=target)
    assert hit == expected


def test_bfs_respects_round_cap(lines):
    _, hit = graph.bfs(graph.edges(lines), 1, target=6, max_rounds=2)
    assert hit is None


def test_bfs_property_distance_bound(lines):
    levels, _ = graph.bfs(graph.edges(lines), 1)
    dist = {r.id: r.distance for r in levels.collect()}
    for e in graph.edges(lines).collect():
        if e.src in dist:
            assert dist[e.dst] <= dist[e.src] + 1


def test_round_states_merge(lines):
    got = {r.id: (r.n_connections, r.distance, r.color)
           for r in graph.bfs_round_states(lines, 1).collect()}
    assert got[1] == (3, 0, "BLACK")
    assert got[2] == (2, 1, "GRAY") and got[4] == (1, 1, "GRAY")
    assert got[5] == (3, 9999, "WHITE") and got[7] == (0, 9999, "WHITE")


def test_bfs_with_unreached(lines):
    levels, _ = graph.bfs(graph.edges(lines), 1)
    got = {r.id: (r.distance, r.color) for r in graph.with_unreached(levels, lines).collect()}
    assert got[7] == (9999, "WHITE") and got[6] == (3, "BLACK") and got[1] == (0, "BLACK")
    assert len(got) == 7


def test_bfs_round_cap_leaves_last_level_gray(lines):
    levels, _ = graph.bfs(graph.edges(lines), 1, max_rounds=1)
    got = {r.id: (r.distance, r.color) for r in levels.collect()}
    assert got == {1: (0, "BLACK"), 2: (1, "GRAY"), 3: (1, "GRAY"), 4: (1, "GRAY")}


def test_bfs_with_salted_hubs_same_result(lines):
    base = graph.bfs(graph.edges(lines), 1, target=6)
    salted = graph.bfs(graph.edges(lines), 1, target=6, block_edges=1)
    assert salted[1] == base[1]
    assert sorted(tuple(r) for r in salted[0].collect()) == sorted(tuple(r) for r in base[0].collect())


def test_integer_ids_merge_zero_padded_lines(spark, write_text):
    lines = read_lines(spark, write_text(["007 1", "7 2", "", "x 1"]))
    assert {r.id: r.degree for r in graph.degree(lines).collect()} == {7: 2}


def test_most_connected_tie_goes_to_smallest_id(spark, write_text):
    lines = read_lines(spark, write_text(["9 1 2", "4 1 2", "6 1"]))
    assert tuple(graph.most_connected(graph.degree(lines)).first()) == (4, 2)
