"""Item pairs above thresholds by prefixes, against all pairs."""

import math
import random
from collections import defaultdict
from itertools import combinations

import pytest

from quarry.operators import similarity

SCHEMA = "user long, item long, rating double"


def _ratings(seed, users=60, items=40, hot=True):
    r = random.Random(seed)
    rows = {(u, i): float(r.randrange(1, 50)) for u in range(users)
            for i in r.sample(range(items), r.randrange(1, 7))}
    if hot:  # one user rates everything, one item is rated by everybody
        rows.update({(1000, i): 5.0 for i in range(items)})
        rows.update({(u, 0): float(u % 9 + 1) for u in range(users)})
    rows[5000, 77] = 0.0
    rows[5000, 78] = 0.0
    return rows


def _all_pairs(rows):
    by_item = defaultdict(dict)
    for (u, i), v in rows.items():
        by_item[i][u] = v
    out = {}
    for a, b in combinations(sorted(by_item), 2):
        common = by_item[a].keys() & by_item[b].keys()
        if common:
            xy = sum(by_item[a][u] * by_item[b][u] for u in common)
            xx, yy = (sum(by_item[i][u] ** 2 for u in common) for i in (a, b))
            out[a, b] = (xy / math.sqrt(xx) / math.sqrt(yy) if xx and yy else 0.0, len(common))
    return out


@pytest.mark.parametrize("strength, block_rows", [(0, 3), (3, 2000)])
def test_similar_pairs_equal_the_filtered_table(spark, strength, block_rows):
    rows = _ratings(strength)
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)
    want = {p: s for p, s in _all_pairs(rows).items() if s[0] > 0.8 and s[1] > strength}
    got = {(r.item1, r.item2): (r.score, r.strength)
           for r in similarity.similar_pairs(df, 0.8, strength, block_rows=block_rows,
                                             prefixes=True).collect()}
    by_cost = similarity.similar_pairs(df, 0.8, strength).select("item1", "item2").collect()
    assert {tuple(r) for r in by_cost} == want.keys()
    assert got.keys() == want.keys() and want
    for p, (score, n) in want.items():
        assert math.isclose(got[p][0], score) and got[p][1] == n


def test_candidates_hold_every_strong_pair_and_few_others(spark):
    rows = _ratings(7, users=400, items=120)
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)
    pairs = _all_pairs(rows)
    before = None
    for strength in (1, 4, 8):
        got = {(r.item1, r.item2): (r.n1, r.n2)
               for r in similarity.pair_candidates(df, strength).collect()}
        assert {p for p, s in pairs.items() if s[1] > strength} <= got.keys() <= pairs.keys()
        assert before is None or len(got) < before
        before = len(got)
    # the user who rates everything makes every pair a pair, but only few of them candidates
    assert len(pairs) > 7000 and before < len(pairs) / 2
    prefix = similarity.prefix_ratings(df.toDF("u", "i", "r"), 4)
    assert prefix.where("u = 1000").count() == 0


def test_similar_items_by_share_of_raters(spark):
    rows = _ratings(3)
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)
    raters = sum(1 for _, i in rows if i == 0)
    want = sorted(((-s[0], -s[1], b if a == 0 else a) for (a, b), s in _all_pairs(rows).items()
                   if 0 in (a, b) and s[0] > 0.7 and s[1] > 0.1 * raters))[:10]
    got = similarity.similar_items(df, 0, 0.7, min_share=0.1).collect()
    assert [r.item for r in got] == [w[2] for w in want] and got


def test_the_cheaper_way_is_taken(spark):
    few = spark.createDataFrame([(u, u + d, 1.0) for u in range(100) for d in (0, 1)], "u long, i long, r double")
    assert not similarity._prefixes_pay(few, 0)
    rows = [(u, i, 1.0) for u in range(6) for i in range(200)] + [(100 + i, i, 1.0) for i in range(200)]
    many = spark.createDataFrame(rows, "u long, i long, r double")
    assert similarity._prefixes_pay(many, 6)


@pytest.mark.parametrize("prefixes", [False, True])
def test_tasks_grow_with_the_pairs(spark, monkeypatch, prefixes):
    """The memory of a task is bounded: more pairs are cut into more tasks than the session has."""
    from quarry.operators import skew
    rows = _ratings(5, users=200)
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)
    want = {p for p, s in _all_pairs(rows).items() if s[0] > 0.5 and s[1] > 1}
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 1500 if prefixes else 100)
    found = similarity.similar_pairs(df, 0.5, 1, prefixes=prefixes)
    assert len(found.inputFiles()) > 1.5 * int(usual)
    assert {(r.item1, r.item2) for r in found.collect()} == want
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    assert len(similarity.pair_candidates(df, 1).inputFiles()) > 1.5 * int(usual)
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
