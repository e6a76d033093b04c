"""What a trained model must satisfy, and its exact top-n by pruned search."""

import random

import numpy as np
import pytest

from quarry.operators import recommend


@pytest.fixture(scope="module")
def ratings(spark):
    r = random.Random(1)
    rows = {(u, i): (i % 50) / 10 + (u % 3) / 4 for u in range(80) for i in r.sample(range(300), 25)}
    rows.update({(0, i): 2.0 for i in range(300)})  # one user rates everything
    return spark.createDataFrame([(u, i, v) for (u, i), v in rows.items()],
                                 "_u int, _i int, _r float").cache()


@pytest.fixture(scope="module")
def model(ratings):
    return recommend.fit_als(ratings, "_u", "_i", "_r", seed=3)


def test_user_factors_solve_the_normal_equations(model, ratings):
    got = {r._u: r for r in recommend.normal_equation_residuals(model, ratings, "_r").collect()}
    assert len(got) == 80 and max(r.residual for r in got.values()) < 1e-4
    items = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    users = {r.id: np.array(r.features, dtype=float) for r in model.userFactors.collect()}
    rows = [tuple(r) for r in ratings.collect()]
    for u in (0, 7):
        v = np.array([items[i] for a, i, _ in rows if a == u])
        b = v.T @ np.array([x for a, _, x in rows if a == u])
        off = (v.T @ v + recommend.REG_PARAM * len(v) * np.eye(10)) @ users[u] - b
        assert got[u].n_ratings == len(v)
        assert abs(got[u].residual - abs(off).max() / abs(b).max()) < 1e-9
    wrong = recommend.normal_equation_residuals(model, ratings, "_r", reg_param=0.2)
    assert wrong.agg({"residual": "max"}).first()[0] > 1e-3


def test_prediction_error_counts_known_pairs_only(spark, model, ratings):
    held = spark.createDataFrame([(1, 2, 0.45), (1, 9999, 1.0), (777, 2, 1.0), (5, 40, 4.5)],
                                 "_u int, _i int, _r float")
    row = recommend.prediction_error(model, held, "_r", 2.0).first()
    x = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    v = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    want = np.sqrt(np.mean([(x[1] @ v[2] - 0.45) ** 2, (x[5] @ v[40] - 4.5) ** 2]))
    assert row.n == 2 and abs(row.rmse - want) < 1e-6
    assert abs(row.rmse_mean - np.sqrt((1.55 ** 2 + 2.5 ** 2) / 2)) < 1e-6


@pytest.mark.parametrize("block_items, chunk_users", [(16, 7), (64, 1000)])
def test_pruned_search_equals_the_exhaustive_one(spark, model, ratings, block_items, chunk_users):
    users = ratings.select("_u").distinct().unionByName(spark.createDataFrame([(9999,), (3,)], "_u int"))
    want = {(r._u, r["rank"]): (r._i, r.rating) for r in recommend.recommend(model, users, 10).collect()}
    top, report = recommend.recommend_pruned(model, users, 10, block_items, chunk_users)
    got = {(r._u, r["rank"]): (r._i, r.rating) for r in top.collect()}
    assert got.keys() == want.keys() and len(got) == 800
    assert all(abs(got[k][1] - want[k][1]) < 1e-5 for k in want)
    assert np.mean([got[k][0] == want[k][0] for k in want]) > 0.99  # but for near ties
    row = report.first()
    assert row.users == 80 and row.blocks == -(-300 // block_items) and row.pairs == 80 * row.blocks
    assert row.users <= row.scored <= row.pairs
    if block_items == 16:
        assert row.scored < row.pairs


def test_pruned_search_for_more_items_than_there_are(model, ratings):
    top, _ = recommend.recommend_pruned(model, ratings.select("_u").distinct().limit(2), 1000, 64)
    assert top.count() == 2 * 300


def test_scores_below_the_floor_are_not_handed_on(spark):
    """Every block gave n rows per user, whatever the user's n-th best of the first block was."""
    items = [(i, [float(i), 0.0]) for i in range(6)]
    users = [(1, [1.0, 0.0], 3.0), (2, [1.0, 0.0], float("-inf")), (3, [1.0, 0.0], 9.0), (4, [1.0, 0.0], 5.0)]
    pairs = spark.createDataFrame(
        [(users, items)], "members array<struct<_user:int,_x:array<float>,_floor:float>>, "
        "items array<struct<_item:int,_v:array<float>>>")
    got = sorted((r._user, r._item) for r in recommend._score_pairs(pairs, 4).collect())
    assert got == [(1, 3), (1, 4), (1, 5), (2, 2), (2, 3), (2, 4), (2, 5), (4, 5)]
