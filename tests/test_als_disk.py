"""What training, its evidence and the pruned search leave on disk and send through shuffles."""

import ast
import glob
import os
import random
import subprocess
import sys
import time
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark import cloudpickle

from quarry.operators import lineage, recommend


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _left(spark, before):
    """Shuffle files made since ``before``, once Spark's cleaner had time to act."""
    for _ in range(40):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    return left


@pytest.fixture(scope="module")
def ratings(spark):
    r = random.Random(5)
    rows = {(u, i): (i % 40) / 10 + (u % 3) / 4 for u in range(60) for i in r.sample(range(200), 20)}
    rows.update({(0, i): 2.0 for i in range(200)})  # one hot user
    return spark.createDataFrame([(u, i, v) for (u, i), v in rows.items()], "_u int, _i int, _r float").cache()


@pytest.fixture(scope="module")
def model(ratings):
    return recommend.fit_als(ratings, "_u", "_i", "_r", seed=3)


@pytest.fixture
def plans(monkeypatch):
    """Plans of what is stored, by the table's name."""
    seen, real = {}, recommend.write_through

    def spy(spark, name, build):
        def built():
            df = build()
            seen.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
            return df
        return real(spark, name, built)
    monkeypatch.setattr(recommend, "write_through", spy)
    return seen


def test_tables_written_through_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    behind = []

    def build():
        behind.append(lineage.write_table(spark.range(50), "behind"))
        return behind[0].repartition(3, "id")
    table = lineage.write_through(spark, "through", build)
    folder = os.path.dirname(behind[0].inputFiles()[0].removeprefix("file://"))
    assert sorted(r.id for r in table.collect()) == list(range(50))
    assert not _left(spark, before) and not os.path.exists(folder)
    here = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    lineage.remove_table(table)
    assert not os.path.exists(here)


def test_remove_table_only_takes_tables_of_the_shared_folder(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError):
        lineage.remove_table(spark.read.parquet(f"{tmp_path}/own"))
    assert spark.read.parquet(f"{tmp_path}/own").count() == 3


def test_training_leaves_no_shuffle_files_and_no_cached_blocks(spark, ratings):
    """The messages of all iterations stayed, and the model held them."""
    ratings.count()
    before, cached = _shuffle_files(spark), spark.sparkContext._jsc.getPersistentRDDs().size()
    model = recommend.fit_als(ratings, "_u", "_i", "_r", seed=4)
    assert not _left(spark, before)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached
    assert model.userFactors.count() == 60 and model.rank == 10 and model.getUserCol() == "_u"


def test_residuals_send_ratings_not_sums(model, ratings, plans):
    """Partial sums, 65 numbers of nearly every rating, went through a shuffle."""
    got = recommend.normal_equation_residuals(model, ratings, "_r")
    stored = [p for name, some in plans.items() for p in some] + [got._jdf.queryExecution().executedPlan().toString()]
    lines = [p.splitlines() for p in stored]
    assert not any("Exchange" in a and "partial_sum" in b for p in lines for a, b in zip(p, p[1:]))
    assert any("partial_sum" in line for p in lines for line in p)


@pytest.mark.parametrize("slice_ratings, hot_ratings", [(300, 10**6), (10**9, 100), (400, 100)])
def test_residuals_by_slices_and_of_hot_users(model, ratings, slice_ratings, hot_ratings):
    got = {r._u: r for r in recommend.normal_equation_residuals(
        model, ratings, "_r", slice_ratings=slice_ratings, hot_ratings=hot_ratings).collect()}
    items = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    users = {r.id: np.array(r.features, dtype=float) for r in model.userFactors.collect()}
    assert got.keys() == users.keys()
    rows = [tuple(r) for r in ratings.collect()]
    for u, x in users.items():
        v = np.array([items[i] for a, i, _ in rows if a == u])
        b = v.T @ np.array([s for a, _, s in rows if a == u])
        off = (v.T @ v + recommend.REG_PARAM * len(v) * np.eye(10)) @ x - b
        assert got[u].n_ratings == len(v)
        assert abs(got[u].residual - abs(off).max() / abs(b).max()) < 1e-9


def _whole_numbers(spark, n_users, n_items):
    """A model of small whole factors, so that scores are exact and many are equal."""
    r = random.Random(9)
    x = {u: [r.randint(-3, 3) for _ in range(4)] for u in range(n_users)}
    v = {i: [r.randint(-4, 4) for _ in range(4)] for i in range(n_items)}
    frame = lambda rows: spark.createDataFrame(
        [(k, [float(a) for a in f]) for k, f in rows.items()], "id int, features array<float>")
    model = SimpleNamespace(userFactors=frame(x), itemFactors=frame(v), getUserCol=lambda: "u", getItemCol=lambda: "i")
    return model, x, v


@pytest.mark.parametrize("block_items, round_blocks", [(8, (1, 2)), (5, (3,)), (8, (1000,)), (1000, (4,))])
def test_rounds_find_the_exact_best_with_ties(spark, block_items, round_blocks):
    model, x, v = _whole_numbers(spark, 40, 150)
    wanted = spark.createDataFrame([(u,) for u in [*range(40), 3, 3, 777]], "u int")
    top, report = recommend.recommend_pruned(model, wanted, 7, block_items, 16, round_blocks)
    got = {}
    for row in top.orderBy("u", "rank").collect():
        assert row["rank"] == len(got.setdefault(row.u, [])) + 1
        got[row.u].append((row.i, row.rating))
    want = {u: [(i, float(s)) for s, i in sorted(((sum(a * b for a, b in zip(f, v[i])), i) for i in v),
                                                 key=lambda p: (-p[0], p[1]))[:7]] for u, f in x.items()}
    assert got == want
    row = report.first()
    assert row.users == 40 and row.blocks == -(-150 // block_items) and row.pairs == 40 * row.blocks
    assert row.users <= row.scored <= row.pairs


def test_search_copies_no_chunks_into_shuffles(spark, plans):
    """Every chunk of users went through a shuffle once for every block it met."""
    model, x, _ = _whole_numbers(spark, 40, 150)
    folder = f"{lineage.checkpoint_dir(spark).removeprefix('file://')}/quarry-tables"
    recommend.recommend_pruned(model, model.userFactors.select(model.userFactors.id.alias("u")), 7, 8, 16, (1, 2))
    rounds = [p for p in plans["als-state"] if "MapInArrow" in p]
    assert len(rounds) > 2 and all("BroadcastHashJoin [_block" in p for p in rounds)
    assert not any("hashpartitioning(_block" in p for p in rounds)
    assert glob.glob(f"{folder}/als-done-*/") and not glob.glob(f"{folder}/als-state-*/")


def test_consecutive_blocks_of_a_chunk_give_one_result(spark):
    users = [(1, [1.0, 0.0], float("-inf")), (2, [1.0, 0.0], 6.5)]
    pairs = spark.createDataFrame(
        [(users, [(i, [float(i), 0.0]) for i in some]) for some in ([9, 8, 7], [6, 5], [4, 3])],
        "members array<struct<_user:int,_x:array<float>,_floor:float>>, "
        "items array<struct<_item:int,_v:array<float>>>").coalesce(1)
    got = sorted((r._user, r._item) for r in recommend._score_pairs(pairs, 4).collect())
    assert got == [(1, 6), (1, 7), (1, 8), (1, 9), (2, 7), (2, 8), (2, 9)]


def test_workers_need_not_have_the_package(tmp_path):
    with open(tmp_path / "sent", "wb") as f:
        f.write(cloudpickle.dumps((recommend._chunk_type(2), recommend._bound())))
    code = ("import sys, numpy as np; from pyspark import cloudpickle\n"
            "chunk, reach = cloudpickle.load(open('sent', 'rb')); assert 'quarry' not in sys.modules\n"
            "c = chunk(np.array([7]), np.array([[2.0]], np.float32), np.array([-np.inf]))\n"
            "c.meet(np.array([1, 2, 3]), np.array([[1.0], [3.0], [2.0]], np.float32)); print(c.batch().to_pylist())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert [r["_item"] for r in ast.literal_eval(got.stdout)] == [2, 3]
