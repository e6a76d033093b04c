"""The jobs on files of the original formats, against plain Python over the same lines.

The files are generated (seeded); point ``QUARRY_PEOPLE_CSV`` at a people file and
``QUARRY_RATING_FILES`` at rating files (the five test folds) to run on those, in place, and
hold the results against their known numbers too.
"""

import math
import os
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quarry.operators import lookup, relational, similarity
from quarry.sources import read_delimited

FRIENDS = os.environ.get("QUARRY_PEOPLE_CSV", "")
FOLDS = [f for f in os.environ.get("QUARRY_RATING_FILES", "").split(",") if f]

RATING_SCHEMA = "userID int, movieID int, rating int, timestamp bigint"


@pytest.fixture(scope="module")
def people(tmp_path_factory):
    if FRIENDS:
        return FRIENDS
    r = random.Random(500)
    path = tmp_path_factory.mktemp("golden") / "people.csv"
    rows = [f"{i},{r.choice(['Ann', 'Bo', 'Cy'])},{r.randrange(18, 70)},{r.randrange(500)}" for i in range(500)]
    path.write_text("\n".join(["userID,name,age,friends", *rows]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def folds(tmp_path_factory):
    if FOLDS:
        return FOLDS
    r = random.Random(5)
    rows = list({(r.randrange(120), int(80 * r.random() ** 2)): r.randrange(1, 6) for _ in range(4000)}.items())
    out = []
    for k in range(5):
        path = tmp_path_factory.mktemp("golden") / f"u{k + 1}.test"
        path.write_text("".join(f"{u}\t{i}\t{v}\t{n}\n" for n, ((u, i), v) in enumerate(rows[k::5])))
        out.append(str(path))
    return out


@pytest.fixture(scope="module")
def lines(people):
    with open(people) as f:
        head, *rows = f.read().splitlines()
    age, friends = (head.split(",").index(c) for c in ("age", "friends"))
    return [(int(x.split(",")[age]), int(x.split(",")[friends])) for x in rows]


@pytest.fixture(scope="module")
def rated(folds):
    return [tuple(map(int, line.split("\t")[:3])) for f in folds for line in open(f)]


def _friends(spark, people):
    return read_delimited(spark, people, header=True, infer_schema=True)


def _ratings(spark, folds):
    return read_delimited(spark, folds, RATING_SCHEMA, sep="\t")


def test_friends_exploration(spark, people, lines):
    df = _friends(spark, people)
    ages = Counter(a for a, _ in lines)
    teens = "SELECT * FROM friends WHERE age >= 13 AND age <= 19"
    got = (df.count(), relational.filter_below(df, "age", 23).count(),
           relational.count_by_key(df, "age").count(), relational.sql_over_view(df, "friends", teens).count())
    assert got == (len(lines), sum(n for a, n in ages.items() if a < 23), len(ages),
                   sum(n for a, n in ages.items() if 13 <= a <= 19))
    if FRIENDS:
        assert got == (500, 39, 52, 19)


def test_friends_average(spark, people, lines):
    got = {r.age: r["avg(friends)"] for r in relational.average_by_key(
        _friends(spark, people), "age", "friends").collect()}
    by_age = defaultdict(list)
    for a, f in lines:
        by_age[a].append(f)
    assert got.keys() == by_age.keys()
    assert all(math.isclose(got[a], sum(x) / len(x)) for a, x in by_age.items())
    if FRIENDS:
        assert round(got[18], 4) == 343.375 and round(got[19], 4) == 213.2727
        assert got[20] == 165.0 and got[21] == 350.875


def test_fold_union_popularity(spark, folds, rated):
    top = lookup.top_k(lookup.popularity(_ratings(spark, folds), "movieID"),
                       [F.desc("count"), F.asc("movieID")], 5)
    got = [tuple(r) for r in top.collect()]
    assert got == sorted(Counter(i for _, i, _ in rated).items(), key=lambda x: (-x[1], x[0]))[:5]
    if FOLDS:
        assert got == [(50, 583), (258, 509), (100, 508), (181, 507), (294, 485)]


def _pairs(rated):
    by_user = defaultdict(list)
    for u, i, v in rated:
        by_user[u].append((i, v))
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for items in by_user.values():
        for (a, x), (b, y) in combinations(sorted(items), 2):
            s = sums[a, b]
            for k, v in enumerate((x * y, x * x, y * y, 1)):
                s[k] += v
    return {p: (s[0] / (math.sqrt(s[1]) * math.sqrt(s[2])), s[3]) for p, s in sums.items()}


def test_fold_union_similar_items(spark, folds, rated):
    movie, score, strength = (50, 0.97, 50.0) if FOLDS else (1, 0.8, 20.0)
    top = similarity.similar_items(_ratings(spark, folds), movie, score, strength, 10, user="userID",
                                   item="movieID", rating="rating")
    got = [(r.item, round(r.score, 6), r.strength) for r in top.collect()]
    want = [(a + b - movie, *s) for (a, b), s in _pairs(rated).items()
            if movie in (a, b) and s[0] > score and s[1] > strength]
    want = sorted(want, key=lambda x: (-x[1], -x[2], x[0]))[:10]
    assert [g[0] for g in got] == [w[0] for w in want] and len(got) == 10
    if FOLDS:
        assert got[:3] == [(172, 0.989552, 345), (181, 0.985723, 480), (174, 0.98176, 380)]


def test_fold_union_pair_table(spark, folds, rated):
    pairs = similarity.item_pairs(_ratings(spark, folds), "userID", "movieID", "rating")
    agg = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum("strength").alias("s")).first()
    want = _pairs(rated)
    assert (agg.n, agg.s) == (len(want), sum(s[1] for s in want.values()))
    if FOLDS:
        assert (agg.n, agg.s) == (983206, 10050406)
