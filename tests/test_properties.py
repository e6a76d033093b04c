"""Property checks: token rules against a model of Java's
String.split, cosine bounds, fold coverage, row numbering."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import line_tokens_jvm, word_tokens
from quarry.operators import similarity, splits

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
ASCII_LINE = st.text(alphabet="ab Z_9,.-!\t", max_size=12)
NON_WORD = re.compile(r"[^A-Za-z0-9_]+")


def java_split(s):
    """Java String.split(regex) with limit 0: a zero-length input gives [""];
    trailing empty strings are removed."""
    if s == "":
        return [""]
    parts = NON_WORD.split(s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(ASCII_LINE, min_size=1, max_size=6))
def test_line_tokens_match_java_split(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: (r.t or []) for r in df.select("i", line_tokens_jvm("line").alias("t")).collect()}
    assert {i: java_split(s) for i, s in enumerate(lines)} == got


@SETTINGS
@given(st.lists(ASCII_LINE, min_size=1, max_size=6))
def test_non_empty_tokens(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: r.t for r in df.select("i", word_tokens("line").alias("t")).collect()}
    assert got == {i: [w for w in NON_WORD.split(s) if w] for i, s in enumerate(lines)}


RATING_ROWS = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6), st.integers(0, 5)),
                       min_size=1, max_size=25)


@SETTINGS
@given(RATING_ROWS)
def test_pairs_ordered_and_cosine_bounded(spark, rows):
    uniq = {(u, i): r for u, i, r in rows}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in uniq.items()], "user int, item int, rating int")
    got = similarity.item_pairs(df).collect()
    by_user = {}
    for (u, i), r in uniq.items():
        by_user.setdefault(u, {})[i] = r
    expect = {}
    for items in by_user.values():
        for a in items:
            for b in items:
                if a < b:
                    xy, xx, yy, n = expect.get((a, b), (0, 0, 0, 0))
                    expect[(a, b)] = (xy + items[a] * items[b], xx + items[a] ** 2,
                                      yy + items[b] ** 2, n + 1)
    assert {(r.item1, r.item2) for r in got} == set(expect)
    for r in got:
        assert r.item1 < r.item2 and -1e-9 <= r.score <= 1 + 1e-9
        xy, xx, yy, n = expect[(r.item1, r.item2)]
        den = math.sqrt(xx) * math.sqrt(yy)
        assert r.strength == n and math.isclose(r.score, xy / den if den else 0.0, abs_tol=1e-12)


@SETTINGS
@given(st.integers(1, 60), st.integers(1, 7), st.integers(1, 5))
def test_folds_disjoint_and_covering(spark, n, k, parts):
    df = spark.range(0, n, 1, parts).select((F.col("id") * 37 % 1009).alias("key"))
    got = splits.contiguous_folds(df, ["key"], k).collect()
    keys = sorted(r.key for r in got)
    assert len(got) == n and len(set(keys)) == n
    size = math.ceil(n / k)
    rank = {key: i for i, key in enumerate(keys)}
    for r in got:
        assert r.fold == rank[r.key] // size + 1 and 1 <= r.fold <= k


@SETTINGS
@given(st.lists(st.text(alphabet="12 \t", max_size=10), min_size=1, max_size=6), st.booleans())
def test_neighbour_count_equals_token_count(spark, lines, trim):
    from quarry.functions import adjacency_neighbour_count, adjacency_tokens
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, v string")
    rows = df.select((F.size(adjacency_tokens("v", trim)) - 1).alias("a"),
                     adjacency_neighbour_count("v", trim).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
