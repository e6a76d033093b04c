"""Exact sums of doubles, against sums of fractions rounded once."""

import math
import random
from fractions import Fraction

import pytest

from quarry.operators.exact import exact_sum_by_key


def _cases():
    r = random.Random(8)
    cases = {"mixed": [1e100, 1.0, -1e100, 1e-30, 3.0], "tenths": [0.1] * 1000, "cents": [0.1, 0.2, 0.3],
             "cancel": [1e308, -1e308, 5e-324], "huge": [1e308] * 3 + [-1e308] * 2, "zero": [0.0, -0.0],
             "tie": [2.0 ** 53, 1.0], "tie up": [2.0 ** 53, 1.0, 2.0 ** -60], "tie down": [2.0 ** 53, 1.0, -(2.0 ** -60)],
             "negative": [-(2.0 ** 53), -1.0, -(2.0 ** -900)], "one": [-1.7976931348623157e308], "small": [2.0 ** -1022] * 3,
             "powers": [2.0 ** e for e in range(-300, 300, 7)], "edges": [2.0 ** 32, 2.0 ** 32 - 1, -(2.0 ** 64), 2.0 ** -32]}
    for i in range(40):
        cases[f"random {i}"] = [r.choice([1, -1]) * r.random() * 2.0 ** r.randrange(-r.choice([4, 60, 500]), 60)
                                for _ in range(r.randrange(1, 60))]
    return cases


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_are_exact_in_any_order(spark, parts):
    cases = _cases()
    rows = [(k, x) for k, xs in cases.items() for x in xs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    got = {r.k: r.total for r in exact_sum_by_key(df, "k", "x").collect()}
    assert got == {k: float(sum(map(Fraction, xs))) for k, xs in cases.items()}


def test_special_values(spark):
    inf, nan = math.inf, math.nan
    df = spark.createDataFrame([("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", nan), ("d", None), ("e", None),
                                ("e", 2.5), (None, 1.5), ("f", 1e308), ("f", 1e308)], "k string, x double")
    got = {r.k: r.total for r in exact_sum_by_key(df, "k", "x").collect()}
    assert got["a"] == inf and math.isnan(got["b"]) and math.isnan(got["c"]) and got["d"] is None
    assert got["e"] == 2.5 and got[None] == 1.5 and got["f"] == inf
    assert exact_sum_by_key(df.limit(0), "k", "x").count() == 0


def test_the_cuts_of_a_value_are_computed_once(spark):
    """Written as one expression, the pieces of a value repeated its logarithm some hundred times."""
    df = spark.createDataFrame([("a", 1.5)], "k string, x double")
    plan = exact_sum_by_key(df, "k", "x")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("LOG2(") <= 2
