"""Strict parsing with quarantine, true line numbers, fold tables."""

import os
from collections import Counter

import pytest

from quarry.operators import splits, text
from quarry.plans.file_jobs import rating_splits
from quarry.sources import good_rows, parse_strict, quarantined, read_dimension, read_lines, read_numbered_lines

FIELDS = [("station", 0, "string"), ("kind", 2, "string"), ("tenths", 3, "float")]


def test_good_and_quarantined_are_all_lines(spark, write_text):
    raw = [b"S1,20240101,TMIN,-12,,E", b"S2,20240101,TMAX,abc", b"S3,20240101", b"S\xe9,20240101,TMIN,5",
           b"", b"S4,20240102,TMIN,7", b",,,", b"S5,20240102,TMIN,1e3"]
    parsed = parse_strict(read_lines(spark, write_text(b"\n".join(raw) + b"\n")), FIELDS)
    good = sorted(tuple(r) for r in good_rows(parsed).collect())
    assert good == [("S1", "TMIN", -12.0), ("S4", "TMIN", 7.0), ("S5", "TMIN", 1000.0)]
    bad = Counter(r.problem for r in quarantined(parsed).collect())
    assert bad == {"bad tenths": 2, "missing fields": 2, "malformed bytes": 1}
    assert len(good) + sum(bad.values()) == len(raw)
    replaced = parse_strict(read_lines(spark, write_text(b"\n".join(raw))), FIELDS, malformed="replace")
    assert ("S�", "TMIN", 5.0) in {tuple(r) for r in good_rows(replaced).collect()}
    with pytest.raises(ValueError):
        parse_strict(read_lines(spark, write_text(["x"])), FIELDS, malformed="drop")


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_line_numbers_of_a_file_read_in_many_blocks(spark, write_text, tmp_path, small_blocks):
    for name, n in (("a.txt", 1000), ("b.txt", 37), ("c.txt", 1)):
        write_text([f"{name} {i + 1}" + " pad" * (i % 5) for i in range(n)], name)
    rows = read_numbered_lines(spark, str(tmp_path)).collect()
    assert len(rows) == 1038
    for r in rows:
        name, number = r.value.split(" ")[:2]
        assert os.path.basename(r.file) == name and r.line == int(number)


def test_first_and_last_line_rules_over_many_blocks(spark, write_text, small_blocks):
    path = write_text([f"{i % 10}|name {i}|x" for i in range(600)])
    last = {r.id: r.name for r in read_dimension(spark, path, encoding="UTF-8").collect()}
    first = {r.id: r.name for r in read_dimension(spark, path, encoding="UTF-8", keep="first").collect()}
    assert last == {i: f"name {590 + i}" for i in range(10)} and first == {i: f"name {i}" for i in range(10)}


def test_splits_in_file_order(spark, write_text, small_blocks):
    lines = [f"{i % 3}\t{i}\t{i % 5}\t{1000 - i}" for i in range(200)]
    path = write_text(lines[:100] + ["1\tx\t3\t4", "7"] + lines[100:])
    out = rating_splits(spark, path, folds=4, holdout_start=1, holdout_stop=2, file_order=True)
    folds = {r.movieID: r.fold for r in out["folds"].collect()}
    assert folds == {i: i // 50 + 1 for i in range(200)}
    assert {r.movieID for r in out["holdout"].where("split = 'test'").collect()} == {0, 1, 2, 3, 4, 5}
    assert sorted(r.problem for r in out["quarantined"].collect()) == ["bad movieID", "missing fields"]


def test_fold_tables_are_pruned_and_sorted(spark, tmp_path):
    df = spark.range(0, 103).selectExpr("id AS o", "id % 7 AS user", "103 - id AS item")
    path = str(tmp_path / "folds")
    splits.write_folds(splits.contiguous_folds(df, ["o"], 5), path, ["user", "item"])
    seen = set()
    for i in range(1, 6):
        test, base = splits.read_fold(spark, path, i, ["user", "item"])
        t, b = ([(r.user, r.item) for r in x.collect()] for x in (test, base))
        assert t == sorted(t) and b == sorted(b) and len(t) + len(b) == 103 and not set(t) & set(b)
        assert {103 - item for _, item in t} == set(range(21 * (i - 1), min(21 * i, 103)))
        seen |= set(t)
        for frame, sign in ((test, "="), (base, "NOT")):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            filters = plan[plan.index("PartitionFilters:"):].split("]")[0]
            assert "fold" in filters and sign in filters
    assert len(seen) == 103


def test_lines_are_split_once(spark):
    df = spark.createDataFrame([("--a\nb--\n---\n\nc d",), (None,)], "value string")
    counted = text.word_count(df, keep_empty=True)
    assert {r.word: r["count"] for r in counted.collect()} == {"": 2, "a": 1, "b": 1, "c": 1, "d": 1}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2  # the text into lines, the line into words
