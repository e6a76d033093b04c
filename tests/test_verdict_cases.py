"""Cases in which an earlier version was wrong or incomplete."""

import time

from pyspark.sql import functions as F

from quarry.functions.expressions import line_tokens_jvm
from quarry.operators import graph, relational, splits
from quarry.sources import read_dimension, read_quoted_dimension


def test_totals_round_only_the_sum(spark):
    df = spark.createDataFrame([(1, 0.004)] * 1000 + [(2, 1.005), (2, 1.005), (3, 1e17)],
                               "k int, v double")
    got = {r.k: r.t for r in relational.rounded_total_by_key(df, "k", "v", alias="t").collect()}
    assert got == {1: 4.0, 2: 2.01, 3: 1e17}


def test_search_reaches_the_end_of_a_long_chain(spark):
    lines = spark.createDataFrame([(f"{i} {i + 1}",) for i in range(1, 15)], "value string")
    levels, _ = graph.bfs(graph.edges(lines), 1)
    assert {r.id: r.distance for r in levels.collect()} == {i: i - 1 for i in range(1, 16)}
    capped, _ = graph.bfs(graph.edges(lines), 1, max_rounds=3)
    assert capped.count() == 4


def test_hub_edges_are_cut_into_blocks(spark):
    lines = spark.createDataFrame([("1 " + " ".join(map(str, range(2, 62))),),
                                   ("2 100",), ("3 100",)], "value string")
    plain = graph.bfs(graph.edges(lines), 1, target=100)
    cut = graph.bfs(graph.edges(lines), 1, target=100, block_edges=7)
    assert plain[1] == cut[1] == {"hops": 2, "parents": 2, "edge_hits": 2}
    assert sorted(plain[0].collect()) == sorted(cut[0].collect())


def test_test_set_limit_binds_when_passed(spark):
    df = spark.range(0, 40).select((F.col("id") % 4).alias("u"), F.col("id").alias("o"))
    free = splits.per_user_holdout(df, "u", ["o"], "o", 1, 5)
    held = splits.per_user_holdout(df, "u", ["o"], "o", 1, 5, max_test=7)
    assert free.where("split = 'test'").count() == 20
    assert held.where("split = 'test'").count() == 7
    assert held.count() == 40


def test_repeated_rating_lines_do_not_multiply(spark, write_text):
    from quarry.plans.file_jobs import rating_splits
    path = write_text(["1\t10\t3\t100", "1\t10\t3\t100", "1\t11\t4\t101"])
    assert rating_splits(spark, path)["holdout"].count() == 3


def test_dimension_keeps_empty_names_and_decodes(spark, write_text):
    path = write_text("1|Caf\xe9|x\n3||x\n4\n1|later|x\n".encode("latin-1"))
    last = {r.id: r.name for r in read_dimension(spark, path).collect()}
    first = {r.id: r.name for r in read_dimension(spark, path, keep="first").collect()}
    assert last == {1: "later", 3: ""} and first == {1: "Caf\xe9", 3: ""}


def test_quoted_dimension_decodes(spark, write_text):
    path = write_text('1 "Ren\xe9"\n2\n1 "SECOND"\n'.encode("latin-1"))
    assert [tuple(r) for r in read_quoted_dimension(spark, path, keep="first").collect()] == [
        (1, "Ren\xe9")]
    assert [tuple(r) for r in read_quoted_dimension(spark, path).collect()] == [(1, "SECOND")]


def test_java_split_rule_is_linear(spark):
    df = spark.createDataFrame([("a-b--",), ("--a",), ("---",), ("",), ("a",)], "l string")
    got = [r[0] for r in df.select(line_tokens_jvm("l")).collect()]
    assert got == [["a", "b"], ["", "a"], None, [""], ["a"]]
    long = spark.range(1).select(F.concat(F.repeat(F.lit("-"), 1_000_000), F.lit("z")).alias("l"))
    start = time.time()
    assert long.select(F.size(line_tokens_jvm("l"))).first()[0] == 2
    assert time.time() - start < 5
