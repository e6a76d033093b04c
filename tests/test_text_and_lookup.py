"""Word count token rules, name readers and lookups."""

from pyspark.sql import functions as F

from quarry.operators import lookup, text
from quarry.sources import read_delimited, read_lines, read_quoted_dimension

LINES = ["", "--", "--Hello, world!", "Hello again", "Hi."]


def test_word_count_non_empty(spark, write_text):
    df = read_lines(spark, write_text(LINES))
    got = {r.word: r["count"] for r in text.word_count(df).collect()}
    assert got == {"hello": 2, "world": 1, "again": 1, "hi": 1}


def test_word_count_with_empty_token(spark, write_text):
    df = read_lines(spark, write_text(LINES))
    got = {r.word: r["count"] for r in text.word_count(df, keep_empty=True).collect()}
    assert got == {"hello": 2, "world": 1, "again": 1, "hi": 1, "": 2}


def test_non_word_is_ascii_only(spark, write_text):
    df = read_lines(spark, write_text(["café x"]))
    got = {r.word for r in text.word_count(df).collect()}
    assert got == {"caf", "x"}


def test_space_separated_names_csv_reader(spark, write_text):
    path = write_text(['1 "ALPHA ONE"', "2 BETA", "3"])
    df = read_delimited(spark, path, "id int, name string", sep=" ")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "ALPHA ONE"), (2, "BETA"), (3, None)]


def test_quoted_names_loader_keeps_only_quoted(spark, write_text):
    path = write_text(['1 "ALPHA ONE"', "2 BETA", "3"])
    df = read_quoted_dimension(spark, path)
    assert [tuple(r) for r in df.collect()] == [(1, "ALPHA ONE")]


def test_latin1_pipe_items(spark, write_text):
    raw = b"1|Caf\xe9 (1995)|01-Jan-1995||http|0|1\n2|B|x\n3|\n"
    path = write_text(raw, "items.txt")
    df = read_delimited(spark, path, "movieID int, movieTitle string", sep="|",
                        encoding="ISO-8859-1")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Café (1995)"), (2, "B"), (3, None)]


def test_attach_name_left_join_and_strict_count(spark):
    counts = spark.createDataFrame([(1, 5), (2, 3), (9, 1)], "item int, count long")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    named = lookup.attach_name(counts, dim, "item", "id", "name")
    assert sorted(tuple(r) for r in named.collect()) == [(1, 5, "one"), (2, 3, "two"), (9, 1, None)]
    assert lookup.count_unmatched(named, "name").first().unmatched == 1


def test_top_k_is_ordered_limit(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, c int")
    top = lookup.top_k(df, [F.desc("c"), F.asc("id")], 3)
    assert [r.id for r in top.collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_pipe_dimension_skips_short_lines_and_dedupes(spark, write_text):
    from quarry.sources import read_dimension
    raw = b"1|Caf\xe9|x\n2\n3|Three|y\nbad|Name\n3|Three again|z\n"
    df = read_dimension(spark, write_text(raw, "dim.txt"), sep="|", encoding="ISO-8859-1")
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Café"), (3, "Three again")]


def test_min_converted_label_format(spark):
    from quarry.operators import relational
    df = spark.createDataFrame([("S1", -148.0), ("S1", 0.0)], "s string, t double")
    out = relational.min_then_convert(df, "s", "t").withColumn(
        "label", F.format_string("%.2f F", F.col("temperature")))
    assert out.first().label == "5.36 F"


def test_dimension_read_as_utf8_replaces_malformed_bytes(spark, write_text):
    """Reading Latin-1 bytes with the UTF-8 decoder replaces the bad byte
    with U+FFFD, as the replacing loader of one original program did."""
    from quarry.sources import read_dimension
    df = read_dimension(spark, write_text(b"1|Caf\xe9|x\n", "dim8.txt"), sep="|", encoding="UTF-8")
    assert [tuple(r) for r in df.collect()] == [(1, "Caf�")]


def test_dimension_last_line_wins_across_splits(spark, write_text):
    """A repeated id keeps its last line in file order (not the greatest
    name), also when the file is read as many splits."""
    from quarry.sources import read_dimension, read_quoted_dimension
    filler = [f"{i}|name {i}|x" for i in range(100, 20100)]
    raw = ("3|Zed|x\n" + "\n".join(filler) + "\n3|Alpha|y\n").encode("latin-1")
    path = write_text(raw, "big_dim.txt")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_dimension(spark, path, sep="|")
        assert spark.read.text(path).rdd.getNumPartitions() > 1
        got = {r.id: r.name for r in df.where("id = 3 or id = 100").collect()}
        assert got == {3: "Alpha", 100: "name 100"}
        q = read_quoted_dimension(spark, write_text(['3 "Zed"', '4 "Four"', '3 "Alpha"']))
        assert {r.id: r.name for r in q.collect()} == {3: "Alpha", 4: "Four"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_unmatched_lookup_reads_every_part(spark, tmp_path):
    """Small parts have names too: only the id without a part is unmatched."""
    from quarry.plans import QUERIES
    spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 50)], "p_partkey long, p_name string, p_size long"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1,), (2,), (2,), (3,), (4,)], "l_partkey long").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    assert QUERIES["popular_items_unmatched"](spark, str(tmp_path)).first().unmatched == 1
