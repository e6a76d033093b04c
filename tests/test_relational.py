"""People, customer orders and temperature fixtures (hand-made, expected
results worked out by hand)."""

from pyspark.sql import functions as F

from quarry.operators import relational
from quarry.sources import read_delimited

PEOPLE = ["id,name,age,friends", "0,A,13,10", "1,B,19,30", "2,C,22,5", "3,D,23,7", "4,E,22,6"]


def test_people_inferred_schema_and_filter(spark, write_text):
    df = read_delimited(spark, write_text(PEOPLE), header=True, infer_schema=True)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("id", "int"), ("name", "string"), ("age", "int"), ("friends", "int")]
    ids = sorted(r.id for r in relational.filter_below(df, "age", 23).collect())
    assert ids == [0, 1, 2, 4]


def test_people_offset_keeps_auto_name(spark, write_text):
    df = read_delimited(spark, write_text(PEOPLE), header=True, infer_schema=True)
    out = relational.with_offset(df, ["name"], "age", 10)
    assert out.columns == ["name", "(age + 10)"]
    assert sorted(r[1] for r in out.collect()) == [23, 29, 32, 32, 33]


def test_people_average_by_age(spark, write_text):
    df = read_delimited(spark, write_text(PEOPLE), header=True, infer_schema=True)
    out = relational.average_by_key(df, "age", "friends").orderBy("age")
    assert out.columns == ["age", "avg(friends)"]
    assert [tuple(r) for r in out.collect()] == [(13, 10.0), (19, 30.0), (22, 5.5), (23, 7.0)]


def test_people_sql_view(spark, write_text):
    df = read_delimited(spark, write_text(PEOPLE), header=True, infer_schema=True)
    out = relational.sql_over_view(df, "people", "SELECT * FROM people WHERE age >= 13 AND age <= 19")
    assert sorted(r.id for r in out.collect()) == [0, 1]


def test_count_by_key(spark, write_text):
    df = read_delimited(spark, write_text(PEOPLE), header=True, infer_schema=True)
    got = {r.age: r["count"] for r in relational.count_by_key(df, "age").collect()}
    assert got == {13: 1, 19: 1, 22: 2, 23: 1}


def test_customer_spend(spark, write_text):
    path = write_text(["7,100,10.10", "7,101,0.25", "8,100,5.00", "9,5,99.99"])
    df = read_delimited(spark, path, "user_id int, item_id int, amt double")
    out = relational.rounded_total_by_key(df, "user_id", "amt").orderBy("total_spent")
    assert [tuple(r) for r in out.collect()] == [(8, 5.0), (7, 10.35), (9, 99.99)]


TEMPS = ["S1,18000101,TMIN,-148,,,E,", "S1,18000102,TMIN,0,,,E,", "S1,18000101,TMAX,300,,,E,",
         "S2,18000101,TMIN,-50,,,E,", "S3,18000101,TMIN,-200,,,E,"]
TEMP_SCHEMA = "stationID string, date int, measure_type string, temperature float"


def test_min_then_convert_sorted_by_temperature(spark, write_text):
    df = read_delimited(spark, write_text(TEMPS), TEMP_SCHEMA)
    out = relational.min_then_convert(df, "stationID", "temperature",
                                      where=F.col("measure_type") == "TMIN").orderBy("temperature")
    assert out.schema["temperature"].dataType.simpleString() == "float"
    rows = [(r.stationID, round(r.temperature, 4)) for r in out.collect()]
    assert rows == [("S3", -4.0), ("S1", 5.36), ("S2", 23.0)]


def test_convert_then_min_sorted_by_station(spark, write_text):
    df = read_delimited(spark, write_text(TEMPS), TEMP_SCHEMA)
    out = relational.convert_then_min(df, "stationID", "temperature",
                                      where=F.col("measure_type") == "TMIN").orderBy("stationID")
    rows = [(r.stationID, round(r.temperature, 2)) for r in out.collect()]
    assert rows == [("S1", 5.36), ("S2", 23.0), ("S3", -4.0)]


def test_float32_conversion_matches_java(spark):
    # -148 tenths °C in float32: -148 * 0.1f * 1.8f + 32f = 5.36 (float)
    from quarry.functions import tenths_celsius_to_fahrenheit
    v = spark.range(1).select(tenths_celsius_to_fahrenheit(F.lit(-148)).alias("t")).first().t
    import numpy as np
    f = np.float32
    expect = f(-148) * f(0.1) * f(9.0 / 5.0) + f(32.0)
    assert np.float32(v) == expect


def test_scale_settings_bounds():
    from quarry.session import scale_settings
    big = scale_settings(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "204800"
    small = scale_settings(40 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.files.maxPartitionBytes"]) <= 512 << 20


def test_money_sums_are_exact_decimals(spark):
    # binary doubles: 0.1 + 0.2 = 0.30000000000000004; the decimal sum is exact
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 1.005)], "k int, amt double")
    got = {r.k: r.total_spent for r in relational.rounded_total_by_key(df, "k", "amt").collect()}
    assert got[1] == 0.3
    avg = relational.average_by_key(df, "k", "amt", alias="a", exact_scale=2)
    assert {r.k: r.a for r in avg.collect()}[1] == 0.15


def test_checkpoint_dir_refuses_local_folder_on_a_cluster():
    import pytest
    from quarry.session import checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "yarn"

        def getConf(self):
            return _Conf()

        def getCheckpointDir(self):
            return None

    class _Session:
        conf = _Conf()
        sparkContext = _Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session())


def test_checkpoint_dir_reads_the_session_setting(spark):
    from quarry.session import checkpoint_dir
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
