"""The per-program jobs over their original file formats, and the CLI."""

import os

import pytest

from quarry.__main__ import main
from quarry.plans import file_jobs as J

RATING_FILES = [f for f in os.environ.get("QUARRY_RATING_FILES", "").split(",") if f]
GRAPH = ["1 2 3", "1 4 ", "2 1 5", "3 1 5", "4 1", "5 3 6 6", "7"]


def test_friends_jobs(spark, write_text):
    path = write_text(["id,name,age,friends", "0,A,13,10", "1,B,19,30", "2,C,22,5",
                       "3,D,23,7", "4,E,22,6"])
    over = J.friends_overview(spark, path)
    assert over["under_23"].count() == 4 and over["age_plus_10"].columns == ["name", "(age + 10)"]
    avg = [tuple(r) for r in J.friends_by_age(spark, path)["avg_friends"].collect()]
    assert avg[2] == (22, 5.5)
    assert sorted(r.id for r in J.teenagers(spark, path)["teenagers"].collect()) == [0, 1]


def test_spend_and_temperatures(spark, write_text):
    spend = J.customer_spend(spark, write_text(["7,100,10.10", "7,101,0.25", "8,100,5.00"]))
    assert [tuple(r) for r in spend["total_spent"].collect()] == [(8, 5.0), (7, 10.35)]
    temps = write_text(["S1,18000101,TMIN,-148,,,E,", "S2,18000101,TMIN,-50,,,E,",
                        "S3,18000101,TMIN,-200,,,E,"])
    w05 = J.min_temperatures(spark, temps)["min_temperature"].collect()
    assert [(r.stationID, r.label) for r in w05] == [("S3", "-4.00 F"), ("S1", "5.36 F"),
                                                     ("S2", "23.00 F")]
    w06 = J.min_temperatures(spark, temps, convert_first=True)["min_temperature"].collect()
    assert [r.stationID for r in w06] == ["S1", "S2", "S3"]


def test_word_count_job(spark, write_text):
    out = J.word_counts(spark, write_text(["", "--", "--Hello, world!", "Hello again", "Hi."]))
    got = {r.word: r["count"] for r in out["word_count"].collect()}
    assert got[""] == 2 and got["hello"] == 2


def test_graph_jobs(spark, write_text):
    g = write_text(GRAPH)
    names = write_text(['1 "ALPHA ONE"', '7 "SEVEN"'])
    pop = J.node_popularity(spark, g, names)
    assert tuple(pop["most_connected"].first()) == (1, 3, "ALPHA ONE")
    assert [tuple(r) for r in pop["least_connected"].collect()] == [(7, 0, "SEVEN")]
    sep = J.degrees_of_separation(spark, g, 1, 6)
    assert [tuple(r) for r in sep["hit"].collect()] == [(1, 6, 3, 1, 2)]


def test_cli_writes_results(spark, write_text, tmp_path):
    g = write_text(GRAPH)
    out = tmp_path / "out"
    assert main(["node-popularity", "--graph-path", g, "--out", str(out)]) == 0
    assert sorted(os.listdir(out)) == ["degree", "least_connected", "most_connected"]
    assert spark.read.parquet(str(out / "most_connected")).first().id == 1


@pytest.mark.skipif(not RATING_FILES, reason="set QUARRY_RATING_FILES (see test_golden.py)")
def test_movie_jobs_on_shipped_folds(spark):
    ratings = RATING_FILES
    pop = J.popular_movies(spark, ratings, top=3)["popular"].collect()
    assert [(r.movieID, r["count"]) for r in pop] == [(50, 583), (258, 509), (100, 508)]
    sim = J.movie_similarities(spark, ratings, movie_id=50)["similar"].collect()
    assert [r.item for r in sim][:3] == [172, 181, 174]
    splits_ = J.rating_splits(spark, ratings)
    sizes = {r.fold: r["count"] for r in splits_["folds"].groupBy("fold").count().collect()}
    assert sizes == {i: 20000 for i in range(1, 6)}
    hold = splits_["holdout"]
    assert hold.where("split = 'test'").count() == 9430


def test_recommendation_job(spark, write_text):
    rows = [f"{u}\t{(u * 7 + j * 3) % 40}\t{(u + j) % 5 + 1}\t{1000 + j}"
            for u in range(30) for j in range(15)]
    items = write_text([f"{i}|Title {i}|x" for i in range(40)])
    recs = J.movie_recommendations(spark, write_text(rows), 3, items)["recommendations"].collect()
    assert [r["rank"] for r in recs] == list(range(1, 11))
    assert all(r.movieTitle == f"Title {r.movieID}" for r in recs)


def test_job_options_strict_and_unreached(spark, write_text):
    ratings = write_text(["1\t10\t4\t1", "2\t10\t3\t2", "1\t99\t5\t3"])
    titles = write_text(["10|Ten|x"])
    out = J.popular_movies(spark, ratings, titles, strict=True)
    assert out["unmatched"].first().unmatched == 1
    g = write_text(GRAPH)
    sep = J.degrees_of_separation(spark, g, 1, 6, include_unreached=True)
    got = {r.id: r.distance for r in sep["distances"].collect()}
    assert got[7] == 9999 and got[6] == 3


def test_node_names_as_each_program_read_them(spark, write_text):
    g = write_text(["1 2 3", "2 1", "3 1", "9 1 2 3 4", "9 5"])
    names = write_text(['9 NINE', '1 "ONE"', '2 "TWO"', '2 "TWO AGAIN"', '3'])
    pop = J.node_popularity(spark, g, names)
    assert tuple(pop["most_connected"].first()) == (9, 5, "NINE")
    assert [tuple(r) for r in pop["least_connected"].collect()] == [(2, 1, "TWO AGAIN"),
                                                                    (3, 1, None)]
