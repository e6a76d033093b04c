"""The jobs over the original file formats, one function per program.

Each takes a session, input paths and parameters, and returns the result
DataFrames by name (nothing is printed or collected).  Schemas are the
formats the programs read: a people CSV with a header, header-less customer
orders and temperature CSVs, tab-separated ratings, a pipe-separated Latin-1
item table, space-separated quoted node names, adjacency-list text, a book.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import graph, lookup, recommend, relational, similarity, splits, text
from quarry.sources import (good_rows, parse_strict, quarantined, read_delimited, read_dimension,
                            read_lines, read_numbered_lines, read_quoted_dimension)

# The input schemas of the programs and the constants they use.
ORDER_SCHEMA = "user_id int, item_id int, amt double"
TEMPERATURE_SCHEMA = "stationID string, date int, measure_type string, temperature float"
RATING_SCHEMA = "userID int, movieID int, rating int, timestamp bigint"
RATING_FIELDS = [("userID", 0, "int"), ("movieID", 1, "int"), ("rating", 2, "int"), ("timestamp", 3, "bigint")]
AGE_LIMIT, AGE_OFFSET, TEEN_MIN, TEEN_MAX = 23, 10, 13, 19
MINIMUM_TYPE = "TMIN"
SIMILAR_MIN_SCORE, SIMILAR_MIN_STRENGTH, SIMILAR_TOP = 0.97, 50.0, 10
BFS_ROUNDS = 10
FOLD_COUNT, HOLDOUT_FIRST, HOLDOUT_LAST = 5, 1, 10


def _people(spark, path):
    return read_delimited(spark, path, header=True, infer_schema=True)


def friends_overview(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Names, people under 23, head count per age, age + 10."""
    people = _people(spark, path)
    return {"names": people.select("name"),
            "under_23": relational.filter_below(people, "age", AGE_LIMIT),
            "count_by_age": relational.count_by_key(people, "age"),
            "age_plus_10": relational.with_offset(people, ["name"], "age", AGE_OFFSET)}


def friends_by_age(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Mean number of friends per age, by age."""
    return {"avg_friends": relational.average_by_key(_people(spark, path), "age", "friends")
            .orderBy("age")}


def teenagers(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """SQL over a view of the people file."""
    return {"teenagers": relational.sql_over_view(
        _people(spark, path), "people",
        f"SELECT * FROM people WHERE age >= {TEEN_MIN} AND age <= {TEEN_MAX}")}


def customer_spend(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Total spent per customer, rounded to cents, ascending."""
    orders = read_delimited(spark, path, ORDER_SCHEMA)
    return {"total_spent": relational.rounded_total_by_key(orders, "user_id", "amt")
            .orderBy("total_spent", "user_id")}


def min_temperatures(spark: SparkSession, path: str, convert_first: bool = False
                     ) -> dict[str, DataFrame]:
    """W05 (minimum, then °F rounded to 2, by temperature) or W06
    (``convert_first``: °F of every row, minimum, by station)."""
    temps = read_delimited(spark, path, TEMPERATURE_SCHEMA)
    is_min = F.col("measure_type") == MINIMUM_TYPE
    if convert_first:
        out = relational.convert_then_min(temps, "stationID", "temperature", where=is_min)
        return {"min_temperature": out.orderBy("stationID", "temperature")}
    out = relational.min_then_convert(temps, "stationID", "temperature", where=is_min)
    return {"min_temperature": out.withColumn("label", F.format_string("%.2f F", "temperature"))
            .orderBy("temperature", "stationID")}


def word_counts(spark: SparkSession, path: str, keep_empty: bool = True) -> dict[str, DataFrame]:
    """Word counts of a text, by count (``keep_empty`` = the line-split rule)."""
    return {"word_count": text.word_count(read_lines(spark, path), "value", keep_empty)
            .orderBy("count", "word")}


def _ratings(spark, path):
    return read_delimited(spark, path, RATING_SCHEMA, sep="\t")


def _titles(spark, path, keep="last"):
    return read_dimension(spark, path, sep="|", encoding="ISO-8859-1",
                          id_col="movieID", name_col="movieTitle", keep=keep)


def popular_movies(spark: SparkSession, ratings: str, items: str | None = None,
                   top: int | None = None, strict: bool = False) -> dict[str, DataFrame]:
    """Ratings per movie, with titles when ``items`` is given, most
    rated first; ``top`` keeps the first rows (ties by id).  ``strict`` adds
    the number of rated movies without a title (the original failed on them)."""
    counts = lookup.popularity(_ratings(spark, ratings), "movieID")
    order = [F.desc("count"), F.asc("movieID")]
    if top is not None:
        counts = lookup.top_k(counts, order, top)
    out = {}
    if items is not None:
        counts = lookup.attach_name(counts, _titles(spark, items), "movieID", "movieID",
                                    "movieTitle", small_side_rows=top)
        if strict:
            out["unmatched"] = lookup.count_unmatched(counts, "movieTitle")
    out["popular"] = counts.orderBy(*order)
    return out


def node_popularity(spark: SparkSession, graph_path: str, names_path: str | None = None,
                    trim: bool = True) -> dict[str, DataFrame]:
    """The most connected node and every least connected node.

    Names as the two programs read them: space-separated CSV (quoted names,
    a bare id has no name) for the most connected node, the quote-splitting
    loader (lines without a quoted name skipped) for the least connected
    ones; a repeated id keeps its first line for the former, its last for the
    latter."""
    deg = graph.degree(read_lines(spark, graph_path), trim=trim)
    most, least = graph.most_connected(deg), graph.least_connected(deg)
    if names_path is not None:
        csv_names = read_dimension(spark, names_path, sep=" ", encoding="ISO-8859-1",
                                   quoted=True, keep="first")
        quoted_names = read_quoted_dimension(spark, names_path)
        most = lookup.attach_name(most, csv_names, "id", "id", "name", small_side_rows=1)
        least = lookup.attach_name(least, quoted_names, "id", "id", "name")
    return {"degree": deg, "most_connected": most, "least_connected": least.orderBy("id")}


def degrees_of_separation(spark: SparkSession, graph_path: str, start: int, target: int,
                          max_rounds: int = BFS_ROUNDS, include_unreached: bool = False
                          ) -> dict[str, DataFrame]:
    """BFS from ``start``; the hit report (hops, distinct parents,
    edge occurrences) and the distances reached until the hit
    (``include_unreached``: every other node with a line, 9999 / WHITE)."""
    lines = read_lines(spark, graph_path)
    levels, hit = graph.bfs(graph.edges(lines), start, target=target, max_rounds=max_rounds)
    if include_unreached:
        levels = graph.with_unreached(levels, lines)
    return {"hit": graph.hit_frame(spark, start, target, hit), "distances": levels}


def movie_similarities(spark: SparkSession, ratings: str, movie_id: int | None = None,
                       items: str | None = None, min_score: float = SIMILAR_MIN_SCORE,
                       min_strength: float = SIMILAR_MIN_STRENGTH, k: int = SIMILAR_TOP,
                       literal_precedence: bool = False) -> dict[str, DataFrame]:
    """The item-pair table, and with ``movie_id`` the ``k`` most
    similar movies passing the thresholds."""
    r = _ratings(spark, ratings)
    out = {"pairs": similarity.item_pairs(r, "userID", "movieID", "rating")}
    if movie_id is not None:
        top = similarity.similar_items(r, movie_id, min_score, min_strength, k, user="userID",
                                       item="movieID", rating="rating",
                                       literal_precedence=literal_precedence)
        if items is not None:
            top = lookup.attach_name(top, _titles(spark, items), "item", "movieID", "movieTitle",
                                     small_side_rows=k)
        out["similar"] = top.orderBy(F.desc("score"), F.desc("strength"), "item")
    return out


def movie_recommendations(spark: SparkSession, ratings: str, user_id: int,
                          items: str | None = None, n: int = recommend.TOP_N,
                          seed: int = 42) -> dict[str, DataFrame]:
    """ALS top-``n`` movies for ``user_id``, with titles when given."""
    r = _ratings(spark, ratings).select("userID", "movieID", F.col("rating").cast("float"))
    model = recommend.fit_als(r, "userID", "movieID", "rating", seed=seed)
    users = spark.range(user_id, user_id + 1).select(F.col("id").cast("int").alias("userID"))
    recs = recommend.recommend(model, users, n)
    if items is not None:
        recs = lookup.attach_name(recs, _titles(spark, items, keep="first"), "movieID", "movieID", "movieTitle",
                                  small_side_rows=n)
    return {"recommendations": recs.orderBy("rank")}


def rating_splits(spark: SparkSession, ratings: str, folds: int = FOLD_COUNT,
                  holdout_start: int = HOLDOUT_FIRST, holdout_stop: int = HOLDOUT_LAST,
                  max_test: int = 0, file_order: bool = False) -> dict[str, DataFrame]:
    """Contiguous folds and a per-user hold-out, in (timestamp, user, movie) order or
    with ``file_order`` in that of the lines in the file; lines that do not parse are then a
    result of their own."""
    order, rest = ["timestamp", "userID", "movieID"], {}
    if file_order:
        parsed = parse_strict(read_numbered_lines(spark, ratings), RATING_FIELDS, sep="\t")
        r, order, rest = good_rows(parsed), ["file", "line"], {"quarantined": quarantined(parsed)}
    else:
        r = _ratings(spark, ratings)
    keyed = splits.row_index(r, order, "row_key")  # unique, also for repeated lines
    return {"folds": splits.contiguous_folds(r, order, folds),
            "holdout": splits.per_user_holdout(keyed, "userID", order, "row_key", holdout_start,
                                               holdout_stop, max_test).drop("row_key"), **rest}


JOBS = {
    "friends-overview": friends_overview,
    "friends-by-age": friends_by_age,
    "teenagers": teenagers,
    "customer-spend": customer_spend,
    "min-temperatures": min_temperatures,
    "word-count": word_counts,
    "popular-movies": popular_movies,
    "node-popularity": node_popularity,
    "degrees-of-separation": degrees_of_separation,
    "movie-similarities": movie_similarities,
    "movie-recommendations": movie_recommendations,
    "rating-splits": rating_splits,
}
