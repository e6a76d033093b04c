"""Named queries over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  The jobs of the original programs read files that are not shipped,
so every job is pointed at driver tables of the same shape (see README):
people → part/customer, customer orders → orders, temperatures → events,
a book → documents, ratings → lineitem joined with orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators import graph, lookup, recommend, relational, similarity, splits, text
from quarry.operators.lineage import remove_table, scratch_path, write_table, write_through
from quarry.operators.exact import exact_sum_by_key
from quarry.operators.skew import sized_shuffles
from quarry.sources import (good_rows, load_table, parse_strict, quarantined, read_delimited,
                            read_dimension, read_lines, read_numbered_lines, read_quoted_dimension)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


# --- table exploration, averages, SQL view (people-style jobs) -------------

@query
def select_columns(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query
def add_constant(spark, sf_dir):
    return relational.with_offset(_t(spark, sf_dir, "part"), ["p_partkey"], "p_size", 10,
                                  alias="size_plus_10")


@query
def filter_less_than(spark, sf_dir):
    return relational.filter_below(_t(spark, sf_dir, "part"), "p_size", 23)


@query
def sql_range_view(spark, sf_dir):
    return relational.sql_over_view(
        _t(spark, sf_dir, "part"), "quarry_parts",
        "SELECT * FROM quarry_parts WHERE p_size >= 13 AND p_size <= 19")


@query
def count_by_key(spark, sf_dir):
    return relational.count_by_key(_t(spark, sf_dir, "part"), "p_size")


@query
def avg_by_key_sorted(spark, sf_dir):
    return (relational.average_by_key(_t(spark, sf_dir, "customer"), "c_nationkey",
                                      "c_acctbal", alias="avg_acctbal", exact_scale=2)
            .orderBy("c_nationkey"))


# --- spend per customer, minimum temperature ------------------------------

@query
def total_spend(spark, sf_dir):
    return (relational.rounded_total_by_key(_t(spark, sf_dir, "orders"), "o_custkey",
                                            "o_totalprice", alias="total_spent")
            .orderBy("total_spent", "o_custkey"))


@query
def total_revenue(spark, sf_dir):
    """Rounded totals over amounts with four decimals: discounted line prices
    per customer; only the sum is rounded."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = li.join(od, li["l_orderkey"] == od["o_orderkey"])
    return relational.rounded_total_by_key(lines, "o_custkey", "amount", alias="revenue")


@query
def exact_mixed_totals(spark, sf_dir):
    """Exact sums of quantities spread over 29 decimal orders of magnitude, with both signs."""
    li = _t(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    rows = li.select("l_suppkey", (sign * F.col("l_quantity") * F.pow(
        F.lit(2.0), (F.col("l_linenumber") - 4) * 16)).alias("amount"))
    return exact_sum_by_key(rows, "l_suppkey", "amount")


def _station_lines(spark, sf_dir) -> DataFrame:
    """Events as station lines, written as text and read back: every 7th without a number,
    every 11th cut short, every 13th with a byte that is not UTF-8."""
    ev, at = _t(spark, sf_dir, "events"), F.col("event_id")
    station = F.concat(F.lit("S"), F.col("user_id").cast("string"),
                       F.when(at % 13 == 0, F.expr("cast(X'E9' AS string)")).otherwise(""))
    tenths = F.when(at % 7 == 0, "n/a").otherwise(F.floor(F.col("value") * 10).cast("string"))
    head = F.concat_ws(",", at.cast("string"), station)
    line = F.when(at % 11 == 0, head).otherwise(F.concat_ws(",", head, "event_type", tenths))
    path = scratch_path(spark, "station-lines")
    ev.select(line.alias("value")).write.text(path)
    return parse_strict(read_lines(spark, path), [("event_id", 0, "bigint"), ("station", 1, "string"),
                                                  ("kind", 2, "string"), ("tenths", 3, "float")])


@query
def station_lines_good(spark, sf_dir):
    return good_rows(_station_lines(spark, sf_dir))


@query
def station_lines_quarantined(spark, sf_dir):
    """What is wrong with the other lines, by problem."""
    bad = quarantined(_station_lines(spark, sf_dir))
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def numbered_lines_roundtrip(spark, sf_dir):
    """Events written as lines that hold their place in their file, read back numbered."""
    path = scratch_path(spark, "numbered-lines")
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33) + 1
    (_t(spark, sf_dir, "events").select(F.concat_ws(" ", F.col("event_id").cast("string"), place.cast("string"))
                                        .alias("value")).write.text(path))
    parts = F.split("value", " ")
    return read_numbered_lines(spark, path).select(
        F.get(parts, 0).cast("bigint").alias("event_id"),
        (F.get(parts, 1).cast("bigint") == F.col("line")).alias("in_place"))


@query
def read_lines_roundtrip(spark, sf_dir):
    """Document texts written as text and read back as lines: lines by length."""
    path = scratch_path(spark, "roundtrip-lines")
    (_t(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value"))
        .write.mode("overwrite").text(path))
    lines = read_lines(spark, path)
    return lines.groupBy(F.length("value").alias("chars")).agg(F.count(F.lit(1)).alias("n_lines"))


@query
def read_narrow_schema(spark, sf_dir):
    """A file with more fields than the schema: the first two come back."""
    src = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "roundtrip-narrow")
    src.select("o_orderkey", "o_custkey", "o_totalprice").write.mode("overwrite").csv(path)
    return read_delimited(spark, path, "o_orderkey bigint, o_custkey bigint")


def _name_lines(spark, sf_dir, line) -> str:
    path = scratch_path(spark, "roundtrip-names")
    names = _t(spark, sf_dir, "supplier").select(line.alias("value"))
    names.write.mode("overwrite").option("encoding", "ISO-8859-1").option(
        "sep", "\u0001").option("quote", "").option("escape", "\u0002").csv(path)
    return path


@query
def read_dimension_roundtrip(spark, sf_dir):
    """Pipe-separated Latin-1 names (é added, every fifth empty) through the
    dimension loader."""
    name = F.when(F.col("s_suppkey") % 5 == 0, "").otherwise(F.concat("s_name", F.lit(" é")))
    path = _name_lines(spark, sf_dir, F.concat_ws("|", F.col("s_suppkey").cast("string"), name,
                                                  F.lit("x")))
    return read_dimension(spark, path)


@query
def read_quoted_dimension_roundtrip(spark, sf_dir):
    """Quoted Latin-1 names (é added; every fifth line a bare id) through the
    quote-splitting loader."""
    line = F.when(F.col("s_suppkey") % 5 == 0, F.col("s_suppkey").cast("string")).otherwise(
        F.concat(F.col("s_suppkey").cast("string"), F.lit(' "'), F.col("s_name"), F.lit(' é"')))
    return read_quoted_dimension(spark, _name_lines(spark, sf_dir, line))


@query
def adjacency_multi(spark, sf_dir):
    """Adjacency lines with several neighbours, split on single spaces: a line
    item's part with its supplier and order, and every part alone."""
    li = _t(spark, sf_dir, "lineitem").select(F.concat_ws(
        " ", F.col("l_partkey").cast("string"), supplier_node("l_suppkey").cast("string"),
        F.col("l_orderkey").cast("string")).alias("value"))
    bare = _t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("value"))
    return graph.degree(li.unionByName(bare), trim=False)


@query
def adjacency_spaced(spark, sf_dir):
    """The same lines with runs of spaces and tabs between, before and after the ids, trimmed
    and split on white space."""
    li = _t(spark, sf_dir, "lineitem").select(F.format_string(
        "  %d \t%d   %d ", "l_partkey", supplier_node("l_suppkey"), "l_orderkey").alias("value"))
    bare = _t(spark, sf_dir, "part").select(F.format_string(" %d ", "p_partkey").alias("value"))
    return graph.degree(li.unionByName(bare))


@query
def min_converted(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return (relational.min_then_convert(ev, "user_id", "value",
                                        where=F.col("event_type") == "error")
            .withColumn("label", F.format_string("%.2f F", F.col("temperature")))
            .orderBy("temperature", "user_id"))


@query
def min_convert_first(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return (relational.convert_then_min(ev, "user_id", "value",
                                        where=F.col("event_type") == "error")
            .orderBy("user_id", "temperature"))


# --- word count -----------------------------------------------------------

@query
def word_count(spark, sf_dir):
    return text.word_count(_t(spark, sf_dir, "documents"), "text").orderBy("count", "word")


@query
def word_count_with_empty(spark, sf_dir):
    return (text.word_count(_t(spark, sf_dir, "documents"), "text", keep_empty=True)
            .orderBy("count", "word"))


# --- popularity with names ------------------------------------------------

@query
def popular_items_named(spark, sf_dir):
    counts = lookup.popularity(_t(spark, sf_dir, "lineitem"), "l_partkey")
    named = lookup.attach_name(counts, _t(spark, sf_dir, "part"), "l_partkey",
                               "p_partkey", "p_name")
    return named.orderBy(F.desc("count"), "l_partkey")


@query
def popular_items_unmatched(spark, sf_dir):
    """Strict lookup check: rated items that found no name (one row)."""
    counts = lookup.popularity(_t(spark, sf_dir, "lineitem"), "l_partkey")
    named = lookup.attach_name(counts, _t(spark, sf_dir, "part"), "l_partkey", "p_partkey", "p_name")
    return lookup.count_unmatched(named, "p_name")


@query
def popular_items_top10(spark, sf_dir):
    counts = lookup.popularity(_t(spark, sf_dir, "lineitem"), "l_partkey")
    return lookup.top_k(counts, [F.desc("count"), F.asc("l_partkey")], 10)


FLAGSHIP = "popular_items_named"


# --- graph: adjacency text derived from the tables ---------------------------
#
# Nodes are parts (id = p_partkey) and suppliers (id = -1 - s_suppkey, so the
# two key spaces never collide).  Every lineitem row contributes the line
# "<part> <supplier>" and the line "<supplier> <part>", and every part a bare
# line "<part>" (degree 0 unless it is sold).  The text is linear in the
# tables: no line lists all members of an order, so no group's pairs are
# ever enumerated.

BFS_START = 1          # part 1
BFS_TARGET = -4        # supplier 3


def supplier_node(c):
    return F.lit(-1) - F.col(c)


def graph_lines(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    pairs = li.select(F.explode(F.array(
        F.concat_ws(" ", F.col("l_partkey").cast("string"), supplier_node("l_suppkey").cast("string")),
        F.concat_ws(" ", supplier_node("l_suppkey").cast("string"), F.col("l_partkey").cast("string")),
    )).alias("value"))
    bare = _t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("value"))
    return pairs.unionByName(bare)


def graph_names(spark, sf_dir) -> DataFrame:
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                             F.col("p_name").alias("name"))
    supps = _t(spark, sf_dir, "supplier").select(supplier_node("s_suppkey").alias("id"),
                                                 F.col("s_name").alias("name"))
    return parts.unionByName(supps)


@query
def adjacency_parse(spark, sf_dir):
    return graph.edges(graph_lines(spark, sf_dir))


@query
def degree_by_node(spark, sf_dir):
    return graph.degree(graph_lines(spark, sf_dir))


@query
def most_connected(spark, sf_dir):
    top = graph.most_connected(graph.degree(graph_lines(spark, sf_dir)))
    return lookup.attach_name(top, graph_names(spark, sf_dir), "id", "id", "name",
                              small_side_rows=1)


@query
def least_connected(spark, sf_dir):
    low = graph.least_connected(graph.degree(graph_lines(spark, sf_dir)))
    return (lookup.attach_name(low, graph_names(spark, sf_dir), "id", "id", "name")
            .orderBy("id"))


@query
def bfs_distances(spark, sf_dir):
    levels, _ = graph.bfs(graph.edges(graph_lines(spark, sf_dir)), BFS_START)
    return levels


@query
def bfs_hit(spark, sf_dir):
    """The hit report by search from both ends (the graph has every edge both ways)."""
    hit = graph.bfs_hit(graph.edges(graph_lines(spark, sf_dir)), BFS_START, BFS_TARGET,
                        symmetric=True)
    return graph.hit_frame(spark, BFS_START, BFS_TARGET, hit)


@query
def bfs_hit_self(spark, sf_dir):
    """Start = target: found only through a frontier edge back to the start."""
    _, hit = graph.bfs(graph.edges(graph_lines(spark, sf_dir)), BFS_START,
                       target=BFS_START)
    return graph.hit_frame(spark, BFS_START, BFS_START, hit)


@query
def merge_node_state(spark, sf_dir):
    return graph.bfs_round_states(graph_lines(spark, sf_dir), BFS_START)


@query
def search_states(spark, sf_dir):
    """The state-passing search at its fixed point, unreached nodes included."""
    return graph.search_states(graph_lines(spark, sf_dir), BFS_START)


# --- item similarity ----------------------------------------------------------
#
# Items are product lines (brand and type of a part), whose number does not grow
# with the tables: user = customer, rating = mean quantity.  Thresholded pairs
# over all items take single parts bought in one order: user = order.

SIMILAR_TO = "Brand#1 LARGE"
MIN_SCORE, MIN_SHARE, TOP_K = 0.76, 0.22, 10
PAIR_SCORE, PAIR_STRENGTH = 0.9, 1
SCORE_DIGITS = 6


def _line(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", "p_brand", "p_type").alias("item"), "p_name")


def line_ratings(spark, sf_dir) -> DataFrame:
    """One rating per (customer, product line): the mean quantity of their lines."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = _line(spark, sf_dir).select("p_partkey", "item")
    return (li.join(part, li["l_partkey"] == part["p_partkey"])
              .join(od, li["l_orderkey"] == od["o_orderkey"])
              .groupBy(F.col("o_custkey").alias("user"), "item")
              .agg(F.avg("l_quantity").alias("rating")))


def basket_ratings(spark, sf_dir) -> DataFrame:
    """One rating per (order, part): the mean quantity of their lines."""
    return (_t(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.avg("l_quantity").alias("rating")))


@query
def item_pair_similarity(spark, sf_dir):
    pairs = similarity.item_pairs(line_ratings(spark, sf_dir))
    return pairs.withColumn("score", F.round("score", SCORE_DIGITS))


@query
def similar_item_pairs(spark, sf_dir):
    """Every pair of parts bought together more than once in like quantities."""
    with sized_shuffles(spark, _t(spark, sf_dir, "lineitem").count()):
        pairs = similarity.similar_pairs(basket_ratings(spark, sf_dir), PAIR_SCORE, PAIR_STRENGTH)
    return pairs.withColumn("score", F.round("score", SCORE_DIGITS))


@query
def similar_pair_candidates(spark, sf_dir):
    """What the prefixes leave of all pairs: items, their pairs, candidates (one row)."""
    with sized_shuffles(spark, _t(spark, sf_dir, "lineitem").count()):
        ratings = write_table(basket_ratings(spark, sf_dir), "baskets")
        found = similarity.pair_candidates(ratings, PAIR_STRENGTH).select(F.lit(1).alias("_c"))
    items = ratings.select("item").distinct().select(F.lit(0).alias("_c"))
    n, c = F.count_if(F.col("_c") == 0), F.count_if(F.col("_c") == 1)
    return items.unionByName(found).agg(
        n.alias("items"), F.expr("count_if(_c = 0) * (count_if(_c = 0) - 1) div 2").alias("all_pairs"),
        c.alias("candidates"))


def _similar(spark, sf_dir, literal):
    top = similarity.similar_items(line_ratings(spark, sf_dir), SIMILAR_TO, MIN_SCORE,
                                   k=TOP_K, literal_precedence=literal, score_digits=SCORE_DIGITS,
                                   min_share=MIN_SHARE)
    names = (_line(spark, sf_dir).groupBy(F.col("item").alias("line"))
             .agg(F.min("p_name").alias("first_product")))
    return (lookup.attach_name(top, names, "item", "line", "first_product", small_side_rows=TOP_K)
            .orderBy(F.desc("score"), F.desc("strength"), "item"))


@query
def similar_items(spark, sf_dir):
    return _similar(spark, sf_dir, literal=False)


@query
def similar_items_literal(spark, sf_dir):
    return _similar(spark, sf_dir, literal=True)


# --- splits ----------------------------------------------------------------

# The splits of the original scripts (5 contiguous folds; per-user
# rows 1-10, and rows 11-20).
FOLDS = 5
HOLDOUT_START, HOLDOUT_STOP = 1, 10
SECOND_START, SECOND_STOP = 11, 20


@query
def contiguous_folds(spark, sf_dir):
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return splits.contiguous_folds(od, ["o_orderkey"], FOLDS)


@query
def fold_tables(spark, sf_dir):
    """Test and base table of every split, from one stored table, sorted by customer and order."""
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path, order = scratch_path(spark, "folds"), ["o_custkey", "o_orderkey"]
    splits.write_folds(splits.contiguous_folds(od, ["o_orderkey"], FOLDS), path, order)
    out = None
    for i in range(1, FOLDS + 1):
        for part, rows in zip(("test", "base"), splits.read_fold(spark, path, i, order)):
            tagged = rows.select(F.lit(i).alias("split"), F.lit(part).alias("part"), "o_orderkey", "o_custkey")
            out = tagged if out is None else out.unionByName(tagged)
    return out


@query
def per_user_holdout(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return (splits.per_user_holdout(ev, "user_id", ["ts", "event_id"], "event_id",
                                    HOLDOUT_START, HOLDOUT_STOP)
            .select("event_id", "user_id", "split"))


@query
def per_user_holdout_second(spark, sf_dir):
    """The second hold-out of the original scripts: rows 11-20 per user."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return (splits.per_user_holdout(ev, "user_id", ["ts", "event_id"], "event_id",
                                    SECOND_START, SECOND_STOP)
            .select("event_id", "user_id", "split"))


# --- ALS recommendations: user = customer, item = part ------------------------

def part_ratings(spark, sf_dir) -> DataFrame:
    """One rating per (customer, part): the mean quantity, as float."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li["l_orderkey"] == od["o_orderkey"])
              .groupBy(F.col("o_custkey").alias("userID"), F.col("l_partkey").alias("movieID"))
              .agg(F.avg("l_quantity").cast("float").alias("rating")))


@query
def als_recommend(spark, sf_dir):
    """Keys are bigint and outgrow 32 bits at scale, so they are always densely
    re-indexed for MLlib and mapped back (``recommend_any_ids``)."""
    ratings = part_ratings(spark, sf_dir)
    # the requested user: the lowest customer key that has orders
    requested = _t(spark, sf_dir, "orders").agg(F.min("o_custkey").alias("userID"))
    recs = recommend.recommend_any_ids(ratings, requested, "userID", "movieID", "rating",
                                       recommend.TOP_N)
    return lookup.attach_name(recs, _t(spark, sf_dir, "part"), "movieID", "p_partkey", "p_name",
                              small_side_rows=recommend.TOP_N)


@query
def als_recommend_ranks(spark, sf_dir):
    """What is determined of ``als_recommend``: the requested user, ranks 1 to 10, rated parts,
    their names."""
    recs = als_recommend(spark, sf_dir)
    rated = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("_part")).distinct()
    return recs.join(rated, recs["movieID"] == rated["_part"], "left").select(
        "userID", F.col("rank").cast("long").alias("rank"), F.col("_part").isNotNull().alias("rated"),
        F.col("p_name").isNotNull().alias("named"))


# Ratings with structure, for evidence about training: a part's size less what the customer
# was granted on it, in tens.  A tenth of them, told by the keys, is held out.

RESIDUAL_BOUND = 1e-3


def sized_ratings(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_discount")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return (li.join(od, li["l_orderkey"] == od["o_orderkey"])
              .join(part, li["l_partkey"] == part["p_partkey"])
              .groupBy(F.col("o_custkey").alias("userID"), F.col("l_partkey").alias("movieID"))
              .agg((F.avg(F.col("p_size") * (1 - F.col("l_discount"))) / 10).alias("rating"))
              .withColumn("held_out", (F.col("userID") + F.col("movieID")) % 10 == 0))


def _sized_model(spark, sf_dir):
    """Held-out rows, the others on dense ids, the indexes and the model."""
    rows = write_through(spark, "sized-ratings", lambda: sized_ratings(spark, sf_dir))
    indexed, uidx, iidx = recommend.dense_ratings(rows.where("NOT held_out"), "userID", "movieID", "rating")
    held_out = write_through(spark, "held-out", lambda: rows.where("held_out").drop("held_out"))
    remove_table(rows)
    return held_out, indexed, uidx, iidx, recommend.fit_als(indexed, "_u", "_i", "_r")


@query
def als_fit_evidence(spark, sf_dir):
    """What training must satisfy, in one row: every user's factors solve the regularised
    normal equations, and held-out ratings are predicted better than by the mean."""
    held_out, indexed, uidx, iidx, model = _sized_model(spark, sf_dir)
    solved = recommend.normal_equation_residuals(model, indexed, "_r").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n_ratings").alias("n_ratings"),
        (F.max("residual") < RESIDUAL_BOUND).alias("solved"))
    mean = indexed.agg(F.avg("_r")).first()[0] or 0.0
    held = held_out.join(uidx, "userID").join(iidx, "movieID").select(
        "_u", "_i", F.col("rating").alias("_r"))
    error = recommend.prediction_error(model, held, "_r", mean).select(
        F.col("n").alias("n_held_out"), (F.col("rmse") < F.col("rmse_mean")).alias("beats_mean"))
    one = F.lit(0).alias("_one")
    return (solved.select("*", one).unionByName(error.select("*", one), allowMissingColumns=True)
            .groupBy("_one").agg(*(F.max(c).alias(c) for c in (
                "n_users", "n_ratings", "solved", "n_held_out", "beats_mean"))).drop("_one"))


@query
def als_top_items(spark, sf_dir):
    """The exact ten best parts of every customer by pruned inner-product search, described by
    what is determined: their number, ranks 1 to n, falling scores, parts of the training."""
    _, _, uidx, iidx, model = _sized_model(spark, sf_dir)
    top, _ = recommend.recommend_pruned(model, uidx.select("_u"), recommend.TOP_N)
    named = top.join(iidx.select("_i", F.col("movieID").alias("part")), "_i", "left")
    before = F.lag("rating").over(Window.partitionBy("_u").orderBy("rank"))
    return (named.withColumn("_falls", F.coalesce(F.col("rating") <= before, F.lit(True)))
            .groupBy("_u").agg(F.count("part").alias("n_items"), F.count_distinct("part").alias("n_distinct"),
                               F.max("rank").cast("long").alias("last_rank"), F.every("_falls").alias("in_order"))
            .join(uidx, "_u").select("userID", "n_items", "n_distinct", "last_rank", "in_order"))


# --- delimited reader round trip ----------------------------------------------

@query
def read_delimited_roundtrip(spark, sf_dir):
    """Write ``customer`` as header-less, pipe-separated Latin-1 text into the
    shared scratch folder, read it back with an explicit schema."""
    src = _t(spark, sf_dir, "customer")
    path = scratch_path(spark, "roundtrip")
    (src.write.mode("overwrite").option("sep", "|").option("encoding", "ISO-8859-1")
        .option("header", "false").csv(path))
    return read_delimited(spark, path, src.schema, sep="|", encoding="ISO-8859-1")


@query
def read_delimited_roundtrip_tsv(spark, sf_dir):
    """``part`` as tab-separated text with a header line, read back with the
    header skipped and an explicit schema."""
    src = _t(spark, sf_dir, "part")
    path = scratch_path(spark, "roundtrip-tsv")
    src.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)
    return read_delimited(spark, path, src.schema, sep="\t", header=True)


@query
def read_delimited_roundtrip_quoted(spark, sf_dir):
    """Part ids and names as space-separated text: names that contain spaces
    are written quoted and must come back whole."""
    src = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = scratch_path(spark, "roundtrip-space")
    src.write.mode("overwrite").option("sep", " ").csv(path)
    return read_delimited(spark, path, src.schema, sep=" ")


@query
def read_delimited_roundtrip_inferred(spark, sf_dir):
    """``part`` as CSV with a header, read back with the header and schema
    inference (one extra pass over the file), then cast to the source's types:
    what is inferred depends on the size of the keys."""
    src = _t(spark, sf_dir, "part")
    path = scratch_path(spark, "roundtrip-inferred")
    src.write.mode("overwrite").option("header", "true").csv(path)
    got = read_delimited(spark, path, header=True, infer_schema=True)
    return got.select(*(F.col(f.name).cast(f.dataType) for f in src.schema))
