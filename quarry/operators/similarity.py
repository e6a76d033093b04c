"""Item-to-item cosine similarity over co-rated items.

For an item pair the score is sum(x*y) / (sqrt(sum(x*x)) * sqrt(sum(y*y)))
over the users who rated both (0.0 when the denominator is 0) and the
strength is the number of such users.  Ratings must hold one row per
(user, item); callers aggregate duplicates first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import cosine_score
from quarry.operators.lineage import write_table
from quarry.operators.skew import block_tags, sized_shuffles


def _norm(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return ratings.select(F.col(user).alias("u"), F.col(item).alias("i"),
                          F.col(rating).cast("double").alias("r"))


def item_pairs(ratings: DataFrame, user: str = "user", item: str = "item",
               rating: str = "rating", block_rows: int = 2000) -> DataFrame:
    """All pairs ``item1 < item2`` with a common rater: ``item1, item2, score,
    strength``.

    One equi self-join on the user with ``a.i < b.i`` inside the join
    condition (half the pairs, no self-pairs), then one aggregation with four
    algebraic sums, combined map-side.  A user's ratings are cut into blocks of
    about ``block_rows`` and joined block against block (see ``block_tags``), so
    the pairs of one join key are bounded however many ratings a user has.
    """
    r = _norm(ratings, user, item, rating)
    left, right = block_tags(r, "u", "i", block_rows)
    a, b = left.alias("a"), right.alias("b")
    pairs = a.join(b, (F.col("a.u") == F.col("b.u")) & (F.col("a._x") == F.col("b._x"))
                   & (F.col("a._y") == F.col("b._y")) & (F.col("a.i") < F.col("b.i")))
    x, y = F.col("a.r"), F.col("b.r")
    sums = pairs.groupBy(F.col("a.i").alias("item1"), F.col("b.i").alias("item2")).agg(
        F.sum(x * y).alias("_xy"), F.sum(x * x).alias("_xx"), F.sum(y * y).alias("_yy"),
        F.count(F.lit(1)).alias("strength"))
    return sums.select("item1", "item2",
                       cosine_score(F.col("_xy"), F.col("_xx"), F.col("_yy")).alias("score"),
                       "strength")


def similar_items(ratings: DataFrame, item_id, min_score: float, min_strength: float = 0,
                  k: int = 10, user: str = "user", item: str = "item", rating: str = "rating",
                  literal_precedence: bool = False, score_digits: int | None = None,
                  min_share: float | None = None) -> DataFrame:
    """The ``k`` items most similar to ``item_id``: ``item, score, strength``.

    Only pairs that contain ``item_id`` matter, so instead of the full pair
    table this joins the raters of ``item_id`` (one row per rater) with their
    other ratings: work linear in the ratings of those raters.

    Default rule: ``score > min_score and strength > min_strength`` (strict).
    ``literal_precedence=True`` reproduces ``a == id || b == id && s > t && n > c``:
    when ``item_id`` is the smaller item of the pair every pair passes, the
    thresholds only apply when it is the larger one.  ``min_share`` asks for more than
    that share of the queried item's raters instead of a fixed strength, so one threshold
    serves tables of every size.  Ordered by score, then strength (both descending), then
    item id.
    """
    r = _norm(ratings, user, item, rating)
    raters = r.where(F.col("i") == F.lit(item_id)).select("u", F.col("r").alias("x"))
    co = r.where(F.col("i") != F.lit(item_id)).join(raters, "u")
    x, y = F.col("x"), F.col("r")
    sums = co.groupBy(F.col("i").alias("item")).agg(
        F.sum(x * y).alias("_xy"), F.sum(x * x).alias("_xx"), F.sum(y * y).alias("_yy"),
        F.count(F.lit(1)).alias("strength"))
    score = cosine_score(F.col("_xy"), F.col("_xx"), F.col("_yy"))
    scored = sums.select("item", score.alias("score"), "strength")
    if min_share is not None:
        min_strength = min_share * raters.count()
    passes = (F.col("score") > F.lit(min_score)) & (F.col("strength") > F.lit(min_strength))
    if literal_precedence:
        passes = (F.col("item") > F.lit(item_id)) | passes
    top = (scored.where(passes)
           .orderBy(F.desc("score"), F.desc("strength"), F.asc("item")).limit(k))
    if score_digits is not None:  # thresholds and order hold for the raw score
        top = top.withColumn("score", F.round("score", score_digits))
    return top


def prefix_ratings(ratings: DataFrame, min_strength: float) -> DataFrame:
    """The ratings whose users can be the rarest common rater of a pair with more than
    ``min_strength`` of them: ``u, i, n`` (``n``: raters of the item).

    Users are ordered by how many items they rate.  Two items with more than t common raters
    have one of them outside the t most frequent raters of either item, so only the
    ``n - t`` rarest raters of an item matter: the most frequent users, who would bring most
    pairs, drop out of nearly all items, and an item with t raters or fewer drops out whole.
    The t most frequent raters are a window group limit, cut to t per item in every map task,
    and come back as one cut-off row per item.
    """
    t = int(min_strength)
    often = ratings.groupBy("u").agg(F.count(F.lit(1)).alias("_f"))
    size = ratings.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    ranked = ratings.select("u", "i").join(often, "u").join(size.where(F.col("n") > t), "i")
    if t == 0:
        return ranked.select("u", "i", "n")
    ranked = write_table(ranked, "prefix-ratings")
    w = Window.partitionBy("i").orderBy(F.desc("_f"), F.desc("u"))
    cut = (ranked.withColumn("_p", F.row_number().over(w)).where(F.col("_p") <= t)
           .groupBy("i").agg(F.min(F.struct("_f", "u")).alias("_cut")))
    return (ranked.join(cut, "i").where(F.struct("_f", "u") < F.col("_cut"))
            .select("u", "i", "n"))


def pair_candidates(ratings: DataFrame, min_strength: float, user: str = "user",
                    item: str = "item", rating: str = "rating",
                    block_rows: int = 2000) -> DataFrame:
    """Item pairs that may have more than ``min_strength`` common raters: ``item1, item2, n1,
    n2`` (raters of each).  No such pair is missing; the others share a rare rater.  The pairs
    are written, by a job whose tasks are as many as the prefixes' pairs need."""
    p = write_table(prefix_ratings(_norm(ratings, user, item, rating), min_strength), "prefixes")
    left, right = block_tags(p, "u", "i", block_rows)
    a, b = left.alias("a"), right.alias("b")
    pairs = (a.join(b, (F.col("a.u") == F.col("b.u")) & (F.col("a._x") == F.col("b._x"))
                    & (F.col("a._y") == F.col("b._y")) & (F.col("a.i") < F.col("b.i")))
             .select(F.col("a.i").alias("item1"), F.col("b.i").alias("item2"),
                     F.col("a.n").alias("n1"), F.col("b.n").alias("n2")).distinct())
    with sized_shuffles(p.sparkSession, _user_pairs(p)):
        return write_table(pairs, "pair-candidates")


def _user_pairs(rows: DataFrame) -> float:
    """The pairs of all users' items."""
    m = F.col("_m")
    return rows.groupBy("u").agg(F.count(F.lit(1)).cast("double").alias("_m")).agg(
        F.sum(m * (m - 1) / 2)).first()[0] or 0.0


def _prefix_lookups(r: DataFrame, min_strength: float) -> float:
    """The lookups that verify all candidates."""
    p = write_table(prefix_ratings(r, min_strength), "prefixes")
    return _user_pairs(p) * (p.agg(F.avg("n")).first()[0] or 0.0)


def _prefixes_pay(r: DataFrame, min_strength: float) -> bool:
    """Whether the lookups of all candidates are fewer than the pairs of all users' items."""
    return _prefix_lookups(r, min_strength) < _user_pairs(r)


def similar_pairs(ratings: DataFrame, min_score: float, min_strength: float, user: str = "user",
                  item: str = "item", rating: str = "rating", block_rows: int = 2000,
                  prefixes: bool | None = None) -> DataFrame:
    """All pairs ``item1 < item2`` with ``score > min_score and strength > min_strength``:
    ``item1, item2, score, strength``, without the table of all pairs.

    Candidates come from the prefixes (``pair_candidates``).  Each is verified exactly: the
    ratings of its smaller item are looked up among the larger one's, one join on
    ``(item, user)``, so an item that everybody rates is never read once per pair.

    Where users rate few items each, all their pairs are fewer than those lookups, and the
    filtered pair table costs less; two aggregates tell (``prefixes`` decides otherwise).
    The result is written, by a job whose tasks are as many as those pairs or lookups need.
    """
    r = write_table(_norm(ratings, user, item, rating), "ratings")
    work = {False: _user_pairs(r)}
    if prefixes is not False:
        work[True] = _prefix_lookups(r, min_strength)
    if prefixes is None:
        prefixes = work[True] < work[False]
    passes = (F.col("score") > F.lit(min_score)) & (F.col("strength") > F.lit(min_strength))
    with sized_shuffles(r.sparkSession, work[prefixes]):
        scored = (_verified(r, min_strength, block_rows) if prefixes
                  else item_pairs(r, "u", "i", "r", block_rows))
        return write_table(scored.where(passes), "similar-pairs")


def _verified(r: DataFrame, min_strength: float, block_rows: int) -> DataFrame:
    """The candidates' scores and strengths."""
    pairs = pair_candidates(r, min_strength, "u", "i", "r", block_rows)
    first = F.col("n1") <= F.col("n2")
    pairs = pairs.select("item1", "item2", F.when(first, F.col("item1")).otherwise(F.col("item2")).alias("i"),
                         F.when(first, F.col("item2")).otherwise(F.col("item1")).alias("_other"))
    small = pairs.join(r, "i").select("item1", "item2", F.col("_other").alias("i"), "u",
                                      F.col("r").alias("x"))
    common = small.join(r, ["i", "u"])
    x, y = F.col("x"), F.col("r")
    sums = common.groupBy("item1", "item2").agg(
        F.sum(x * y).alias("_xy"), F.sum(x * x).alias("_xx"), F.sum(y * y).alias("_yy"),
        F.count(F.lit(1)).alias("strength"))
    return sums.select("item1", "item2", cosine_score(F.col("_xy"), F.col("_xx"), F.col("_yy"))
                       .alias("score"), "strength")
