"""Alternating-least-squares recommendations (MLlib).

Besides training and MLlib's exhaustive top-n this module checks a model against what it must
satisfy (``normal_equation_residuals``, ``prediction_error``) and finds the exact top-n without
scoring every item (``recommend_pruned``).
"""

from __future__ import annotations

import functools
import gc
import math
import time
from collections.abc import Iterator
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.lineage import remove_table, scratch_path, write_through
from quarry.operators.skew import ROWS_PER_TASK, block_counts, sized_shuffles
from quarry.session import checkpoint_dir

# Fixed values of the original job: explicit feedback, 5 iterations,
# regularisation 0.01, 10 recommendations; rank 10 is the MLlib default.
MAX_ITER, REG_PARAM, RANK, TOP_N = 5, 0.01, 10, 10


#: MLlib's number of user and of item blocks, and the ratings from which there are more: a task
#: builds a block in memory, at about 50 bytes a rating.
BLOCKS, RATINGS_PER_BLOCK = 10, 10_000_000


def fit_als(ratings: DataFrame, user: str, item: str, rating: str, *, max_iter: int = MAX_ITER,
            reg_param: float = REG_PARAM, rank: int = RANK, seed: int = 42) -> ALSModel:
    """Train explicit-feedback ALS.  Ids must fit in a 32-bit int (MLlib rule).

    The seed is always set: without it PySpark derives one from a hash that
    changes per process.  Item factors checkpoint to the shared folder of
    ``spark.checkpoint.dir`` every iteration: MLlib then removes the factor messages of the
    iterations before, which would else all stay on disk until the end of the training.  The
    model returned reads its factors from there too: one that holds the RDDs of the training
    holds their cached blocks and shuffle files.  Blocks are MLlib's ten, or more when they
    would hold more than ``RATINGS_PER_BLOCK`` ratings.
    """
    spark = ratings.sparkSession
    checkpoint_dir(spark)
    blocks = max(BLOCKS, math.ceil(ratings.count() / RATINGS_PER_BLOCK))
    als = ALS(maxIter=max_iter, regParam=reg_param, rank=rank, userCol=user, itemCol=item,
              ratingCol=rating, seed=seed, checkpointInterval=1, numUserBlocks=blocks, numItemBlocks=blocks)
    path, cached = scratch_path(spark, "als-model"), spark.sparkContext._jsc.getPersistentRDDs().size()
    als.fit(ratings).save(path)
    _release_training(spark, cached)
    return ALSModel.load(path)


def _release_training(spark: SparkSession, cached: int) -> None:
    """Has the driver collect garbage until no more than ``cached`` RDDs are kept, so that Spark's
    cleaner removes the blocks and shuffles of a training nothing refers to any more now, not
    whenever the driver's memory is full.  A few tries: other jobs may keep RDDs of their own."""
    for _ in range(4):
        gc.collect()
        time.sleep(1.2)  # py4j hands dropped references on once a second
        spark._jvm.System.gc()
        if spark.sparkContext._jsc.getPersistentRDDs().size() <= cached:
            break


def recommend(model: ALSModel, users: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top-``n`` items per requested user, flattened: user, rank (1-based),
    item, predicted rating (float).  Already-rated items are not excluded and
    unknown users produce no rows, as in MLlib."""
    user_col, item_col = model.getUserCol(), model.getItemCol()
    recs = model.recommendForUserSubset(users, n)
    flat = recs.select(user_col, F.posexplode("recommendations").alias("_pos", "_rec"))
    return flat.select(user_col, (F.col("_pos") + 1).alias("rank"),
                       F.col(f"_rec.{item_col}").alias(item_col),
                       F.col("_rec.rating").alias("rating"))


def dense_index(ratings: DataFrame, col: str, alias: str) -> DataFrame:
    """``col → alias``: a dense 0-based int for every distinct value of ``col``.

    MLlib needs 32-bit ids; keys of large tables exceed that range while
    their number of distinct values may not.  The numbering uses
    ``splits.row_index`` (range sort + per-partition offsets, no single-task
    window).  More than 2^31 distinct values fail loudly on the ANSI cast
    instead of wrapping around."""
    from quarry.operators.splits import row_index
    ids = ratings.select(col).distinct()
    return row_index(ids, [col], "_dense").select(
        col, (F.col("_dense") - 1).cast("int").alias(alias))


def dense_ratings(ratings: DataFrame, user: str, item: str, rating: str
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(_u, _i, _r)`` ratings on dense ids, and the user and item indexes
    (``user → _u``, ``item → _i``).  The ratings are stored first: the two
    indexes and the join read the table, not the jobs behind the ratings; it goes
    once they are stored."""
    spark = ratings.sparkSession
    stored = write_through(spark, "als-ratings", lambda: ratings.select(
        user, item, F.col(rating).cast("float").alias("_r")))
    uidx = write_through(spark, "als-users", lambda: dense_index(stored, user, "_u"))
    iidx = write_through(spark, "als-items", lambda: dense_index(stored, item, "_i"))
    indexed = write_through(spark, "als-indexed", lambda: stored.join(uidx, user).join(iidx, item)
                            .select("_u", "_i", "_r"))
    remove_table(stored)
    return indexed, uidx, iidx


def recommend_any_ids(ratings: DataFrame, users: DataFrame, user: str, item: str,
                      rating: str, n: int = TOP_N, seed: int = 42) -> DataFrame:
    """Train ALS and recommend for ``users`` whatever the id type: ids are
    densely re-indexed for MLlib and mapped back, always, so the same ratings
    train the same model whatever the keys' range.  Returns ``user, rank, item,
    rating`` with the original ids."""
    indexed, uidx, iidx = dense_ratings(ratings, user, item, rating)
    model = fit_als(indexed, "_u", "_i", "_r", seed=seed)
    wanted = users.select(user).join(uidx, user).select("_u")
    recs, _ = recommend_pruned(model, wanted, n)  # MLlib's rows without its cartesian product
    # n rows per requested user: no hint, the requested set may be large;
    # Spark's size check / AQE broadcasts it when it is small
    return recs.join(uidx, "_u").join(iidx, "_i").select(user, "rank", item, "rating")


# --- evidence about a model ---------------------------------------------------

#: Ratings that meet their items' factors at once, and those of one user above which the
#: user's are summed before they are sent.
SLICE_RATINGS, HOT_RATINGS = 64_000_000, 1_000_000


def normal_equation_residuals(model: ALSModel, ratings: DataFrame, rating: str,
                              reg_param: float = REG_PARAM, slice_ratings: int = SLICE_RATINGS,
                              hot_ratings: int = HOT_RATINGS) -> DataFrame:
    """Per user how far the factors are from solving the user's regularised least squares:
    ``user, n_ratings, residual``.

    ALS ends with the users: given the item factors ``v``, user factors ``x`` solve
    ``(sum v v' + reg * n * I) x = sum r v`` over the user's n ratings.  Both sums are plain
    aggregates of products, k (k + 1) / 2 + k of them.  A user's few ratings fall into as many
    tasks, so sums made there would be sent as rows of 65 numbers for every rating; ratings
    are sent with their k factors instead, and added up where the user is.  Only users of more
    than ``hot_ratings`` are combined map-side, one partial row per task.  Users are taken in
    slices of about ``slice_ratings`` ratings whose shuffles go before the next: the
    disk needed at once does not grow with the ratings.  ``residual`` is the largest component
    of ``A x - b`` over the largest of ``b``.
    """
    user, item, k = model.getUserCol(), model.getItemCol(), model.rank
    spark = ratings.sparkSession
    v = model.itemFactors.select(F.col("id").alias("_item"), F.col("features").alias("_v"))
    x = model.userFactors.select(F.col("id").alias("_id"), F.col("features").alias("_x"))
    rated = ratings.select(F.col(user).alias("_user"), F.col(item).alias("_rated"),
                           F.col(rating).cast("double").alias("_r"))

    def with_factors(some: DataFrame) -> DataFrame:
        return some.join(v, some["_rated"] == v["_item"]).select("_user", "_r", "_v")

    def sums(rows: DataFrame) -> DataFrame:
        wide = rows.select("_user", "_r", *(F.col("_v")[j].cast("double").alias(f"_v{j}") for j in range(k)))
        return wide.groupBy("_user").agg(
            F.count(F.lit(1)).alias("n_ratings"),
            *(F.sum(F.col(f"_v{j}") * F.col(f"_v{m}")).alias(f"_g{j}_{m}")
              for j in range(k) for m in range(j, k)),
            *(F.sum(F.col("_r") * F.col(f"_v{j}")).alias(f"_b{j}") for j in range(k)))

    def component(j: int) -> Column:
        total = F.lit(reg_param) * F.col("n_ratings") * F.col("_x")[j] - F.col(f"_b{j}")
        for m in range(k):
            total = total + F.col(f"_g{min(j, m)}_{max(j, m)}") * F.col("_x")[m]
        return F.abs(total)

    def residuals(summed: DataFrame) -> DataFrame:
        both = summed.join(x, summed["_user"] == x["_id"])
        off = F.array_max(F.array(*(component(j) for j in range(k))))
        size = F.array_max(F.array(*(F.abs(F.col(f"_b{j}")) for j in range(k))))
        return both.select(F.col("_user").alias(user), "n_ratings",
                           (off / F.greatest(size, F.lit(1e-30))).alias("residual"))

    hot = write_through(spark, "als-hot", lambda: block_counts(rated, "_user", hot_ratings))
    any_hot = not hot.isEmpty()
    slices = max(1, math.ceil(rated.count() / slice_ratings))

    def one_slice(s: int) -> DataFrame:
        mine = rated.where(F.pmod(F.xxhash64("_user"), F.lit(slices)) == s) if slices > 1 else rated
        few = mine.join(hot, "_user", "left_anti") if any_hot else mine
        out = residuals(sums(with_factors(few).repartition("_user")))
        if any_hot:
            out = out.unionByName(residuals(sums(with_factors(mine.join(hot, "_user", "left_semi")))))
        return out
    out = [write_through(spark, "als-residuals", lambda: one_slice(s)) for s in range(slices)]
    return functools.reduce(DataFrame.unionByName, out)


def prediction_error(model: ALSModel, held_out: DataFrame, rating: str, mean: float) -> DataFrame:
    """One row over the held-out ratings whose user and item the model knows: ``n``, ``rmse``
    of the model and ``rmse_mean`` of always predicting ``mean``."""
    user, item = model.getUserCol(), model.getItemCol()
    x = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("_x"))
    v = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("_v"))
    dot = F.aggregate(F.zip_with("_x", "_v", lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0), lambda total, p: total + p)
    r = F.col(rating).cast("double")
    known = held_out.join(x, user).join(v, item).select(
        F.pow(dot - r, F.lit(2)).alias("_e"), F.pow(r - F.lit(mean), F.lit(2)).alias("_m"))
    return known.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg("_e")).alias("rmse"),
                     F.sqrt(F.avg("_m")).alias("rmse_mean"))


# --- exact top-n without scoring every item -------------------------------------

BLOCK_ITEMS = 1024
CHUNK_USERS = 1024
#: Item blocks sent to every executor at once (about 90 KB each), in the first rounds and later:
#: few rounds on small tables, and better floors before many blocks are met.
ROUND_BLOCKS = (16, 64, 256)
#: What float32 dot products may add to the Cauchy-Schwarz bound.
_SLACK = 1e-4


def _norm_of(features: str) -> Column:
    return F.sqrt(F.aggregate(F.col(features), F.lit(0.0),
                              lambda total, f: total + f.cast("double") * f.cast("double")))


def _bound():
    """The floors less what rounding may add to scores with items up to a length.  A function
    made here is sent to the workers whole: they need not have this package."""
    def reach(floors: np.ndarray, norms: np.ndarray, longest: float) -> np.ndarray:
        return floors - _SLACK * (np.abs(floors) + norms * longest * 1e-2)
    return reach


def _user_chunks(users: DataFrame, chunk_users: int) -> DataFrame:
    """Users (``_user, _x, _floor``) with equal ``_last`` packed into rows of about
    ``chunk_users``: ``_last, members``."""
    counts = users.groupBy("_last").agg(F.ceil(F.count(F.lit(1)) / chunk_users).alias("_chunks"))
    return (users.join(F.broadcast(counts), "_last")  # at most one row per block of a round
            .withColumn("_chunk", F.pmod(F.xxhash64("_user"), F.col("_chunks")))
            .groupBy("_last", "_chunk").agg(F.collect_list(F.struct("_user", "_x", "_floor")).alias("members")))


def _chunk_type(n: int) -> type:
    """A chunk of users in a task; made here for the reason given in ``_bound``."""
    reach = _bound()

    class Chunk:
        """The best ``n`` items so far of the users of a chunk, with scores not below their floors."""

        def __init__(self, users: np.ndarray, x: np.ndarray, floors: np.ndarray):
            self.users, self.x = users, x
            self.floors = np.array(floors, dtype=np.float32)
            self.norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            self.rows, self.items, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)

        def meet(self, items: np.ndarray, v: np.ndarray) -> None:
            """Scores one block.  A comparison with the floor costs a fraction of a selection of the
            best, which only users with more than ``n`` items left still need."""
            longest = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
            # users whom no item of the block can give a score at the floor are left out
            near = np.flatnonzero(reach(self.floors.astype(np.float64), self.norms, longest) <= self.norms * longest)
            scores = self.x[near] @ v.T
            keep = scores >= self.floors[near, None]
            many = np.flatnonzero(np.count_nonzero(keep, axis=1) > n)
            if len(many):  # ties with the n-th best stay in
                some = scores[many]
                keep[many] &= some >= np.partition(some, -n, axis=1)[:, -n, None]
            row, col = np.nonzero(keep)
            if not len(row):
                return
            rows = np.concatenate([self.rows, near[row]])
            found, best = np.concatenate([self.items, items[col]]), np.concatenate([self.scores, scores[row, col]])
            order = np.lexsort((found, -best, rows))  # ties to the smaller item
            rows, found, best = rows[order], found[order], best[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            full = place == n - 1
            self.floors[rows[full]] = np.maximum(self.floors[rows[full]], best[full])
            first = place < n
            self.rows, self.items, self.scores = rows[first], found[first], best[first]

        def batch(self) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(self.users[self.rows], pa.int32()), pa.array(self.items, pa.int32()),
                 pa.array(self.scores, pa.float32())], names=["_user", "_item", "_score"])
    return Chunk


def _score_pairs(pairs: DataFrame, n: int) -> DataFrame:
    """Top ``n`` items of each user, less those below the user's floor, for every (chunk of
    users, block) row.  Consecutive rows of one chunk raise its floors and give one result."""
    def matrix(cell, name):
        values = cell.values.field(name)
        return np.asarray(values.flatten(), dtype=np.float32).reshape(len(values), -1)

    chunk_type = _chunk_type(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in batches:
            members = batch.column(batch.schema.get_field_index("members"))
            items = batch.column(batch.schema.get_field_index("items"))
            for users, block in zip(members, items):
                ids = np.asarray(users.values.field("_user"))
                if chunk is None or not np.array_equal(chunk.users, ids):
                    if chunk is not None:
                        yield chunk.batch()
                    chunk = chunk_type(ids.copy(), matrix(users, "_x").copy(),
                                       np.asarray(users.values.field("_floor"), dtype=np.float32))
                chunk.meet(np.asarray(block.values.field("_item")), matrix(block, "_v"))
        if chunk is not None:
            yield chunk.batch()
    return pairs.select("members", "items").mapInArrow(run, "_user int, _item int, _score float")


def recommend_pruned(model: ALSModel, users: DataFrame, n: int = TOP_N,
                     block_items: int = BLOCK_ITEMS, chunk_users: int = CHUNK_USERS,
                     round_blocks: tuple[int, ...] = ROUND_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The exact top-``n`` of ``recommend`` (user, rank, item, rating; ties to the smaller
    item) without the product of all users and items, and a report of what was scored.

    Items are sorted by the length of their factors (``row_index``) and cut into blocks.  Every
    user first scores the block of the longest items, whose n-th best score is a floor (lower
    scores of later blocks are not handed on); by
    Cauchy-Schwarz an item reaches it only if its length times the user's does, so the user
    needs just the blocks up to the last one whose longest item does, and of them hands on what
    reaches the floor.

    The blocks are met in rounds.  A round broadcasts its next few blocks; users with the same
    last block are packed into chunks, and the task that holds a chunk scores it against one
    block after the other, so neither chunks nor blocks are copied into a shuffle, whatever the
    number of pairs.  The n best items so far of every user then give floors for the next
    round, which only users who still need blocks take part in; the others' rows are stored
    and done.  Tables of a round go with the next, so the disk needed is that of a few rows
    of n items per user.  The driver passes the blocks of one round on and sees the longest length
    of each block, one number per ``block_items`` items.

    The report has one row: ``users``, ``blocks`` (of items), ``pairs`` (user, block) of an
    exhaustive search and the ``scored`` ones.
    """
    from quarry.operators.splits import row_index
    user_col, item_col = model.getUserCol(), model.getItemCol()
    spark = users.sparkSession
    lengths = model.itemFactors.select(F.col("id").alias("_item"), F.col("features").alias("_v"),
                                       (-_norm_of("features")).alias("_down"))
    blocks = write_through(spark, "als-blocks", lambda: row_index(lengths, ["_down", "_item"], "_at")
                           .withColumn("_block", F.floor((F.col("_at") - 1) / block_items).cast("int"))
                           .groupBy("_block").agg(F.max(-F.col("_down")).alias("longest"),
                                                  F.collect_list(F.struct("_item", "_v")).alias("items")))
    longest = np.array([r["longest"] for r in
                        blocks.select("_block", "longest").orderBy("_block").collect()])
    wanted = users.select(F.col(user_col).alias("_user")).distinct()
    nothing = F.lit(float("-inf")).cast("float")
    # the best items so far as (score, minus the item): falling, ties to the smaller item
    best_type = "array<struct<_score:float,_minus:bigint>>"
    state = write_through(spark, "als-wanted", lambda: wanted.join(
        model.userFactors.select(F.col("id").alias("_user"), F.col("features").alias("_x")), "_user")
        .select("_user", "_x", nothing.alias("_floor"), F.array().cast(best_type).alias("_best"),
                F.lit(0).alias("_last"), F.lit(0).alias("_scored")))

    reach_of = _bound()

    @F.arrow_udf("int")
    def last_block(floors: pa.Array, norms: pa.Array, counts: pa.Array) -> pa.Array:
        floors, norms = np.asarray(floors, dtype=np.float64), np.asarray(norms)
        reach = reach_of(floors, norms, longest[0] if len(longest) else 0.0)
        need = np.where((np.asarray(counts) < n) | (reach <= 0), -np.inf,
                        reach / np.maximum(norms, 1e-30))
        # blocks are sorted by falling length: count those at least as long as needed
        return pa.array(len(longest) - np.searchsorted(longest[::-1], need, side="left") - 1, pa.int32())

    def next_state(active: DataFrame, start: int, stop: int) -> DataFrame:
        """``active`` after the blocks ``start`` to ``stop - 1``."""
        to = F.least(F.col("_last"), F.lit(stop - 1))
        chunks = _user_chunks(active.select("_user", "_x", "_floor", to.alias("_last")), chunk_users)
        some = blocks.where(F.col("_block").between(start, stop - 1)).select("_block", "items")
        pairs = chunks.withColumn("_block", F.explode(F.sequence(F.lit(start), F.col("_last"))))
        found = _score_pairs(pairs.join(F.broadcast(some), "_block"), n).groupBy("_user").agg(
            F.collect_list(F.struct("_score", (-F.col("_item").cast("bigint")).alias("_minus"))).alias("_found"))
        both = F.concat("_best", F.coalesce("_found", F.array().cast(best_type)))
        return (active.join(found, "_user", "left")
                .withColumn("_best", F.slice(F.sort_array(both, asc=False), 1, n))
                .withColumn("_floor", F.when(F.size("_best") < n, nothing)
                            .otherwise(F.get(F.col("_best"), F.lit(n - 1))["_score"]))
                .withColumn("_scored", F.col("_scored") + to - start + 1)
                .withColumn("_last", last_block("_floor", _norm_of("_x"), F.size("_best")))
                .select("_user", "_x", "_floor", "_best", "_last", "_scored"))

    done, start, rounds = [], 0, iter([1, *round_blocks])
    size = 1
    while True:
        finished = F.col("_last") < start if start < len(longest) else F.lit(True)
        if start or not len(longest):
            done.append(write_through(spark, "als-done", lambda: state.where(finished).select("_user", "_best", "_scored")))
        active = state.where(~finished)
        stop = min(start + (size := next(rounds, size)), len(longest))
        user_blocks = active.agg(F.sum(F.least(F.col("_last"), F.lit(stop - 1)) - start + 1)).first()[0]
        if not user_blocks:
            break
        # a million (user, block) pairs a task; few pairs are left to adaptive execution
        with sized_shuffles(spark, user_blocks) if user_blocks > ROWS_PER_TASK else nullcontext():
            after = write_through(spark, "als-state", lambda: next_state(active, start, stop))
        remove_table(state)
        state, start = after, stop
    remove_table(state)
    found = functools.reduce(DataFrame.unionByName, done)
    top = found.select(F.col("_user").alias(user_col), F.posexplode("_best").alias("_pos", "_b")).select(
        user_col, (F.col("_pos") + 1).alias("rank"), (-F.col("_b._minus")).cast("int").alias(item_col),
        F.col("_b._score").alias("rating"))
    report = found.agg(
        F.count(F.lit(1)).alias("users"), F.lit(len(longest)).cast("long").alias("blocks"),
        (F.count(F.lit(1)) * len(longest)).alias("pairs"),
        F.coalesce(F.sum("_scored"), F.lit(0)).cast("long").alias("scored"))
    return top, report
