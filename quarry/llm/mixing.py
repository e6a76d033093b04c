"""Mixing sources to target weights.

Every document gets a hash-random key; documents are range-sorted by (source, key) and a
distributed prefix sum of their sizes tells where each one starts in its source's random
order.  A source's budget of words is laid over that order, beginning again at the front for
a further epoch when the budget exceeds the source, and is cut exactly where it ends: a
document takes the words by which it overlaps the budget.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own and
ranks last; rows that repeat a doc_id are separate rows (identical ones are interchangeable);
an empty table gives an empty result; a corpus without words has targets 0; extra columns are
ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import document_key, n_words, packed, scratch, unpacked
from quarry.llm.ranking import running_sum

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = 20240607


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size`` (one row each) -> those columns and ``target``.

    Sources in code-point order, null last, take the weights in turn and share
    ``share`` times all sizes; no target exceeds ``most`` times its source, the excess is
    shared again by weight until no target does.  Each round settles at least one source and
    brings only two sums and a count to the driver; the sources stay a table.
    """
    ranked = running_sum(
        sources.withColumn("_last", F.col("source").isNull())
               .withColumn("_one", F.lit(1).cast("long"))
               .withColumn("_all", F.lit(0)),
        ["_all"], ["_last", "source"], "_one", "_rank")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)),
                          (F.col("_rank") % len(weights) + 1).cast("int"))
    state = scratch(ranked.select("source", "source_size", weight.cast("long").alias("_weight"),
                                  F.lit(False).alias("_full")), "sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    budget = share * total
    per_weight = 0.0
    while True:
        row = state.agg(
            F.sum(F.when(F.col("_full"), most * F.col("source_size"))).alias("taken"),
            F.sum(F.when(~F.col("_full"), F.col("_weight"))).alias("weight")).first()
        per_weight = (budget - (row["taken"] or 0)) / row["weight"] if row["weight"] else 0.0
        above = ~F.col("_full") & (F.lit(per_weight) * F.col("_weight")
                                   > most * F.col("source_size"))
        if state.where(above).isEmpty():
            break
        state = scratch(state.withColumn("_full", F.col("_full") | above), "sources")
    return state.select("source", "source_size",
                        F.when(F.col("_full"), (most * F.col("source_size")).cast("double"))
                         .otherwise(F.lit(per_weight) * F.col("_weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document row: ``id_col, _key, source, size, source_size, target, taken``.

    ``taken`` is exact: the words of a source sum to its target rounded down.
    """
    sized = scratch(docs.select(
        F.col(f"`{id_col}`"), F.col(f"`{source_col}`").alias("source"),
        n_words(F.col(text_col)).alias("size"), document_key(id_col, text_col).alias("_key")),
        "sizes")
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    keyed = sized.withColumn("_random", F.xxhash64(F.lit(seed), F.col("_key")))
    placed = running_sum(keyed, ["source"], ["_random", "_key"], "size", "_start")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    budget = F.floor(F.col("target")).cast("long")
    # words of this document that the first x words of the repeated order hold
    epochs = F.floor(budget / F.col("source_size")).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_start"), F.lit(0)), F.col("size"))
    taken = F.when(F.col("source_size") > 0, epochs * F.col("size") + part).otherwise(F.lit(0))
    return (placed.join(t, F.col("source").eqNullSafe(F.col("_source")))
            .select(id_col, "_key", "source", "size", "source_size", "target",
                    taken.cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", length_col: str | None = "n_chars",
                    **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for every whole epoch that
    takes a document, and one with its first words where the budget ends inside it (cut at
    the exact word; ``length_col`` then counts the cut text's characters)."""
    taken = mix(docs, id_col, text_col, source_col, **options)
    # the same document may stand in several sources, each with its own share
    per_key = (taken.where("taken > 0").groupBy("_key", F.col("source").alias("_source"))
               .agg(F.sum("taken").alias("_taken"), F.first("size").alias("_size"),
                    F.count(F.lit(1)).alias("_rows")))
    source = F.col("_row").getField(source_col)
    joined = packed(docs, id_col, text_col).withColumnRenamed("_key", "_own_key").join(
        per_key, (F.col("_own_key") == F.col("_key")) & source.eqNullSafe(F.col("_source")))
    # rows that repeat a document share its words evenly, the first ones take what is left
    number = F.row_number().over(Window.partitionBy("_key", "_source").orderBy(F.lit(0)))
    single = joined.where("_rows = 1").withColumn("_own", F.col("_taken"))
    several = (joined.where("_rows > 1").withColumn("_n", number)
               .withColumn("_own", F.floor(F.col("_taken") / F.col("_rows"))
                           + F.when(F.col("_n") <= F.col("_taken") % F.col("_rows"), 1)
                             .otherwise(0)).drop("_n"))
    rows = single.unionByName(several)
    whole = F.floor(F.col("_own") / F.col("_size")).cast("int")
    cut = F.col("_own") - whole * F.col("_size")
    pieces = F.concat(F.array_repeat(F.lit(0).cast("long"), whole),
                      F.when(cut > 0, F.array(cut)).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("_cut", F.explode(pieces))
    words = F.array_remove(F.split(F.col("_text"), r"[\x20\x09-\x0D]+"), "")
    whole_text, row = F.col("_cut") == 0, F.col("_row")
    text = F.when(whole_text, F.col("_text")).otherwise(
        F.array_join(F.slice(words, 1, F.greatest(F.col("_cut"), F.lit(1)).cast("int")), " "))
    changed = {text_col: text}
    if length_col in docs.columns:
        changed[length_col] = (F.when(whole_text, row.getField(length_col)).otherwise(F.length(text))
                               .cast(docs.schema[length_col].dataType))
    return unpacked(rows, docs.columns, changed)
