"""Weak supervision over quality rules.

Every rule looks at one feature of a whole text and votes good (+1) or bad (-1) or abstains
(0).  A latent two-class model gives each rule one accuracy, the probability that a vote of it
is right, the same for both classes and kept between 0.6 and 0.995;
expectation-maximisation estimates the accuracies together with the class prior, and the
posterior probability of "good" replaces an all-rules-must-pass filter.  The documents enter the
estimation only through the number of documents per vote pattern, a table of at most
3 ** rules rows whatever the corpus size, so all documents count and nothing is sampled.

Defined results: a null or empty text has no words, every rule abstains and the base rule
fails it; texts of any length are read whole; repeated rows and ids are judged row by row;
an empty table gives an empty result; extra columns are ignored by ``quality_features`` and
kept by ``filter_quality``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (columns_of, map_batches, packed, scratch, text_bytes,
                               unpacked)
from quarry.llm.hashing import (SPACE, Windows, _lut, as_bytes, covered, span_hashes, spans)

MIN_WORDS = 20
REPEAT_WINDOW = 8

#: name: (feature, bad when, good when), None: never.  Most rules only know junk and abstain on
#: the rest; one also recognises prose.
RULES = {
    "symbols": ("symbol_share", (">", 0.05), None),
    "capitals": ("capital_share", (">", 0.45), None),
    "shouting": ("bang_share", (">", 0.50), None),
    "repeats": ("repeat_share", (">", 0.20), None),
    "line_repeats": ("dup_line_share", (">", 0.45), None),
    "stutter": ("stutter_share", (">", 0.30), None),
    "word_length": ("mean_word", (">", 40.0), None),
    "decoration": ("decorated_share", (">", 0.30), None),
    "punctuation": ("punct_share", (">", 0.12), None),
    "vocabulary": ("distinct_share", ("<", 0.25), None),
    "sentences": ("sentence_share", None, (">", 0.60)),
}
#: Below this many words the shares say little, so all rules abstain.
VOTE_WORDS = 20

_SYMBOL = _lut(b"#*$%&|<>")
_UPPER = _lut(bytes(range(65, 91)))
_WORD_START = np.array([not SPACE[b] and (b & 0xC0) != 0x80 for b in range(256)])
_PUNCT = _lut(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_ENDS = (b".", b"?", "…".encode(), "。".encode(), b'."', b".)")

FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_lines long, n_capitals long, n_bangs long, "
            "n_distinct long, n_stutters long, n_sentences long, n_decorated long, "
            "n_puncts long")


def text_features(text: bytes) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``FEATURES``."""
    buf = as_bytes(text)
    starts, ends = spans(buf)
    hashes = span_hashes(buf, starts, ends)
    n = len(hashes)
    windows = Windows(hashes).all(REPEAT_WINDOW)
    repeat_words = 0
    if len(windows):
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            twice = np.zeros(len(windows), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            repeat_words = int(covered(np.flatnonzero(twice), REPEAT_WINDOW, n).sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()] if text else []
    sentences = sum(x.rstrip().endswith(_ENDS) for x in lines)
    last = _PUNCT[buf[ends - 1]] if n else np.zeros(0, dtype=bool)
    decorated = last & ((ends - starts == 1) | _PUNCT[buf[np.maximum(ends - 2, 0)]]) if n else last
    counts = np.bincount(buf, minlength=256) if len(buf) else np.zeros(256, dtype=np.int64)
    return (n, int(counts[_WORD_START].sum()), int(counts[_SYMBOL].sum()),
            len(lines) - len(set(lines)), repeat_words, len(lines),
            int(counts[_UPPER].sum()), int(counts[33]),
            len(np.unique(hashes)), int((hashes[1:] == hashes[:-1]).sum()), sentences,
            int(decorated.sum()), int(counts[_PUNCT].sum()))


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts per document row."""
    names = [c.split()[0] for c in FEATURES.split(", ")]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        col = columns_of(batch, ["_id", "_text"])
        rows = np.array([text_features(t) for t in text_bytes(col["_text"])], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [col["_id"], *(pa.array(rows[:, i]) for i in range(len(names)))],
            names=[id_col, *names])
    return map_batches(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")),
                       run, f"`{id_col}` {id_type}, {FEATURES}")


def votes(features: DataFrame) -> DataFrame:
    """Add the shares' votes as ``votes``, a string of one digit per rule (0 bad, 1 abstain,
    2 good), and the base rule's verdict."""
    share = {
        "symbol_share": F.col("n_symbols") / F.col("word_chars"),
        "capital_share": F.col("n_capitals") / F.col("word_chars"),
        "bang_share": F.col("n_bangs") / F.col("n_words"),
        "repeat_share": F.col("n_repeat_words") / F.col("n_words"),
        "dup_line_share": F.col("n_dup_lines") / F.col("n_lines"),
        # long texts repeat words: the share of distinct words is held against 200 words
        "distinct_share": F.col("n_distinct") / F.least(F.col("n_words"), F.lit(200)),
        "stutter_share": F.col("n_stutters") / F.col("n_words"),
        "sentence_share": F.col("n_sentences") / F.col("n_lines"),
        "decorated_share": F.col("n_decorated") / F.col("n_words"),
        "punct_share": F.col("n_puncts") / F.col("word_chars"),
        "mean_word": F.col("word_chars") / F.col("n_words"),
    }

    def compare(x, bound):
        return x > bound[1] if bound[0] == ">" else x < bound[1]

    enough = F.col("n_words") >= VOTE_WORDS

    def says(feature, bound):
        return enough & compare(share[feature], bound) if bound else F.lit(False)
    digits = [F.when(says(f, bad), "0").when(says(f, good), "2").otherwise("1")
              for f, bad, good in RULES.values()]
    return (features.withColumn("votes", F.concat(*digits))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))


def fit_accuracies(patterns: list[tuple[str, int]], rounds: int = 100, tolerance: float = 1e-9):
    """Expectation-maximisation over (vote pattern, documents) pairs.

    Returns (prior of good, accuracy per rule, posterior of good per pattern).  A rule that
    votes is right with its accuracy whatever the class; abstaining says nothing.  The start
    takes every rule as right in 85 of 100 votes; accuracies keep to 0.6-0.995 (a rule is
    better than a coin, which also fixes which class is which) and a pseudo-count of 20
    votes at the start's accuracy steadies rules that seldom vote.
    """
    patterns = sorted(patterns)
    start, low, high, pseudo = 0.85, 0.6, 0.995, 20.0
    accuracy = np.full(len(RULES), start)
    if not patterns:
        return 0.5, accuracy, {}
    vote = np.array([[int(d) - 1 for d in p] for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    prior = 0.8
    good = None
    for _ in range(rounds):
        score = np.log(prior / (1 - prior)) + vote @ np.log(accuracy / (1 - accuracy))
        update = 1 / (1 + np.exp(-score))
        moved = good is None or float(np.abs(update - good).max()) > tolerance
        good = update
        right = np.where(vote > 0, good[:, None], np.where(vote < 0, 1 - good[:, None], 0.0))
        cast = weight @ (vote != 0)
        accuracy = np.clip((weight @ right + pseudo * start) / (cast + pseudo), low, high)
        prior = float(np.clip((weight @ good + pseudo * 0.8) / (weight.sum() + pseudo), 0.05, 0.95))
        if not moved:
            break
    return prior, accuracy, {p: float(g) for (p, _), g in zip(patterns, good)}


def judge(features: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``votes``, ``base_failed``, ``posterior`` (of good) and ``kept``.

    Runs one job for the pattern counts (at most 3 ** rules rows reach the driver); the
    posteriors go back as a table of as many rows.
    """
    voted = votes(features)
    counts = [(r["votes"], r["n"]) for r in
              voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    posterior = fit_accuracies(counts)[2]
    spark = features.sparkSession
    scores = spark.createDataFrame(sorted(posterior.items()), "votes string, posterior double")
    return (voted.join(F.broadcast(scores), "votes", "left")
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the judged rules keep, with their columns unchanged."""
    rows = packed(docs, id_col, text_col)
    features = scratch(quality_features(rows, "_key", "_text"), "quality")
    kept = judge(features, threshold).where("kept").select("_key").distinct()
    return unpacked(rows.join(kept, "_key", "left_semi"), docs.columns)
