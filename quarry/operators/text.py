"""Word count over text lines or whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import word_tokens
from quarry.functions.expressions import NON_WORD


def word_count(df: DataFrame, text_col: str = "value", keep_empty: bool = False) -> DataFrame:
    """Count lower-cased words; columns ``word``, ``count``.

    ``keep_empty=False``: split the whole text on non-word runs, drop empty
    tokens.  ``keep_empty=True``: the line-by-line rule of Java's
    ``String.split`` (see ``line_tokens_jvm``), which counts the empty token
    produced by blank lines and by lines starting with a separator.
    Texts are processed whole; the explode is map-side and the count is
    combined per partition before the shuffle, so frequent words do not skew.
    """
    if keep_empty:
        # each line is split once: lines of separators only have no tokens, and of the others'
        # empty tokens the one in front counts and the one at the end does not
        lines = df.select(F.explode(F.split(F.col(text_col), "\n")).alias("_line"))
        words = (lines.where(~F.col("_line").rlike(rf"\A{NON_WORD}\z"))
                 .select(F.posexplode(F.split("_line", NON_WORD)).alias("_at", "_w"))
                 .where((F.col("_w") != F.lit("")) | (F.col("_at") == 0)))
    else:
        # explode all tokens, then drop empties: cheaper than an array filter
        words = (df.select(F.explode(word_tokens(text_col, keep_empty=True)).alias("_w"))
                   .where(F.col("_w") != F.lit("")))
    return words.groupBy(F.lower("_w").alias("word")).count()
