"""Column-expression helpers.

Everything here builds Catalyst expressions, so it stays inside whole-stage
codegen; nothing is evaluated in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
# Word separator: one or more ASCII non-word characters (Java and RE2 agree
# that \W is ASCII-only), and the temperature conversion factors, applied in
# 32-bit float arithmetic in this order: tenths * 0.1 * (9 / 5) + 32.
NON_WORD = r"\W+"
TENTHS = 0.1
NINE_FIFTHS = 9.0 / 5.0
FREEZING_F = 32.0


def float_lit(x: float) -> Column:
    """A FloatType literal (a bare Python float would make the expression double)."""
    return F.lit(x).cast("float")


def tenths_celsius_to_fahrenheit(c: Column | str) -> Column:
    """Tenths of a degree Celsius → degrees Fahrenheit, in float32 like the original."""
    t = (F.col(c) if isinstance(c, str) else c).cast("float")
    return t * float_lit(TENTHS) * float_lit(NINE_FIFTHS) + float_lit(FREEZING_F)


def word_tokens(text: Column | str, keep_empty: bool = False) -> Column:
    """Array of tokens of ``text`` split on runs of non-word characters.

    ``keep_empty=False`` drops empty tokens (the DataFrame word-count rule).
    """
    c = F.col(text) if isinstance(text, str) else text
    toks = F.split(c, NON_WORD)
    return toks if keep_empty else F.filter(toks, lambda w: w != F.lit(""))


def line_tokens_jvm(line: Column | str) -> Column:
    """Tokens of one line with the semantics of Java ``String.split("\\W+")``.

    Java keeps a leading empty token, removes trailing empty tokens, turns an
    empty line into one empty token and an all-separator line into nothing.
    Spark's ``split`` keeps the one trailing empty token that a run of
    separators leaves, so it is cut off; a line made only of separators (two
    empty tokens) gives null (exploded to nothing).  One linear split per line.
    """
    c = F.col(line) if isinstance(line, str) else line
    toks = F.split(c, NON_WORD)
    n = F.size(toks)
    ends_empty = (n > 1) & (F.element_at(toks, -1) == "")
    only_separators = ends_empty & (n == 2) & (F.element_at(toks, 1) == "")
    return F.when(only_separators, F.lit(None)).when(
        ends_empty, F.slice(toks, F.lit(1), n - 1)).otherwise(toks)


def adjacency_tokens(line: Column | str, trim: bool = True) -> Column:
    """Tokens of an adjacency line ``"<id> <nbr> <nbr> ..."``.

    ``trim=True`` trims and splits on runs of whitespace; ``trim=False`` splits
    on single spaces exactly, so a trailing space adds an empty token.
    """
    c = F.col(line) if isinstance(line, str) else line
    return F.split(F.trim(c), r"\s+") if trim else F.split(c, " ")


def adjacency_neighbour_count(line: Column | str, trim: bool = True) -> Column:
    """``size(adjacency_tokens(line, trim)) - 1`` without building the array:
    a split yields one piece more than there are separator matches."""
    c = F.col(line) if isinstance(line, str) else line
    if trim:
        return F.regexp_count(F.trim(c), F.lit(r"\s+"))
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def cosine_score(sum_xy: Column, sum_xx: Column, sum_yy: Column) -> Column:
    """Cosine from co-rated sums; 0.0 when the denominator is zero."""
    den = F.sqrt(sum_xx) * F.sqrt(sum_yy)
    return F.when(den != 0, sum_xy / den).otherwise(F.lit(0.0))
