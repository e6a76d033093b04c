"""Relational summaries: projections, filters, per-key aggregates, SQL views.

Every aggregate here is algebraic, so Spark combines map-side before the
shuffle and a hot key costs one partial row per map task, not its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import tenths_celsius_to_fahrenheit


#: Decimal places kept while amounts are summed.
GUARD_DIGITS = 10


def with_offset(df: DataFrame, keep: Sequence[str], col: str, offset: int,
                alias: str | None = None) -> DataFrame:
    """Project ``keep`` plus ``col + offset``.

    Without ``alias`` the column keeps Spark's automatic name, e.g. ``(age + 10)``.
    """
    expr = F.col(col) + F.lit(offset)
    return df.select(*keep, expr.alias(alias) if alias else expr)


def filter_below(df: DataFrame, col: str, bound) -> DataFrame:
    """Rows with ``col < bound``; pushed down to the file scan."""
    return df.where(F.col(col) < F.lit(bound))


def sql_over_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as a temporary view and run ``sql`` against it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def count_by_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Row count per key, column ``count``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count()


def average_by_key(df: DataFrame, key: str, value: str, alias: str | None = None,
                   exact_scale: int | None = None) -> DataFrame:
    """Mean of ``value`` per ``key``; without alias the column is ``avg(value)``.

    ``exact_scale`` sums as decimals with that many places, ``GUARD_DIGITS`` at
    least (exact for money), converts the exact sum to double once and divides by the
    count, so the mean is the correctly rounded quotient whatever the order
    of the partial sums.
    """
    if exact_scale is None:
        mean = F.avg(value)
    else:
        total = F.sum(F.col(value).cast(f"decimal(30,{max(exact_scale, GUARD_DIGITS)})")).cast("double")
        mean = total / F.count(value)
    return df.groupBy(key).agg(mean.alias(alias or f"avg({value})"))


def rounded_total_by_key(df: DataFrame, key: str, value: str, alias: str = "total_spent",
                         scale: int = 2) -> DataFrame:
    """``round(sum(value), scale)`` per key.

    Only the sum is rounded.  It runs over decimals with ``GUARD_DIGITS`` places,
    so it is exact for values with as many decimals and no binary half-way case
    reaches the rounding; amounts beyond 1e20 fail loudly (ANSI cast).
    """
    total = F.sum(F.col(value).cast(f"decimal(30,{GUARD_DIGITS})"))
    return df.groupBy(key).agg(F.round(total, scale).cast("double").alias(alias))


def min_then_convert(df: DataFrame, key: str, value: str, where: Column | None = None,
                     alias: str = "temperature", digits: int | None = 2) -> DataFrame:
    """Filter, minimum of ``value`` (tenths °C, read as float) per key, then
    convert to °F and round.  Minimum-then-convert equals convert-then-minimum
    because the conversion is monotone; this order converts one row per key."""
    rows = df if where is None else df.where(where)
    mins = rows.groupBy(key).agg(F.min(F.col(value).cast("float")).alias("_min"))
    temp = tenths_celsius_to_fahrenheit("_min")
    if digits is not None:
        temp = F.round(temp, digits)
    return mins.select(key, temp.alias(alias))


def convert_then_min(df: DataFrame, key: str, value: str, where: Column | None = None,
                     alias: str = "temperature") -> DataFrame:
    """Convert every row to °F (float32), filter, minimum per key, unrounded."""
    conv = df.select(key, tenths_celsius_to_fahrenheit(value).alias(alias),
                     *([] if where is None else [where.alias("_keep")]))
    if where is not None:
        conv = conv.where("_keep").drop("_keep")
    return conv.groupBy(key).agg(F.min(alias).alias(alias))
