"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds after every step, so a sum depends on how rows meet in tasks, and one
over mixed magnitudes loses the small ones.  Here a double is cut, exactly, into at most
three whole numbers on a fixed grid of 32-bit places (bins); the whole numbers of a bin are
added in two halves as longs, which is exact and combined map-side, and the bins of a key (at most 68)
are put together and rounded once, to the nearest double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bin, and the bins of special rows (outside those of finite doubles, -36 to 31).
_BITS = 32
_NOT_FINITE, _NULL = 9999, 9998
_PLACE = float(1 << _BITS)
_LIMB = "decimal(38,0)"


def _scaled(x: Column, places: Column) -> Column:
    """``x`` times 2 ** (32 * places), exactly unless the result has no exact double; in two
    steps, since one factor may not be a double."""
    half = F.pow(F.lit(2.0), places * (_BITS // 2))
    return x * half * half


def _pieces(df: DataFrame, key: str, value: str) -> DataFrame:
    """``_key, _p`` (``struct<bin, limb, special>``), one to three rows per value.

    Each step is a column of its own: a step is used several times by the next, and written
    as one expression the first would be computed some hundred times per row."""
    x, v = F.col("_x"), F.col("_v")
    steps = (df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_x"))
             .withColumn("_finite", ~F.isnan(x) & (F.abs(x) != float("inf")))
             .withColumn("_v", F.when(F.col("_finite") & (x != 0), x))
             .withColumn("_at", F.floor(F.floor(F.log2(F.abs(v))) / _BITS).cast("int"))
             .withColumn("_half", F.pow(F.lit(2.0), F.col("_at") * (-_BITS // 2)))
             .withColumn("_top", v * F.col("_half") * F.col("_half"))
             .withColumn("_first", F.col("_top").cast("bigint"))  # drops the fraction
             .withColumn("_middle", (F.col("_top") - F.col("_first")) * _PLACE)
             .withColumn("_second", F.col("_middle").cast("bigint"))
             .withColumn("_third", ((F.col("_middle") - F.col("_second")) * _PLACE).cast("bigint")))

    def piece(at: Column, limb: Column, special: Column) -> Column:
        return F.struct(at.cast("int").alias("bin"), limb.cast("bigint").alias("limb"),
                        special.cast("double").alias("special"))
    none, at = F.lit(None), F.col("_at")
    bin_ = (F.when(x.isNull(), _NULL).when(~F.col("_finite"), _NOT_FINITE).when(x == 0, 0).otherwise(at))
    # outer: no filter that would repeat the pieces is inferred
    pieces = F.explode_outer(F.array(
        piece(bin_, F.coalesce(F.col("_first"), F.lit(0)), F.when(~F.col("_finite"), x)),
        piece(F.when(F.col("_second") != 0, at - 1), F.col("_second"), none),
        piece(F.when(F.col("_third") != 0, at - 2), F.col("_third"), none)))
    return steps.select("_key", pieces.alias("_p")).where(F.col("_p.bin").isNotNull())


def _carried(totals: Column) -> Column:
    """Totals of consecutive bins, lowest first, as digits from 0 to 2**32 - 1 and the last
    carry (-1 for a negative sum): ``struct<digits, carry>``."""
    start = F.struct(F.array().cast(f"array<{_LIMB}>").alias("digits"), F.lit(0).cast(_LIMB).alias("carry"))
    base = F.lit(1 << _BITS).cast(_LIMB)

    def step(state: Column, total: Column) -> Column:
        value = (total + state["carry"]).cast(_LIMB)
        digit = F.pmod(value, base).cast(_LIMB)
        return F.struct(F.concat(state["digits"], F.array(digit)).alias("digits"),
                        ((value - digit) / base).cast(_LIMB).alias("carry"))
    return F.aggregate(totals, start, step)


def exact_sum_by_key(df: DataFrame, key: str, value: str, alias: str = "total") -> DataFrame:
    """``key, alias``: the sum of ``value`` (double) per key, the exact sum rounded once to the
    nearest double, whatever the order and partitioning of the rows.

    Nulls are ignored, a key of nulls only gives null; infinities and NaN give what adding
    them gives; sums beyond the largest double are infinite (below 2**-1022 the last bit may
    be off).  Two aggregates: per key and bin, combined map-side, then at most 68 rows a key.
    """
    # the halves of a limb are added as longs, which would take 2**46 rows to overflow
    limb, half = F.col("_p.limb"), _BITS // 2
    high, low = F.sum(F.shiftright(limb, half)), F.sum(limb.bitwiseAND((1 << half) - 1))
    bins = (_pieces(df, key, value).groupBy("_key", F.col("_p.bin").alias("_bin"))
            .agg((high.cast("decimal(20,0)") * F.lit(1 << half).cast("decimal(10,0)") + low).cast(_LIMB).alias("_total"),
                 F.sum("_p.special").alias("_special")))
    normal = F.col("_bin") < _NULL
    keys = bins.groupBy("_key").agg(
        F.collect_list(F.when(normal, F.struct("_bin", "_total"))).alias("_all"),
        F.min(F.when(normal, F.col("_bin"))).alias("_low"), F.max(F.when(normal, F.col("_bin"))).alias("_high"),
        F.max(F.when(F.col("_bin") == _NOT_FINITE, F.col("_special"))).alias("_special"))
    by_bin = F.map_from_entries("_all")
    # three more places take the carry of any number of rows
    filled = F.transform(F.sequence(F.col("_low"), F.col("_high") + 3),
                         lambda b: F.coalesce(F.try_element_at(by_bin, b), F.lit(0).cast(_LIMB)))
    signed = (keys.withColumn("_totals", filled)
              .withColumn("_plus", _carried(F.col("_totals")))
              .withColumn("_minus", _carried(F.transform("_totals", lambda t: (-t).cast(_LIMB))))
              .withColumn("_negative", F.col("_plus.carry") < 0))
    digits = F.when(F.col("_negative"), F.col("_minus.digits")).otherwise(F.col("_plus.digits"))
    ranked = signed.withColumn("_digits", digits).withColumn(
        "_top", F.aggregate(F.sequence(F.lit(1), F.size("_digits")), F.lit(0),
                            lambda best, i: F.when(F.element_at("_digits", i) != 0, i).otherwise(best)))

    def digit(back: int) -> Column:
        at = F.col("_top") - back
        return F.when(at >= 1, F.get(F.col("_digits"), at - 1)).otherwise(F.lit(0).cast(_LIMB))
    # 65 bits or more: what lies below only matters for being nothing or something
    lead = (digit(0) * F.lit(str(1 << 64)).cast("decimal(20,0)") + digit(1) * F.lit(1 << 32).cast("decimal(10,0)")
            + digit(2)).cast("decimal(37,0)")
    rest = F.exists(F.slice("_digits", 1, F.greatest(F.col("_top") - 3, F.lit(0))), lambda d: d != 0)
    lead = (lead.cast("decimal(38,1)") + F.when(rest, F.lit("0.1").cast("decimal(2,1)"))
            .otherwise(F.lit("0.0").cast("decimal(2,1)"))).cast("decimal(38,1)").cast("double")
    total = _scaled(lead, F.col("_low") + F.col("_top") - 3)
    total = F.when(F.col("_top") == 0, F.lit(0.0)).otherwise(
        F.when(F.col("_negative"), -total).otherwise(total))
    return ranked.select(F.col("_key").alias(key), F.coalesce("_special", total).alias(alias))
