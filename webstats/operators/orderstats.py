"""Exact quantiles of groups of any size, without a buffer per group.

``F.percentile`` keeps every distinct value of a group in one aggregation
buffer. Here a group is never gathered: its values are counted, the counts are
summed by *value range* (a monotone function of the value, so ranges are in
value order), a running sum over the ranges of a group tells which ranges hold
the wanted ranks, and only the values of those ranges are read again and ranked.
A hot group is spread over its values in the first step, over its ranges in the
last, and the window in between sees at most one row per range.

Quantiles interpolate between the two neighbouring ranks, as PERCENTILE_CONT
does. The approximate form stops at the ranges: a value is replaced by a
representative of its range, ``RANGES_PER_OCTAVE`` of which make a factor of
two, so it is off by at most ``MOST_RELATIVE_ERROR`` and ties to the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES_PER_OCTAVE = 32
MOST_RELATIVE_ERROR = 2 ** (1 / RANGES_PER_OCTAVE) - 1
# ranges of the smallest positive double lie above -1,074 octaves, those of the largest below 1,024
_OCTAVES = 1_080


def value_range(value: Column) -> Column:
    """A whole number that never falls as the value grows; zero, infinities and NaN have ranges of their own."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v)) * RANGES_PER_OCTAVE) + (_OCTAVES + 1) * RANGES_PER_OCTAVE
    most = F.lit(3 * _OCTAVES * RANGES_PER_OCTAVE)
    return (F.when(F.isnan(v), most + 1).when(v == 0, F.lit(0)).when(v == float("inf"), most).when(v == float("-inf"), -most)
            .when(v > 0, size).otherwise(-size)).cast("long")


def representative(value: Column) -> Column:
    """The middle of a value's range."""
    v = value.cast("double")
    middle = F.pow(F.lit(2.0), (F.floor(F.log2(F.abs(v)) * RANGES_PER_OCTAVE) + 0.5) / RANGES_PER_OCTAVE)
    return F.when((v == 0) | F.isnan(v) | (F.abs(v) == float("inf")), v).otherwise(F.signum(v) * middle)


def value_counts(df: DataFrame, groups: list[str], value: str, approx: bool = False) -> DataFrame:
    """``(groups…, value, n)`` of the non-NULL values; ``approx`` counts representatives."""
    v = F.col(value).cast("double")
    return (df.where(F.col(value).isNotNull()).groupBy(*groups, (representative(v) if approx else v).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def quantiles(counts: DataFrame, groups: list[str], probs: dict[str, float]) -> DataFrame:
    """``(groups…, one column per entry of probs)`` from ``counts`` (groups…, value, n: see ``value_counts``).

    NULL group keys are groups; a group without counted values has no row.
    """
    ranged = counts.withColumn("_range", value_range(F.col("value")))
    # windows and joins act on one non-NULL column, whatever the keys are
    key = F.to_json(F.struct(*[F.col(g).cast("string").alias(f"k{i}") for i, g in enumerate(groups)])) if groups else F.lit("")
    ranged = ranged.withColumn("_key", key)
    sums = ranged.groupBy("_key", "_range").agg(F.sum("n").alias("_n"))
    upto = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_key")
    placed = sums.withColumn("_to", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(whole))
    names = list(probs)
    place = [F.lit(float(p)) * (F.col("_all") - 1) for p in probs.values()]
    # ranks from 0; each quantile needs the ranks on both sides of its place
    ranks = F.array(*[F.struct(F.lit(i).alias("q"), side.alias("side"), at.cast("long").alias("rank"), p.alias("place"))
                      for i, p in enumerate(place) for side, at in ((F.lit(0), F.floor(p)), (F.lit(1), F.ceil(p)))])
    inside = F.filter(ranks, lambda r: (r["rank"] >= F.col("_to") - F.col("_n")) & (r["rank"] < F.col("_to")))
    wanted = (placed.select("_key", "_range", (F.col("_to") - F.col("_n")).alias("_before"), inside.alias("_ranks"))
              .where(F.size("_ranks") > 0))
    read = ranged.join(wanted, ["_key", "_range"])
    within = Window.partitionBy("_key", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = read.withColumn("_upto", F.col("_before") + F.sum("n").over(within))
    hits = ranked.select(*groups, "_key", "value", F.explode(F.filter("_ranks", lambda r: (
        r["rank"] >= F.col("_upto") - F.col("n")) & (r["rank"] < F.col("_upto")))).alias("r"))

    def at(i: int, side: int) -> Column:
        return F.max(F.when((F.col("r.q") == i) & (F.col("r.side") == side), F.col("value")))

    def between(i: int) -> Column:
        low, high, p = F.col(f"_low{i}"), F.col(f"_high{i}"), F.col(f"_place{i}")
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)
    sides = hits.groupBy(*groups, "_key").agg(*[c for i in range(len(names)) for c in (
        at(i, 0).alias(f"_low{i}"), at(i, 1).alias(f"_high{i}"),
        F.max(F.when(F.col("r.q") == i, F.col("r.place"))).alias(f"_place{i}"))])
    return sides.select(*groups, *[between(i).alias(n) for i, n in enumerate(names)])
