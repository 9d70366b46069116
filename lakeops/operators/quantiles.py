"""Approximate and exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bits of the ranges of values within each factor of e, and of the steps that each range is cut into.
RANGE_BITS, STEP_BITS = 12, 20
_INFINITE, _NAN = 1 << 61, 1 << 62


def approx_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """One ``percentile_approx`` sketch per group: a bounded buffer, merged map side."""
    ps = F.array(*[F.lit(float(p)) for p in probs])
    found = df.groupBy(*by).agg(F.percentile_approx(value, ps, accuracy).alias("_q"))
    return found.select(*by, *[F.col("_q")[i].alias(quantile_name(p)) for i, p in enumerate(probs)])


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def _step(value: Column) -> Column:
    """Number of the step a value lies in, rising with the value. Steps are relative to the size of
    the value, so one outlier does not widen the others; infinities and, last, NaN have their own."""
    number = F.floor((F.log(F.abs(value)) + 750) * (1 << (RANGE_BITS + STEP_BITS))).cast("bigint")
    number = F.when(F.abs(value) == float("inf"), F.lit(_INFINITE)).otherwise(number)
    signed = F.when(value > 0, number).when(value < 0, -number)
    return F.coalesce(F.when(F.isnan(value), F.lit(_NAN)).otherwise(signed), F.lit(0).cast("bigint"))


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles, equal to ``percentile``, without a whole group in one task.

    ``percentile`` keeps every distinct value of a group in one buffer. Here the rows are counted per
    distinct value and then per range of values. Running counts over a group's ranges say which ones hold
    a wanted rank, two for each quantile at most. Their values are counted again by fine steps, 2^20 a
    range, and only the values of the steps that hold a wanted rank are ordered. Doubles are spaced such that
    a step has 2^20 different ones at most, however close together all values lie. A value that fills a
    third of the rows is one count, and one plan serves groups of every size.
    """
    keys = list(by)
    group = [f"_{k}" for k in keys]
    positions = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    wanted = [rank for at in positions for rank in (F.floor(at), F.ceil(at))]
    start, end = F.col("_start"), F.col("_end")

    def holding(sizes: DataFrame, before: Column, within: list[str], place: str) -> DataFrame:
        """Of the places in order, those that hold a wanted rank, and the rows before each."""
        order = Window.partitionBy(*within).orderBy(place)
        placed = sizes.withColumn("_end", before + F.sum("_rows").over(order)).withColumn("_start", end - F.col("_rows"))
        has = reduce(lambda a, b: a | b, [(rank >= start) & (rank < end) for rank in wanted])
        return placed.where(has).select(*group, F.col(place).alias("_held"), "_start", "_total")

    def matched(left: DataFrame, held: DataFrame, place: str) -> DataFrame:
        same = [left[k].eqNullSafe(held[f"_{k}"]) for k in keys] + [left[place] == held["_held"]]
        return left.join(held, same).drop(*group, "_held")

    names = [F.col(k).alias(f"_{k}") for k in keys]
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_step", _step(F.col("_v")))
        .withColumn("_range", F.shiftright("_step", STEP_BITS))
    )
    ranges = counts.groupBy(*names, "_range").agg(F.sum("_n").alias("_rows"))
    ranges = ranges.withColumn("_total", F.sum("_rows").over(Window.partitionBy(*group)))
    inside = matched(counts, holding(ranges, F.lit(0), group, "_range"), "_range")
    steps = inside.groupBy(*names, "_range", "_step").agg(
        F.sum("_n").alias("_rows"), F.min("_start").alias("_before"), F.min("_total").alias("_total")
    )
    held = holding(steps, F.col("_before"), [*group, "_range"], "_step")
    inside = matched(inside.drop("_start", "_total"), held, "_step")
    order = Window.partitionBy(*keys, "_step").orderBy("_v")
    ranked = inside.withColumn("_after", start + F.sum("_n").over(order)).withColumn("_first", F.col("_after") - F.col("_n"))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_first")) & (rank < F.col("_after")), F.col("_v")))

    answers, named = [], []
    for i, (p, at) in enumerate(zip(probs, positions)):
        answers += [at_rank(F.floor(at)).alias(f"_l{i}"), at_rank(F.ceil(at)).alias(f"_h{i}"), F.max(at - F.floor(at)).alias(f"_f{i}")]
        low, high, share = F.col(f"_l{i}"), F.col(f"_h{i}"), F.col(f"_f{i}")
        finite = F.abs(low) < float("inf")
        between = F.when(finite, low + (high - low) * share).otherwise(low * (1 - share) + high * share)
        named.append(F.when(low == high, low).otherwise(between).alias(quantile_name(p)))
    return ranked.groupBy(*keys).agg(*answers).select(*keys, *named)


def quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """Columns ``p10``, ``p50``, ... per group."""
    return (exact_quantiles if exact else approx_quantiles)(df, value, probs, by)
