"""Counts, shares and histograms."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def item_counts(df: DataFrame, items: Column, name: str = "item") -> DataFrame:
    """How often each item occurs in an array, in lower case."""
    return (
        df.select(F.explode(items).alias("raw"))
        .groupBy(F.lower("raw").alias(name))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def price_histogram(
    df: DataFrame, by: Sequence[str] = ("city",), col: str = "price_num", lo: float = 5, hi: float = 2000
) -> DataFrame:
    """Rows per whole price (half away from zero) inside the range."""
    return (
        df.where(F.col(col).between(lo, hi))
        .groupBy(*by, F.round(col).alias("price_bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def rating_histogram(
    df: DataFrame, by: Sequence[str] = ("city",), col: str = "review_scores_rating", width: int = 5
) -> DataFrame:
    """Rows per rating bin. With the default width a 0-5 scale has two bins only. Nulls and NaN are in none."""
    return (
        df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
        .groupBy(*by, (F.floor(F.col(col) / F.lit(float(width))) * width).alias("rating_bin"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def histogram(df: DataFrame, value: str | Column, lo: float, hi: float, bins: int) -> DataFrame:
    """Fixed-width histogram of the value clipped to the range; the last bin is closed. Nulls
    and NaN are in no bin, and bins without rows are left out."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    width = (hi - lo) / bins
    clipped = F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi)))
    index = F.least(F.floor((clipped - F.lit(float(lo))) / F.lit(width)), F.lit(bins - 1).cast("bigint"))
    return (
        df.where(x.isNotNull() & ~F.isnan(x))
        .groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("bin_start", F.lit(float(lo)) + F.col("bin") * F.lit(width))
    )


def share(df: DataFrame, by: str, within: Sequence[str]) -> DataFrame:
    """Rows per value and their share of the group total.

    The total is summed from the counts and joined back. A window over the group would put all
    values of a group into one task.
    """
    keys = list(within)
    counts = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("cnt").alias("_total"))
    same = [counts[k].eqNullSafe(totals[f"_{k}"]) for k in keys]
    return counts.join(totals, same).select(
        *keys, by, "cnt", (F.col("cnt") / F.col("_total")).alias("share")
    )


def pivot_counts(
    df: DataFrame, row: str, col: str, values: Iterable[str], count: str = "cnt", fill: float | None = 0
) -> DataFrame:
    """One column per listed value. Gaps are ``fill``, or null if it is None."""
    def cell(v: str) -> Column:
        total = F.sum(F.when(F.col(col) == v, F.col(count)))
        return total if fill is None else F.coalesce(total, F.lit(fill))

    return df.groupBy(row).agg(*[cell(v).alias(str(v)) for v in values])
