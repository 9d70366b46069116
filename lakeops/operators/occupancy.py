"""Calendar occupancy. Two readings of an unknown availability exist, and both are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.measure import month_of
from lakeops.functions.parse import safe_date, tf_bool, tf_int


def typed_calendar(df: DataFrame) -> DataFrame:
    """``date`` as a date and ``available`` as a boolean, where the frame has them."""
    new = {}
    if "date" in df.columns:
        new["date"] = safe_date("date")
    if "available" in df.columns:
        new["available"] = tf_bool("available")
    return df.withColumns(new) if new else df


def occupancy_by_month(calendar: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Share of days not available per month; an unknown day counts as free. Takes a typed calendar."""
    taken = F.when(F.col("available") == F.lit(False), 1).otherwise(0)
    return calendar.groupBy(*by, month_of("date").alias("month")).agg(F.avg(taken).alias("occ_rate_month"))


def occupancy_overall(calendar: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Share of days not available; an unknown day is left out. Takes ``t``/``f`` text."""
    return calendar.groupBy(*by).agg(F.avg(1 - tf_int("available")).alias("avg_occupancy"))


def occupancy_stats(by_month: DataFrame, city: str = "city", exact: bool = False) -> DataFrame:
    """Mean, median, p10 and p90 over the months of a city (hundreds of rows per city at most)."""
    pick = F.percentile if exact else F.percentile_approx
    return by_month.groupBy(city).agg(
        F.avg("occ_rate_month").alias("occ_month_avg"),
        pick("occ_rate_month", 0.5).alias("occ_month_median"),
        pick("occ_rate_month", 0.1).alias("occ_p10"),
        pick("occ_rate_month", 0.9).alias("occ_p90"),
    )
