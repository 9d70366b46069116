"""Rule-based advice on the report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.combine import union_all
from lakeops.operators.profile import missing_report

# fixed values: thresholds of the rules
MIN_PRICE_BINS = 10
MAX_NULL_PERCENT = 20
MIN_MONTHS = 6
METRICS = ("lat", "lon", "avg_price", "avg_occ_365")


def _advice(df: DataFrame, city: Column, dataset: str, text: Column) -> DataFrame:
    return df.select(city.alias("city"), F.lit(dataset).alias("dataset"), text.alias("recommendation"))


def _too_few(df: DataFrame, limit: int, cities: Sequence[str], dataset: str, text: str) -> DataFrame:
    """One row per city where the table as a whole has fewer rows than the limit."""
    small = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < limit)
    return _advice(small, F.explode(F.array(*[F.lit(c) for c in cities])), dataset, F.lit(text))


def recommend(
    price_hist: DataFrame, neighbourhoods: DataFrame, by_month: DataFrame, cities: Sequence[str]
) -> DataFrame:
    """Few price bins; no neighbourhoods; a neighbourhood metric often null; no months; a city
    with a short history. Every rule is a filtered aggregate, so nothing is collected."""
    often_null = missing_report(neighbourhoods.select(*METRICS)).where(
        F.col("missing_percent") > MAX_NULL_PERCENT
    )
    months = by_month.groupBy("city").agg(F.count_distinct("month").alias("n"))
    return union_all(
        [
            _too_few(price_hist, MIN_PRICE_BINS, cities, "price_hist",
                     "few or no price bins: check the price texts and the price range"),
            _too_few(neighbourhoods, 1, cities, "neighbourhood_metrics",
                     "no neighbourhoods: check the neighbourhood and location columns"),
            _advice(often_null, F.lit("all"), "neighbourhood_metrics",
                    F.concat("column", F.lit(": "), F.round("missing_percent", 1).cast("string"),
                             F.lit("% null, filter or impute before mapping"))),
            _too_few(by_month, 1, cities, "occ_by_month",
                     "no monthly occupancy: check the calendar dates and t/f flags"),
            _advice(months.where(F.col("n") < MIN_MONTHS), F.col("city"), "occ_by_month",
                    F.concat(F.lit("short history ("), F.col("n").cast("string"),
                             F.lit(" months): seasonality is weak, add data or group by quarter"))),
        ]
    )
