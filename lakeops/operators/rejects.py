"""Rows with reasons: accepted rows, rejected rows, and how often each reason occurs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.measure import reasons


def with_reasons(df: DataFrame, rules: Mapping[str, Column], col: str = "reject_reasons") -> DataFrame:
    return df.withColumn(col, reasons(rules))


def accepted(df: DataFrame, col: str = "reject_reasons") -> DataFrame:
    return df.where(F.size(col) == 0)


def quarantine(df: DataFrame, col: str = "reject_reasons") -> DataFrame:
    return df.where(F.size(col) > 0)


def reason_counts(df: DataFrame, col: str = "reject_reasons") -> DataFrame:
    return (
        df.select(F.explode(col).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))
    )


def run_metrics(df: DataFrame, col: str = "reject_reasons") -> DataFrame:
    """Raw, accepted and rejected rows of one run, and the rejected share."""
    bad = F.count_if(F.size(col) > 0)
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("raw_rows"),
        (rows - bad).alias("accepted_rows"),
        bad.alias("rejected_rows"),
        F.try_divide(bad, rows).alias("reject_ratio"),
    )


def listing_rules(max_price: float = 10000, max_nights: int = 90, price: str = "price_num") -> dict[str, Column]:
    """Why a listing is not fit for use. Takes a frame with a numeric price."""
    return {
        "NULL_PRICE": F.col(price).isNull(),
        "EXTREME_PRICE": F.col(price) >= max_price,
        "ZERO_PRICE": F.col(price) <= 0,
        "LONG_MINIMUM_STAY": F.col("minimum_nights") > max_nights,
        "NULL_NEIGHBOURHOOD": F.col("neighbourhood_cleansed").isNull(),
        "NULL_LOCATION": F.col("latitude").isNull() | F.col("longitude").isNull(),
        "RATING_OUT_OF_RANGE": ~F.col("review_scores_rating").between(0, 5),
    }
