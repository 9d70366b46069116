"""Listing feeds: files to raw tables under a contract, and the cleaning chain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.parse import bathrooms, parse_list, price_to_double, tf_equal
from lakeops.operators.columns import add_metadata, keep
from lakeops.operators.rejects import listing_rules, with_reasons
from lakeops.sources.contracts import contract, with_metadata_fields
from lakeops.sources.files import read_csv_checked
from lakeops.sources.sinks import append, ensure_table

# fixed values: columns kept for modelling, and the two limits
KEEP = (
    "host_id", "host_since", "host_is_superhost", "latitude", "longitude", "property_type",
    "room_type", "accommodates", "bathrooms", "bathrooms_text", "bedrooms", "beds", "amenities",
    "price", "minimum_nights", "maximum_nights", "number_of_reviews", "review_scores_rating",
    "license", "instant_bookable", "reviews_per_month",
)
MAX_PRICE = 10000
MAX_MINIMUM_NIGHTS = 90
QUARANTINE = contract("file string, reason string, record string")


def load_feed(
    spark: SparkSession, path: str, contract: StructType, table: str, area: str,
    at: dt.datetime | None = None, multi_line: bool | None = None, strict: bool = False,
) -> None:
    """Append a CSV feed to its raw table with the load columns, creating the table if needed.

    Rows that do not have the header's fields go to ``<table>_quarantine`` with file, reason and text.
    """
    full, aside = with_metadata_fields(contract), with_metadata_fields(QUARANTINE)
    ensure_table(spark, table, full)
    ensure_table(spark, f"{table}_quarantine", aside)
    good, bad = read_csv_checked(spark, path, contract, multi_line, strict)
    append(good.transform(add_metadata, area, at), table, full)
    append(bad.transform(add_metadata, area, at), f"{table}_quarantine", aside)


def amenity_items(trim: bool = False, drop_empty: bool = False) -> Column:
    return parse_list("amenities", trim, drop_empty)


def fix_bathrooms(df: DataFrame) -> DataFrame:
    return df.withColumn("bathrooms", bathrooms("bathrooms_text")).drop("bathrooms_text")


def clean_listings(df: DataFrame) -> DataFrame:
    """Kept columns, numeric price below the limit, short minimum stays, typed flags, amenities
    as an array. Rows with a null price go as well."""
    have = set(df.columns)
    typed = keep(df, [c for c in KEEP if c in have]).withColumn("price", price_to_double("price"))
    return (
        typed.where(F.col("price") < MAX_PRICE)
        .where(F.col("minimum_nights") <= MAX_MINIMUM_NIGHTS)
        .withColumns(
            {
                "instant_bookable": tf_equal("instant_bookable"),
                "host_is_superhost": tf_equal("host_is_superhost"),
                "amenities": amenity_items(),
            }
        )
    )


def validate_listings(df: DataFrame) -> DataFrame:
    """Every listing with ``invalid_reasons``; an empty array means valid."""
    priced = df.withColumn("price_num", price_to_double("price"))
    return with_reasons(priced, listing_rules(MAX_PRICE, MAX_MINIMUM_NIGHTS), "invalid_reasons")
