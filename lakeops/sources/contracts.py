"""Schema contracts: stored as JSON text, compared with what a feed really brings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TYPES = {"string": StringType(), "bigint": LongType(), "double": DoubleType()}


def contract(text: str) -> StructType:
    """Contract of ``name type`` pairs. Unlike a DDL text it needs no session to be read."""
    pairs = [pair.split() for pair in text.split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


# fixed values: the three feed contracts, in field order
LISTING = contract(
    """
    listing_url string, scrape_id bigint, last_scraped string, source string, name string,
    description string, neighborhood_overview string, picture_url string, host_id bigint,
    host_url string, host_name string, host_since string, host_location string,
    host_about string, host_response_time string, host_response_rate string,
    host_acceptance_rate string, host_is_superhost string, host_thumbnail_url string,
    host_picture_url string, host_neighbourhood string, host_listings_count double,
    host_total_listings_count double, host_verifications string, host_has_profile_pic string,
    host_identity_verified string, neighbourhood string, neighbourhood_cleansed string,
    neighbourhood_group_cleansed double, latitude double, longitude double,
    property_type string, room_type string, accommodates bigint, bathrooms double,
    bathrooms_text string, bedrooms double, beds double, amenities string, price string,
    minimum_nights bigint, maximum_nights bigint, minimum_minimum_nights bigint,
    maximum_minimum_nights bigint, minimum_maximum_nights bigint,
    maximum_maximum_nights bigint, minimum_nights_avg_ntm double,
    maximum_nights_avg_ntm double, calendar_updated double, has_availability string,
    availability_30 bigint, availability_60 bigint, availability_90 bigint,
    availability_365 bigint, calendar_last_scraped string, number_of_reviews bigint,
    number_of_reviews_ltm bigint, number_of_reviews_l30d bigint, first_review string,
    last_review string, review_scores_rating double, review_scores_accuracy double,
    review_scores_cleanliness double, review_scores_checkin double,
    review_scores_communication double, review_scores_location double,
    review_scores_value double, license string, instant_bookable string,
    calculated_host_listings_count bigint, calculated_host_listings_count_entire_homes bigint,
    calculated_host_listings_count_private_rooms bigint,
    calculated_host_listings_count_shared_rooms bigint, reviews_per_month double
    """
)
CALENDAR = contract(
    """
    date string, available string, price string, adjusted_price string,
    minimum_nights bigint, maximum_nights bigint
    """
)
AGG_LISTING = contract(
    """
    name string, host_id bigint, host_name string, neighbourhood_group double,
    neighbourhood string, latitude double, longitude double, room_type string, price bigint,
    minimum_nights bigint, number_of_reviews bigint, last_review string,
    reviews_per_month double, calculated_host_listings_count bigint, availability_365 bigint,
    number_of_reviews_ltm bigint, license string
    """
)
# fixed values: the two fields every load adds
METADATA = StructType(
    [StructField("processing_datetime", TimestampType()), StructField("area", StringType())]
)


def with_metadata_fields(schema: StructType) -> StructType:
    """The contract extended by the load fields; the contract itself is left as it was."""
    return StructType(schema.fields + METADATA.fields)


def save_contract(spark: SparkSession, schema: StructType, path: str) -> None:
    """Write the contract as JSON text to any file system Spark can write to."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_contract(spark: SparkSession, path: str) -> StructType:
    import json

    text = spark.read.option("wholetext", "true").text(path).first()
    if text is None:
        raise ValueError(f"no contract at {path}")
    return StructType.fromJson(json.loads(text[0]))


def contract_diff(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per column that is missing, extra or of another type than the contract says."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = [(n, "missing", t, None) for n, t in want.items() if n not in have]
    rows += [(n, "extra", None, t) for n, t in have.items() if n not in want]
    rows += [(n, "mistyped", t, have[n]) for n, t in want.items() if n in have and have[n] != t]
    return df.sparkSession.createDataFrame(
        rows, "column string, issue string, expected string, actual string"
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame in contract order. Raises where a column is missing or extra; casts the types."""
    have, want = set(df.columns), set(schema.names)
    if have != want:
        raise ValueError(
            f"contract mismatch: missing {sorted(want - have)}, extra {sorted(have - want)}"
        )
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
