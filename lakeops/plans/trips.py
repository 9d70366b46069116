"""Taxi trips: raw to a checked view, silver, quarantine and gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.ids import row_id
from lakeops.functions.measure import avg_2dp, duration_min, reasons, sum_2dp
from lakeops.operators.regression import load_model, model_expr, score_window
from lakeops.sources.sinks import ensure_schema, replace_partitions, write_table
from lakeops.sources.tables import last_window_by_day, partition_values

# fixed values: model inputs and label
FEATURES = (
    "VendorID", "passenger_count", "trip_distance", "RatecodeID", "PULocationID", "DOLocationID",
    "trip_duration_min",
)
LABEL = "fare_amount"
PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def stamp_raw(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    return df.withColumn("_ingest_ts", F.current_timestamp() if at is None else F.lit(at))


def trip_rules(strict: bool = False) -> dict[str, Column]:
    """Reject reasons. The five default ones leave some unusable trips without a reason;
    ``strict`` names these too, so that accepted and rejected rows add up to the raw rows."""
    rules = {
        "NULL_PICKUP_TS": F.col(PICKUP).isNull(),
        "NULL_DROPOFF_TS": F.col(DROPOFF).isNull(),
        "NEG_DURATION": F.col(DROPOFF) < F.col(PICKUP),
        "NEG_DISTANCE": F.col("trip_distance") < 0,
        "NEG_TOTAL": F.col("total_amount") < 0,
    }
    if strict:
        rules["ZERO_DURATION"] = (F.col(DROPOFF) >= F.col(PICKUP)) & (duration_min(PICKUP, DROPOFF) <= 0)
        rules["NULL_DISTANCE"] = F.col("trip_distance").isNull()
        rules["NULL_TOTAL"] = F.col("total_amount").isNull()
    return rules


def dq_view(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed trips with pickup date and hour, duration, id and reject reasons."""
    stamp = ["_ingest_ts"] if "_ingest_ts" in raw.columns else []
    return raw.select(
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col(PICKUP).alias("pickup_ts"),
        F.col(DROPOFF).alias("dropoff_ts"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "trip_distance",
        F.col("PULocationID").cast("int").alias("pu_location_id"),
        F.col("DOLocationID").cast("int").alias("do_location_id"),
        F.col("payment_type").cast("int").alias("payment_type"),
        "total_amount",
        "tip_amount",
        F.to_date(PICKUP).alias("pickup_date"),
        F.hour(PICKUP).alias("pickup_hour"),
        duration_min(PICKUP, DROPOFF).alias("trip_duration_min"),
        row_id("VendorID", PICKUP, "PULocationID", "DOLocationID").alias("trip_id"),
        *stamp,
        reasons(trip_rules(strict)).alias("reject_reasons"),
    )


def is_silver() -> Column:
    """Holds for raw trips whose distance, total and duration are known and not negative."""
    return (F.col("trip_distance") >= 0) & (F.col("total_amount") >= 0) & (duration_min(PICKUP, DROPOFF) > 0)


def silver(raw: DataFrame) -> DataFrame:
    """Raw trips with a duration, those with a negative or unknown measure left out."""
    return raw.where(is_silver()).withColumn("trip_duration_min", duration_min(PICKUP, DROPOFF))


def daily(trips: DataFrame) -> DataFrame:
    """Trips, mean distance, mean total and revenue per pickup day."""
    return trips.groupBy(F.to_date(PICKUP).alias("pickup_date")).agg(
        F.count(F.lit(1)).alias("trips_cnt"),
        avg_2dp("trip_distance").alias("avg_trip_distance"),
        avg_2dp("total_amount").alias("avg_total_amount"),
        sum_2dp("total_amount").alias("total_revenue"),
    )


def trips_pipeline(
    spark: SparkSession, source: DataFrame, schema: str, at: dt.datetime | None = None, strict: bool = True
) -> None:
    """Write ``trips_raw``, ``trips_silver``, ``trips_quarantine`` and ``trips_gold``. Each layer
    reads the table written before it, so nothing is computed twice."""
    ensure_schema(spark, schema)
    write_table(stamp_raw(source, at), f"{schema}.trips_raw")
    raw = spark.table(f"{schema}.trips_raw")
    write_table(silver(raw), f"{schema}.trips_silver")
    bad = dq_view(raw, strict).where(F.size("reject_reasons") > 0)
    write_table(bad, f"{schema}.trips_quarantine")
    write_table(daily(spark.table(f"{schema}.trips_silver")), f"{schema}.trips_gold")


def score_and_store(
    spark: SparkSession, trips: DataFrame, model_path: str, target: str,
    features: Sequence[str] = FEATURES, ts: str = PICKUP, length: str = "1 day",
) -> None:
    """Load the model, score the newest slice of silver trips and replace its partition below
    ``target``. A repeated run replaces its own rows; other slices stay."""
    prediction = model_expr(load_model(model_path), features)
    replace_partitions(score_window(trips, prediction, ts, features, length), target, ["window_end"])


DAY = "pickup_day"


def store_by_day(trips: DataFrame, name: str) -> None:
    """Silver trips, partitioned by the day of pickup. A day is written by one task, so it is one file."""
    tasks = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_table(trips.withColumn(DAY, F.to_date(PICKUP)).repartition(tasks, DAY), name, partition_by=[DAY])


def score_newest_days(
    spark: SparkSession, name: str, prediction: Column, features: Sequence[str] = FEATURES, days: int = 1
) -> DataFrame:
    """``score_window`` of a table that ``store_by_day`` has written; only the partitions of the window are read."""
    newest = last_window_by_day(spark, name, PICKUP, DAY, days)
    days_read = partition_values(spark, name, DAY)[-1:]
    end = spark.table(name).where(F.col(DAY).isin([dt.date.fromisoformat(d) for d in days_read])).agg(F.max(PICKUP)).scalar()
    return newest.select(*features, PICKUP, prediction.alias("prediction"), end.cast("string").alias("window_end"))


# Gold marts over silver trips. Each is one grouped aggregate.


def _hour() -> Column:
    return F.hour(PICKUP).alias("pickup_hour")


def payment_mix(trips: DataFrame) -> DataFrame:
    """Trips, revenue and share of trips per payment type."""
    types = trips.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips_cnt"), sum_2dp("total_amount").alias("revenue")
    )
    total = trips.agg(F.count(F.lit(1))).scalar()
    return types.withColumn("trip_share", F.col("trips_cnt") / total)


def peak_hours(trips: DataFrame) -> DataFrame:
    return trips.groupBy(_hour()).agg(
        F.count(F.lit(1)).alias("trips_cnt"), avg_2dp("total_amount").alias("avg_total_amount")
    )


def revenue_daily(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.to_date(PICKUP).alias("pickup_date")).agg(
        F.count(F.lit(1)).alias("trips_cnt"), sum_2dp("total_amount").alias("revenue")
    )


def tips_by_hour_zone(trips: DataFrame) -> DataFrame:
    return trips.groupBy(_hour(), "PULocationID").agg(
        F.count(F.lit(1)).alias("trips_cnt"),
        sum_2dp("tip_amount").alias("tips"),
        avg_2dp("tip_amount").alias("avg_tip"),
    )


def top_pickup_zones(trips: DataFrame, k: int = 10) -> DataFrame:
    zones = trips.groupBy("PULocationID").agg(
        F.count(F.lit(1)).alias("trips_cnt"), sum_2dp("total_amount").alias("revenue")
    )
    return zones.orderBy(F.desc("trips_cnt"), "PULocationID").limit(k)


def length_segments(trips: DataFrame, edges: Sequence[float] = (2, 10)) -> DataFrame:
    """Short, medium and long trips by distance."""
    short, long = edges
    segment = F.when(F.col("trip_distance") < short, "short").when(
        F.col("trip_distance") < long, "medium"
    ).otherwise("long")
    return trips.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("trips_cnt"),
        avg_2dp("trip_distance").alias("avg_trip_distance"),
        avg_2dp("total_amount").alias("avg_total_amount"),
    )


def trips_by_zone(trips: DataFrame) -> DataFrame:
    return trips.groupBy("PULocationID", "DOLocationID").agg(
        F.count(F.lit(1)).alias("trips_cnt"), sum_2dp("total_amount").alias("revenue")
    )
