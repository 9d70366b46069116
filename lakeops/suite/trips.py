"""Trip layers, quality and gold marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.ids import row_id
from lakeops.operators import profile, reconcile, rejects
from lakeops.operators.aggregate import histogram
from lakeops.plans import trips as plan
from lakeops.suite import standins
from lakeops.suite.registry import avg2, query, sum2
from lakeops.suite.standins import joined, with_ctes

RAW, SILVER = with_ctes("trips"), with_ctes("silver")
PICKUP, DROPOFF = plan.PICKUP, plan.DROPOFF
REASONS = f"""list_filter([
    CASE WHEN {PICKUP} IS NULL THEN 'NULL_PICKUP_TS' END,
    CASE WHEN {DROPOFF} IS NULL THEN 'NULL_DROPOFF_TS' END,
    CASE WHEN {DROPOFF} < {PICKUP} THEN 'NEG_DURATION' END,
    CASE WHEN trip_distance < 0 THEN 'NEG_DISTANCE' END,
    CASE WHEN total_amount < 0 THEN 'NEG_TOTAL' END], lambda x: x IS NOT NULL)"""
STRICT = f"""(({PICKUP} IS NULL) OR ({DROPOFF} IS NULL) OR ({DROPOFF} <= {PICKUP})
    OR (trip_distance IS NULL) OR (trip_distance < 0) OR (total_amount IS NULL) OR (total_amount < 0))"""
TRIP_ID = f"""sha256(concat_ws('||', CAST(VendorID AS VARCHAR), CAST({PICKUP} AS VARCHAR),
    CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR)))"""
VIEW = f"""SELECT VendorID AS vendor_id, {PICKUP} AS pickup_ts, {DROPOFF} AS dropoff_ts, passenger_count,
    trip_distance, PULocationID AS pu_location_id, DOLocationID AS do_location_id, payment_type,
    total_amount, tip_amount, CAST({PICKUP} AS DATE) AS pickup_date,
    CAST(hour({PICKUP}) AS INT) AS pickup_hour,
    (epoch({DROPOFF}) - epoch({PICKUP})) / 60e0 AS trip_duration_min,
    {TRIP_ID} AS trip_id, array_to_string({REASONS}, ',') AS reject_reasons FROM trips"""


@query(f"{RAW} {VIEW}")
def trips_dq_view(spark, sf):
    return plan.dq_view(standins.trips(spark, sf)).withColumn("reject_reasons", joined("reject_reasons"))


@query(f"{RAW} SELECT * FROM ({VIEW}) WHERE reject_reasons <> ''")
def trips_quarantine(spark, sf):
    bad = rejects.quarantine(plan.dq_view(standins.trips(spark, sf)))
    return bad.withColumn("reject_reasons", joined("reject_reasons"))


@query(f"{RAW} SELECT reason, count(*) AS cnt FROM (SELECT unnest({REASONS}) AS reason FROM trips) GROUP BY 1")
def trips_reject_reasons(spark, sf):
    return rejects.reason_counts(plan.dq_view(standins.trips(spark, sf)))


@query(
    f"""{RAW} SELECT count(*) AS raw_rows, count(*) - count(CASE WHEN {STRICT} THEN 1 END) AS accepted_rows,
    count(CASE WHEN {STRICT} THEN 1 END) AS rejected_rows,
    count(CASE WHEN {STRICT} THEN 1 END) / count(*) AS reject_ratio FROM trips"""
)
def dq_run_metrics(spark, sf):
    return rejects.run_metrics(plan.dq_view(standins.trips(spark, sf), strict=True))


NUMERIC = ("trip_distance", "total_amount", "tip_amount", "passenger_count")


@query(
    RAW
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS cnt, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
        CAST(max({c}) AS DOUBLE) AS max FROM trips"""
        for c in NUMERIC
    )
)
def dq_numeric_stats(spark, sf):
    stats = profile.numeric_stats(standins.trips(spark, sf), NUMERIC)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    f"""{RAW} SELECT VendorID, {PICKUP}, PULocationID, DOLocationID, {TRIP_ID} AS trip_id,
    sha256(concat_ws('||', coalesce(CAST(VendorID AS VARCHAR), '∅'), coalesce(CAST({PICKUP} AS VARCHAR), '∅'),
      coalesce(CAST(PULocationID AS VARCHAR), '∅'), coalesce(CAST(DOLocationID AS VARCHAR), '∅')))
      AS null_safe_id FROM trips"""
)
def trip_id(spark, sf):
    parts = ["VendorID", PICKUP, "PULocationID", "DOLocationID"]
    return standins.trips(spark, sf).select(
        *parts, row_id(*parts).alias("trip_id"), row_id(*parts, null_safe=True).alias("null_safe_id")
    )


@query(f"{SILVER} SELECT * FROM silver")
def trips_silver(spark, sf):
    return standins.silver_trips(spark, sf)


@query(f"{SILVER} SELECT (SELECT count(*) FROM trips) AS bronze_cnt, (SELECT count(*) FROM silver) AS silver_cnt")
def layer_counts(spark, sf):
    return reconcile.filtered_counts(standins.trips(spark, sf), bronze=F.lit(True), silver=plan.is_silver())


@query(
    f"""{SILVER} SELECT CAST({PICKUP} AS DATE) AS pickup_date, count(*) AS trips_cnt,
    {avg2("trip_distance")} AS avg_trip_distance, {avg2("total_amount")} AS avg_total_amount,
    {sum2("total_amount")} AS total_revenue FROM silver GROUP BY 1"""
)
def trips_gold_daily(spark, sf):
    return plan.daily(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER}, binned AS (SELECT least(CAST(floor(least(greatest(fare_amount, 0e0), 200e0)
      / {200 / 60!r}) AS BIGINT), 59) AS bin FROM silver WHERE fare_amount IS NOT NULL)
    SELECT bin, count(*) AS cnt, bin * {200 / 60!r}e0 AS bin_start FROM binned GROUP BY bin"""
)
def fare_histogram(spark, sf):
    return histogram(standins.silver_trips(spark, sf), "fare_amount", 0, 200, 60)


@query(
    f"""{SILVER} SELECT payment_type, count(*) AS trips_cnt, {sum2("total_amount")} AS revenue,
    count(*) / (SELECT count(*) FROM silver) AS trip_share FROM silver GROUP BY 1"""
)
def gold_payment_mix(spark, sf):
    return plan.payment_mix(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT CAST(hour({PICKUP}) AS INT) AS pickup_hour, count(*) AS trips_cnt,
    {avg2("total_amount")} AS avg_total_amount FROM silver GROUP BY 1"""
)
def gold_peak_hours(spark, sf):
    return plan.peak_hours(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT CAST({PICKUP} AS DATE) AS pickup_date, count(*) AS trips_cnt,
    {sum2("total_amount")} AS revenue FROM silver GROUP BY 1"""
)
def gold_revenue_daily(spark, sf):
    return plan.revenue_daily(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT CAST(hour({PICKUP}) AS INT) AS pickup_hour, PULocationID, count(*) AS trips_cnt,
    {sum2("tip_amount")} AS tips, {avg2("tip_amount")} AS avg_tip FROM silver GROUP BY 1, 2"""
)
def gold_tips_hour_zone(spark, sf):
    return plan.tips_by_hour_zone(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT PULocationID, count(*) AS trips_cnt, {sum2("total_amount")} AS revenue
    FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
)
def gold_top_pickup(spark, sf):
    return plan.top_pickup_zones(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 10 THEN 'medium'
      ELSE 'long' END AS segment, count(*) AS trips_cnt, {avg2("trip_distance")} AS avg_trip_distance,
    {avg2("total_amount")} AS avg_total_amount FROM silver GROUP BY 1"""
)
def gold_length_segments(spark, sf):
    return plan.length_segments(standins.silver_trips(spark, sf))


@query(
    f"""{SILVER} SELECT PULocationID, DOLocationID, count(*) AS trips_cnt, {sum2("total_amount")} AS revenue
    FROM silver GROUP BY 1, 2"""
)
def gold_trips_zone(spark, sf):
    return plan.trips_by_zone(standins.silver_trips(spark, sf))
