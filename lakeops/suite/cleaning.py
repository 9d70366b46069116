"""Parsing, filters, deduplication, imputation, samples and places, over the stand-in listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeops.functions import parse
from lakeops.operators import aggregate, columns, geo, rows, sample
from lakeops.operators.impute import impute
from lakeops.operators.rejects import reason_counts
from lakeops.operators.sample import sample_k, with_split
from lakeops.plans import city, listings, trips
from lakeops.sources.tables import read_parquet
from lakeops.suite import standins
from lakeops.suite.registry import bucket, dollars, money, query
from lakeops.suite.standins import joined, with_ctes

LISTED = with_ctes("listings")
AT = dt.datetime(2025, 1, 2, 3, 4, 5)
FEATURES = list(trips.FEATURES)


@query(
    f"""{LISTED} SELECT host_id, host_is_superhost, latitude, longitude, room_type, bathrooms_text,
    amenities, price, minimum_nights, number_of_reviews, review_scores_rating, instant_bookable
    FROM listings"""
)
def keep_columns(spark, sf):
    df = standins.listings(spark, sf)
    return columns.keep(df, [c for c in listings.KEEP if c in df.columns])


@query(f"{with_ctes('priced')} SELECT id, occ_rate_365 FROM priced")
def occ_rate_365(spark, sf):
    return columns.with_occupancy(standins.listings(spark, sf)).select("id", "occ_rate_365")


@query(
    f"""{with_ctes("silver")} SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)}
    FROM silver"""
)
def cast_features(spark, sf):
    return columns.cast_all(standins.silver_trips(spark, sf).select(*FEATURES), FEATURES)


@query(f"{LISTED} SELECT id, {dollars('price')} AS price FROM listings WHERE {dollars('price')} < 10000")
def price_cap(spark, sf):
    typed = standins.listings(spark, sf).select("id", parse.price_to_double("price").alias("price"))
    return rows.split_outliers(typed, "price", listings.MAX_PRICE)[0]


@query(f"{LISTED} SELECT id, minimum_nights FROM listings WHERE minimum_nights <= 90")
def min_nights_cap(spark, sf):
    nights = standins.listings(spark, sf).select("id", "minimum_nights")
    return nights.where(F.col("minimum_nights") <= listings.MAX_MINIMUM_NIGHTS)


@query(
    f"""{LISTED} SELECT city, count(CASE WHEN p < 10000 THEN 1 END) AS kept,
      count(CASE WHEN p >= 10000 THEN 1 END) AS extreme, count(*) - count(p) AS null_rows
    FROM (SELECT city, {dollars("price")} AS p FROM listings) GROUP BY city"""
)
def outlier_counts(spark, sf):
    typed = standins.listings(spark, sf).withColumn("price", parse.price_to_double("price"))
    return rows.outlier_counts(typed, "price", listings.MAX_PRICE, ["city"])


@query(
    f"""{LISTED} SELECT id, try_cast(digits AS DOUBLE) AS clean_price
    FROM (SELECT id, price, regexp_replace(price, '[$,]', '', 'g') AS digits FROM listings)
    WHERE trim(price) <> '' AND regexp_matches(digits, '^[0-9]+$')
      AND try_cast(digits AS DOUBLE) BETWEEN 10 AND 1000"""
)
def clean_price(spark, sf):
    return rows.whole_prices(standins.listings(spark, sf)).select("id", "clean_price")


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_partkey % 3 = 0)")
def dedupe_rows(spark, sf):
    """Whole rows; a third of them lies there twice, loaded at another time."""
    lines = read_parquet(spark, sf, "lineitem")
    again = lines.where(F.col("l_partkey") % 3 == 0)
    both = columns.add_load_timestamp(lines, AT).union(columns.add_load_timestamp(again, AT + dt.timedelta(days=1)))
    return rows.dedupe(both).drop("load_timestamp")


@query(f"""{with_ctes("listings", "sparse")} SELECT * FROM sparse WHERE id IS NOT NULL""")
def drop_all_null(spark, sf):
    return rows.drop_all_null(columns.add_load_timestamp(standins.sparse(spark, sf), AT)).drop("load_timestamp")


@query(
    """SELECT * FROM (SELECT CASE WHEN l_orderkey % 13 <> 0 THEN l_orderkey END AS listing_id,
      l_linenumber AS stars FROM lineitem) WHERE listing_id IS NOT NULL"""
)
def drop_null_key(spark, sf):
    """Reviews without an ``id``: every thirteenth listing id is a null, set here."""
    reviews = read_parquet(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 13 != 0, F.col("l_orderkey")).alias("listing_id"),
        F.col("l_linenumber").alias("stars"),
    )
    return rows.drop_null_key(reviews, "berlin_reviews")


@query(
    f"""{with_ctes("trips")} SELECT * FROM trips
    WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
      AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL"""
)
def drop_null_features(spark, sf):
    return rows.drop_null(
        standins.trips(spark, sf),
        ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"],
    )


@query(f"{LISTED} SELECT id, {dollars('price')} AS price FROM listings")
def price_to_double(spark, sf):
    return standins.listings(spark, sf).select("id", parse.price_to_double("price").alias("price"))


@query(
    f"""WITH balances AS (SELECT o_orderkey AS id, concat(CASE WHEN o_orderkey % 3 = 0 THEN '-$' ELSE '$' END,
      CAST(o_orderkey % 400 AS VARCHAR), '.50') AS balance FROM orders)
    SELECT id, {money("balance")} AS plain,
      CASE WHEN balance LIKE '-%' THEN -1 ELSE 1 END * {money("balance")} AS signed FROM balances"""
)
def parse_money(spark, sf):
    """Money texts, a third of them negative: without and with the sign."""
    sign = F.when(F.col("o_orderkey") % 3 == 0, "-$").otherwise("$")
    balance = F.concat(sign, (F.col("o_orderkey") % 400).cast("string"), F.lit(".50"))
    return read_parquet(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        parse.parse_money(balance).alias("plain"),
        parse.parse_money_signed(balance).alias("signed"),
    )


@query(
    f"""{LISTED} SELECT id, host_is_superhost = 't' AS host_is_superhost,
    instant_bookable = 't' AS instant_bookable FROM listings"""
)
def tf_equal(spark, sf):
    flags = ["host_is_superhost", "instant_bookable"]
    return standins.listings(spark, sf).select("id", *[parse.tf_equal(c).alias(c) for c in flags])


@query(
    f"""{LISTED} SELECT id,
      CASE lower(host_is_superhost) WHEN 't' THEN true WHEN 'f' THEN false END AS host_is_superhost,
      CASE lower(instant_bookable) WHEN 't' THEN true WHEN 'f' THEN false END AS instant_bookable
    FROM listings"""
)
def tf_three_way(spark, sf):
    flags = ["host_is_superhost", "instant_bookable"]
    return standins.listings(spark, sf).select("id", *[parse.tf_bool(c).alias(c) for c in flags])


@query(
    f"""{LISTED} SELECT id, coalesce(try_cast(split_part(bathrooms_text, ' ', 1) AS DOUBLE),
      CASE WHEN contains(lower(bathrooms_text), 'half-bath') THEN 0.5e0 END) AS bathrooms FROM listings"""
)
def bathrooms_fix(spark, sf):
    return listings.fix_bathrooms(standins.listings(spark, sf).select("id", "bathrooms_text"))


@query(
    f"""{LISTED} SELECT lower(item) AS item, count(*) AS cnt FROM (
      SELECT unnest(string_split(translate(amenities, '[]"\\', ''), ',')) AS item FROM listings)
    GROUP BY 1"""
)
def amenity_counts(spark, sf):
    return aggregate.item_counts(standins.listings(spark, sf), listings.amenity_items())


@query(
    f"""{LISTED} SELECT lower(trim(item)) AS item, count(*) AS cnt FROM (
      SELECT unnest(string_split(translate(amenities, '[]"\\', ''), ',')) AS item FROM listings)
    WHERE trim(item) <> '' GROUP BY 1"""
)
def amenity_counts_trimmed(spark, sf):
    return aggregate.item_counts(standins.listings(spark, sf), listings.amenity_items(True, True))


@query(f"{LISTED} SELECT minimum_nights, count(*) AS cnt FROM listings GROUP BY 1")
def min_nights_counts(spark, sf):
    return aggregate.value_counts(standins.listings(spark, sf), "minimum_nights")


@query(f"{LISTED} SELECT number_of_reviews, count(*) AS cnt FROM listings GROUP BY 1")
def reviews_distribution(spark, sf):
    return aggregate.value_counts(standins.listings(spark, sf), "number_of_reviews")


@query(f"{with_ctes('days')} SELECT listing_id, date FROM days")
def to_date_cols(spark, sf):
    return standins.calendar(spark, sf).select("listing_id", parse.safe_date("date").alias("date"))


@query(
    f"""{with_ctes("calendar")} SELECT listing_id, city, try_cast(date AS DATE) AS date, available
    FROM (SELECT DISTINCT * FROM calendar)"""
)
def silver_clean(spark, sf):
    """Bronze to silver of a calendar: distinct rows, then typed dates."""
    stamped = columns.add_load_timestamp(standins.calendar(spark, sf), AT)
    return city.clean("berlin_calendar", stamped).drop("load_timestamp")


@query(
    f"""{LISTED} SELECT host_id, host_is_superhost = 't' AS host_is_superhost, latitude, longitude,
      room_type, bathrooms_text, replace(translate(amenities, '[]"\\', ''), ', ', ', ') AS amenities,
      {dollars("price")} AS price, minimum_nights, number_of_reviews, review_scores_rating,
      instant_bookable = 't' AS instant_bookable
    FROM listings WHERE {dollars("price")} < 10000 AND minimum_nights <= 90"""
)
def listings_clean(spark, sf):
    return listings.clean_listings(standins.listings(spark, sf)).withColumn("amenities", joined("amenities"))


@query(
    f"""{LISTED}, typed AS (SELECT *, {dollars("price")} AS p FROM listings), reasons AS (
      SELECT unnest([CASE WHEN p IS NULL THEN 'NULL_PRICE' END,
        CASE WHEN p >= 10000 THEN 'EXTREME_PRICE' END, CASE WHEN p <= 0 THEN 'ZERO_PRICE' END,
        CASE WHEN minimum_nights > 90 THEN 'LONG_MINIMUM_STAY' END,
        CASE WHEN neighbourhood_cleansed IS NULL THEN 'NULL_NEIGHBOURHOOD' END,
        CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'NULL_LOCATION' END,
        CASE WHEN NOT review_scores_rating BETWEEN 0 AND 5 THEN 'RATING_OUT_OF_RANGE' END]) AS reason
      FROM typed)
    SELECT reason, count(*) AS cnt FROM reasons WHERE reason IS NOT NULL GROUP BY 1"""
)
def listing_reject_reasons(spark, sf):
    return reason_counts(listings.validate_listings(standins.listings(spark, sf)), "invalid_reasons")


@query(
    f"""{with_ctes("priced")} SELECT id,
      price_num IS NULL AS price_num_imputed,
      coalesce(price_num, (SELECT median(price_num) FROM priced)) AS price_num,
      review_scores_rating IS NULL AS review_scores_rating_imputed,
      round(coalesce(review_scores_rating, (SELECT avg(review_scores_rating) FROM priced)), 9)
        AS review_scores_rating,
      neighbourhood_cleansed IS NULL AS neighbourhood_cleansed_imputed,
      coalesce(neighbourhood_cleansed, 'Unknown') AS neighbourhood_cleansed,
      host_is_superhost IS NULL AS host_is_superhost_imputed,
      coalesce(host_is_superhost, (SELECT host_is_superhost FROM priced
        WHERE host_is_superhost IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
        AS host_is_superhost
    FROM priced"""
)
def impute_flags(spark, sf):
    rules = {
        "price_num": "median",
        "review_scores_rating": "mean",
        "neighbourhood_cleansed": "category:Unknown",
        "host_is_superhost": "mode",
    }
    listed = standins.priced(spark, sf).select("id", *rules)
    filled = impute(listed, rules, exact=True)
    return filled.withColumn("review_scores_rating", F.round("review_scores_rating", 9))


@query(
    f"""SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY {bucket("CAST(o_orderkey AS VARCHAR)")}, o_orderkey LIMIT 2000"""
)
def hash_sample(spark, sf):
    return sample_k(read_parquet(spark, sf, "orders"), ["o_orderkey"], 2000).select("o_orderkey", "o_totalprice")


@query(
    f"""SELECT CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split,
      count(*) AS cnt
    FROM (SELECT {bucket("CAST(o_orderkey AS VARCHAR)")} % 100 AS b FROM orders) GROUP BY 1"""
)
def hash_split_counts(spark, sf):
    return aggregate.value_counts(with_split(read_parquet(spark, sf, "orders"), ["o_orderkey"]), "split")


@query(
    """SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
      AND ts < (SELECT max(ts) FROM events)"""
)
def last_day_window(spark, sf):
    return rows.last_window(read_parquet(spark, sf, "events"), "ts", "1 day")


@query(f"{LISTED} SELECT price, latitude, longitude FROM listings ORDER BY id LIMIT 30")
def geo_points(spark, sf):
    return geo.geo_points(standins.listings(spark, sf), 30)


@query(
    f"""{with_ctes("priced")} SELECT CAST(floor(latitude * 100) AS BIGINT) AS cell_lat,
      CAST(floor(longitude * 100) AS BIGINT) AS cell_lon, count(*) AS cnt,
      round(avg(latitude), 6) AS lat, round(avg(longitude), 6) AS lon,
      round(avg(price_num), 6) AS avg_price
    FROM priced GROUP BY 1, 2"""
)
def geo_grid(spark, sf):
    cells = geo.geo_grid(standins.priced(spark, sf), 100)
    return cells.withColumns({c: F.round(c, 6) for c in ("lat", "lon", "avg_price")})
