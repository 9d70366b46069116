"""Listings, calendars and trips as projections of the given tables, over all their rows.

The texts are valid on Spark and on the engine that checks the results, so both sides start from
the same rows. Nulls, bad texts and odd values are set by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.columns import with_occupancy, with_price
from lakeops.plans.trips import silver
from lakeops.sources.tables import read_parquet
from lakeops.suite.registry import money

LISTINGS = """
SELECT o_orderkey AS id, o_custkey AS host_id,
  CASE WHEN o_custkey % 2 = 0 THEN 'Berlin' ELSE 'Stock' END AS city,
  o_custkey % 2 = 0 AS is_berlin,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL
       WHEN o_orderkey % 53 = 0 THEN ''
       WHEN o_orderkey % 97 = 0 THEN '$12,000.00'
       WHEN o_orderkey % 10 = 0 THEN concat('$1,', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '.00')
       WHEN o_orderkey % 7 = 0 THEN concat('$', CAST(o_orderkey % 400 AS STRING))
       ELSE concat('$', CAST(o_orderkey % 400 AS STRING), '.00') END AS price,
  CAST(o_orderkey % 366 AS BIGINT) AS availability_365,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE n_name END AS neighbourhood_cleansed,
  37.9e0 + CAST(o_orderkey % 100 AS DOUBLE) / 1000e0 AS latitude,
  23.7e0 + CAST(o_custkey % 100 AS DOUBLE) / 1000e0 AS longitude,
  o_orderpriority AS room_type,
  CAST(o_orderkey % 120 + 1 AS BIGINT) AS minimum_nights,
  CAST(o_orderkey % 37 AS BIGINT) AS number_of_reviews,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DOUBLE) / 20e0 END
    AS review_scores_rating,
  CASE o_orderkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' END AS host_is_superhost,
  CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'F' END AS instant_bookable,
  CASE o_orderkey % 5 WHEN 0 THEN 'Half-bath' WHEN 1 THEN '1 bath' WHEN 2 THEN '1.5 shared baths'
    WHEN 3 THEN '2 baths' END AS bathrooms_text,
  CASE o_orderkey % 3 WHEN 0 THEN '["Wifi", "Kitchen"]' WHEN 1 THEN '["wifi", "TV", "Pool"]'
    ELSE '[]' END AS amenities,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS last_scraped
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

CALENDAR = """
SELECT l_orderkey AS listing_id,
  CASE WHEN l_suppkey % 2 = 0 THEN 'Berlin' ELSE 'Stock' END AS city,
  CASE WHEN l_partkey % 89 = 0 THEN 'not-a-date' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date,
  CASE WHEN l_partkey % 25 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 't' ELSE 'f' END AS available
FROM {lineitem}
"""

TRIPS = """
SELECT l_linenumber AS VendorID,
  CASE WHEN l_partkey % 61 = 0 THEN NULL
       ELSE o_orderdate + INTERVAL '1' HOUR * (l_partkey % 24) END AS tpep_pickup_datetime,
  CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE l_shipdate END AS tpep_dropoff_datetime,
  CAST(l_quantity AS INT) % 6 AS passenger_count,
  (CASE WHEN l_partkey % 40 = 0 THEN -l_quantity ELSE l_quantity END) * 0.3183098861837907e0 AS trip_distance,
  l_linenumber % 6 + 1 AS RatecodeID,
  CAST(l_partkey % 263 + 1 AS INT) AS PULocationID,
  CAST(l_suppkey % 263 + 1 AS INT) AS DOLocationID,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS payment_type,
  l_extendedprice * (1 - l_discount) / 517.3e0 AS fare_amount,
  (CASE WHEN l_partkey % 45 = 1 THEN -l_extendedprice ELSE l_extendedprice END) / 437.9e0 AS total_amount,
  l_tax * 18.31563888734179e0 AS tip_amount
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

NAMES = {t: t for t in ("orders", "customer", "nation", "lineitem")}

# The same derived tables in SQL, as leading common table expressions.
CTES = {
    "listings": LISTINGS.format(**NAMES),
    "calendar": CALENDAR.format(**NAMES),
    "trips": TRIPS.format(**NAMES),
    "priced": f"""
        SELECT *, {money("price")} AS price_num,
          1e0 - CAST(availability_365 AS DOUBLE) / 365e0 AS occ_rate_365
        FROM listings""",
    "sparse": """
        SELECT """ + ", ".join(
        f"CASE WHEN id % 31 <> 0 THEN {c} END AS {c}"
        for c in (
            "id host_id city is_berlin price availability_365 neighbourhood_cleansed latitude longitude room_type "
            "minimum_nights number_of_reviews review_scores_rating host_is_superhost instant_bookable bathrooms_text "
            "amenities last_scraped"
        ).split()
    ) + " FROM listings",
    "days": """
        SELECT listing_id, city, try_cast(date AS DATE) AS date,
          CASE lower(available) WHEN 't' THEN true WHEN 'f' THEN false END AS available
        FROM calendar""",
    "months": """
        SELECT city, CAST(date_trunc('month', date) AS DATE) AS month,
          avg(CASE WHEN available = false THEN 1 ELSE 0 END) AS occ_rate_month
        FROM days GROUP BY 1, 2""",
    "silver": """
        SELECT * FROM (
          SELECT *, (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60e0 AS trip_duration_min
          FROM trips)
        WHERE trip_distance >= 0 AND total_amount >= 0 AND trip_duration_min > 0""",
}
NEEDS = {
    "priced": ("listings",), "sparse": ("listings",), "days": ("calendar",), "months": ("days",), "silver": ("trips",),
}


def with_ctes(*names: str) -> str:
    """``WITH a AS (..), b AS (..)`` for the names and what they are built on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order) + "\n"


def tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: read_parquet(spark, sf, n) for n in names}


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LISTINGS, **tables(spark, sf, "orders", "customer", "nation"))


def sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Listings of which every thirty-first row is empty."""
    rows = listings(spark, sf)
    return rows.select(*[F.when(F.col("id") % 31 != 0, F.col(c)).alias(c) for c in rows.columns])


def priced(spark: SparkSession, sf: str) -> DataFrame:
    """Listings with numeric price and yearly occupancy."""
    return with_occupancy(with_price(listings(spark, sf)))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(CALENDAR, **tables(spark, sf, "lineitem"))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(TRIPS, **tables(spark, sf, "lineitem", "orders"))


def silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return silver(trips(spark, sf))


def joined(col: str):
    """An array column as one text, for comparison by value."""
    return F.concat_ws(",", col).alias(col)


#: Rank error of a sketch of accuracy 10,000, and of the position that it rounds to.
SKETCH_ERROR = 1e-4


def rank_fits(value: str, found: str, p: float):
    """Does ``found`` lie among the ranks that a sketch may give for quantile ``p`` of ``value``."""
    n = F.count(value)
    below, upto = F.count_if(F.col(value) < F.col(found)), F.count_if(F.col(value) <= F.col(found))
    return (below - 1 <= (p + SKETCH_ERROR) * n) & (upto + 1 >= (p - SKETCH_ERROR) * n)
