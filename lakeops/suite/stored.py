"""Queries over tables that they first store: replacement, loads, counts by the write, buckets, days, sketches.

Each makes a database of its own below the shared scratch folder and goes through the library's sinks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators import geo, sketches
from lakeops.operators import regression as reg
from lakeops.operators.combine import union_all
from lakeops.plans import star, trips
from lakeops.session import scratch_path
from lakeops.sources import loads, sinks
from lakeops.sources.files import read_csv_checked
from lakeops.sources.tables import read_parquet
from lakeops.suite import standins
from lakeops.suite.models import COEFS, FEATURES, INTERCEPT, PREDICTION
from lakeops.suite.registry import query
from lakeops.suite.standins import with_ctes

AT = dt.datetime(2025, 1, 2, 3, 4, 5)
AT_SQL = "TIMESTAMP '2025-01-02 03:04:05'"
STAR = ("customer", "orders", "lineitem", "supplier", "part", "nation", "region")


def database(spark: SparkSession) -> str:
    name = f"lakeops_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


def stored_layer(spark: SparkSession, sf: str, tables=STAR) -> str:
    """A database with the star tables as they are."""
    name = database(spark)
    for t in tables:
        sinks.write_table(read_parquet(spark, sf, t), f"{name}.{t}")
    return name


@query("SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def replace_in_place(spark, sf) -> DataFrame:
    """A replacement that fails and leaves the rows, then two that read the table they replace."""
    name = f"{database(spark)}.orders"
    orders = read_parquet(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.write_table(orders, name)
    broken = F.when(F.col("o_orderstatus") == "P", F.raise_error("a row that cannot be written").cast("double"))
    try:
        sinks.write_table(orders.withColumn("o_totalprice", broken.otherwise(F.col("o_totalprice"))), name)
    except Exception as error:
        if "a row that cannot be written" not in str(error):
            raise
    sinks.write_table(spark.table(name).where("o_orderstatus <> 'P'"), name)
    sinks.write_table(spark.table(name).withColumn("o_totalprice", F.col("o_totalprice") + 1), name)
    return spark.table(name)


BROKEN = """CASE WHEN p_partkey % 10 = 0 THEN 'too_few_fields' WHEN p_partkey % 11 = 0 THEN 'too_many_fields'
  WHEN p_partkey % 13 = 0 THEN 'unclosed_quote' WHEN p_partkey % 17 = 0 THEN 'bad_value:p_size' END"""


@query(
    f"""SELECT coalesce({BROKEN}, 'good') AS reason, count(*) AS row_count, CAST(sum(p_partkey) AS BIGINT) AS keys,
    CAST(sum(CASE WHEN {BROKEN} IS NULL THEN p_size END) AS BIGINT) AS sizes, true AS whole FROM part GROUP BY 1"""
)
def csv_quarantine(spark, sf):
    """Parts as CSV with short, long and broken rows: good rows and quarantined ones, by reason."""
    part = read_parquet(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.expr(BROKEN).alias("fault"))
    quoted = F.concat(F.lit('"'), F.replace("p_name", F.lit('"'), F.lit('""')))
    size = F.when(F.col("fault") == "bad_value:p_size", F.lit("many")).otherwise(F.col("p_size").cast("string"))
    line = (
        F.when(F.col("fault") == "too_few_fields", F.concat_ws(",", "p_partkey", F.concat(quoted, F.lit('"'))))
        .when(F.col("fault") == "too_many_fields", F.concat_ws(",", "p_partkey", F.concat(quoted, F.lit('"')), size, F.lit("more")))
        .when(F.col("fault") == "unclosed_quote", F.concat_ws(",", "p_partkey", quoted, size))
        .otherwise(F.concat_ws(",", "p_partkey", F.concat(quoted, F.lit('"')), size))
    )
    files, path = 4, scratch_path(spark, "broken-csv")
    heads = spark.range(files).select("id", F.lit(0).alias("place"), F.lit("p_partkey,p_name,p_size").alias("line"))
    body = part.select((F.col("p_partkey") % files).alias("id"), F.lit(1).alias("place"), line.alias("line"))
    lines = heads.unionByName(body).repartition(files, "id").sortWithinPartitions("id", "place")
    lines.select("id", "line").write.partitionBy("id").text(path)
    contract = StructType.fromDDL("p_partkey bigint, p_size bigint")
    good, bad = read_csv_checked(spark, f"{path}/*", contract, multi_line=False, strict=True)
    key = F.coalesce(F.get_json_object("record", "$.p_partkey"), F.split("record", ",")[0]).cast("bigint")
    whole = F.col("file").isNotNull() & (F.length("record") > 0)
    rows = good.select(F.lit("good").alias("reason"), F.col("p_partkey").alias("key"), F.col("p_size").alias("size"), F.lit(True).alias("whole"))
    rows = rows.unionByName(bad.select("reason", key.alias("key"), F.lit(None).cast("bigint").alias("size"), whole.alias("whole")))
    return rows.groupBy("reason").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("key").alias("keys"), F.sum("size").alias("sizes"), F.bool_and("whole").alias("whole")
    )


@query(
    " UNION ALL ".join(
        f"SELECT {AT_SQL} AS run_timestamp, '{t}' AS table_name, count(*) AS bronze_count, count(*) AS silver_count, "
        f"CAST(0 AS BIGINT) AS diff, 'OK' AS status, 'day 1' AS load_id FROM {t}" for t in STAR
    )
)
def dq_log_by_write(spark, sf):
    """The quality log of a silver load that is run twice: counts come from the writes, one row a table."""
    bronze, silver, monitoring = stored_layer(spark, sf), database(spark), database(spark)
    for _ in range(2):
        star.to_silver_logged(spark, bronze, silver, monitoring, "day 1", AT, STAR)
    log = spark.table(f"{monitoring}.data_quality_loads")
    return log.withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


@query("SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'second' ELSE 'first' END AS load_id FROM customer")
def feed_loaded_twice(spark, sf):
    """Two loads of one feed that overlap, the first one twice: every row once, with the load that brought it."""
    name, customer = f"{database(spark)}.customer", read_parquet(spark, sf, "customer")
    first = customer.where("c_custkey % 3 <> 0")
    loads.append_new(union_all([first, first]), name, "first")
    loads.append_new(first, name, "first")
    loads.append_new(customer, name, "second")
    loads.append_new(customer, name, "third")
    return spark.table(name)


@query(
    """SELECT o_orderpriority, count(*) AS lines, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders,
    round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
)
def bucketed_join(spark, sf):
    """Line items with their orders, both in buckets by order."""
    bronze, silver = stored_layer(spark, sf, ("orders", "lineitem")), database(spark)
    star.to_silver_bucketed(spark, bronze, silver, 8)
    lines, orders = spark.table(f"{silver}.lineitem"), spark.table(f"{silver}.orders")
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    return per_order.join(orders, F.col("l_orderkey") == F.col("order_id")).groupBy(F.col("priority").alias("o_orderpriority")).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("orders"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


@query(
    f"""{with_ctes("silver")}, newest AS (SELECT max(tpep_pickup_datetime) AS t FROM silver)
    SELECT {", ".join(FEATURES)}, tpep_pickup_datetime, round({PREDICTION}, 6) AS prediction,
      CAST(t AS VARCHAR) AS window_end
    FROM silver, newest WHERE tpep_pickup_datetime >= t - INTERVAL 30 DAY AND tpep_pickup_datetime < t"""
)
def score_newest_days(spark, sf):
    """As ``score_last_day``, from trips stored by day: only the days of the window are read."""
    name = f"{database(spark)}.trips_silver"
    trips.store_by_day(standins.silver_trips(spark, sf), name)
    return trips.score_newest_days(spark, name, F.round(reg.score_expr(COEFS, INTERCEPT, FEATURES), 6), FEATURES, 30)


SKETCHED = ("o_totalprice", "o_custkey")
PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column, {p}e0 AS p, count(*) AS row_count, count(*) - count({c}) AS missing, CAST(min({c}) AS DOUBLE) AS low,
        CAST(max({c}) AS DOUBLE) AS high, round(sum({c}), 2)::DOUBLE AS total, true AS rank_within, true AS distinct_within FROM orders"""
        for c in SKETCHED for p in PROBS
    )
)
def sketches_by_load(spark, sf):
    """Sketches kept for each year of orders and merged; the rank of each quantile held against the rows."""
    name, orders = f"{database(spark)}.orders_profile", read_parquet(spark, sf, "orders")
    years = orders.withColumn("year", F.year("o_orderdate").cast("string"))
    kept = sketches.sketch(years, SKETCHED, SKETCHED, by=["year"])
    sinks.write_table(kept, name, partition_by=["year"])
    merged = sketches.merge(spark.table(name))
    errors = sketches.rank_errors(orders, merged, PROBS)
    counted = sketches.read(merged, PROBS).select("column", "rows", "missing", "low", "high", "distinct_values")
    true = orders.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], list(SKETCHED), "column", "true_distinct")
    totals = merged.select("column", F.round("total", 2).cast("double").alias("total"))
    off = F.abs(F.col("distinct_values") - F.col("true_distinct")) <= 0.1 * F.col("true_distinct")
    return errors.join(counted, "column").join(totals, "column").join(true, "column").select(
        "column", "p", F.col("rows").alias("row_count"), "missing", "low", "high", "total",
        (F.col("rank_error") <= 2 * F.col("bound")).alias("rank_within"), off.alias("distinct_within"),
    )


LEVELS = 8


@query(
    f"""{with_ctes("priced")}, z AS (SELECT unnest(range({LEVELS})) AS level), placed AS (
      SELECT level, CAST(floor(latitude * (1 << level)) AS BIGINT) AS cell_lat, CAST(floor(longitude * (1 << level)) AS BIGINT) AS cell_lon,
        latitude, longitude, price_num FROM priced, z WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
    SELECT CAST(level AS INTEGER) AS level, cell_lat, cell_lon, count(*) AS cnt, 
      round(CAST(sum(CAST(latitude AS DECIMAL(28,10))) AS DOUBLE) / count(*), 9) AS lat,
      round(CAST(sum(CAST(longitude AS DECIMAL(28,10))) AS DOUBLE) / count(*), 9) AS lon,
      round(CAST(sum(CAST(price_num AS DECIMAL(28,10))) AS DOUBLE) / count(price_num), 9) AS avg_price FROM placed GROUP BY 1, 2, 3"""
)
def geo_pyramid(spark, sf):
    """Cells of every zoom level, summed up from the finest."""
    cells = geo.geo_pyramid(standins.priced(spark, sf), LEVELS)
    return cells.withColumns({c: F.round(c, 9) for c in ("lat", "lon", "avg_price")})
