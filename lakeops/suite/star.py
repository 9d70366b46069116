"""Star schema queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators import columns
from lakeops.operators.combine import table_counts as count_tables
from lakeops.operators.combine import union_all
from lakeops.operators.keys import STAR_FOREIGN, STAR_PRIMARY, ForeignKey, PrimaryKey
from lakeops.operators.keys import check_foreign, check_primary
from lakeops.operators.reconcile import quality_log, reconcile
from lakeops.operators.sample import latest
from lakeops.plans import listings as listing_plan
from lakeops.plans import star
from lakeops.plans import trips as trip_plan
from lakeops.session import scratch_path
from lakeops.sources.files import read_csv
from lakeops.sources.tables import file_sizes as list_files
from lakeops.sources.tables import read_parquet
from lakeops.suite import standins
from lakeops.suite.registry import dollars, query
from lakeops.suite.standins import with_ctes

STAR = ("customer", "orders", "lineitem", "supplier", "part", "nation", "region")
CUSTOMER_ID = 605
AT = dt.datetime(2025, 1, 2, 3, 4, 5)
AT_SQL = "TIMESTAMP '2025-01-02 03:04:05'"


def _silver(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return star.silver(table, read_parquet(spark, sf, table))


def _layers(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Bronze and silver copies of the star tables, two tables whose silver step drops rows, and one
    whose silver load is missing."""
    trips, listings = standins.trips(spark, sf), standins.listings(spark, sf)
    bronze = {t: read_parquet(spark, sf, t) for t in STAR} | {"trips": trips, "listings": listings}
    silver = {t: _silver(spark, sf, t) for t in STAR if t != "region"}
    silver |= {"trips": trip_plan.silver(trips), "listings": listing_plan.clean_listings(listings)}
    return bronze, silver


LAYER_SQL = f"""{with_ctes("silver", "listings")}, counts AS (
  {" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS bronze_count, count(*) AS silver_count FROM {t}" for t in STAR if t != "region")}
  UNION ALL SELECT 'region', (SELECT count(*) FROM region), CAST(NULL AS BIGINT)
  UNION ALL SELECT 'trips', (SELECT count(*) FROM trips), (SELECT count(*) FROM silver)
  UNION ALL SELECT 'listings', (SELECT count(*) FROM listings),
    (SELECT count(*) FROM listings WHERE {dollars("price")} < 10000 AND minimum_nights <= 90))
"""


@query("SELECT * FROM orders")
def scan_orders(spark, sf):
    return read_parquet(spark, sf, "orders")


@query("SELECT * FROM part")
def csv_roundtrip_part(spark, sf):
    part = read_parquet(spark, sf, "part")
    path = scratch_path(spark, "part-csv")
    part.select(*reversed(part.columns)).write.option("header", "true").option("escape", '"').option(
        "compression", "gzip"
    ).csv(path)
    return read_csv(spark, path, StructType(part.schema.fields), multi_line=False)


@query()
def file_sizes(spark, sf):
    return list_files(spark, sf, "*.parquet")


@query(
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS prediction FROM orders "
    "UNION ALL SELECT o_orderkey, o_totalprice, o_totalprice * 2 FROM orders"
)
def append_evolving(spark, sf):
    orders = read_parquet(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return union_all([orders, orders.withColumn("prediction", F.col("o_totalprice") * 2)])


@query(f"{LAYER_SQL} SELECT *, bronze_count - silver_count AS diff FROM counts WHERE coalesce(bronze_count <> silver_count, true)")
def count_reconcile(spark, sf):
    return reconcile(*_layers(spark, sf))


@query(
    f"""{LAYER_SQL} SELECT {AT_SQL} AS run_timestamp, *, bronze_count - silver_count AS diff,
    CASE WHEN silver_count IS NULL THEN 'MISSING' WHEN bronze_count = silver_count THEN 'OK' ELSE 'MISMATCH' END
      AS status FROM counts"""
)
def dq_count_log(spark, sf):
    log = quality_log(*_layers(spark, sf), at=AT)
    return log.withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR))
def table_counts(spark, sf):
    return count_tables({t: read_parquet(spark, sf, t) for t in STAR})


@query(
    "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, "
    "c_acctbal AS account_balance, c_mktsegment AS market_segment FROM customer"
)
def silver_customer(spark, sf):
    return _silver(spark, sf, "customer")


@query(
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, "
    "o_totalprice AS total_price, o_orderdate AS order_date, o_orderpriority AS priority FROM orders"
)
def silver_orders(spark, sf):
    return _silver(spark, sf, "orders")


@query("SELECT o_orderkey, 'Athens' AS area, true AS stamped FROM orders")
def add_metadata(spark, sf):
    stamped = columns.add_metadata(read_parquet(spark, sf, "orders"), "Athens")
    return stamped.select("o_orderkey", "area", F.col("processing_datetime").isNotNull().alias("stamped"))


@query(f"SELECT *, {AT_SQL} AS load_timestamp FROM orders")
def load_stamp(spark, sf):
    stamped = columns.add_load_timestamp(read_parquet(spark, sf, "orders"), AT)
    return stamped.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


@query(
    f"SELECT sum(l_quantity) AS sum_quantity FROM lineitem "
    f"WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey = {CUSTOMER_ID})"
)
def qty_of_customer(spark, sf):
    return star.quantity_of_customer(
        read_parquet(spark, sf, "lineitem"), _silver(spark, sf, "orders"), CUSTOMER_ID
    )


@query(f"SELECT min(o_orderdate) AS first_purchase_date FROM orders WHERE o_custkey = {CUSTOMER_ID}")
def first_purchase(spark, sf):
    return star.first_purchase(_silver(spark, sf, "orders"), CUSTOMER_ID)


@query(f"SELECT count(*) AS num_of_orders FROM orders WHERE o_custkey = {CUSTOMER_ID}")
def orders_of_customer(spark, sf):
    return star.orders_of_customer(_silver(spark, sf, "orders"), CUSTOMER_ID)


@query(
    """WITH top AS (
      SELECT c_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
      GROUP BY 1, 2 ORDER BY count(o_orderkey) DESC, c_custkey LIMIT 1)
    SELECT n_name AS nationality FROM top JOIN nation ON c_nationkey = n_nationkey"""
)
def top_customer_nation(spark, sf):
    return star.top_customer_nation(
        _silver(spark, sf, "orders"), _silver(spark, sf, "customer"), _silver(spark, sf, "nation")
    )


@query("SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20")
def latest_orders(spark, sf):
    return latest(read_parquet(spark, sf, "orders"), "o_orderdate", 20, ["o_orderkey"])


@query(
    """SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS account_balance,
      c_mktsegment AS market_segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""
)
def union_by_name(spark, sf):
    customer = columns.rename(
        read_parquet(spark, sf, "customer"),
        {"c_custkey": "party_id", "c_name": "name", "c_acctbal": "account_balance",
         "c_mktsegment": "market_segment"},
    )
    supplier = columns.rename(
        read_parquet(spark, sf, "supplier"),
        {"s_name": "name", "s_suppkey": "party_id", "s_acctbal": "account_balance"},
    )
    return union_all([customer, supplier])


# The given tables break none of the declared keys, so one broken key of each kind is added, and one
# of a table there is not. The parts that suppliers sell are taken from the order lines.
PRIMARY = (*STAR_PRIMARY, PrimaryKey("lineitem", "l_orderkey"), PrimaryKey("returns", "id"))
FOREIGN = (
    *STAR_FOREIGN, ForeignKey("events", "user_id", "supplier", "s_suppkey"), ForeignKey("returns", "id", "part", "p_partkey")
)
PARTSUPP = "SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem"


def _bronze_column(table: str, column: str) -> str:
    names = {new: old for old, new in star.RENAMES.get(table, {}).items()}
    return names.get(column, column)


def _pk_sql(pk: PrimaryKey) -> str:
    if pk.table == "returns":
        return f"SELECT 'returns', '{pk.column}', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"
    c = _bronze_column(pk.table, pk.column)
    return f"""SELECT '{pk.table}' AS table_name, '{pk.column}' AS key_column,
      CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_rows,
      CAST(count(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) AS BIGINT) AS duplicate_keys,
      CAST(coalesce(sum(CASE WHEN k IS NOT NULL THEN n - 1 END), 0) AS BIGINT) AS excess_rows
      FROM (SELECT {c} AS k, count(*) AS n FROM {pk.table} GROUP BY 1)"""


def _fk_sql(fk: ForeignKey) -> str:
    if fk.child == "returns":
        return f"SELECT 'returns', '{fk.column}', '{fk.parent}', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"
    c, p = _bronze_column(fk.child, fk.column), _bronze_column(fk.parent, fk.parent_column)
    child = f"({PARTSUPP})" if fk.child == "partsupp" else fk.child
    return f"""SELECT '{fk.child}' AS child, '{fk.column}' AS key_column, '{fk.parent}' AS parent,
      count(DISTINCT {c}) AS orphan_keys, count(*) AS orphan_rows FROM {child} c
      WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE p.{p} = c.{c})"""


def _look_up(spark: SparkSession, sf: str):
    def table(name: str) -> DataFrame | None:
        if name == "returns":
            return None
        if name == "partsupp":
            lines = read_parquet(spark, sf, "lineitem")
            return lines.select(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).distinct()
        return _silver(spark, sf, name)

    return table


@query(" UNION ALL ".join(map(_pk_sql, PRIMARY)))
def pk_violations(spark, sf):
    return check_primary(_look_up(spark, sf), PRIMARY)


@query(" UNION ALL ".join(map(_fk_sql, FOREIGN)))
def fk_orphans(spark, sf):
    return check_foreign(_look_up(spark, sf), FOREIGN)
