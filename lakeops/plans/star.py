"""Star schema: source to bronze to silver, count checks and business questions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.columns import rename
from lakeops.operators.combine import top_by_count
from lakeops.operators.keys import STAR_FOREIGN, STAR_PRIMARY, check_foreign, check_primary
from lakeops.operators.reconcile import quality_log, quality_log_of
from lakeops.plans.layers import STAR_TABLES, copy_counted, copy_tables, existing, frames, reader
from lakeops.sources.loads import append_load
from lakeops.sources.sinks import append, ensure_schema, ensure_table, write_table

# fixed values: silver names
CUSTOMER = {
    "c_custkey": "customer_id", "c_name": "name", "c_address": "address",
    "c_nationkey": "nation_id", "c_phone": "phone", "c_acctbal": "account_balance",
    "c_mktsegment": "market_segment", "c_comment": "comment",
}
ORDERS = {
    "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
    "o_totalprice": "total_price", "o_orderdate": "order_date", "o_orderpriority": "priority",
    "o_clerk": "clerk", "o_shippriority": "ship_priority", "o_comment": "comment",
}
RENAMES = {"customer": CUSTOMER, "orders": ORDERS}


# the column that most joins and key checks of a table go by
BUCKETS = {"orders": "order_id", "lineitem": "l_orderkey"}


def silver(table: str, df: DataFrame) -> DataFrame:
    return rename(df, RENAMES[table]) if table in RENAMES else df


def to_bronze(
    spark: SparkSession, source: str, bronze: str, tables: Iterable[str] = STAR_TABLES, fmt: str = "parquet"
) -> list[str]:
    return copy_tables(spark, source, bronze, existing(spark, source, tables), fmt=fmt)


def to_silver(
    spark: SparkSession, bronze: str, target: str, tables: Iterable[str] = STAR_TABLES, fmt: str = "parquet"
) -> list[str]:
    return copy_tables(spark, bronze, target, existing(spark, bronze, tables), silver, fmt)


def to_silver_bucketed(
    spark: SparkSession, bronze: str, target: str, buckets: int,
    tables: Iterable[str] = STAR_TABLES, fmt: str = "parquet",
) -> list[str]:
    """Bronze to silver with orders and line items in ``buckets`` buckets by order, each sorted: joins of the two, and
    counts of their keys, move no rows. One load shuffles them once for all the joins that follow."""
    ensure_schema(spark, target)
    done = []
    for table in existing(spark, bronze, tables):
        keys = (buckets, [BUCKETS[table]]) if table in BUCKETS else None
        write_table(silver(table, spark.table(f"{bronze}.{table}")), f"{target}.{table}", fmt=fmt, bucket_by=keys)
        done.append(f"{target}.{table}")
    return done


def log_counts(
    spark: SparkSession, bronze: str, target: str, monitoring: str,
    at: dt.datetime | None = None, tables: Iterable[str] = STAR_TABLES,
) -> None:
    """Append one row per table to ``<monitoring>.data_quality_log``."""
    tables = list(tables)
    name = f"{monitoring}.data_quality_log"
    rows = quality_log(frames(spark, bronze, tables), frames(spark, target, tables), at)
    ensure_schema(spark, monitoring)
    ensure_table(spark, name, rows.schema)
    append(rows, name)


def to_silver_logged(
    spark: SparkSession, bronze: str, target: str, monitoring: str, load_id: str,
    at: dt.datetime | None = None, tables: Iterable[str] = STAR_TABLES, fmt: str = "parquet",
) -> list[tuple[str, int, int]]:
    """Bronze to silver and its quality log, one scan a table: the write counts what it reads and writes.

    The log rows are the load ``load_id`` of ``<monitoring>.data_quality_loads``, so a second run of the same load
    leaves one row a table. Tables that one layer lacks are logged without the other's count.
    """
    here = existing(spark, bronze, tables)
    counts = copy_counted(spark, bronze, target, here, silver, fmt)
    only = [t for t in existing(spark, target, tables) if t not in here]
    counts += [(t, None, spark.table(f"{target}.{t}").count()) for t in only]
    ensure_schema(spark, monitoring)
    append_load(quality_log_of(spark, counts, at), f"{monitoring}.data_quality_loads", load_id)
    return counts


def check_keys(spark: SparkSession, schema: str) -> tuple[DataFrame, DataFrame]:
    """Primary and foreign key checks of the silver star schema."""
    look_up = reader(spark, schema)
    return check_primary(look_up, STAR_PRIMARY), check_foreign(look_up, STAR_FOREIGN)


def quantity_of_customer(lineitem: DataFrame, orders: DataFrame, customer_id: int) -> DataFrame:
    mine = orders.where(F.col("customer_id") == customer_id).select(F.col("order_id").alias("l_orderkey"))
    kept = lineitem.join(mine, "l_orderkey", "left_semi")
    return kept.agg(F.sum("l_quantity").alias("sum_quantity"))


def first_purchase(orders: DataFrame, customer_id: int) -> DataFrame:
    return orders.where(F.col("customer_id") == customer_id).agg(
        F.min("order_date").alias("first_purchase_date")
    )


def orders_of_customer(orders: DataFrame, customer_id: int) -> DataFrame:
    return orders.where(F.col("customer_id") == customer_id).agg(
        F.count(F.lit(1)).alias("num_of_orders")
    )


def top_customer_nation(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Nation of the customer with most orders; the lowest customer id wins a tie."""
    top = top_by_count(
        orders.where(F.col("order_id").isNotNull()), "customer_id",
        customer.select("customer_id", "nation_id"), "customer_id",
    )
    return top.join(nation, top["nation_id"] == nation["n_nationkey"]).select(
        F.col("n_name").alias("nationality")
    )
