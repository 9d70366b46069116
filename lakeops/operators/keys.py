"""Primary and foreign keys as checks: the catalog takes no key declarations, so the data is asked."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.combine import orphans, union_all


@dataclass(frozen=True)
class PrimaryKey:
    table: str
    column: str


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str


# fixed values: keys of the star schema, by the silver column names
STAR_PRIMARY = (
    PrimaryKey("customer", "customer_id"),
    PrimaryKey("orders", "order_id"),
    PrimaryKey("nation", "n_nationkey"),
    PrimaryKey("part", "p_partkey"),
    PrimaryKey("region", "r_regionkey"),
    PrimaryKey("supplier", "s_suppkey"),
)
STAR_FOREIGN = (
    ForeignKey("orders", "customer_id", "customer", "customer_id"),
    ForeignKey("customer", "nation_id", "nation", "n_nationkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "order_id"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("partsupp", "ps_partkey", "part", "p_partkey"),
    ForeignKey("partsupp", "ps_suppkey", "supplier", "s_suppkey"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
)


def city_keys(prefix: str) -> tuple[tuple[PrimaryKey, ...], tuple[ForeignKey, ...]]:
    """Keys of the listing tables of one city. The short review table has two spellings."""
    primary = tuple(
        PrimaryKey(f"{prefix}_{t}", "id") for t in ("detailed_listing", "listing", "detailed_reviews")
    )
    foreign = tuple(
        ForeignKey(f"{prefix}_{t}", "listing_id", f"{prefix}_listing", "id")
        for t in ("calendar", "detailed_reviews", "reviews", "review")
    )
    return primary, foreign


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """One row: null keys, key values held more than once, and rows in excess of one per key.

    Rows are counted per key first, map side too, so a key held by a third of the rows is one
    row per task in the shuffle.
    """
    per_key = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("key").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("excess_rows"),
    )


def null_keys(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row with the null count of each key column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def fk_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: key values without a parent, and the child rows that hold them."""
    lost = orphans(child, key, parent, parent_key)
    return lost.agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
    )


PRIMARY_REPORT = "table_name string, key_column string, null_rows bigint, duplicate_keys bigint, excess_rows bigint"
FOREIGN_REPORT = "child string, key_column string, parent string, orphan_keys bigint, orphan_rows bigint"


def _report(spark: SparkSession, found: list[DataFrame], absent: list[tuple], schema: str) -> DataFrame:
    """What was counted, and a row of null counts for each key that could not be looked at."""
    return union_all([*found, spark.createDataFrame(absent, schema)] if absent or not found else found)


def check_primary(table: Callable[[str], DataFrame | None], registry: Iterable[PrimaryKey]) -> DataFrame:
    """``pk_violations`` of every registered key; null counts where the table does not exist."""
    found, absent = [], []
    for pk in registry:
        if (df := table(pk.table)) is None:
            absent.append((pk.table, pk.column, None, None, None))
            continue
        found.append(
            pk_violations(df, pk.column).select(
                F.lit(pk.table).alias("table_name"), F.lit(pk.column).alias("key_column"), "*"
            )
        )
    return _report(SparkSession.active(), found, absent, PRIMARY_REPORT)


def check_foreign(table: Callable[[str], DataFrame | None], registry: Iterable[ForeignKey]) -> DataFrame:
    """``fk_orphans`` of every registered key; null counts where one of its tables does not exist."""
    found, absent = [], []
    for fk in registry:
        child, parent = table(fk.child), table(fk.parent)
        if child is None or parent is None:
            absent.append((fk.child, fk.column, fk.parent, None, None))
            continue
        found.append(
            fk_orphans(child, fk.column, parent, fk.parent_column).select(
                F.lit(fk.child).alias("child"), F.lit(fk.column).alias("key_column"),
                F.lit(fk.parent).alias("parent"), "*",
            )
        )
    return _report(SparkSession.active(), found, absent, FOREIGN_REPORT)
