"""Copying tables from layer to layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.sinks import ensure_schema, write_table
from lakeops.sources.tables import tables_like

# fixed values: tables of the star schema
STAR_TABLES = ("customer", "orders", "lineitem", "supplier", "part", "partsupp", "nation", "region")


def unchanged(table: str, df: DataFrame) -> DataFrame:
    return df


def copy_tables(
    spark: SparkSession,
    source: str,
    target: str,
    tables: Iterable[str],
    change: Callable[[str, DataFrame], DataFrame] = unchanged,
    fmt: str = "parquet",
) -> list[str]:
    """Write ``change(table, frame)`` of every source table to the target schema, never onto itself."""
    if source == target:
        raise ValueError(f"{source} cannot be both the upper and the lower layer")
    ensure_schema(spark, target)
    done = []
    for table in tables:
        write_table(change(table, spark.table(f"{source}.{table}")), f"{target}.{table}", fmt=fmt)
        done.append(f"{target}.{table}")
    return done


def shuffles(df: DataFrame) -> bool:
    """Whether the plan moves rows between tasks."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def copy_counted(
    spark: SparkSession,
    source: str,
    target: str,
    tables: Iterable[str],
    change: Callable[[str, DataFrame], DataFrame] = unchanged,
    fmt: str = "parquet",
) -> list[tuple[str, int, int]]:
    """As ``copy_tables``; returns table, rows read and rows written, as the write itself has counted them.

    The one scan of a table feeds both counts. A task that runs again counts once, as long as the rows go
    straight from the scan to the files. A change that shuffles could count rows of a lost task twice
    before the shuffle: there the upper table is counted for itself.
    """
    if source == target:
        raise ValueError(f"{source} cannot be both the upper and the lower layer")
    ensure_schema(spark, target)
    done = []
    for table in tables:
        above, below = Observation(), Observation()
        rows = F.count(F.lit(1)).alias("rows")
        upper = spark.table(f"{source}.{table}")
        apart = shuffles(change(table, upper))
        lower = change(table, upper if apart else upper.observe(above, rows)).observe(below, rows)
        write_table(lower, f"{target}.{table}", fmt=fmt)
        done.append((table, upper.count() if apart else above.get["rows"], below.get["rows"]))
    return done


def existing(spark: SparkSession, schema: str, tables: Iterable[str]) -> list[str]:
    have = set(tables_like(spark, schema, ""))
    return [t for t in tables if t in have]


def reader(spark: SparkSession, schema: str) -> Callable[[str], DataFrame | None]:
    """Look a table of the schema up by name; None where there is none."""

    def look_up(table: str) -> DataFrame | None:
        name = f"{schema}.{table}"
        return spark.table(name) if spark.catalog.tableExists(name) else None

    return look_up


def frames(spark: SparkSession, schema: str, tables: Iterable[str]) -> Mapping[str, DataFrame]:
    return {t: spark.table(f"{schema}.{t}") for t in existing(spark, schema, tables)}
