"""Named tables and file listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.rows import last_window


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tables_like(spark: SparkSession, schema: str, prefix: str) -> list[str]:
    """Names of the tables of a schema that begin with the prefix, temp views left out."""
    found = spark.catalog.listTables(schema)
    return sorted(t.name for t in found if not t.isTemporary and t.name.startswith(prefix))


def read_first(spark: SparkSession, names: Iterable[str]) -> DataFrame | None:
    """The first table that exists, or None. Asks the catalog; no job is started."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def partition_values(spark: SparkSession, name: str, key: str) -> list[str]:
    """The values of a partition column, as text and in order, from the catalog: no file is opened. The
    partition of null is left out."""
    listed = [dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return sorted({unquote(parts[key]) for parts in listed} - {"__HIVE_DEFAULT_PARTITION__", "null"})


def last_window_by_day(spark: SparkSession, name: str, ts: str, day: str, days: int = 1) -> DataFrame:
    """``last_window`` of a table that is partitioned by the date of ``ts``: the catalog says which day is the newest,
    and only its partition and those of the ``days`` before it are read."""
    table = spark.table(name)
    known = partition_values(spark, name, day)
    if not known:
        return table.limit(0)
    first = dt.date.fromisoformat(known[-1]) - dt.timedelta(days=days)
    return last_window(table.where(F.col(day) >= F.lit(first)), ts, f"{days} days")


def file_sizes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file below the path plus a ``Total size`` row, in whole MB and in bytes.

    Only path and length are selected, so the file source lists the files and opens none.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    )
    total = files.agg(F.lit("Total size").alias("name"), F.sum("bytes").alias("bytes"))
    return files.unionByName(total).withColumn(
        "size_mb", F.round(F.col("bytes") / F.lit(1024.0 * 1024.0)).cast("bigint")
    )
