"""Writing tables. The table format is a parameter; parquet needs nothing beyond Spark."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.sources.contracts import conform
from lakeops.sources.versions import STAGED, definition, home, remove_folder, replace_table

SOURCE_LAYERS = ("source", "data", "raw")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    bucket_by: tuple[int, Iterable[str]] | None = None,
) -> None:
    """Create or replace the table by the frame.

    Tables of plain files are replaced as ``versions.replace_table`` does: a write that fails leaves the
    old rows, and the frame may be read from the table itself. Other formats, and catalogs that keep the place
    of tables to themselves, replace tables in their own way.
    """
    if mode == "overwrite" and fmt in STAGED and home(df.sparkSession, name):
        replace_table(df, name, fmt, partition_by, bucket_by)
        return
    if bucket_by:
        raise ValueError(f"buckets are for replaced tables of {STAGED}")
    writer = df.write.mode(mode).format(fmt)
    keys = list(partition_by)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.saveAsTable(name)


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create an empty table from the schema unless there is one."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source=fmt, schema=schema)


def _in_table_order(df: DataFrame, target: StructType) -> DataFrame:
    """The table's columns in the table's order, as ``insertInto`` goes by position; lacking ones are null."""
    given = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def append(df: DataFrame, name: str, contract: StructType | None = None) -> None:
    """Append by column name, against the contract if given, else against the table itself.

    The order of the contract's columns does not matter. A table may hold more columns than its
    contract (they become null), but not fewer.
    """
    target = df.sparkSession.table(name).schema
    df = conform(df, contract or target)
    if unknown := sorted(set(df.columns) - set(target.names)):
        raise ValueError(f"{name} lacks the columns {unknown} of the contract")
    _in_table_order(df, target).write.insertInto(name)


def append_evolving(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Append by name; columns the table lacks are added to it, columns the frame lacks are null."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name, fmt=fmt)
        return
    have = set(spark.table(name).columns)
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    _in_table_order(df, spark.table(name).schema).write.insertInto(name)


def append_files(df: DataFrame, path: str) -> None:
    """Append to a parquet folder; later columns show up in ``read_merged``."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_partitions(df: DataFrame, path: str, keys: Iterable[str]) -> None:
    """Write only the partitions the frame holds. Writing the same batch again changes nothing,
    and an empty frame writes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def drop_tables(
    spark: SparkSession, names: Iterable[str], protected: Iterable[str] = SOURCE_LAYERS
) -> None:
    """Drop tables if they exist, with the folders of their versions. Tables of a source layer, and
    copies that end in ``_raw``, are refused, all or nothing: later layers could not be built again without them."""
    names, layers = list(names), set(protected)
    refused = [n for n in names if layers & set(n.lower().split(".")[:-1]) or n.lower().endswith("_raw")]
    if refused:
        raise ValueError(f"refusing to drop source tables {refused}")
    for name in names:
        if definition(spark, name):
            spark.sql(f"DROP TABLE {name}")
            if folder := home(spark, name):
                remove_folder(spark, folder)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
