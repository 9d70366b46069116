"""Replacing a table without a moment in which its rows are lost.

The new rows are written to a fresh folder beside the table. Only when all of them are there does the
table's location change, so a write that fails leaves the old rows as they were, and a frame may be
read from the table that it replaces. The folder of the rows before stays until the next replacement,
for readers that began with it and for ``undo_replace``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Formats whose tables are plain folders of files. Others bring replacements of their own.
STAGED = ("parquet", "orc")
PREVIOUS = "lakeops.previous"


@dataclass(frozen=True)
class Definition:
    """What the catalog says of a table."""

    location: str
    provider: str
    managed: bool
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    buckets: tuple[int, tuple[str, ...]] | None
    previous: str | None


def definition(spark: SparkSession, name: str) -> Definition | None:
    if not spark.catalog.tableExists(name):
        return None
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    listed = spark.catalog.listColumns(name)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return Definition(
        facts.get("Location", ""),
        facts.get("Provider", "").lower(),
        facts.get("Type") == "MANAGED",
        tuple((f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields),
        tuple(c.name for c in listed if c.isPartition),
        _buckets(facts),
        properties.get(PREVIOUS) or None,
    )


def _buckets(facts: dict[str, str]) -> tuple[int, tuple[str, ...]] | None:
    if not facts.get("Num Buckets"):
        return None
    return int(facts["Num Buckets"]), tuple(c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(","))


def home(spark: SparkSession, name: str) -> str | None:
    """The folder of the table's versions, beside those of its database's tables; None where the catalog
    does not say where these are."""
    *schema, table = [part.strip("`") for part in name.split(".")]
    database = spark.catalog.getDatabase(".".join(schema) or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{table}.versions" if database.locationUri else None


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _create(
    spark: SparkSession, name: str, schema: StructType, fmt: str, keys: tuple[str, ...],
    buckets: tuple[int, tuple[str, ...]] | None, location: str,
) -> None:
    quoted = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields]
    parts = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    if buckets:
        listed = ", ".join(f"`{k}`" for k in buckets[1])
        parts += f" CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets[0]} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({', '.join(quoted)}) USING {fmt} {parts} LOCATION '{location}'")
    if keys:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _owned(old: Definition, folder: str) -> str:
    """The old folder, if it is the library's or the catalog's to delete; others stay where they are."""
    return old.location if old.managed or old.location.rsplit("/", 1)[0].endswith(folder.split("/", 1)[-1]) else ""


def _stage(df: DataFrame, name: str, fmt: str, keys: tuple[str, ...], buckets: tuple[int, tuple[str, ...]] | None, path: str) -> None:
    if not buckets:
        writer = df.write.format(fmt)
        (writer.partitionBy(*keys) if keys else writer).save(path)
        return
    # only a table can be written in buckets: one that is forgotten again, its files stay. A task writes one bucket.
    passing = f"{'.'.join(name.split('.')[:-1] + [''])}stage_{uuid.uuid4().hex}"
    number, columns = buckets
    writer = df.repartition(number, *columns).write.format(fmt).option("path", path).bucketBy(number, *columns).sortBy(*columns)
    try:
        (writer.partitionBy(*keys) if keys else writer).saveAsTable(passing)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {passing}")


def replace_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: Iterable[str] = (),
    bucket_by: tuple[int, Iterable[str]] | None = None,
) -> None:
    """Replace the table by the frame, or create it.

    ``bucket_by`` is a number of buckets and their columns: tables with the same number join on these columns,
    and are grouped by them, without a shuffle.

    If columns, types and format stay and there are no partitions, one change of the location publishes
    the new rows. Otherwise the definition is dropped and made anew after they are all written, and the old
    one comes back if that fails; a table that Spark manages loses its old files with its definition.
    Writers at the same time never mix rows: the last to finish wins.
    """
    if fmt not in STAGED:
        raise ValueError(f"{fmt} tables are not plain folders; write them by their own replacement")
    spark, keys = df.sparkSession, tuple(partition_by)
    if (folder := home(spark, name)) is None:
        raise ValueError(f"the catalog of {name} does not say where its tables are")
    stage = f"{folder}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    buckets = (bucket_by[0], tuple(bucket_by[1])) if bucket_by else None
    try:
        _stage(df, name, fmt, keys, buckets, stage)
    except BaseException:
        remove_folder(spark, stage)
        raise
    schema = StructType([f for f in df.schema.fields if f.name not in keys] + [df.schema[k] for k in keys])
    old = definition(spark, name)
    previous = _owned(old, folder) if old else ""
    if old is None:
        _create(spark, name, schema, fmt, keys, buckets, stage)
    elif (old.columns, old.keys, keys, old.provider, old.buckets) == (
        tuple((f.name, f.dataType.simpleString()) for f in schema.fields), (), (), fmt, buckets,
    ):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{stage}'")
    else:
        kept = spark.table(name).schema
        spark.sql(f"DROP TABLE {name}")
        try:
            _create(spark, name, schema, fmt, keys, buckets, stage)
        except BaseException:
            if not old.managed:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                _create(spark, name, kept, old.provider, old.keys, old.buckets, old.location)
            raise
        previous = "" if old.managed else previous
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{previous}')")
    spark.catalog.refreshTable(name)
    if old and old.previous and old.previous not in (previous, stage):
        remove_folder(spark, old.previous)


def undo_replace(spark: SparkSession, name: str) -> None:
    """Show the rows from before the last replacement again; a second call goes forward again.

    Only for replacements that kept columns and format: the rows before must fit the definition.
    """
    now = definition(spark, name)
    if now is None or not now.previous or now.keys:
        raise ValueError(f"{name} has no replaced rows to go back to")
    if tuple((f.name, f.dataType.simpleString()) for f in spark.read.format(now.provider).load(now.previous).schema.fields) != now.columns:
        raise ValueError(f"the rows before have other columns than {name} has now")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{now.previous}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{now.location}')")
    spark.catalog.refreshTable(name)
