"""Appends that may be run again: a load has an id, its rows a partition, and a finished load a record.

A load table is partitioned by ``load_id``. A load first writes its partition, which replaces what a broken
run of the same load has left there, then adds one row to ``<table>_loads``. Running a finished load again
does nothing; running an unfinished one again gives the rows of one run. Loads of different ids do not touch
each other's partitions, so they may run side by side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from lakeops.session import scratch_path
from lakeops.sources.contracts import METADATA, contract

LOAD = "load_id"
COMMITS = StructType([*contract("load_id string, rows bigint").fields, StructField("committed_at", TimestampType())])
LEDGER = contract("row_hash string")


def ensure_load_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create an empty table partitioned by load, and the table of its finished loads, unless they are there."""
    if spark.catalog.tableExists(name):
        if LOAD not in spark.table(name).columns:
            raise ValueError(f"{name} is not a table of loads: it lacks the column {LOAD}")
    else:
        fields = [f for f in schema.fields if f.name != LOAD] + [StructField(LOAD, StringType())]
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {name} ({listed}) USING {fmt} PARTITIONED BY ({LOAD})")
    if not spark.catalog.tableExists(f"{name}_loads"):
        spark.catalog.createTable(f"{name}_loads", source=fmt, schema=COMMITS)


def finished(spark: SparkSession, name: str, load_id: str) -> bool:
    return not spark.table(f"{name}_loads").where(F.col(LOAD) == load_id).isEmpty()


def _write_partition(df: DataFrame, name: str, load_id: str) -> int:
    """Rows written. The rows of the partition, if there are any, go."""
    spark, seen = df.sparkSession, Observation()
    target = [c for c in spark.table(name).columns if c != LOAD]
    if unknown := sorted(set(df.columns) - {*target, LOAD}):
        raise ValueError(f"{name} lacks the columns {unknown}")
    given, kinds = set(df.columns), spark.table(name).schema
    rows = df.select(
        *[(F.col(f"`{c}`") if c in given else F.lit(None)).cast(kinds[c].dataType).alias(c) for c in target]
    )
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    # one partition is named, so only that one is replaced; columns follow the table's order
    view = f"load_{abs(hash((name, load_id, id(rows))))}"
    rows.createOrReplaceTempView(view)
    try:
        quoted = load_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD} = '{quoted}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return seen.get["rows"]


def _finish(spark: SparkSession, name: str, load_id: str, rows: int) -> None:
    record = spark.range(1).select(F.lit(load_id).alias(LOAD), F.lit(rows).cast("bigint").alias("rows"), F.current_timestamp().alias("committed_at"))
    record.write.insertInto(f"{name}_loads")


def append_load(df: DataFrame, name: str, load_id: str) -> int | None:
    """Append the rows of one load by column name; rows written, or None if the load was finished before."""
    spark = df.sparkSession
    ensure_load_table(spark, name, df.schema)
    if finished(spark, name, load_id):
        return None
    rows = _write_partition(df, name, load_id)
    _finish(spark, name, load_id, rows)
    return rows


def row_hash(df: DataFrame, ignore: Iterable[str] = ()) -> Column:
    """MD5 of a row as JSON with its nulls: equal rows, nulls included, and only they have the same."""
    left = set(ignore)
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in left]), {"ignoreNullFields": "false"}))


def append_new(df: DataFrame, name: str, load_id: str, ignore: Iterable[str] = METADATA.names) -> int | None:
    """Append the rows that no earlier load has brought; rows written, or None if the load was finished before.

    ``<table>_ledger`` keeps the hash of every row, partitioned by load as the table is. The columns of
    ``ignore`` (the load columns) do not count. Of equal rows of one load, one is kept. Only hashes meet the
    ledger, in an anti join that shuffles both by hash; the ledger of an unfinished run of this load
    does not count, so it can be run again.
    """
    spark, ledger = df.sparkSession, f"{name}_ledger"
    ensure_load_table(spark, name, df.schema)
    ensure_load_table(spark, ledger, LEDGER)
    if finished(spark, name, load_id):
        return None
    keyed = df.withColumn("row_hash", row_hash(df, ignore)).dropDuplicates(["row_hash"])
    before = spark.table(ledger).where(F.col(LOAD) != load_id).select("row_hash")
    # written aside first, as a table cannot be read while a partition of it is replaced
    path = scratch_path(spark, "fresh-hashes")
    keyed.select("row_hash").join(before, "row_hash", "left_anti").write.parquet(path)
    fresh = spark.read.parquet(path)
    _write_partition(fresh, ledger, load_id)
    rows = _write_partition(keyed.join(fresh, "row_hash", "left_semi").drop("row_hash"), name, load_id)
    _finish(spark, name, load_id, rows)
    return rows
