"""Row counts of two layers, side by side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.combine import table_counts


def _paired(upper: Mapping[str, DataFrame], lower: Mapping[str, DataFrame], names: tuple[str, str]) -> DataFrame:
    left = table_counts(upper).withColumnRenamed("row_count", names[0])
    right = table_counts(lower).withColumnRenamed("row_count", names[1])
    return left.join(right, "table_name", "full").withColumn("diff", F.col(names[0]) - F.col(names[1]))


def reconcile(
    upper: Mapping[str, DataFrame],
    lower: Mapping[str, DataFrame],
    names: tuple[str, str] = ("bronze_count", "silver_count"),
) -> DataFrame:
    """Tables whose counts differ, or that only one of the layers has (its count is null there)."""
    return _paired(upper, lower, names).where(F.coalesce(F.col("diff") != 0, F.lit(True)))


def quality_log(
    upper: Mapping[str, DataFrame], lower: Mapping[str, DataFrame], at: dt.datetime | None = None
) -> DataFrame:
    """One row per table with status OK, MISMATCH or, if only one layer has it, MISSING, in the
    column order of the log table."""
    return _log(_paired(upper, lower, ("bronze_count", "silver_count")), at)


def quality_log_of(
    spark: SparkSession, counts: Iterable[tuple[str, int | None, int | None]], at: dt.datetime | None = None
) -> DataFrame:
    """The same rows from counts that are known: table, rows above, rows below; None for an absent table."""
    known = spark.createDataFrame(list(counts), "table_name string, bronze_count bigint, silver_count bigint")
    return _log(known.withColumn("diff", F.col("bronze_count") - F.col("silver_count")), at)


def _log(paired: DataFrame, at: dt.datetime | None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else F.lit(at)
    status = F.when(F.col("diff").isNull(), "MISSING").when(F.col("diff") == 0, "OK").otherwise("MISMATCH")
    return paired.select(
        stamp.alias("run_timestamp"), "table_name", "bronze_count", "silver_count", "diff",
        status.alias("status"),
    )


def filtered_counts(df: DataFrame, **layers: Column) -> DataFrame:
    """``<layer>_cnt`` for layers that are filters of one frame: all in one pass over it."""
    return df.agg(*[F.count_if(keep).alias(f"{name}_cnt") for name, keep in layers.items()])


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row, one ``<layer>_cnt`` column per layer."""
    first, *rest = [
        df.agg(F.count(F.lit(1)).alias(f"{name}_cnt")) for name, df in layers.items()
    ]
    return first.select("*", *[df.scalar().alias(df.columns[0]) for df in rest])
