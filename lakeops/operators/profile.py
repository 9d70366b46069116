"""Missing values, whole-frame profiles and coverage: one aggregate per frame, whatever its width."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, NumericType, StringType
from pyspark.sql.types import TimestampNTZType, TimestampType

from lakeops.operators.combine import union_all
from lakeops.operators.rows import drop_all_null


def is_missing(col: str, dtype: DataType, nan_as_null: bool = False) -> Column:
    c = F.col(f"`{col}`")
    if nan_as_null and isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _missing_counts(df: DataFrame, nan_as_null: bool) -> DataFrame:
    """Rows ``column, total_rows, missing_count`` from a single aggregate row."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[
            F.count_if(is_missing(f.name, f.dataType, nan_as_null)).alias(f"m{i}")
            for i, f in enumerate(df.schema.fields)
        ],
    )
    pairs = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"m{i}").alias("missing_count"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select("total_rows", F.inline(F.array(*pairs))).select(
        "column", "total_rows", "missing_count"
    )


def missing_profile(
    df: DataFrame, ignore: Iterable[str] = (), nan_as_null: bool = False
) -> DataFrame:
    """Missing values per column after empty rows are removed; percent unrounded, 0 for no rows."""
    counts = _missing_counts(drop_all_null(df, ignore), nan_as_null)
    percent = F.try_divide("missing_count", "total_rows") * 100
    return counts.withColumn("missing_percent", F.coalesce(percent, F.lit(0.0)))


def missing_report(df: DataFrame, nan_as_null: bool = False) -> DataFrame:
    """Missing values per column, percent to two places. A frame without rows gives no rows."""
    counts = _missing_counts(df, nan_as_null).where("total_rows > 0")
    percent = F.try_divide(F.col("missing_count") * 100, F.col("total_rows"))
    return counts.withColumn("missing_percent", F.round(percent, 2))


def missing_rate(df: DataFrame, wide: bool = False, nan_as_null: bool = False) -> DataFrame:
    """Missing fraction per column: one row per column, or one row with the columns of the frame."""
    if wide:
        rows = F.count(F.lit(1))
        return df.agg(
            *[
                F.try_divide(F.count_if(is_missing(f.name, f.dataType, nan_as_null)), rows).alias(f.name)
                for f in df.schema.fields
            ]
        )
    counts = _missing_counts(df, nan_as_null)
    return counts.select(
        "column", "missing_count", F.try_divide("missing_count", "total_rows").alias("missing_rate")
    )


def missing_reports(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The reports of several frames under their names."""
    return union_all(missing_report(df).withColumn("table", F.lit(name)) for name, df in frames.items())


def describe(df: DataFrame, *cols: str) -> DataFrame:
    return df.describe(*cols)


def summary(df: DataFrame, *statistics: str) -> DataFrame:
    return df.summary(*statistics)


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Type, nulls, distinct values, range, mean and spread per column.

    Ranges of numbers are in ``min_num``/``max_num``, those of texts and times in
    ``min_text``/``max_text``. Distinct counts are sketches unless ``exact``, which multiplies
    the rows by the number of columns and is meant for small tables.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    entries = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, NumericType)
        ordered = isinstance(f.dataType, (StringType, DateType, TimestampType, TimestampNTZType))
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), distinct(c).alias(f"d{i}")]
        if number or ordered:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if number:
            aggs += [F.avg(c).alias(f"avg{i}"), F.stddev_samp(c).alias(f"sd{i}")]

        def pick(name: str, wanted: bool, dtype: str) -> Column:
            return (F.col(f"{name}{i}") if wanted else F.lit(None)).cast(dtype)

        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("null_count"),
                F.col(f"d{i}").alias("distinct_count"),
                pick("lo", number, "double").alias("min_num"),
                pick("hi", number, "double").alias("max_num"),
                pick("avg", number, "double").alias("mean"),
                pick("sd", number, "double").alias("stddev"),
                pick("lo", ordered, "string").alias("min_text"),
                pick("hi", ordered, "string").alias("max_text"),
            )
        )
    return df.agg(*aggs).select("total_rows", F.inline(F.array(*entries)))


def numeric_stats(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Count, mean, spread and range of the named columns, one row each."""
    cols = list(cols)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        parts = {"cnt": F.count(c), "mean": F.avg(c), "stddev": F.stddev_samp(c),
                 "min": F.min(c).cast("double"), "max": F.max(c).cast("double")}
        aggs += [agg.alias(f"{name}{i}") for name, agg in parts.items()]
        entries.append(
            F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in parts])
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def parse_failures(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per column: texts present, and texts the parser made a null of."""
    aggs, entries = [], []
    for i, (name, value) in enumerate(parsed.items()):
        has_text = F.col(name).isNotNull()
        aggs += [F.count_if(has_text).alias(f"t{i}"), F.count_if(has_text & value.isNull()).alias(f"f{i}")]
        entries.append(
            F.struct(F.lit(name).alias("column"), F.col(f"t{i}").alias("texts"), F.col(f"f{i}").alias("failed"))
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def coverage(dataset: str, df: DataFrame, date: str | None = None, by: str = "city") -> DataFrame:
    """Rows and date range of a dataset per city; a dataset without dates has a null range."""
    lo, hi = (F.min(date), F.max(date)) if date else (F.lit(None), F.lit(None))
    return df.groupBy(by).agg(
        F.lit(dataset).alias("dataset"),
        F.count(F.lit(1)).alias("rows"),
        lo.cast("date").alias("min_date"),
        hi.cast("date").alias("max_date"),
    )
