"""Filters and row cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.parse import strip_currency

# fixed values: load columns that say nothing about a row being empty or repeated
LOAD_COLUMNS = ("load_timestamp", "processing_datetime", "area", "_ingest_ts")


def business_columns(df: DataFrame, ignore: Iterable[str] = LOAD_COLUMNS) -> list[str]:
    skip = set(ignore)
    return [c for c in df.columns if c not in skip]


def between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def split_outliers(df: DataFrame, col: str, limit: float) -> tuple[DataFrame, DataFrame]:
    """Rows below the limit and rows at or above it; nulls are in neither."""
    return df.where(F.col(col) < limit), df.where(F.col(col) >= limit)


def outlier_counts(df: DataFrame, col: str, limit: float, by: Iterable[str] = ()) -> DataFrame:
    """Rows kept, rows removed as extreme and rows removed as null, in one pass."""
    return df.groupBy(*by).agg(
        F.count_if(F.col(col) < limit).alias("kept"),
        F.count_if(F.col(col) >= limit).alias("extreme"),
        F.count_if(F.col(col).isNull()).alias("null_rows"),
    )


def whole_prices(df: DataFrame, lo: float = 10, hi: float = 1000, col: str = "price") -> DataFrame:
    """Rows whose price text is a whole number in the range, with ``clean_price``. A text with
    cents does not count as one."""
    digits = strip_currency(col)
    return (
        df.where(F.trim(F.col(col)) != "")
        .where(digits.rlike("^[0-9]+$"))
        .withColumn("clean_price", digits.try_cast("double"))
        .where(F.col("clean_price").between(lo, hi))
    )


def dedupe(df: DataFrame, ignore: Iterable[str] = LOAD_COLUMNS) -> DataFrame:
    """One copy of each row. Load columns are left out of the comparison; the earliest value of
    each is kept, so the answer does not depend on the order of rows."""
    keys = business_columns(df, ignore)
    stamps = [c for c in df.columns if c not in set(keys)]
    if not stamps:
        return df.dropDuplicates()
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in stamps]).select(*df.columns)


def is_all_null(df: DataFrame, ignore: Iterable[str] = LOAD_COLUMNS) -> Column:
    """As a count, not a chain of ANDs: the optimizer would multiply that out over conditional columns."""
    return sum(F.col(f"`{c}`").isNotNull().cast("int") for c in business_columns(df, ignore)) == 0


def drop_all_null(df: DataFrame, ignore: Iterable[str] = LOAD_COLUMNS) -> DataFrame:
    """Drop rows without any value. A load stamp does not make a row non-empty."""
    return df.where(~is_all_null(df, ignore))


def all_null_count(df: DataFrame, ignore: Iterable[str] = LOAD_COLUMNS) -> DataFrame:
    return df.agg(F.count_if(is_all_null(df, ignore)).alias("all_null_rows"))


def null_key_column(table: str, columns: Iterable[str]) -> str | None:
    """The column that must be set: ``id`` for listing and review tables, else ``listing_id``
    for review tables without one."""
    have = set(columns)
    if table.endswith("listing"):
        return "id" if "id" in have else None
    if table.endswith(("reviews", "review")):
        return next((c for c in ("id", "listing_id") if c in have), None)
    return None


def drop_null_key(df: DataFrame, table: str) -> DataFrame:
    key = null_key_column(table, df.columns)
    return df if key is None else df.where(F.col(key).isNotNull())


def drop_null(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop(subset=list(subset))


def last_window(df: DataFrame, ts: str, length: str = "1 day") -> DataFrame:
    """Rows of the half-open slice ``[newest - length, newest)``; the newest row is not in it.

    The newest timestamp is a scalar subquery over that one column, so nothing passes through
    the driver program.
    """
    newest = df.agg(F.max(ts)).scalar()
    return df.where((F.col(ts) >= newest - F.expr(f"INTERVAL {length}")) & (F.col(ts) < newest))
