"""Choosing, renaming, stamping and casting columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.parse import parse_money


def keep(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """The mapped columns under their new names, in mapping order. Columns the frame lacks are
    passed over, so one mapping serves full and reduced copies of a table."""
    have = set(df.columns)
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items() if old in have])


def add_metadata(df: DataFrame, area: str, at: dt.datetime | None = None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else F.lit(at)
    return df.withColumns({"processing_datetime": stamp, "area": F.lit(area)})


def add_load_timestamp(df: DataFrame, at: dt.datetime) -> DataFrame:
    """One literal per load; the moment is an argument so that a load can be repeated."""
    return df.withColumn("load_timestamp", F.lit(at))


def with_city(df: DataFrame, city: str) -> DataFrame:
    return df.withColumn("city", F.lit(city))


def occupancy_365(available_days: str = "availability_365") -> Column:
    return F.lit(1.0) - F.col(available_days).cast("double") / F.lit(365.0)


def with_occupancy(df: DataFrame) -> DataFrame:
    """Yearly occupancy, where the frame has the days available and no occupancy yet."""
    if "availability_365" not in df.columns or "occ_rate_365" in df.columns:
        return df
    return df.withColumn("occ_rate_365", occupancy_365())


def with_price(df: DataFrame) -> DataFrame:
    """Numeric price, where the frame has a price text and no numeric price yet."""
    if "price" not in df.columns or "price_num" in df.columns:
        return df
    return df.withColumn("price_num", parse_money("price"))


def cast_all(df: DataFrame, cols: Iterable[str], dtype: str = "double") -> DataFrame:
    """Cast several columns in one projection."""
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols})
