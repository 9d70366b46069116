"""Points, grid cells and their zoom levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def geo_points(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """Price and place of the first n rows by key."""
    return df.orderBy(key).limit(n).select("price", "latitude", "longitude")


def _placed(df: DataFrame) -> DataFrame:
    """Rows with a place: a null, NaN or infinite coordinate is none."""
    sure = [F.abs(F.col(c).cast("double")) < float("inf") for c in ("latitude", "longitude")]
    return df.where(sure[0] & sure[1])  # not true for NaN either, which is above all numbers


def _price(price: str) -> Column:
    """NaN is a gap."""
    return F.nanvl(F.col(price).cast("double"), F.lit(None))


def geo_grid(df: DataFrame, per_degree: int, price: str = "price_num") -> DataFrame:
    """Cells of 1/per_degree degrees: points, centre of the points, mean price. Points without a place
    are left out, gaps in prices too."""
    return (
        _placed(df)
        .groupBy(
            F.floor(F.col("latitude") * per_degree).alias("cell_lat"),
            F.floor(F.col("longitude") * per_degree).alias("cell_lon"),
        )
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.avg("latitude").alias("lat"),
            F.avg("longitude").alias("lon"),
            F.avg(_price(price)).alias("avg_price"),
        )
    )


def geo_pyramid(df: DataFrame, levels: int, per_degree: int = 1, price: str = "price_num") -> DataFrame:
    """``geo_grid`` for every zoom level at once: level z has cells of 1/(per_degree * 2^z) degrees, z from 0.

    The rows are grouped once, into the finest cells. Four cells of a level make one of the level above, so
    every other level is summed from the counts of the finest one. Amounts are summed as decimals, so
    that a centre does not depend on the order of the rows.
    """
    finest = levels - 1
    scale = per_degree << finest
    exact = lambda c: F.sum(c.cast("decimal(28,10)"))
    cells = _placed(df).groupBy(
        F.floor(F.col("latitude") * scale).alias("_lat"), F.floor(F.col("longitude") * scale).alias("_lon")
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        exact(F.col("latitude")).alias("_y"),
        exact(F.col("longitude")).alias("_x"),
        exact(_price(price)).alias("_p"),
        F.count(_price(price)).alias("_priced"),
    )
    each = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(finest))))
    return (
        each.groupBy(
            "level",
            F.expr(f"shiftright(_lat, {finest} - level)").alias("cell_lat"),
            F.expr(f"shiftright(_lon, {finest} - level)").alias("cell_lon"),
        )
        .agg(*[F.sum(c).alias(c) for c in ("_n", "_y", "_x", "_p", "_priced")])
        .select(
            "level",
            "cell_lat",
            "cell_lon",
            F.col("_n").alias("cnt"),
            (F.col("_y").cast("double") / F.col("_n")).alias("lat"),
            (F.col("_x").cast("double") / F.col("_n")).alias("lon"),
            F.try_divide(F.col("_p").cast("double"), F.col("_priced")).alias("avg_price"),
        )
    )
