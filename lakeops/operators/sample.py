"""Repeatable samples and splits: decided by a hash of the key, never by partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.ids import key_hash


#: Slices of the hash range whose rows are counted, and parts that the rows of one slice are first cut into.
SLICES, PARTS = 1 << 20, 256


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows in the given order. Each input task sends its k best rows on, to one task."""
    return df.orderBy(*order).limit(k)


def latest(df: DataFrame, ts: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The k rows with the newest timestamp; ``tie`` columns settle equal timestamps."""
    return top_k(df, [F.desc(ts), *[F.asc(c) for c in tie]], k)


def sample_k(df: DataFrame, key: Sequence[str], k: int, seed: int | None = None) -> DataFrame:
    """Exactly k rows (or all, if fewer): those with the lowest key hash, then the lowest key.

    One pass counts the rows of each slice of the hash range and finds the slice that completes k. All rows
    of the slices before it stay, by a filter; of that slice, as many as are wanting. A key of a third of
    the rows fills its slice: the slice is cut by a hash of the whole row, each part is ordered and k rows
    of it go on at most.
    """
    width = (1 << 32) // SLICES
    hashed = df.withColumn("_h", key_hash(*key, seed=seed)).withColumn("_s", F.floor(F.col("_h") / width))
    counts = hashed.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    reached = counts.withColumn("_end", F.sum("_n").over(Window.orderBy("_s")))
    # the slice that completes k, and the rows before it; without one, all rows stay
    cut = reached.where(F.col("_end") >= k).agg(F.min(F.struct("_s", (F.col("_end") - F.col("_n")).alias("before")))).scalar()
    whole = hashed.where(F.coalesce(F.col("_s") < cut["_s"], F.lit(True)))
    # floats hash alike, whatever their zeros and NaN; columns that cannot be hashed leave equal keys together
    parts = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind], F.lit(1)), F.lit(PARTS))
    last = hashed.where(F.col("_s") == cut["_s"]).withColumn("_p", parts)
    place = F.row_number().over(Window.partitionBy("_p").orderBy("_h", *key))
    some = last.withColumn("_place", place).where(F.col("_place") <= k)
    place = F.row_number().over(Window.partitionBy("_s").orderBy("_h", *key))
    rest = some.withColumn("_place", place).where(F.col("_place") <= k - cut["before"])
    return whole.select(*df.columns).unionByName(rest.select(*df.columns))


def with_split(
    df: DataFrame, key: Sequence[str], weights: Sequence[int] = (70, 15, 15),
    names: Sequence[str] = ("train", "val", "test"), seed: int | None = None,
) -> DataFrame:
    """Add ``split``. Weights are percent and sum to 100; rows with equal keys stay together."""
    if sum(weights) != 100:
        raise ValueError("weights must sum to 100")
    bucket = key_hash(*key, seed=seed) % 100
    edge, choice = 0, None
    for weight, name in zip(weights, names):
        edge += weight
        choice = (F if choice is None else choice).when(bucket < edge, name)
    return df.withColumn("split", choice)


def split(
    df: DataFrame, key: Sequence[str], weights: Sequence[int] = (70, 15, 15), seed: int | None = None
) -> list[DataFrame]:
    """One frame per weight; together they hold every row once."""
    names = [f"s{i}" for i in range(len(weights))]
    tagged = with_split(df, key, weights, names, seed)
    return [tagged.where(F.col("split") == n).drop("split") for n in names]
