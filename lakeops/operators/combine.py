"""Unions, counts of several tables, and joins between them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count. All tables are counted in one stage, each task by table."""
    names = list(frames)
    rows = union_all(df.select(F.lit(k).alias("_table")) for k, df in enumerate(frames.values()))
    counts = rows.groupBy("_table").agg(F.count(F.lit(1)).alias("_rows"))
    listed = rows.sparkSession.createDataFrame(list(enumerate(names)), "_table int, table_name string")
    return listed.join(counts, "_table", "left").select("table_name", F.coalesce("_rows", F.lit(0)).alias("row_count"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of the child that no parent row has, with the number of child rows.

    The child is counted per key before the join, so a key held by a third of all rows crosses
    the shuffle as one row per task.
    """
    keys = (
        child.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def top_by_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The parent row with most child rows, with ``child_rows``; the lowest key wins a tie.

    Counting comes first, then the join: the parent meets one row per key.
    """
    counts = child.groupBy(F.col(key).alias(parent_key)).agg(F.count(F.lit(1)).alias("child_rows"))
    return parent.join(counts, parent_key).orderBy(F.desc("child_rows"), F.asc(parent_key)).limit(1)
