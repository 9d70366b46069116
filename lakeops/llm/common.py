"""Helpers the operators share: scratch tables, inputs, Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read from there.

    Cuts the lineage and computes the rows once. A lost executor loses nothing: the files lie in the
    folder that ``spark.checkpoint.dir`` names. They stay there; the folder is the cluster's to clear.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this library, once for each application: they run its functions."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="lakeops-")) / f"{home.name}.zip"  # served to executors by the driver
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def inputs(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; extra columns cannot clash."""
    ship(df.sparkSession)
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node reachable.

    Alternating large-star and small-star rounds. A node's neighbours are reduced to their minimum
    before they are joined, so a hub is one row a task; each round is saved. Rounds grow with the
    logarithm of the longest path, not with the size of a component.
    """
    arcs = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    while True:
        arcs = saved(arcs, label)
        seen = arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return arcs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                arcs.select("v", "v").distinct()
            )
        state = seen
        both = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        arcs = hooked.union(low.select("u", F.col("m").alias("v"))).distinct()
