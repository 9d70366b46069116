"""Documents to packed training data: each stage works on what the one before it has kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``documents``. Decisions are taken for a row, not for an id: a row is named by its id and a hash of its text, so
rows without an id, and rows that share one, are judged by their own texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import packing, simhash, spans, tiling, toxicity
from lakeops.llm.common import saved, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if it is toxic to any degree with this probability or more.
TOXIC = 0.5


#: Stands for the id of rows without one: they come after all others.
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with ``key``: id (rows without one last) and hash of the text, neither ever null."""
    name = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(*COLUMNS, F.struct(name.alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")).alias("key"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The keyed documents whose key is not in ``gone``."""
    return docs.join(gone.select("key").distinct(), "key", "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model holds to be toxic go; with no labelled rows none does."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    named = keyed(docs)
    scored = toxicity.severity(named, model, id_col="key").withColumnRenamed("doc_id", "key")
    return without(named, scored.where(F.col("p_toxic") >= TOXIC)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group one document stays: that of the smallest id, then of the least hash of its text."""
    named = keyed(docs)
    groups = saved(simhash.near_duplicates(named, id_col="key").withColumnRenamed("doc_id", "key"), "groups")
    kept = without(named, groups.where("key <> component_id"))
    # rows of one id and text are the same document
    twice = groups.groupBy("key").count().where("count > 1").select("key")
    single = kept.join(twice, "key", "left_anti")
    return single.union(kept.join(twice, "key", "left_semi").dropDuplicates(["key"])).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of passages that an earlier document holds are cut out; every document stays."""
    named = docs.withColumns({"nameless": F.col("doc_id").isNull(), "doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))})
    cut = spans.without_repeats(named, keep=("lang", "source", "n_chars", "nameless"))
    return cut.select(
        F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"), "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    named = keyed(docs)
    leaks = tiling.contaminated(named, table(spark, sf_dir, "benchmark"), id_col="key").withColumnRenamed("doc_id", "key")
    return without(named, leaks).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and offset of every piece of every document that is left."""
    return packing.best_fit(packing.measured(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substrings", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Fingerprints by majority, learned weights and tiling are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
