"""Small frames with what operators must bear: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# names the operators use inside
CLASHES = (
    "code component_id first after h g batch shard size gone word place part value query members vector salt z grade toxic counts "
    "item_id coverage start n_tokens ids_crc32 n_words n_removed bin_id offset piece cluster licence dice score node root a b u v m"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, per_sentence: int = 9) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(words):
        w = "".join(rng.choice(["ta", "ri", "mo", "sel", "un", "ka", "per", "do"]) for _ in range(rng.randint(1, 4)))
        out.append(w + ("." if k % per_sentence == per_sentence - 1 else ""))
    return " ".join(out)


def documents(spark: SparkSession, texts: list, clash: bool = True, ids: list | None = None) -> DataFrame:
    """One row a text, ids from 0 unless given; further columns carry the operators' own names."""
    names = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(names, texts))]
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, x) for x in r))
