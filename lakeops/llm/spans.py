"""Substring deduplication by runs of consecutive sentences.

Every document is cut after sentence ends and before line ends, without loss. For each sentence,
the shortest run that starts there and the shortest run that ends there are hashed; a run holds
``sentences`` sentences and ``words`` words at least, or ``long_words`` words in fewer sentences. With
two sentences and no word floor, any repeated run of several sentences is covered whole by runs inside it, and
so is a single sentence of ``long_words`` words. What is repeated of a sentence without the rest of it stays.
Runs are joined over all documents, and sentences that a run covers which was there before are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved, slices

SENTENCES = 2
WORDS = 0
LONG_WORDS = 50
_CUT = re.compile(r"(?<=[.!?])(?=\s)|(?<!\n)(?=\n)")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def pieces(text: str) -> list[str]:
    """The sentences with the white space before them; joined they are the text. White space is no sentence."""
    out, blank = [], ""
    for p in _CUT.split(text):
        if not p or p.isspace():
            blank += p
        else:
            out.append(blank + p)
            blank = ""
    if blank:
        out[-1:] = ["".join(out[-1:]) + blank]
    return out


def _digests(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces, 64-bit hashes of their words, and how many words each has. White space does not count."""
    parts = pieces(text)
    split = [p.split() for p in parts]
    digest = xxhash.xxh64_intdigest
    return (
        parts,
        np.array([digest(" ".join(w).encode()) for w in split], np.uint64),
        np.array([len(w) for w in split], np.int64),
    )


def runs(counts: np.ndarray, sentences: int = SENTENCES, words: int = WORDS, long_words: int = LONG_WORDS) -> np.ndarray:
    """(first, after last) of the shortest runs from each sentence on and up to each sentence, without repeats."""
    n = len(counts)
    if not n:
        return np.zeros((0, 2), np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(n)
    several = np.maximum(np.searchsorted(total, total[at] + words), at + sentences)
    ends = np.minimum(several, np.searchsorted(total, total[at] + long_words))
    forward = np.stack([at, ends], 1)[ends <= n]
    stop = at + 1
    several = np.minimum(np.searchsorted(total, total[stop] - words, "right") - 1, stop - sentences)
    starts = np.maximum(several, np.searchsorted(total, total[stop] - long_words, "right") - 1)
    backward = np.stack([starts, stop], 1)[starts >= 0]
    return np.unique(np.concatenate([forward, backward]), axis=0)


def run_hashes(digests: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of polynomial hash for each run of sentence hashes, from prefix sums modulo 2**64."""
    out = []
    for base in _MIX:
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(digests), base)]), dtype=np.uint64)
        scrambled = (digests ^ (digests >> np.uint64(29))) * (base ^ np.uint64(0xFF51AFD7ED558CCC))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(scrambled * power[:-1], dtype=np.uint64)])
        # lifted to a common power, so that equal runs at different places agree
        first, after = spans[:, 0], spans[:, 1]
        h = (prefix[after] - prefix[first]) * _inverse(base, len(digests))[first] + (after - first).astype(np.uint64)
        h ^= h >> np.uint64(32)
        out.append(h * np.uint64(0xD6E8FEB86659FD93))
    return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _inverse(base: np.uint64, n: int) -> np.ndarray:
    """Powers of the inverse of ``base`` modulo 2**64."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)


def span_rows(docs: DataFrame, sentences: int, words: int, long_words: int) -> DataFrame:
    """``doc_id, t, first, after, h, g, again``: the runs of each row's text and their hashes.

    ``t`` is the hash of the text: id and text together name a document. ``again``: the same run was earlier in
    the same text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            owner, found = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                _, digests, counts = _digests(text)
                spans = runs(counts, sentences, words, long_words)
                if not len(spans):
                    continue
                h, g = run_hashes(digests, spans)
                order = np.lexsort((spans[:, 0], g, h))
                again = np.zeros(len(spans), bool)
                again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] == g[order[:-1]])
                owner.append(np.full(len(spans), k))
                found.append((spans[:, 0].astype(np.int32), spans[:, 1].astype(np.int32), h, g, again))
            if not owner:
                continue
            columns = [np.concatenate(c) for c in zip(*found)]
            rows = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("t").take(rows), *map(pa.array, columns)],
                ["doc_id", "t", "first", "after", "h", "g", "again"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, t long, first int, after int, h long, g int, again boolean")


def repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: int = SENTENCES,
    words: int = WORDS,
    long_words: int = LONG_WORDS,
) -> DataFrame:
    """``doc_id, t, first, after``: the sentence runs that an earlier document holds, or the same one earlier.

    Rows with a null id or text have none. Rows of one id with one text are one document; rows of one id with
    different texts are documents of their own, the one with the lesser hash ``t`` of the text first. Counting
    comes before joining: a run that a third of all documents hold is one counted row a task.
    """
    rows = inputs(docs, doc_id=id_col, text=text_col).dropna().withColumn("t", F.xxhash64("text"))
    spans = saved(span_rows(rows, sentences, words, long_words), "spans")
    shared = (
        spans.where("not again").groupBy("h", "g")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.min("t").alias("t_low"), F.max("t").alias("t_high"))
        .where("owner <> last or t_low <> t_high").drop("last", "t_low", "t_high")
    )
    columns = ("doc_id", "t", "first", "after")
    held = spans.where("not again").join(shared, ["h", "g"])
    elsewhere = held.where("doc_id <> owner").select(*columns)
    # ids with several texts, if there are any: within the first id too, one text keeps a run
    several = rows.groupBy("doc_id").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low <> high")
    several = saved(several.select("doc_id"), "shared-ids")
    own = held.where("doc_id = owner").join(several, "doc_id", "left_semi")
    keeper = own.groupBy("h", "g").agg(F.min("t").alias("kept"))
    later = own.join(keeper, ["h", "g"]).where("t <> kept").select(*columns)
    return elsewhere.union(later).union(spans.where("again").select(*columns))


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: int = SENTENCES,
    words: int = WORDS,
    long_words: int = LONG_WORDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, text, n_removed`` for every row, and the columns ``keep`` unchanged.

    ``text`` is the row's text without the sentences that ``repeated`` covers. What is left keeps its white
    space and order; a text of which nothing is left is empty, null stays null. Untouched texts, and those of
    rows with a null id, are returned as they are.
    """
    gone = (
        repeated(docs, id_col, text_col, sentences, words, long_words)
        .groupBy("doc_id", "t").agg(F.collect_set(F.struct("first", "after")).alias("gone"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts, lists = batch.column("text"), batch.column("gone").to_pylist()
            left, removed = texts.to_pylist() if any(lists) else None, np.zeros(batch.num_rows, np.int32)
            for k, gaps in enumerate(lists):
                if gaps and left[k] is not None:
                    parts = pieces(left[k])
                    edges = np.zeros(len(parts) + 1, np.int64)
                    for gap in gaps:
                        edges[gap["first"]] += 1
                        edges[gap["after"]] -= 1
                    hidden = np.cumsum(edges)[:-1] > 0
                    removed[k] = hidden.sum()
                    left[k] = "".join(p for p, h in zip(parts, hidden.tolist()) if not h).lstrip()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), texts if left is None else pa.array(left, pa.string()), pa.array(removed),
                    *(batch.column(c) for c in keep),
                ],
                ["doc_id", "text", "n_removed", *keep],
            )

    rows = inputs(docs, doc_id=id_col, text=text_col, **{c: c for c in keep})
    named = gone.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "gone")
    rows = rows.join(named, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_t")), "left").drop("_id", "_t")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, n_removed int" + (f", {kinds}" if keep else "")
    return rows.mapInArrow(run, schema).select("doc_id", "text", "n_removed", *keep)
