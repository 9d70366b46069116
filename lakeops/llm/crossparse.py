"""Language identification by cross-parsing entropy.

Each language has the suffix automaton of a bounded sample of its labelled texts. A text is parsed from left
to right into the longest strings that occur in the sample; the language that needs the fewest phrases,
each weighted with the bits of a place in its sample, wins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, slices

#: Labelled texts of a language that the sample draws on, chosen by the hash of the text.
SAMPLE_TEXTS = 256
#: Bytes of a language's sample; every chosen text gives an equal share.
SAMPLE_BYTES = 65_536
#: Bytes of text that a task parses side by side.
BATCH_BYTES = 16_000_000
#: With fewer texts left side by side than this, each is parsed for itself.
NARROW = 96

_BREAK = 0
_SPACES = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def normal(text: str) -> bytes:
    """Lower-case UTF-8; ASCII characters but letters are spaces, one between words and one at each end."""
    words = text.lower().encode("utf-8", "replace").translate(_SPACES).split()
    return b" %b " % b" ".join(words)


def excerpt(text: bytes, share: int, at: int) -> bytes:
    """``share`` bytes of the text from a place that ``at`` sets; the whole text if it is shorter."""
    start = at % max(1, len(text) - share + 1)
    return text[start : start + share]


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS, size: int = SAMPLE_BYTES
) -> list[tuple[str, bytes, int]]:
    """Language, sample and number of labelled rows of each language, ready for `identify`.

    Rows with null text or language or without letters teach nothing. A text that many rows hold is one text. At
    most ``texts`` texts of a language are fetched and ``size`` bytes kept, whatever the table; the choice
    depends on the texts alone.
    """
    rows = inputs(docs, text=text_col, lang=lang_col).where("lang is not null").where(has_letter())
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = rows.groupBy("lang", "h").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts).select("lang", "h")
    sizes = {r.lang: r.n for r in keys.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    found = rows.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = max(1, size // texts)
        for some in slices(batches):
            pieces = [excerpt(normal(t), share, h) for t, h in zip(some.column("text").to_pylist(), some.column("h").to_pylist())]
            yield pa.RecordBatch.from_arrays([some.column("lang"), some.column("h"), pa.array(pieces, pa.binary())], ["lang", "h", "piece"])

    samples: dict[str, list] = {}
    for r in sorted(found.mapInArrow(cut, "lang string, h long, piece binary").collect(), key=lambda r: (r.lang, r.h)):
        samples.setdefault(r.lang, []).append(bytes(r.piece))
    return [(lang, bytes([_BREAK]).join(pieces), sizes[lang]) for lang, pieces in samples.items()]


def has_letter():
    return F.col("text").rlike(r"\p{L}")


@functools.lru_cache(64)
def automaton(sample: bytes) -> tuple[int, np.ndarray]:
    """States and edges (state, byte, next state) of the suffix automaton; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sample:
        new, p = len(edges), last
        edges.append({}), link.append(0), length.append(length[last] + 1)
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] > length[p] + 1:
                twin = len(edges)
                edges.append(edges[q].copy()), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = q = twin
            link[new] = q
        last = new
    rows = [(s, c, t) for s, out in enumerate(edges) for c, t in out.items() if c != _BREAK]
    return len(edges), np.array(rows, np.int32).reshape(-1, 3)


def parser(sample: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns of bytes, steps, and the entry at which a parse starts.

    ``steps[entry + column]`` is twice the next entry, plus one if a phrase starts with this byte. A byte that
    the sample lacks is a phrase; the state after it has no edges, like the first one.
    """
    states, edges = automaton(sample)
    known = np.unique(edges[:, 1])
    width = len(known) + 1
    columns = np.full(256, width - 1, np.int64)
    columns[known] = np.arange(len(known))
    afresh = np.full(width, states * width, np.int32)
    first = edges[edges[:, 0] == 0]
    afresh[columns[first[:, 1]]] = first[:, 2] * np.int32(width)
    steps = np.tile(2 * afresh + np.int32(1), (states + 1, 1))
    steps[edges[:, 0], columns[edges[:, 1]]] = 2 * edges[:, 2] * np.int32(width)
    return columns, steps.ravel(), states * width


def phrases(texts: list[bytes], sample: bytes, narrow: int = NARROW) -> np.ndarray:
    """Number of phrases of each text. All texts go forward together, byte by byte; the longest end alone."""
    columns, steps, start = parser(sample)
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    sorted_sizes, count = sizes[order], np.zeros(len(texts), np.int64)
    if not len(texts):
        return count
    data = columns[np.frombuffer(b"".join(texts[k] for k in order), np.uint8)].astype(np.uint8)
    begins = np.cumsum(sorted_sizes) - sorted_sizes
    entry, at, place = np.full(len(texts), start, np.int32), 0, begins.copy()
    alive = len(texts)
    while True:
        alive = int(np.searchsorted(-sorted_sizes[:alive], -at, "left"))
        if alive < narrow:
            break
        until = int(sorted_sizes[alive - 1])
        entry, place, total = entry[:alive], place[:alive], count[:alive]
        for _ in range(at, until):
            found = steps.take(entry + data.take(place))
            total += found & 1
            entry = found >> 1
            place += 1
        at = until
    view, plain = memoryview(steps), data.tobytes()
    for k in range(alive):
        found, n = 2 * int(entry[k]), int(count[k])
        for c in plain[begins[k] + at : begins[k] + sorted_sizes[k]]:
            found = view[(found >> 1) + c]
            n += found & 1
        count[k] = n
    out = np.empty_like(count)
    out[order] = count
    return out


def verdict(counts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winner (the first, if equal) and its share of the probability, from phrases by language (rows) and text."""
    cost = counts * bits[:, None]
    best = cost.argmin(0)
    return best, 1 / np.exp2(cost.min(0) - cost).sum(0)


def identify(docs: DataFrame, model: list[tuple[str, bytes, int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, n_phrases`` for every row of ``docs``, from its whole text.

    Null texts, texts without a letter, and all texts of an empty model are ``und`` with score 0. The score is
    the language's probability under code lengths of phrases times log2 of the sample's size. Equal costs
    go to the language with more labelled rows, then to the lesser name. Repeated rows are answered each.
    """
    rows = inputs(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    model = sorted(model, key=lambda m: (-m[2], m[0]))
    names = [m[0] for m in model]
    bits = np.array([log2(max(2, len(m[1]))) for m in model])
    rows = rows.select("id", F.when(has_letter(), F.col("text")).alias("text"))

    def flush(ids: list[pa.Array], texts: list[bytes | None]) -> pa.RecordBatch:
        real = [k for k, t in enumerate(texts) if t is not None and names]
        lang, score, n = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        if real:
            own = [texts[k] for k in real]
            counts = np.array([phrases(own, m[1]) for m in model])
            best, share = verdict(counts, bits)
            score[real], n[real] = share, counts[best, np.arange(len(real))]
            for k, b in zip(real, best.tolist()):
                lang[k] = names[b]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), pa.array(lang, pa.string()), pa.array(score), pa.array(n)], ["doc_id", "lang_pred", "score", "n_phrases"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for some in slices(batches):
            ids.append(some.column("id"))
            for t in some.column("text").to_pylist():
                texts.append(None if t is None else normal(t))
                held += len(texts[-1] or b"")
            if held >= BATCH_BYTES:
                yield flush(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield flush(ids, texts)

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_phrases long")
