"""Severity of toxic text by cumulative-link ordinal regression on sparse word counts.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector for all ordered thresholds t_1 < t_2 < ..;
the expected severity is the sum of these over k. x holds log(1 + count) of the chosen features: words,
and the first letters of longer words, which compounds and inflected forms share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved, slices

WORD = re.compile(r"\w+")
#: Letters of a prefix, which longer words count for.
PREFIX = 4
#: Labelled rows the model is fitted on, at most, and features it may weigh, at most.
MAX_TRAIN = 20_000
MAX_FEATURES = 512
#: A word is weighed if it is in so many sampled texts and its log odds are so many deviations from even.
MIN_DOCS = 3
MIN_Z = 2.5
#: Deviations from which a word counts as a mark of toxic text when grades are made from 0/1 labels.
MARK_Z = 3.0
GRADES = 3


@dataclass(frozen=True)
class OrdinalModel:
    words: tuple[str, ...]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """Row for each score, column k: probability of grade k + 1 or more."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(np.asarray(self.thresholds)[None, :] - score[:, None]))


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def features(found: list[str]) -> list[str]:
    """The words, and ``abcd*`` for every word that starts so and goes on."""
    return found + [w[:PREFIX] + "*" for w in found if len(w) > PREFIX]


def labelled_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, toxic, counts`` of at most ``max_train`` labelled documents, chosen by a hash of the id.

    Rows with a null id or label are left out; a null text counts as empty. The sample is what is
    broadcast, so its bound is the broadcast's bound. Several labels of one id: toxic if any is; of several
    rows of one id, one is taken.
    """
    marks = (
        inputs(labels, doc_id="doc_id", toxic="toxic").dropna()
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = max_train / max(marks.count(), 1)
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    marks = marks.where(spot < int(min(share, 1.0) * (1 << 30)) + 1).orderBy(spot, "doc_id").limit(max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.int32())
        for batch in slices(batches):
            counts = [list(Counter(features(words(t))).items()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(counts, kind)], ["doc_id", "toxic", "counts"]
            )

    rows = inputs(docs, doc_id="doc_id", text="text").join(F.broadcast(marks), "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.select("doc_id", "toxic", "text").mapInArrow(run, f"doc_id {kind}, toxic int, counts map<string,int>")
    # of an id's rows the same one whatever the order of tasks
    first = F.min_by("counts", F.struct(F.size("counts"), F.to_json("counts"))).alias("counts")
    return counted.groupBy("doc_id", "toxic").agg(first)


def word_odds(sample: DataFrame, positive: str, min_docs: int = MIN_DOCS) -> DataFrame:
    """``word, z``: log odds of a word's document frequency in positive rows, in standard deviations."""
    sizes = sample.agg(F.sum(F.expr(positive).cast("int")).alias("p"), F.count("*").alias("n")).first()
    yes, no = (sizes.p or 0), sizes.n - (sizes.p or 0)
    in_yes = F.sum(F.expr(positive).cast("int"))
    return (
        sample.select("*", F.explode(F.map_keys("counts")).alias("word"))
        .groupBy("word").agg(in_yes.alias("a"), F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
        .withColumn("b", F.col("n") - F.col("a"))
        .withColumn(
            "odds",
            F.log((F.col("a") + 0.5) / (yes - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (no - F.col("b") + 0.5)),
        )
        .withColumn("spread", F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5)))
        .select("word", (F.col("odds") / F.col("spread")).alias("z"))
    )


def graded(sample: DataFrame, grades: int = GRADES, max_features: int = MAX_FEATURES) -> DataFrame:
    """Adds ``grade``: 0 for rows that are not toxic, 1 to ``grades`` for toxic ones.

    The labels are 0/1, so the grades of toxic rows are made: cut at equal shares by how many words
    the text holds that mark toxic text.
    """
    marks = _first_words(word_odds(sample, "toxic = 1").where(F.col("z") >= MARK_Z), max_features)
    total = F.aggregate("n", F.lit(0), lambda a, b: a + b)
    hits = _counts_of(sample, marks).select("doc_id", total.alias("hits"))
    rows = sample.join(hits, "doc_id", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    shares = [k / grades for k in range(1, grades)]
    cuts = rows.where("toxic = 1").agg(F.percentile_approx("hits", shares, 10_000).alias("c")).first().c or []
    above = sum((F.col("hits") > c).cast("int") for c in cuts) if cuts else F.lit(0)
    return rows.select("doc_id", "toxic", "counts", F.when(F.col("toxic") == 1, above + 1).otherwise(0).alias("grade"))


def _first_words(odds: DataFrame, most: int) -> list[str]:
    """The ``most`` words with the largest odds, ties in order of the words."""
    return [r.word for r in odds.orderBy(F.desc(F.abs("z")), "word").limit(most).collect()]


def _counts_of(sample: DataFrame, chosen: list[str]) -> DataFrame:
    """``doc_id, at, n`` for every text: places in ``chosen`` of the features it holds, and their counts."""
    place = {w: k for k, w in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in slices(batches):
            held = [[(place[w], c) for w, c in row if w in place] for row in batch.column("counts").to_pylist()]
            at, n = ([[pair[side] for pair in row] for row in held] for side in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(at, kind), pa.array(n, kind)], ["doc_id", "at", "n"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    return sample.select("doc_id", "counts").mapInArrow(run, f"doc_id {kind}, at array<int>, n array<int>")


def fit(sample: DataFrame, grades: int = GRADES, max_features: int = MAX_FEATURES, l2: float = 1e-4, steps: int = 400) -> OrdinalModel:
    """Fit on ``counts, grade``. The driver gets the chosen words of the bounded sample only.

    Without rows of some grade above 0, every probability of it is 0.
    """
    vocabulary = _first_words(word_odds(sample, "grade > 0").where(F.abs("z") >= MIN_Z), max_features)
    rows = sample.select("doc_id", "grade").orderBy("doc_id").toArrow()
    found = _counts_of(sample, vocabulary).toArrow()
    grade = rows.column("grade").to_numpy().astype(np.int64)
    owner = pc.index_in(found.column("doc_id"), value_set=rows.column("doc_id").combine_chunks()).to_numpy()
    row = np.repeat(owner.astype(np.int64), pc.list_value_length(found.column("at")).to_numpy())
    col, n = (pc.list_flatten(found.column(c)).to_numpy() for c in ("at", "n"))
    order = np.lexsort((col, row))
    row, col, val = row[order], col[order].astype(np.int64), np.log1p(n[order].astype(np.float64))
    weights, thresholds = descend(grade, row, col, val, len(vocabulary), grades, l2, steps)
    return OrdinalModel(tuple(vocabulary), tuple(weights.tolist()), tuple(thresholds.tolist()))


def loss(params: np.ndarray, grade, row, col, val, width: int, grades: int, l2: float) -> tuple[float, np.ndarray]:
    """Mean negative log likelihood with ridge, and its gradient.

    ``params``: the weights, the first threshold, and the logarithms of the steps to the next ones.
    """
    n, w = len(grade), params[:width]
    gaps = np.exp(params[width + 1 :])
    cuts = params[width] + np.concatenate([[0.0], np.cumsum(gaps)])
    score = np.bincount(row, val * w[col], minlength=n) if len(row) else np.zeros(n)
    above = np.concatenate(
        [np.ones((n, 1)), 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -500, 500))), np.zeros((n, 1))], axis=1
    )
    i = np.arange(n)
    p = np.maximum(above[i, grade] - above[i, grade + 1], 1e-12)
    slope = above * (1 - above)
    up, down = slope[i, grade] / p, slope[i, grade + 1] / p  # of the two bounds of each row's grade
    by_cut = np.zeros(grades + 2)
    np.add.at(by_cut, grade, up)
    np.add.at(by_cut, grade + 1, -down)
    g_cut = by_cut[1 : grades + 1] / n
    g_w = np.bincount(col, val * (down - up)[row], minlength=width) / n if len(row) else np.zeros(width)
    tail = np.cumsum(g_cut[::-1])[::-1]
    gradient = np.concatenate([g_w + l2 * w, tail[:1], tail[1:] * gaps])
    return float(-np.log(p).mean() + l2 / 2 * (w @ w)), gradient


def descend(grade, row, col, val, width: int, grades: int, l2: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds after ``steps`` of Adam from zero weights."""
    seen = int(grade.max(initial=0))
    if seen == 0:
        return np.zeros(width), np.full(grades, np.inf)
    params = np.concatenate([np.zeros(width), [0.0], np.zeros(seen - 1)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, steps + 1):
        _, g = loss(params, grade, row, col, val, width, seen, l2)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        params = params - 0.1 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-9)
    cuts = params[width] + np.concatenate([[0.0], np.cumsum(np.exp(params[width + 1 :]))])
    return params[:width], np.concatenate([cuts, np.full(grades - seen, np.inf)])


def severity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, severity, grade, p_toxic`` of every row, from its whole text.

    ``severity`` is the expected grade, ``grade`` the likeliest (ties to the lower), ``p_toxic`` the
    probability of any grade above 0. Null texts count as empty. Rows of one id are each scored.
    The model is at most ``MAX_FEATURES`` words.
    """
    weigh = dict(zip(model.words, model.weights))
    starts = {f[:-1] for f in weigh if f.endswith("*")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = []
            for text in batch.column("text").to_pylist():
                own = words(text)
                found = Counter(w for w in own if w in weigh)
                found.update([w[:PREFIX] + "*" for w in own if w[:PREFIX] in starts and len(w) > PREFIX])
                scores.append(sum(weigh[w] * np.log1p(c) for w, c in sorted(found.items())))
            above = model.at_least(np.array(scores, np.float64))
            steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            grade = np.argmax(steps[:, :-1] - steps[:, 1:], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(grade), pa.array(above[:, 0])],
                ["doc_id", "severity", "grade", "p_toxic"],
            )

    rows = inputs(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, severity double, grade int, p_toxic double")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> OrdinalModel:
    """Sample, grade and fit. Without labelled rows, every text has severity 0."""
    sample = saved(labelled_sample(docs, labels, max_train), "toxicity-sample")
    return fit(saved(graded(sample), "toxicity-grades"))
