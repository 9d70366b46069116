"""Approximate nearest neighbours by multi-index hashing of binary codes.

Vectors become 64-bit codes: the signs after a rotation learned on a bounded sample. Codes are cut
into substrings, and every substring is an index of its own. Two codes within a Hamming radius agree
in some substring up to that substring's share of the radius, so probing all values within the
share finds every code within the radius. What is found is ranked by the cosine of the vectors themselves.

Equal vectors are one entry, with their smallest ids, so a vector that a third of all rows hold is one
candidate. Crowded buckets are split by a hash, and probes visit every part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved

BITS = 64
SUBSTRINGS = 8
WIDTH = BITS // SUBSTRINGS
#: Vectors the rotation and the radius are learned on, at most, and of them those whose neighbours are looked at.
SAMPLE, PROBED = 8_192, 512
#: Share of the sample's true neighbours that the radius reaches.
REACH = 0.99
#: Entries of a bucket that one task holds.
BUCKET = 50_000


@dataclass(frozen=True)
class Codes:
    """Mean, projection to the bits, radius, and the sample of vectors for score bounds."""

    mean: np.ndarray
    projection: np.ndarray
    radius: int
    sample: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = (unit(vectors) - self.mean) @ self.projection > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine in double precision of one vector with each of several."""
    return (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def shares(radius: int) -> list[int]:
    """Radius of each substring: with distances summing to ``radius`` or less, one is within its own."""
    low, more = divmod(radius, SUBSTRINGS)
    return [low if k <= more else low - 1 for k in range(SUBSTRINGS)]


def learn(sample: np.ndarray, k: int = 5, rounds: int = 30, seed: int = 7) -> Codes:
    """Rotation by alternating signs and Procrustes steps on the principal axes; radius from true neighbours."""
    rng = np.random.default_rng(seed)
    x = unit(sample)
    mean = x.mean(axis=0)
    x = x - mean
    dim = x.shape[1]
    if dim >= BITS:
        _, vectors = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(dim))
        axes = vectors[:, ::-1][:, :BITS]
        rotation = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
        y = x @ axes
        for _ in range(rounds):
            u, _, v = np.linalg.svd(y.T @ np.where(y @ rotation > 0, 1.0, -1.0))
            rotation = u @ v
        projection = axes @ rotation
    else:
        projection = np.linalg.qr(rng.normal(size=(BITS, dim)))[0].T
    codes = Codes(mean, projection, BITS, sample)
    own = codes.of(sample)
    probe = rng.permutation(len(sample))[:PROBED]
    scores = unit(sample[probe]) @ unit(sample).T
    scores[np.arange(len(probe)), probe] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(k, len(sample) - 1)]
    apart = np.bitwise_count(own[probe][:, None] ^ own[near])
    radius = int(np.quantile(apart, REACH, method="higher")) if apart.size else BITS
    return Codes(mean, projection, min(radius, BITS), sample)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def _around(value: int, radius: int) -> list[int]:
    """The substring values within ``radius`` bits of ``value``."""
    return [value ^ sum(1 << b for b in bits) for r in range(min(radius, WIDTH) + 1) for bits in combinations(range(WIDTH), r)]


def entries(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``vec_id, h, g`` of every different row that takes part, and one entry ``id, h, g, vector, members`` for each vector.

    Rows without id take no part, nor do vectors that are null, zero, hold null or non-finite components, or
    have another dimension than most. ``members``: the ``k + 1`` smallest ids of the vector, which is all that
    a list of k neighbours can need.
    """
    rows = inputs(vectors, vec_id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & fine & F.exists("vector", lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("vector") == (usual.d if usual else 0))
    rows = rows.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")}).dropDuplicates(["vec_id", "h", "g"])
    order = Window.partitionBy("h", "g").orderBy("vec_id")
    some = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    own = some.groupBy("h", "g").agg(
        F.min("vec_id").alias("id"), F.first("vector").alias("vector"), F.array_sort(F.collect_list("vec_id")).alias("members")
    )
    return rows.select("vec_id", "h", "g"), own


def _index(entry: DataFrame, codes: Codes) -> DataFrame:
    """A row for each entry and substring: ``part, value`` and the entry with its code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = codes.of(_matrix(batch.column("vector"))).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ENTRY), pa.array(own)], [*ENTRY, "code"])

    coded = entry.select(*ENTRY).mapInArrow(run, "id long, vector array<double>, members array<long>, code long")
    parts = F.explode(F.sequence(F.lit(0), F.lit(SUBSTRINGS - 1))).alias("part")
    value = F.expr(f"cast((code >>> (part * {WIDTH})) & {(1 << WIDTH) - 1} as int)")
    return coded.select("*", parts).withColumn("value", value)


ENTRY = ["id", "vector", "members"]


def _probes(queries: DataFrame, codes: Codes, radius: int, k: int) -> DataFrame:
    """A row for each query, substring and value to visit, with the least score that can matter.

    That score is the query's (k + 1)-th best in the sample, whose vectors are all in the index.
    """
    reach = shares(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            own = codes.of(vectors)
            for n in range(batch.num_rows):
                ranked = np.sort(cosine(vectors[n], codes.sample))[::-1]
                least = float(ranked[k]) - 1e-9 if len(ranked) > k else -2.0
                visits = [
                    (p, v)
                    for p, r in enumerate(reach)
                    if r >= 0
                    for v in _around(int(own[n] >> np.uint64(p * WIDTH)) & ((1 << WIDTH) - 1), r)
                ]
                part, value = zip(*visits)
                same = pa.array(np.zeros(len(visits), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(n, 1).take(same), batch.column("vector").slice(n, 1).take(same),
                        pa.array(np.full(len(visits), own[n], np.uint64).view(np.int64)), pa.array([least] * len(visits)),
                        pa.array(part, pa.int32()), pa.array(value, pa.int32()),
                    ],
                    ["id", "vector", "code", "least", "part", "value"],
                )

    return queries.select("id", "vector").mapInArrow(
        run, "id long, vector array<double>, code long, least double, part int, value int"
    )


def found_within(index: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int, bucket: int = BUCKET) -> DataFrame:
    """``query, id, score, members``: of the entries within ``radius`` of each query, those that may be among its best k + 1."""
    reach = shares(radius) if radius < BITS else [WIDTH] + [-1] * (SUBSTRINGS - 1)
    crowd = index.groupBy("part", "value").agg(F.ceil(F.count("*") / bucket).cast("int").alias("salts"))
    crowd = F.broadcast(crowd)  # a row for each substring value: SUBSTRINGS * 2**WIDTH at most
    held = index.join(crowd, ["part", "value"]).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).drop("salts")
    visits = _probes(queries, codes, radius, k).where(F.col("part").isin([p for p, r in enumerate(reach) if r >= 0]))
    visits = visits.join(crowd, ["part", "value"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    def rank(key: tuple, entry: pa.Table, query: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "at": [], "score": []}
        if entry.num_rows and query.num_rows:
            part = key[0].as_py()
            vectors, code = _matrix(entry.column("vector")), entry.column("code").to_numpy().view(np.uint64)
            norms = np.linalg.norm(vectors, axis=1)
            ids = entry.column("id").to_numpy()
            asked, own = _matrix(query.column("vector")), query.column("code").to_numpy().view(np.uint64)
            least = query.column("least").to_numpy()
            for n, name in enumerate(query.column("id").to_pylist()):
                differ = code ^ own[n]
                near = np.flatnonzero(np.bitwise_count(differ) <= radius)
                for p in range(part):  # an earlier substring has found it already
                    if reach[p] >= 0:
                        piece = (differ[near] >> np.uint64(p * WIDTH)) & np.uint64((1 << WIDTH) - 1)
                        near = near[np.bitwise_count(piece) > reach[p]]
                score = (vectors[near] @ asked[n]) / (norms[near] * np.linalg.norm(asked[n]))
                near, score = near[score >= least[n]], score[score >= least[n]]
                best = np.lexsort((ids[near], -score))[: k + 1]
                out["query"] += [name] * len(best)
                out["at"] += near[best].tolist()
                out["score"] += score[best].tolist()
        at = pa.array(out["at"], pa.int64())
        return pa.table({
            "query": pa.array(out["query"], pa.int64()), "id": entry.column("id").take(at),
            "score": pa.array(out["score"], pa.float64()), "members": entry.column("members").take(at),
        })

    bucket_of = ("part", "value", "salt")
    return held.groupBy(*bucket_of).cogroup(visits.groupBy(*bucket_of)).applyInArrow(
        rank, "query long, id long, score double, members array<long>"
    )


def nearest(
    vectors: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of every row for which SQL ``is_query`` holds.

    ``is_query`` is an expression over ``vec_id``. Candidates are all rows but the query's own id; nearness is
    the cosine, ties go to the smaller id. A query that finds fewer than k within the learned radius is asked
    again with the radius of all bits, so only tables of fewer candidates give shorter lists. Ids are whole numbers.

    Rows that repeat an id with its vector count once, as candidates and as queries. An id is meant to have one
    vector: the lists of ids with several, and lists in which these are, have no defined length.
    """
    rows, entry = entries(vectors, k, id_col, vector_col)
    entry = saved(entry, "vectors")
    total = entry.count()
    spot = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))
    chosen = entry.where(spot < int(min(1.0, sample / max(total, 1)) * (1 << 30)) + 1).orderBy(spot, "id").limit(sample)
    chosen = chosen.select("vector").toArrow()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], schema)
    codes = learn(_matrix(chosen.column("vector")) if chosen.num_rows else _matrix(entry.select("vector").limit(1).toArrow().column("vector")), k)
    asked = rows.where(is_query)
    queries = entry.join(asked.select("h", "g").distinct(), ["h", "g"], "left_semi")
    index = saved(_index(entry, codes), "index")
    found = saved(found_within(index, queries, codes, codes.radius, k), "found")
    enough = found.groupBy("query").agg(F.sum(F.size("members")).alias("n")).where(F.col("n") > k)
    short = queries.join(enough.select(F.col("query").alias("id")), "id", "left_anti")
    short = saved(short, "short")
    if codes.radius < BITS and total > 1 and not short.isEmpty():
        again = found_within(index, short, codes, BITS, k)
        found = found.join(short.select(F.col("id").alias("query")), "query", "left_anti").union(again)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    listed = found.select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    names = asked.join(queries.select("h", "g", F.col("id").alias("query")), ["h", "g"])
    pairs = names.select("query", F.col("vec_id").alias("query_id")).join(listed.drop("place"), "query").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").cast("long").alias("vec_id"), "score")
    )
