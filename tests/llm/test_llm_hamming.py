import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import hamming
from lakeops.llm.common import table


def plain(rows: list[tuple], is_query, k: int = 5) -> dict:
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in good:
        if is_query(q):
            ranked = sorted((-(x @ v) / np.linalg.norm(x) / np.linalg.norm(v), i) for i, v in good if i != q)
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def lists(df) -> dict:
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    vectors = table(spark, f"/root/testdata/{sf}", "embeddings")
    want = plain([(r.vec_id, r.embedding) for r in vectors.collect()], lambda q: q % 50 == 0)
    got = lists(hamming.nearest(vectors, "vec_id % 50 = 0", sample=300 if sf == "sf0.01" else 1000))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    for q in want:
        exact = dict(plain([(r, v) for r, v in []], bool) or want[q])
        for i, s in got[q]:
            assert i not in exact or s == pytest.approx(exact[i], abs=1e-12)


def test_every_code_within_the_radius_is_found(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64))
    codes = hamming.learn(x)
    own = codes.of(x)
    frame = spark.createDataFrame([(k, v.tolist(), [k]) for k, v in enumerate(x)], "id long, vector array<double>, members array<long>")
    index = hamming._index(frame, codes)
    for radius, bucket in ((11, 50_000), (21, 3), (64, 20)):
        found = hamming.found_within(index, frame.where("id < 20"), hamming.Codes(codes.mean, codes.projection, radius, x[:0]), radius, 400, bucket)
        got = sorted((r.query, r.id) for r in found.collect())
        want = sorted((q, i) for q in range(20) for i in range(300) if int(own[q] ^ own[i]).bit_count() <= radius)
        assert got == want


def test_substring_radii_leave_no_gap():
    for radius in range(65):
        own = hamming.shares(radius)
        # the least sum of distances that misses every substring
        assert sum(r + 1 for r in own) > radius


def test_copies_ties_and_rows_that_take_no_part(spark):
    bad = [(900, None), (950, [0.0, 0.0, 0.0]), (1000, [1.0, None, 0.0]), (1050, [float("nan"), 1.0, 0.0]), (1100, [float("inf"), 0.0, 0.0]), (1150, [1.0, 2.0])]
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300, 10)] + [(5, [1.0, 2.0, 2.9]), (15, [-1.0, 0.0, 0.5]), (None, [1.0, 2.0, 3.0])] + bad
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "code", "part", "value", "query")})
    got = lists(hamming.nearest(frame, "vec_id % 50 = 0"))
    want = plain([(i, None if v is None else [None if a is None else float(np.float32(a)) for a in v]) for i, v in rows if v is None or len(v) == 3], lambda q: q % 50 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert got[0][0] == (10, pytest.approx(1.0))


def test_few_candidates_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [-1.0, 0.0])], kind)
    assert {q: [i for i, _ in v] for q, v in lists(hamming.nearest(frame, "vec_id % 50 = 0")).items()} == {0: [50, 3], 50: [0, 3]}
    assert hamming.nearest(spark.createDataFrame([], kind), "vec_id % 50 = 0").count() == 0
    assert hamming.nearest(spark.createDataFrame([(0, [1.0])], kind), "vec_id % 50 = 0").count() == 0
    assert hamming.nearest(frame, "vec_id = 7").count() == 0


@pytest.mark.parametrize("times", [1, 2, 7])
def test_repeated_rows_count_once(spark, times):
    rng = np.random.default_rng(9)
    once = [(i, rng.normal(size=8).round(3).tolist()) for i in range(40, 60)] + [(60, [1.0] * 8), (61, [1.0] * 8), (100, [1.0] * 8)]
    frame = spark.createDataFrame(once * times + [once[10]] * 9, "vec_id long, embedding array<double>")
    want = plain(once, lambda q: q % 50 == 0)
    got = lists(hamming.nearest(frame, "vec_id % 50 = 0"))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(len(v) == 5 for v in got.values()) and [i for i, _ in got[100]][:2] == [60, 61]
