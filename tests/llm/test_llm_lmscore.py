import math
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, prose
from pyspark.sql import functions as F

from lakeops.llm import lmscore
from lakeops.llm.common import table


def plain(texts: dict, chosen: set) -> dict:
    split = {d: (t or "").lower().encode().split() for d, t in texts.items()}
    models = []
    for own in (split, {d: w for d, w in split.items() if d in chosen}):
        models.append((Counter(w for ws in own.values() for w in ws), Counter(p for ws in own.values() for p in zip(ws, ws[1:]))))
    size = max(1, len(models[0][0]))

    def entropy(ws, uni, bi):
        total, n = 0.0, sum(uni.values())
        for k, w in enumerate(ws):
            v = ws[k - 1] if k else None
            if not n:
                p = 1 / size
            elif v is not None and uni[v]:
                p = 0.6 * bi[v, w] / uni[v] + 0.3 * uni[w] / n + 0.1 / size
            else:
                p = 0.9 * uni[w] / n + 0.1 / size
            total -= math.log(p)
        return total / len(ws)

    return {d: (entropy(ws, *models[1]), entropy(ws, *models[0])) if ws else None for d, ws in split.items()}


def scored(df) -> dict:
    return {r.doc_id: r for r in df.collect()}


def test_blocks_hold_what_was_packed():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        key = np.sort(rng.integers(0, 1 << 56, n, dtype=np.uint64))
        counts = [rng.integers(0, 2**32, n), rng.integers(0, 3, n)]
        got = lmscore.unpack(lmscore.pack(key, *counts), 2)
        assert [x.tolist() for x in got] == [key.tolist(), *(c.tolist() for c in counts)]


@pytest.mark.parametrize("batch_chars, range_chars", [(20_000, 50_000), (20_000, 10**9), (24_000_000, 10_000)])
def test_against_plain_counting(spark, batch_chars, range_chars):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    chosen = docs.where("doc_id % 3 = 0").select("doc_id")
    got = scored(lmscore.cross_entropy_difference(docs, chosen, batch_chars=batch_chars, range_chars=range_chars))
    want = plain({r.doc_id: r.text for r in docs.collect()}, {r.doc_id for r in chosen.collect()})
    assert got.keys() == want.keys()
    for d, (target, background) in want.items():
        assert (got[d].ce_target, got[d].ce_background) == pytest.approx((target, background), abs=1e-9)
        assert got[d].score == pytest.approx(target - background, abs=1e-9)


def test_nulls_empty_texts_and_unknown_targets(spark):
    texts = {0: "A b\ta B", 1: None, 2: "  ", 3: "b", 4: prose(1, 20_000), 5: "c c"}
    docs = documents(spark, list(texts.values()))
    for ids in ([], [77], [0, 0, None, 77], [0, 1, 2, 3, 4, 5]):
        target = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
        got = scored(lmscore.cross_entropy_difference(docs, target))
        want = plain(texts, set(ids))
        for d in texts:
            if want[d] is None:
                assert got[d].score is None and got[d].ce_target is None and got[d].n_words == 0
            else:
                assert (got[d].ce_target, got[d].ce_background) == pytest.approx(want[d], abs=1e-9)


def test_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, ["a b", "a b", "c"], ids=[1, 1, None])
    target = spark.createDataFrame([(1,)], "doc_id long")
    got = lmscore.cross_entropy_difference(docs, target).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"]
    ours = [r for r in got if r.doc_id == 1]
    assert ours[0].score == ours[1].score < 0
    assert lmscore.cross_entropy_difference(documents(spark, []), target).count() == 0


def test_closer_text_scores_lower(spark):
    docs = documents(spark, [prose(k, 300) for k in range(20)] + ["other tongue wholly " * 100])
    target = docs.where(F.col("doc_id") < 10).select("doc_id")
    got = scored(lmscore.cross_entropy_difference(docs, target))
    assert max(got[d].score for d in range(10)) < min(got[d].score for d in range(10, 21))
