import random
import zlib

import numpy as np
import pytest
from conftest import SF
from llm_cases import documents, prose
from pyspark.sql import functions as F

from lakeops.llm import crossparse as cp
from lakeops.llm.common import table
from lakeops.llm.suite import LLM


def plain(text: bytes, sample: bytes) -> int:
    """Phrases by looking for every string in the sample."""
    at = n = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        at, n = at + (k if text[at : at + k] in sample else 1), n + 1
    return n


@pytest.mark.parametrize("narrow", [1, 4, 10**9])
def test_phrases_against_search(narrow):
    rng = random.Random(narrow)
    text = lambda n: bytes(rng.choice(b"aab c\xc3") for _ in range(n))
    samples = [b"", b"a", text(300), text(40) + b"\0" + text(40), b"ab" * 50]
    texts = [b"", b"zz", b"a"] + [text(rng.randint(0, 200)) for _ in range(40)] + [b"ab" * 40 + b"z" + b"ab" * 3]
    for s in samples:
        assert cp.phrases(texts, s, narrow).tolist() == [plain(t, s) for t in texts]
    assert cp.phrases([], samples[2], narrow).tolist() == []


def test_separators_never_match():
    assert cp.phrases([b"ab"], b"a\0b", 1).tolist() == [2]


def test_normal_text():
    assert cp.normal("Ab1c,\n  DÉF\t—") == " ab c déf — ".encode()
    assert cp.normal("...") == b"  " and cp.excerpt(b"abcdef", 3, 5) == b"bcd" and cp.excerpt(b"ab", 3, 7) == b"ab"


def test_the_sample_depends_on_the_texts_alone(spark):
    texts = [prose(k, 60) for k in range(30)]
    df = documents(spark, texts)
    once = cp.learn(df, texts=10, size=500)
    again = cp.learn(df.union(df.where("doc_id < 20")).repartition(7, "n_chars"), texts=10, size=500)
    assert [m[:2] for m in once] == [m[:2] for m in again] and once[0][2] == 30 and again[0][2] == 50
    assert len(once[0][1]) == 10 * 50 + 9


def test_odd_rows(spark):
    texts = ["the cat sat", None, "", "12 ?!", "le chat noir", "the cat sat", "the " * 60_000, "日本語"]
    learned = spark.createDataFrame(
        [("the cat and the dog sat", "en"), ("le chat et le chien noir", "fr"), (None, "xx"), ("5", "xx"), ("lost", None)], "text string, lang string"
    )
    model = cp.learn(learned)
    assert [m[0] for m in model] == ["en", "fr"]
    got = {r.doc_id: r for r in cp.identify(documents(spark, texts, ids=[0, 1, 2, 3, 4, 5, 6, None]), model).collect()}
    assert [got[k].lang_pred for k in range(7)] == ["en", "und", "und", "und", "fr", "en", "en"]
    assert [got[k].score for k in (1, 2, 3)] == [0, 0, 0] and got[0] == got[0] and got[0].score == got[5].score
    assert all(0 <= r.score <= 1 for r in got.values()) and got[6].score > 0.99 and got[None].lang_pred == "en"
    empty = cp.learn(learned.where("false"))
    assert empty == [] and {r.lang_pred for r in cp.identify(documents(spark, texts), empty).collect()} == {"und"}
    assert cp.identify(documents(spark, []), model).count() == 0


def test_equal_costs_go_to_the_larger_language():
    best, share = cp.verdict(np.array([[2, 3], [2, 2]]), np.array([10.0, 10.0]))
    assert best.tolist() == [0, 1] and share[0] == 0.5


def test_query_learns_nothing_from_held_out_rows(spark, tmp_path):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in LLM["op13_language_id"].run(spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert rows.keys() == truth.keys() and {d for d, r in rows.items() if r.held_out} == held
    assert sum(rows[d].lang_pred == truth[d] for d in held) >= 0.98 * len(held)
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))).write.parquet(str(tmp_path / "documents.parquet"))
    again = {r.doc_id: r for r in LLM["op13_language_id"].run(spark, str(tmp_path)).collect()}
    assert again == rows


def test_query_against_a_plain_version(spark):
    docs = table(spark, SF, "documents").where("doc_id < 60")
    model = cp.learn(table(spark, SF, "documents").where("doc_id >= 60"), size=4000)
    got = {r.doc_id: (r.lang_pred, r.n_phrases) for r in cp.identify(docs, model).collect()}
    for r in docs.collect():
        counts = {lang: plain(cp.normal(r.text), sample) for lang, sample, _ in model}
        cost = {lang: counts[lang] * np.log2(len(s)) for lang, s, _ in model}
        assert got[r.doc_id][1] == counts[got[r.doc_id][0]] and cost[got[r.doc_id][0]] == min(cost.values())
