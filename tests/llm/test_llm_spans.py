import random

import numpy as np
import pytest
from llm_cases import documents, prose, rows

from lakeops.llm import spans
from lakeops.llm.common import table


def plain_runs(counts: list[int], sentences: int, words: int, long_words: int) -> set:
    def holds(a, b):
        return (b - a >= sentences and sum(counts[a:b]) >= words) or (b > a and sum(counts[a:b]) >= long_words)

    n, out = len(counts), set()
    for a in range(n):
        out |= {(a, b) for b in list(filter(lambda b: holds(a, b), range(a + 1, n + 1)))[:1]}
    for b in range(1, n + 1):
        out |= {(a, b) for a in list(filter(lambda a: holds(a, b), range(b - 1, -1, -1)))[:1]}
    return out


def plain_result(docs: dict) -> dict:
    """By the runs' own texts: sentences of runs that an earlier document, or an earlier place, has."""
    cut = {d: spans.pieces(t) for d, t in docs.items()}
    words = {d: [" ".join(p.split()) for p in ps] for d, ps in cut.items()}
    seen, gone = set(), {d: set() for d in docs}
    for d in sorted(docs):
        for a, b in sorted(plain_runs([len(w.split()) for w in words[d]], spans.SENTENCES, spans.WORDS, spans.LONG_WORDS)):
            key = tuple(words[d][a:b])
            if key in seen:
                gone[d].update(range(a, b))
            seen.add(key)
    out = {}
    for d, ps in cut.items():
        left = "".join(p for k, p in enumerate(ps) if k not in gone[d])
        out[d] = left.lstrip() if gone[d] else left
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_the_shortest_ones(seed):
    rng = random.Random(seed)
    counts = [rng.choice([0, 1, 2, 5, 9, 14, 60]) for _ in range(rng.randint(0, 40))]
    for limits in ((3, 25, 50), (2, 5, 9), (1, 1, 1)):
        got = {tuple(x) for x in spans.runs(np.array(counts, np.int64), *limits).tolist()}
        assert got == plain_runs(counts, *limits)


@pytest.mark.parametrize("seed", range(20))
def test_a_long_passage_is_covered_whole(seed):
    rng = random.Random(seed)
    passage = [rng.randint(1, 30) for _ in range(20)]
    while sum(passage[:-1]) > 51:
        passage.pop()
    before, after = [[rng.randint(1, 20) for _ in range(9)] for _ in range(2)]
    if sum(passage) <= 50:
        return
    found = spans.runs(np.array(before + passage + after), 3, 25, 50)
    inside = [(a, b) for a, b in found.tolist() if a >= 9 and b <= 9 + len(passage)]
    assert {k for a, b in inside for k in range(a, b)} == set(range(9, 9 + len(passage)))


def test_pieces_lose_nothing():
    for text in ["", "a", "a. b", "a.\n\nb\nc", ".. . x!? y", "\n\n", "e.g. this\t! ", prose(4, 200)]:
        assert "".join(spans.pieces(text)) == text


def test_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = plain_result({r.doc_id: r.text for r in docs.collect()})
    got = {r.doc_id: r.text for r in spans.without_repeats(docs).collect()}
    assert got == want and any(want[r.doc_id] != r.text for r in docs.collect())


def test_passages_go_and_the_rest_stays(spark):
    passage, other = prose(1, 60, 12), prose(2, 55, 60) + "."
    texts = [
        prose(3, 40) + ". " + passage + "\n" + prose(4, 40),
        prose(5, 40) + ". " + passage + "\n" + prose(6, 40),
        f"Start here. {other} End there.",
        f"Begin so. {other} Stop.",
        passage + " " + passage,
        None, "", "Short. Lines. Here.", "Short. Lines. Here.", prose(9, 20_000),
    ]
    got = {r.doc_id: r.text for r in spans.without_repeats(documents(spark, texts)).collect()}
    assert got[0] == texts[0] and got[1] == prose(5, 40) + ".\n" + prose(6, 40)
    assert got[2] == texts[2] and got[3] == "Begin so. Stop." and got[4] == ""
    assert [got[k] for k in (5, 6, 7, 9)] == [*texts[5:8], texts[9]] and got[8] == ""  # three sentences, there before


def test_repeats_of_a_row_nulls_and_ids(spark):
    text = prose(1, 60, 12)
    got = spans.without_repeats(documents(spark, [text, text, text, text], ids=[7, 7, None, 8]))
    assert rows(got, "doc_id", "text") == [(7, text), (7, text), (8, ""), (None, text)]


def test_empty_table_and_kept_columns(spark):
    assert spans.without_repeats(documents(spark, [])).count() == 0
    got = spans.without_repeats(documents(spark, ["x"]), keep=("source", "first"))
    assert got.columns == ["doc_id", "text", "n_removed", "source", "first"]
    assert rows(got, "source", "first") == [("src0", "x")]


def every_run(docs: dict) -> dict:
    """Without the sentences of any run of several sentences, of whatever words, that was there before."""
    cut = {d: spans.pieces(t) for d, t in docs.items()}
    seen, out = set(), {}
    for d in sorted(docs):
        words, gone = [tuple(p.split()) for p in cut[d]], set()
        for size in range(1, len(words) + 1):
            for a in range(len(words) - size + 1):
                key = tuple(words[a : a + size])
                if size > 1 or len(key[0]) >= spans.LONG_WORDS:
                    gone |= set(range(a, a + size)) if key in seen else set()
                    seen.add(key)
        left = "".join(p for k, p in enumerate(cut[d]) if k not in gone)
        out[d] = left.lstrip() if gone else left
    return out


def test_every_run_of_several_sentences_goes(spark):
    rng = random.Random(5)
    sentences = [f"{prose(k, rng.choice([1, 2, 8, 20, 50, 60]), 99)}." for k in range(40)]
    texts = [rng.choice([" ", "\n", " \n "]).join(rng.choices(sentences, k=rng.randint(0, 9))) + " \n" for _ in range(150)]
    texts += ["Twelve words. Stay not.", "Before it. Twelve words. Stay not. After it.", "Alone.  \n\n", "Alone. \n", "Else. \n Alone. \n"]
    got = {r.doc_id: r.text for r in spans.without_repeats(documents(spark, texts)).collect()}
    assert got == every_run(dict(enumerate(texts)))
    assert [got[k] for k in range(151, 155)] == ["Before it. After it.", *texts[152:]]


def test_white_space_is_no_sentence():
    for text in ["a. \n", "a. \n b", " \n a", "\n \n", "a.\n\n \nb. c\n\n"]:
        parts = spans.pieces(text)
        assert "".join(parts) == text and all(p.strip() for p in parts if len(parts) > 1)


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    """A third of the rows has one id and texts of its own: the same result as with ids of their own in that order."""
    rng = random.Random(9)
    sentences = [f"{prose(k, rng.choice([2, 8, 20, 60]), 99)}." for k in range(30)]
    texts = list(dict.fromkeys(" ".join(rng.choices(sentences, k=rng.randint(1, 7))) for _ in range(90)))
    ids = [50 if k % 3 == 0 else 100 + k if k % 3 == 1 else k for k in range(len(texts))]
    df = documents(spark, texts, ids=ids)
    from pyspark.sql import functions as F

    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(range(len(texts)), key=lambda k: (ids[k], hashes[texts[k]]))
    want = every_run({place: texts[k] for place, k in enumerate(order)})
    got = rows(spans.without_repeats(df.union(df.where("doc_id = 50"))), "doc_id", "text")
    twice = [(ids[k], want[place]) for place, k in enumerate(order) for _ in range(2 if ids[k] == 50 else 1)]
    assert got == sorted(twice)
