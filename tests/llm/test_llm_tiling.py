import random

import numpy as np
import pytest
from llm_cases import documents, prose, rows

from lakeops.llm import tiling
from lakeops.llm.common import table


def plain_tiles(item: list, doc: list, width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling as first published: search all places for the longest free match, again and again."""
    p_used, t_used, out = set(), set(), []
    while True:
        best = (width - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                k = 0
                while (
                    p + k < len(item) and t + k < len(doc) and item[p + k] == doc[t + k]
                    and p + k not in p_used and t + k not in t_used
                ):
                    k += 1
                if k > best[0]:
                    best = (k, p, t)
        if best[0] < width:
            return out
        k, p, t = best
        out.append((p, t, k))
        p_used.update(range(p, p + k))
        t_used.update(range(t, t + k))


@pytest.mark.parametrize("seed", range(12))
def test_tiles_are_the_greedy_ones(seed):
    rng = random.Random(seed)
    item = [rng.randint(1, 4) for _ in range(30)]
    doc = [rng.randint(0, 4) for _ in range(40)] + item[15:] + [9] + item[:15]
    seeds = [(p, t) for p in range(len(item) - 2) for t in range(len(doc) - 2) if item[p : p + 3] == doc[t : t + 3]]
    got = tiling.tiles(np.array(item), np.array(doc), seeds, 3)
    want = plain_tiles(item, doc, 3)
    assert sorted(x[2] for x in got) == sorted(x[2] for x in want)
    assert got == want


def plain_pairs(docs: dict, items: dict, least: float = 0.5, width: int = 5) -> set:
    out = set()
    for i, text in items.items():
        item = tiling.tokens(text)
        if len(item) < width:
            continue
        grams = {tuple(item[k : k + width]) for k in range(len(item) - width + 1)}
        for d, body in docs.items():
            doc = tiling.tokens(body)
            if any(tuple(doc[k : k + width]) in grams for k in range(len(doc) - width + 1)):
                if sum(x[2] for x in plain_tiles(item, doc, width)) >= least * len(item):
                    out.add((d, i))
    return out


def test_pairs_against_brute_force(spark):
    docs, items = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    want = plain_pairs({r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in items.collect()})
    got = tiling.contaminated(docs, items)
    assert want and set(rows(got, "doc_id", "item_id")) == want
    blocks = tiling.contaminated(docs, items, block_chars=2_000)
    assert rows(blocks, *blocks.columns) == rows(got, *got.columns)


def test_reordered_passages_are_caught(spark):
    item = prose(7, 40, 10)
    parts = item.split(". ")
    mixed = prose(8, 60) + " " + ". ".join([parts[2].upper(), parts[0], parts[3].rstrip("."), parts[1]]) + ". " + prose(9, 60)
    items = spark.createDataFrame([(1, item), (2, prose(50, 40)), (9, item), (3, None), (4, ""), (5, "two words")], "item_id long, text string")
    texts = [mixed, prose(8, 120), None, "", "two words", prose(3, 50_000) + " " + item, mixed]
    got = tiling.contaminated(documents(spark, texts, ids=[0, 1, 2, 3, 4, 5, 0]), items)
    assert rows(got, "doc_id", "item_id", "matched") == [(0, 1, 40), (0, 1, 40), (5, 1, 40)]
    assert {r.n_tiles for r in got.collect()} == {1, 4}


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert tiling.contaminated(documents(spark, ["a b c d e f"]), items).count() == 0
    assert tiling.contaminated(documents(spark, []), items).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_running_hashes_give_the_greedy_tiles(seed):
    rng = random.Random(seed)
    kinds = rng.choice([1, 2, 3, 6])
    item = [rng.randint(1, kinds) for _ in range(rng.randint(3, 45))]
    doc = [rng.randint(1, kinds) for _ in range(rng.randint(3, 60))] + item[: rng.randint(0, 20)]
    a, b = (tiling.rolling(np.array(x, np.uint64), 3) for x in (item, doc))
    got = tiling.greedy(np.array(item), np.array(doc), np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a)), 3)
    assert got == plain_tiles(item, doc, 3)


def test_one_token_over_and_over_takes_no_time(spark):
    import time

    item, doc = np.full(2_000, 7, np.uint64), np.full(20_000, 7, np.uint64)
    broken = doc.copy()
    broken[::37] = 5
    start = time.perf_counter()
    every = lambda x, y: np.flatnonzero(np.isin(tiling.rolling(x, 5), tiling.rolling(y, 5)))
    assert tiling.greedy(item, doc, every(item, doc), every(doc, item), 5) == [(0, 0, 2_000)]
    got = tiling.greedy(item, broken, every(item, broken), every(broken, item), 5)
    assert sum(x[2] for x in got) == 2_000 and got[0] == (0, 1, 36)
    assert time.perf_counter() - start < 1
    items = spark.createDataFrame([(1, "go " * 2_000)], "item_id long, text string")
    assert rows(tiling.contaminated(documents(spark, ["go " * 20_000, "go " * 900]), items), "doc_id", "matched") == [(0, 2_000)]


def test_lines_that_many_items_share(spark):
    line = "answer the question below with one of the four letters and nothing else"
    rng = random.Random(5)
    items = {k: f"{line} {prose(k, 9)}" for k in range(300)} | {k: f"{line} {prose(k, 30)}" for k in range(300, 400)}
    items |= {400: line, 401: line.upper() + " now"}
    docs = {0: prose(900, 50) + " " + line, 1: items[5] + " " + prose(901, 30), 2: items[350], 3: prose(902, 90), 4: line * 3}
    docs |= {5: " ".join(rng.sample(line.split(), 13))}
    want = plain_pairs(docs, items)
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string").repartition(4)
    for common in (0, 3, 64, 10_000):
        got = tiling.contaminated(documents(spark, list(docs.values())), frame, common=common)
        assert set(rows(got, "doc_id", "item_id")) == want, common
    assert {(2, 350), (0, 400), (1, 5)} <= want and (0, 350) not in want


@pytest.mark.parametrize("kind,ids", [("int", [3, 1, 3]), ("string", ["c", "a", "c"]), ("date", None), ("decimal(20,0)", None)])
def test_ids_of_any_type(spark, kind, ids):
    text = prose(7, 40)
    numbered = [(k, t) for k, t in zip([3, 1, 3], [text, text, prose(8, 40)])]
    from pyspark.sql import functions as F

    made = {"int": F.col("n"), "string": F.char(F.col("n") + 96), "date": F.date_from_unix_date(F.col("n").cast("int")), "decimal(20,0)": F.col("n")}[kind].cast(kind)
    items = spark.createDataFrame([*numbered, (None, text)], "n long, text string").withColumn("item_id", made)
    docs = spark.createDataFrame([(1, text), (None, text)], "n long, text string").withColumn("doc_id", made)
    got = tiling.contaminated(docs, items)
    first = items.where("n = 1").first().item_id
    assert sorted(map(str, ((r.doc_id, r.item_id) for r in got.collect()))) == sorted(map(str, [(first, first), (None, first)]))
