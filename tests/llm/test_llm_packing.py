import random
from collections import defaultdict

import pytest
from llm_cases import documents, prose, rows

from pyspark.sql import functions as F

from lakeops.llm import packing


def plain_pack(ids, sources, clusters, sizes, capacity):
    cuts = []
    for k, size in enumerate(sizes):
        piece = 0
        while True:
            cuts.append((k, piece, min(capacity, size)))
            size, piece = size - capacity, piece + 1
            if size <= 0:
                break
    cuts.sort(key=lambda c: (-c[2], ids[c[0]] is None, ids[c[0]] or 0, c[0], c[1]))
    bins, out = [], []
    for k, piece, size in cuts:
        own = ("row", k) if clusters[k] is None else ("cluster", clusters[k])
        fits = [
            (capacity - b["used"], n)
            for n, b in enumerate(bins)
            if b["used"] < capacity and capacity - b["used"] >= size
            and not (sources[k] is not None and sources[k] in b["sources"]) and own not in b["clusters"]
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"used": 0, "sources": set(), "clusters": set()})
        out.append((k, piece, size, n, bins[n]["used"]))
        bins[n]["used"] += size
        bins[n]["sources"].add(sources[k])
        bins[n]["clusters"].add(own)
    return out


@pytest.mark.parametrize("seed", range(15))
def test_shards_are_packed_best_fit(seed):
    rng = random.Random(seed)
    n, capacity = rng.randint(0, 80), rng.choice([1, 10, 50])
    ids = [rng.choice([None, k, k // 2]) for k in range(n)]
    sources = [rng.choice(["a", "a", "b", "c", None]) for _ in range(n)]
    clusters = [rng.choice([None, 1, 2, k]) for k in range(n)]
    sizes = [rng.choice([0, 1, 3, 7, capacity, 2 * capacity + 1]) for _ in range(n)]
    assert packing.pack_shard(ids, sources, clusters, sizes, capacity) == plain_pack(ids, sources, clusters, sizes, capacity)


def check(spark, docs, capacity, shard):
    own = packing.measured(docs)
    packed = packing.best_fit(own, capacity=capacity, shard_docs=shard).collect()
    facts = {r.doc_id: r for r in own.collect()}
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packed:
        bins[r.bin_id].append(r)
        pieces[r.doc_id].append((r.piece, r.n_words))
    for d, f in facts.items():
        assert [p for p, _ in sorted(pieces[d])] == list(range(len(pieces[d]))) and sum(n for _, n in pieces[d]) == f["size"]
    for rows_ in bins.values():
        rows_.sort(key=lambda r: (r.offset, r.n_words))
        assert [r.offset for r in rows_] == [sum(x.n_words for x in rows_[:k]) for k in range(len(rows_))]
        assert sum(r.n_words for r in rows_) <= capacity
        named = [facts[r.doc_id].source for r in rows_ if facts[r.doc_id].source is not None]
        assert len(named) == len(set(named))
        assert len({facts[r.doc_id].cluster for r in rows_}) == len(rows_)
    return bins


def test_whole_table_keeps_the_constraints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for shard in (100, 4096):
        assert len(check(spark, docs, 2048, shard)) < 1000


def test_nulls_repeats_and_clashing_names(spark):
    texts = [None, "", "a b c", "A  b\nc", prose(1, 5000), "x", None]
    docs = documents(spark, texts)
    bins = check(spark, docs, 100, 4096)
    assert sum(map(len, bins.values())) == 6 + 50
    again = documents(spark, ["a b"] * 4, ids=[1, 1, None, None])
    out = packing.best_fit(packing.measured(again), capacity=10)
    assert rows(out, "doc_id", "n_words", "piece") == [(1, 2, 0)] * 2 + [(None, 2, 0)] * 2
    assert out.select("bin_id").distinct().count() == 4
    own = packing.measured(docs)
    odd = own.selectExpr("doc_id", "source", "if(doc_id = 2, null, -size) AS size", "cluster")
    assert {r.n_words for r in packing.best_fit(odd).collect()} == {0}
    assert packing.best_fit(packing.measured(documents(spark, []))).count() == 0


def test_word_counts_and_clusters(spark):
    df = documents(spark, ["a  b\tc\n", None, "A b C", ""]).select(packing.n_words().alias("n"), packing.copy_cluster().alias("c"))
    got = df.collect()
    assert [r.n for r in got] == [3, 0, 3, 0]
    assert got[0].c == got[2].c != got[1].c == got[3].c


def test_equal_rows_and_rows_without_id_are_spread(spark):
    same = documents(spark, ["a b c"] * 3000, ids=[None] * 3000, clash=False).withColumn("source", F.lit(None).cast("string"))
    own = documents(spark, [f"w{k}" for k in range(3000)], ids=[None] * 3000, clash=False)
    for docs in (same, own):
        out = packing.best_fit(packing.measured(docs), shard_docs=100)
        held = [r["count"] for r in out.groupBy(F.shiftright("bin_id", 32)).count().collect()]
        assert sum(held) == 3000 and len(held) >= 25 and max(held) < 250
