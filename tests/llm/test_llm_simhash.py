import random

import numpy as np
import pytest
import xxhash
from llm_cases import documents, prose, rows

from lakeops.llm import simhash
from lakeops.llm.common import components, table


def plain_fingerprint(text: str, width: int = 4) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\r\x0b\x0c":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [words[k : k + width] for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes: list[int], budget: int) -> list[int]:
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= budget:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a B c", "a b c d", "a b\x0bc\x0cd e", "ÄÖ Straße x y z", prose(1, 500), "x " * 9])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("ab cd é"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("ab cd é".encode(), 42)


def crowd(n: int, seed: int) -> list[int]:
    """Codes in dense groups around a few centres, and lone ones."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        c = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 7)):
            c ^= 1 << rng.randrange(64)
        out.add(c)
    return sorted(out)


@pytest.mark.parametrize("frontier", [8, 1000, 10**6])
def test_trie_join_links_what_all_pairs_link(frontier):
    for seed in range(3):
        codes = crowd(180, seed)
        labels = simhash.trie_groups(np.array(codes, np.uint64), np.zeros(len(codes)), 4, frontier)
        assert labels.tolist() == plain_groups(codes, 4)


def test_tries_do_not_mix():
    codes = np.array([1, 2, 1, 2**60], np.uint64)
    assert simhash.trie_groups(codes, np.array([0, 0, 1, 1]), 4).tolist() == [0, 0, 2, 2]
    assert simhash.trie_groups(codes, np.array([0, 1, 2, 3]), 4).tolist() == [0, 1, 2, 3]
    assert simhash.trie_groups(np.zeros(0, np.uint64), np.zeros(0), 4).tolist() == []


@pytest.mark.parametrize("subtrie", [4, 40, 20_000])
def test_forest_is_the_same_however_it_is_cut(spark, subtrie):
    codes = crowd(150, 5)
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "code long")
    groups = components(simhash.forest(frame, 4, subtrie))
    found = {r.node % 2**64: r.root for r in groups.collect()}
    plain = plain_groups(codes, 4)
    ours = [found.get(c, c) for c in codes]
    assert len({(a, b) for a, b in zip(plain, ours)}) == len(set(plain)) == len(set(ours))


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (30, 29)]
    found = dict(rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}}


def test_near_duplicates_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    codes = [plain_fingerprint(texts[i]) for i in ids]
    labels = plain_groups(codes, 4)
    want = [(i, c, ids[k]) for i, c, k in zip(ids, codes, labels)]
    got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex().alias("f"), "component_id")
    assert rows(got, "doc_id", "f", "component_id") == [(i, f"{c:016x}", g) for i, c, g in want]


def test_nulls_repeats_and_clashing_names(spark):
    long = prose(3, 30_000)
    texts = [None, "", " ", "same words here now", "Same  words here\tnow", "same words here now", long, long + " end", None, "lone text of five words"]
    ids = [5, 3, 9, 4, 8, 4, 20, 21, None, 30]
    got = rows(simhash.near_duplicates(documents(spark, texts, ids=ids)), "doc_id", "component_id")
    assert got == [(3, 3), (4, 4), (4, 4), (5, 3), (8, 4), (9, 3), (20, 20), (21, 20), (30, 30), (None, 3)]


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
