import hashlib
import random
from collections import defaultdict

import pytest

from lakeops.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members = defaultdict(set)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
    out = []
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = {p for p in below if len(p) == len(path) + 1}
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in below) for p in below)
        spared = sum((len(members[p]) - 1) * len(p[-1][1].split()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(kids), leaves, spared, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def frame(spark, convs: dict):
    rows = [(c, k, r, t) for c, seq in convs.items() for k, (r, t) in enumerate(seq)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def made(seed: int, n: int, ids: range, deepest: int = 5) -> dict:
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["user", "tool"]), rng.choice(["hi there", "yes", "", "a b c"]))
    return {c: [pick() for _ in range(rng.randint(1, deepest))] for c in rng.sample(ids, n)}


@pytest.mark.parametrize("width,most", [(1000, 10_000), (20, 10_000), (1, 10_000), (40, 7), (1000, 1)])
def test_against_brute_force(spark, width, most):
    convs = made(width + most, 150, range(-400, 400))
    convs[399] = [("user", "hi there")] * 41  # a conversation longer than a shard
    convs[398] = [("user", "hi there")] * 40 + [("user", "end")]
    assert found(trie.prefix_trie(trie.turns(frame(spark, convs)), width, most)) == plain(convs)


def test_hot_first_turn_and_copies(spark):
    convs = {c: [("user", "same start")] + ([("bot", "copy")] * 3 if c % 3 else [("bot", f"own {c}")]) for c in range(0, 3000, 7)}
    assert found(trie.prefix_trie(trie.turns(frame(spark, convs)), 100)) == plain(convs)


def test_snapshots_of_one_conversation(spark):
    turns = [("user", f"turn {k}") for k in range(35)]
    convs = {k: turns[: k + 1] for k in range(35)}
    assert found(trie.prefix_trie(trie.turns(frame(spark, convs)), 3)) == plain(convs)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 5, None, None), (1, 5, None, None), (1, 7, "user", "x " * 50_000),
        (2, 0, "user", "first"), (2, 1, "", ""), (None, 1, "user", "no one"), (3, 1, "b", "t"), (3, 1, "a", "t"),
        (4, 2, "a", "a:b"), (5, 2, "a:a", "b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as pos", "2 as block", "'x' as node_a", "'y' as turn_key")
    convs = {
        1: [("user", "first"), ("", ""), ("", ""), ("user", "x " * 50_000)], 2: [("user", "first"), ("", "")],
        3: [("a", "t"), ("b", "t")], 4: [("a", "a:b")], 5: [("a:a", "b")],
    }
    assert found(trie.prefix_trie(trie.turns(df))) == plain(convs)


def test_conversations_without_turns_and_empty_tables(spark):
    kind = "conv_id long, pos long, turn_key binary, n_words long"
    named = spark.createDataFrame([(4, None, None, 0), (9, None, None, 0)], kind)
    assert found(trie.prefix_trie(named)) == plain({4: [], 9: []})
    assert found(trie.prefix_trie(spark.createDataFrame([], kind))) == []
    ints = spark.createDataFrame([(1, 1, "a", "b c")], "conv_id int, turn int, role string, text string")
    assert found(trie.prefix_trie(trie.turns(ints))) == plain({1: [("a", "b c")]})
