"""Near-duplicate groups by SimHash: a self-join of binary tries over the fingerprints.

A document's fingerprint is the majority of the bits of its shingles' hashes. Two fingerprints are
linked at ``budget`` or fewer differing bits, and the groups are the components of the links.

The trie over all fingerprints is cut into subtries that fit a task. The 64 bits are cut into
``parts`` blocks; fingerprints within the budget agree in at least ``parts - budget`` of them, so
for every choice of so many blocks the fingerprints that agree there make a trie of their own
over the other bits. A task walks pairs of nodes of such tries together, adds up differing bits
and drops a pair of nodes when it exceeds the budget, or when all leaves below both are grouped
already. Only a spanning forest of the links leaves the task, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import components, inputs, saved, slices

SEED = 42
BITS = 64
#: Codes of one subtrie; a larger one is cut, and its cuts are joined pair by pair.
SUBTRIE = 20_000
#: Codes and node pairs that a task holds at once.
BATCH, FRONTIER = 100_000, 1_000_000
_BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1
_LANES = np.arange(8) * 256


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text.

    A-Z are lower-cased, words are runs without space and ``\\t`` to ``\\r``, shingles are
    space-joined and count with repeats. Fewer words than a shingle: the whole sequence. None: zero.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    count = np.zeros((8, 256), np.int64)
    for at in range(0, len(starts), 65_536):
        pairs = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
        lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
        count += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    ones = count @ _BIT_OF_BYTE
    return int(np.packbits(ones.ravel() * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id, code`` of every row; the code is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            codes = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes)], ["doc_id", "code"])

    rows = inputs(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, code long")


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of each pair; every label is the smallest index of its group."""
    while len(a):
        left, right = labels[a], labels[b]
        differ = left != right
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up


def trie_groups(codes: np.ndarray, tries: np.ndarray, budget: int, frontier: int = FRONTIER) -> np.ndarray:
    """Label of each code: the smallest index reachable by links inside its own trie.

    ``codes`` (unsigned) are sorted within ``tries`` (sorted). A node of depth d is the range of the
    codes that share their first d bits, so its children meet where bit d turns from 0 to 1.
    """
    n = len(codes)
    labels = np.arange(n)
    before: dict[int, np.ndarray] = {}

    def middle(depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if depth not in before:
            bit = (codes >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            before[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        ones = before[depth]
        return hi - (ones[hi] - ones[lo])

    cuts = np.flatnonzero(np.r_[True, tries[1:] != tries[:-1]]) if n else np.array([], np.int64)
    ends = np.r_[cuts[1:], n] if n else cuts
    stack = [(0, cuts, ends, cuts, ends, np.zeros(len(cuts), np.int8))]
    while stack:
        depth, lo1, hi1, lo2, hi2, diff = stack.pop()
        single = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        a, b = lo1[single], lo2[single]
        near = np.bitwise_count(codes[a] ^ codes[b]) <= budget
        merge(labels, a[near], b[near])
        go = ~single
        if depth == BITS:  # equal codes, or a pair whose bits are all counted
            merge(labels, *(x[go] for x in (lo1, lo2)))
            for lo, hi in ((lo1[go], hi1[go]), (lo2[go], hi2[go])):
                for x, y in zip(lo.tolist(), hi.tolist()):
                    merge(labels, np.arange(x, y - 1), np.arange(x + 1, y))
            continue
        lo1, hi1, lo2, hi2, diff = (x[go] for x in (lo1, hi1, lo2, hi2, diff))
        if not len(lo1):
            continue
        if len(lo1) > frontier // 4:
            # a pair of nodes whose leaves are all in one group can add nothing
            changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
            done = (labels[lo1] == labels[lo2]) & (changes[hi1 - 1] == changes[lo1]) & (changes[hi2 - 1] == changes[lo2])
            lo1, hi1, lo2, hi2, diff = (x[~done] for x in (lo1, hi1, lo2, hi2, diff))
        if len(lo1) > frontier:
            for at in range(0, len(lo1), frontier):
                part = slice(at, at + frontier)
                stack.append((depth, lo1[part], hi1[part], lo2[part], hi2[part], diff[part]))
            # the next pop splits nothing more: its length is the frontier at most
            continue
        mid1, mid2 = middle(depth, lo1, hi1), middle(depth, lo2, hi2)
        own = lo1 == lo2
        kids = [
            (lo1, mid1, lo2, mid2, diff, None),
            (mid1, hi1, mid2, hi2, diff, None),
            (lo1, mid1, mid2, hi2, diff + 1, None),
            (mid1, hi1, lo2, mid2, diff + 1, ~own),
        ]
        found = [[], [], [], [], []]
        for l1, h1, l2, h2, e, also in kids:
            keep = (h1 > l1) & (h2 > l2) & (e <= budget) & ~((l1 == l2) & (h1 - l1 == 1))
            if also is not None:
                keep &= also
            for out, x in zip(found, (l1, h1, l2, h2, e)):
                out.append(x[keep])
        stack.append((depth + 1, *(np.concatenate(x) for x in found)))
    return labels


@lru_cache
def blocks(parts: int, budget: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """(shift, width) of each block, and each choice of blocks that must agree."""
    edges = [round(k * BITS / parts) for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])], list(combinations(range(parts), parts - budget))


def _agreeing(codes: np.ndarray, choice: np.ndarray, parts: int, budget: int) -> np.ndarray:
    """The codes with the agreeing blocks moved to the low bits: the trie branches on the others first."""
    spans, choices = blocks(parts, budget)
    out = np.zeros_like(codes)
    for k, fixed in enumerate(choices):
        at = choice == k
        some, moved, up = codes[at], np.zeros(int(at.sum()), np.uint64), 0
        for p in (*fixed, *(p for p in range(parts) if p not in fixed)):
            shift, width = spans[p]
            moved |= ((some >> np.uint64(shift)) & np.uint64((1 << width) - 1)) << np.uint64(up)
            up += width
        out[at] = moved
    return out


def forest(codes: DataFrame, budget: int = 4, subtrie: int = SUBTRIE) -> DataFrame:
    """``a, b``: links between the distinct ``code`` values that connect what all links connect.

    The number of blocks follows from the number of codes, so that a subtrie of evenly spread codes
    fits ``subtrie``. Denser ones are cut by hash into ``subtrie``-sized cuts, and each pair of cuts is a
    task's trie. The result is the same for any number of blocks and cuts.
    """
    total, parts = codes.count(), budget + 1
    while parts < 12 and total / 2 ** (BITS * (parts - budget) // parts) > subtrie:
        parts += 1
    spans, choices = blocks(parts, budget)
    key = F.array(*[
        F.struct(
            F.lit(k).alias("choice"),
            F.xxhash64(*[F.shiftrightunsigned("code", spans[p][0]).bitwiseAND((1 << spans[p][1]) - 1) for p in fixed]).alias("bucket"),
        )
        for k, fixed in enumerate(choices)
    ])
    rows = codes.select("code", F.explode(key).alias("k")).select("code", "k.*")
    crowded = (
        rows.groupBy("choice", "bucket").count().where(F.col("count") > subtrie)
        .select("choice", "bucket", F.ceil(F.col("count") / (subtrie // 2)).alias("cuts"))
    )
    rows = rows.join(crowded, ["choice", "bucket"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = F.pmod(F.xxhash64("code", F.lit(1)), F.col("cuts"))
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1), lambda x: (x != cut) | (F.col("cuts") == 1)),
        lambda x: F.struct(F.least(x, cut).alias("i"), F.greatest(x, cut).alias("j")),
    )
    rows = rows.select("code", "choice", "bucket", F.explode(pairs).alias("p")).select("code", "choice", "bucket", "p.*")
    rows = rows.select("code", "choice", F.xxhash64("choice", "bucket", "i", "j").alias("trie"))

    def walk(code: np.ndarray, choice: np.ndarray, trie: np.ndarray) -> pa.RecordBatch:
        moved = _agreeing(code.view(np.uint64), choice, parts, budget)
        order = np.lexsort((moved, trie))
        labels = trie_groups(moved[order], trie[order], budget)
        code = code[order]
        tied = labels != np.arange(len(labels))
        return pa.RecordBatch.from_arrays([pa.array(code[tied]), pa.array(code[labels[tied]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held.append(tuple(batch.column(x).to_numpy(zero_copy_only=False) for x in ("code", "choice", "trie")))
            if sum(len(x[0]) for x in held) < BATCH:
                continue
            code, choice, trie = (np.concatenate(x) for x in zip(*held))
            whole = int(np.searchsorted(trie, trie[-1]))  # the last trie may go on in the next batch
            if whole:
                yield walk(code[:whole], choice[:whole], trie[:whole])
            held = [(code[whole:], choice[whole:], trie[whole:])]
        if held:
            yield walk(*(np.concatenate(x) for x in zip(*held)))

    return rows.repartition("trie").sortWithinPartitions("trie").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, budget: int = 4
) -> DataFrame:
    """``doc_id, code, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, its own included. Null and empty texts
    have fingerprint zero and are linked like any other. Rows that share an id are each fingerprinted.
    A null id stays null and counts for no group; a group of null ids alone has component null.
    Copies are one fingerprint before the join, so a large group of them costs one code.
    """
    codes = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = codes.groupBy("code").agg(F.min("doc_id").alias("first"))
    links = saved(forest(first.select("code"), budget), "links")
    roots = components(links).withColumnsRenamed({"node": "code"})
    tied = first.join(roots, "code")
    lowest = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = tied.join(lowest, "root").select("code", "component_id")
    single = first.join(roots.select("code"), "code", "left_anti").select("code", F.col("first").alias("component_id"))
    return codes.join(linked.union(single), "code").select("doc_id", "code", "component_id")


def as_hex(code: str = "code") -> F.Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(code)), 16, "0"))
