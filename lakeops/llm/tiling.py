"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared if they share seeds: ``min_match`` tokens with the same
Karp-Rabin hash, joined on Spark. Then the longest match whose tokens are all free is marked again and again;
running Karp-Rabin finds it by hashes of falling lengths. Tiles may lie in any order, so a passage with
its sentences rearranged is covered too. A pair counts if the tiles cover a given share of the
item's tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved, slices

TOKEN = re.compile(r"\w+")
MIN_MATCH = 5
COVERAGE = 0.5
#: A seed of more items than this is common: an item is not looked for by it, unless common seeds alone could cover it.
COMMON = 64
#: Bits of the set of seeds that tasks get, 16 MB whatever the benchmark. What passes it is joined exactly.
SET_BITS = 27
#: Characters of documents whose hits a task sends on at once.
BLOCK_CHARS = 8_000_000
#: Tokens whose hashes a worker remembers; others are hashed each time.
REMEMBERED = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


class _Hashes(dict):
    """8 bytes of hash of a token; a worker remembers some."""

    def __missing__(self, token: str) -> bytes:
        found = xxhash.xxh64_digest(token)
        if len(self) < REMEMBERED:
            self[token] = found
        return found


_hashes = _Hashes()


def numbers(text: str | None) -> np.ndarray:
    """64-bit hashes of the tokens."""
    return np.frombuffer(b"".join(map(_hashes.__getitem__, tokens(text))), np.uint64)


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of every run of ``width`` ids."""
    n = len(ids) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * _BASE + ids[k : k + len(out)]
    return out


class Running:
    """Hashes of runs of any length in one sequence, and how far each place is free."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.ids, self.starts = ids.astype(np.uint64), starts
        # values of one token are spread, so that small numbers do not make sums that agree
        spread = (self.ids ^ (self.ids >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), _BASE)], dtype=np.uint64)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), inverse)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(spread * self.power[:-1], dtype=np.uint64)]
        self.used = np.zeros(len(ids), bool)
        self._measure()

    def _measure(self) -> None:
        """For each start, the tokens from it on up to the next used one."""
        taken = np.r_[np.flatnonzero(self.used), len(self.ids)]
        self.free = taken[np.searchsorted(taken, self.starts)] - self.starts
        keep = self.free > 0
        self.starts, self.free = self.starts[keep], self.free[keep]

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the free runs of one length."""
        at = self.starts[self.free >= size]
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]

    def mark(self, places: list[int], size: int) -> None:
        for p in places:
            self.used[p : p + size] = True
        self._measure()


def greedy(item: np.ndarray, doc: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(position in item, position in doc, length) of each tile, in the order they are marked.

    ``item_at`` and ``doc_at`` hold all places at which ``width`` tokens agree with some place of the other side.
    The longest match goes first, ties to the smaller position in the item, then in the document. The longest
    length is searched between the last one and ``width``; all matches of it are marked in one go, for no
    longer one is left. There are at most about as many lengths as the root of twice the item's tokens.
    """
    left, right, marked = Running(item, item_at), Running(doc, doc_at), []

    def common(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        p, hp = left.runs(size)
        t, ht = right.runs(size)
        if not len(p) or not len(t):
            return None
        known = np.unique(hp)
        hit = known[np.minimum(np.searchsorted(known, ht), len(known) - 1)] == ht
        return (p, hp, t[hit], ht[hit]) if hit.any() else None

    longest = min(len(item), len(doc))
    while longest >= width and (found := common(width)):
        low, high = width, longest  # a match of length low is there
        while low < high:
            middle = (low + high + 1) // 2
            if more := common(middle):
                low, found = middle, more
            else:
                high = middle - 1
        p, hp, t, ht = found
        order = np.argsort(ht, kind="stable")
        t, ht = t[order], ht[order]
        next_of = {int(h): int(k) for h, k in zip(*np.unique(ht, return_index=True))}
        begins, ends = [], []
        for a, h in zip(p.tolist(), hp.tolist()):
            if begins and a < begins[-1] + low:
                continue  # overlaps the tile before it
            k = next_of.get(h)
            # a run of this length that meets a tile, which is no shorter, has its first or last token in it
            while k is not None and k < len(t) and ht[k] == h:
                b = int(t[k])
                if not right.used[b] and not right.used[b + low - 1] and np.array_equal(left.ids[a : a + low], right.ids[b : b + low]):
                    begins.append(a), ends.append(b)
                    right.used[b : b + low] = True
                    marked.append((a, b, low))
                    k += 1
                    break
                k += 1
            if k is not None:
                next_of[h] = k
        if not begins:
            longest = low - 1  # hashes that agree by chance
            continue
        left.mark(begins, low)
        right.mark([], low)
        longest = low
    return marked


def tiles(item: np.ndarray, doc: np.ndarray, seeds: Iterable[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """The tiles of two sequences, from the pairs of places at which ``width`` tokens agree."""
    p, t = (np.unique(np.array(c, np.int64)) for c in zip(*seeds)) if (seeds := list(seeds)) else (np.zeros(0, np.int64),) * 2
    return greedy(item, doc, p, t, width)


def _items(benchmark: DataFrame, width: int) -> DataFrame:
    """``item, item_id, n, tokens``: one row for each distinct token text long enough, under its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = [numbers(t) for t in batch.column("text").to_pylist()]
            keep = pa.array([k for k, x in enumerate(ids) if len(x) >= width], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(keep), pa.array([x.tobytes() for x in ids if len(x) >= width], pa.binary())], ["item_id", "tokens"]
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    own = benchmark.mapInArrow(run, f"item_id {kind}, tokens binary").groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    own = own.select("item_id", (F.length("tokens") / 8).cast("int").alias("n"), "tokens", F.monotonically_increasing_id().alias("item"))
    return saved(own, "benchmark-items")


def _postings(items: DataFrame, width: int) -> DataFrame:
    """``item, h, places``: where each item has each of its seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            item, seeds, places = [], [], []
            for k, raw in zip(batch.column("item").to_pylist(), batch.column("tokens").to_pylist()):
                h = rolling(np.frombuffer(raw, np.uint64), width)
                order = np.argsort(h, kind="stable")
                first = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
                item += [k] * len(first)
                seeds.append(h[order][first].view(np.int64))
                places += [np.sort(x).tolist() for x in np.split(order, first[1:])]
            if item:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int64()), pa.array(np.concatenate(seeds)), pa.array(places, pa.list_(pa.int32()))], ["item", "h", "places"]
                )

    return items.select("item", "tokens").mapInArrow(run, "item long, h long, places array<int>")


def _covered(places: str, width: int) -> str:
    """SQL for the number of tokens that runs of ``width`` from these places cover."""
    ordered = f"array_sort(flatten(collect_list({places})))"
    return f"aggregate({ordered}, struct(0L as n, {-width}L as last), (s, p) -> struct(s.n + least({width}L, p - s.last) as n, cast(p as bigint) as last), s -> s.n)"


def _indexed(items: DataFrame, width: int, coverage: float, common: int) -> tuple[DataFrame, DataFrame]:
    """``item, h, places`` of the seeds to look for, and ``item, spare``: tokens that its other seeds could cover."""
    postings = saved(_postings(items, width), "benchmark-seeds")
    often = postings.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > common).select("h")
    shared = postings.join(often, "h", "left_semi").groupBy("item").agg(F.expr(f"{_covered('places', width)} as spare"))
    rated = items.select("item", "n").join(shared, "item").withColumn("heavy", F.col("spare") >= F.lit(coverage) * F.col("n"))
    spare = saved(rated.select("item", "spare", "heavy"), "benchmark-spare")
    rare = postings.join(often, "h", "left_anti")
    heavy = postings.join(often, "h", "left_semi").join(spare.where("heavy").select("item"), "item", "left_semi")
    return rare.unionByName(heavy), spare.where("not heavy").select("item", "spare")


def _seed_set(indexed: DataFrame) -> Broadcast:
    """The indexed seeds as a set of 2^SET_BITS bits, built by Spark block by block."""
    bit = F.col("h").bitwiseAND((1 << SET_BITS) - 1)
    blocks = indexed.groupBy(F.shiftright(bit, 15).alias("block")).agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    out = np.zeros((1 << SET_BITS) // 8, np.uint8)
    for r in blocks.collect():
        out[r.block * 4096 : (r.block + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return indexed.sparkSession.sparkContext.broadcast(out)


def _hits(docs: DataFrame, held: Broadcast, width: int, block_chars: int) -> DataFrame:
    """``doc, doc_id, seeds, tokens`` of the rows with seeds in the set; ``doc`` is a number of the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, number = held.value, TaskContext.get().partitionId() << 33
        names, found, chars = [], [], 0

        def flush() -> pa.RecordBatch:
            numbered, seeds, texts = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(numbered, pa.int64()), pa.concat_arrays(names), pa.array(seeds, pa.list_(pa.int64())), pa.array(texts, pa.binary())],
                ["doc", "doc_id", "seeds", "tokens"],
            )

        for batch in slices(batches):
            for k, text in enumerate(batch.column("text").to_pylist()):
                number += 1
                ids = numbers(text)
                h = rolling(ids, width)
                at = h & np.uint64((1 << SET_BITS) - 1)
                hit = bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                if hit.any():
                    names.append(batch.column("doc_id").slice(k, 1))
                    found.append((number, np.unique(h[hit > 0]).view(np.int64).tolist(), zstandard.compress(ids.tobytes(), 1)))
                    chars += len(text)
                    if chars >= block_chars:
                        yield flush()
                        names, found, chars = [], [], 0
        if found:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc long, doc_id {kind}, seeds array<long>, tokens binary")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_chars: int = BLOCK_CHARS,
    common: int = COMMON,
) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, matched, longest`` of each document and item it leaks.

    Null and empty texts match nothing, and neither do items of fewer than ``min_match`` tokens. Items of
    the same tokens are reported under the smallest id; rows that share a document id each give their pairs. Ids
    are of any type that has an order. Documents are read once, however large the benchmark is; a row with seeds of
    the benchmark goes on as token hashes. Seeds and items are joined on Spark, and nothing but a set of fixed
    size passes through the driver. A line that many items share leads to an item only if such lines could
    cover it; a text of one token over and over costs no more than others of its length.
    """
    own = inputs(benchmark, item_id=item_col, text=item_text).where("text is not null")
    items = _items(own, min_match)
    indexed, spare = _indexed(items, min_match, coverage, common)
    indexed = saved(indexed, "benchmark-index")
    hits = saved(_hits(inputs(docs, doc_id=id_col, text=text_col), _seed_set(indexed), min_match, block_chars), "seed-hits")
    shared = hits.select("doc", F.explode("seeds").alias("h")).join(indexed, "h").groupBy("doc", "item").agg(
        F.expr(f"{_covered('places', min_match)} as reach")
    )
    likely = shared.join(spare, "item", "left").join(items.withColumnRenamed("tokens", "wanted"), "item")
    # no tiling can cover more than all seeds together
    likely = likely.where(F.col("reach") + F.coalesce("spare", F.lit(0)) >= F.lit(coverage) * F.col("n"))
    pairs = likely.select("doc", "item_id", "wanted").join(hits.select("doc", "doc_id", "tokens"), "doc")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = []
            for k, (wanted, raw) in enumerate(zip(batch.column("wanted").to_pylist(), batch.column("tokens").to_pylist())):
                item, doc = np.frombuffer(wanted, np.uint64), np.frombuffer(zstandard.decompress(raw), np.uint64)
                a, b = rolling(item, min_match), rolling(doc, min_match)
                sizes = [x[2] for x in greedy(item, doc, np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a)), min_match)]
                if sum(sizes) >= coverage * len(item):
                    found.append((k, sum(sizes) / len(item), len(sizes), sum(sizes), max(sizes)))
            if found:
                at, *rest = zip(*found)
                types = [pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(at)) for c in ("doc_id", "item_id")] + [pa.array(c, t) for c, t in zip(rest, types)],
                    ["doc_id", "item_id", "coverage", "n_tiles", "matched", "longest"],
                )

    kinds = [pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, coverage double, n_tiles int, matched int, longest int"
    return pairs.select("doc_id", "item_id", "wanted", "tokens").mapInArrow(tile, schema)
