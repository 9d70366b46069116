"""Cross-entropy difference: how much likelier a text is under a target model than under the background.

Both models are interpolated bigram models of the same order, weights and vocabulary: background over
all documents, target over the chosen ones, vocabulary the words of all documents. For word w after v

    P(w | v) = BIGRAM * c(v, w) / c(v) + UNIGRAM * c(w) / N + REST / V

and without v, or where c(v) = 0, the bigram's weight goes to the unigram. A document's score is its
cross-entropy a word under the target minus that under the background: smaller is closer to the target.

Documents are dealt into batches of bounded size, and texts travel compressed. A batch is counted where
it lies, so an n-gram is one entry a batch however frequent it is. A batch's entries are sorted, cut by
ranges of the n-grams' hashes and sent as compressed blocks; each range adds up its blocks and returns
to a batch the totals of the entries that other batches hold too. What is in one batch alone, as
most n-grams are, the batch knows by itself. No model is held whole anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved, slices

BIGRAM, UNIGRAM, REST = 0.6, 0.3, 0.1
#: Characters of a batch, and of the texts whose n-grams share a range of hashes, on average.
BATCH_CHARS, RANGE_CHARS = 10_000_000, 16_000_000
#: Documents whose texts are compressed together.
PARCEL = 2_048
#: Bits of an n-gram's key: 55 of its hash, and whether it is a single word.
KEY_BITS = 56
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words between ASCII white space, and the words of each text."""
    seen: dict[bytes, int] = {}
    out, sizes = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = (text or "").lower().encode().split()
        for w in set(words).difference(seen):
            seen[w] = digest(w)
        out.append(np.array([seen[w] for w in words], np.uint64))
        sizes.append(len(words))
    return np.concatenate([*out, np.zeros(0, np.uint64)]), np.array(sizes, np.int64)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hash of each word and the one before it."""
    x = (words[:-1] * _MIX) ^ (words[1:] + (words[:-1] >> np.uint64(7)))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def inner(sizes: np.ndarray) -> np.ndarray:
    """For each neighbouring pair of all words laid end to end: do both lie in one text."""
    total = int(sizes.sum())
    ok = np.ones(max(total - 1, 0), bool)
    edges = np.cumsum(sizes)[:-1] - 1
    ok[edges[(edges >= 0) & (edges < total - 1)]] = False
    return ok


def log_p(uni, pair, history, words: float, vocabulary: float) -> np.ndarray:
    """Natural log of P for counts of words, of pairs and of the words before them (0 at a text's start)."""
    if not words:
        return np.full(len(uni), -np.log(vocabulary))
    share = np.divide(pair, history, out=np.zeros(len(uni)), where=history > 0)
    low = uni / words
    known = np.where(history > 0, BIGRAM * share + UNIGRAM * low, (BIGRAM + UNIGRAM) * low)
    return np.log(known + REST / vocabulary)


def keys(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each word, and of each word with the one before it (0 at a text's start)."""
    single = (words >> np.uint64(64 - KEY_BITS)) | np.uint64(1)
    pairs = np.zeros(len(words), np.uint64)
    if len(words):
        pairs[1:] = np.where(inner(sizes), (pair_hashes(words) >> np.uint64(64 - KEY_BITS)) & ~np.uint64(1), 0)
    return single, pairs


def pack(sorted_keys: np.ndarray, *counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, and counts, compressed."""
    steps = np.diff(sorted_keys, prepend=np.uint64(0)).astype("<u8")
    planes = [x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in (steps, *(c.astype("<u4") for c in counts))]
    return zstandard.compress(b"".join(planes), 1)


def unpack(block: bytes, n_counts: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(block), np.uint8)
    n = len(raw) // (8 + 4 * n_counts)
    out = [np.cumsum(raw[: 8 * n].reshape(8, n).T.copy().view("<u8").ravel(), dtype=np.uint64)]
    for k in range(n_counts):
        at = (8 + 4 * k) * n
        out.append(raw[at : at + 4 * n].reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64))
    return out


def parcels(rows: DataFrame) -> DataFrame:
    """``batch, parcel``: ids and texts of some documents of one batch, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for some in slices(batches, PARCEL):
            number = some.column("batch").to_numpy()
            texts = some.select(["doc_id", "text"])
            for n in np.unique(number):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, texts.schema, options=options) as out:
                    out.write_batch(texts.take(pa.array(np.flatnonzero(number == n))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch", "parcel"]
                )

    return rows.mapInArrow(run, "batch long, parcel binary")


def _open(parcel_column: pa.ChunkedArray) -> pa.Table:
    tables = [pa.ipc.open_stream(p).read_all() for p in parcel_column.to_pylist()]
    return pa.concat_tables(tables) if tables else pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})


def _local(docs: pa.Table, chosen: set) -> tuple:
    """Sizes of a batch's texts, its keys (sorted, distinct), where each word's are among them, and their counts."""
    words, sizes = word_hashes(docs.column("text").to_pylist())
    single, pairs = keys(words, sizes)
    distinct, where = np.unique(np.concatenate([single, pairs]), return_inverse=True)
    target = np.repeat(np.array([d in chosen for d in docs.column("doc_id").to_pylist()], bool), sizes)
    n_all = np.bincount(where, minlength=len(distinct))
    n_target = np.bincount(where, np.concatenate([target, target]), len(distinct)).astype(np.int64)
    return sizes, distinct, where[: len(words)], where[len(words) :], n_all, n_target


def cross_entropy_difference(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_chars: int = BATCH_CHARS,
    range_chars: int = RANGE_CHARS,
) -> DataFrame:
    """``doc_id, n_words, ce_target, ce_background, score`` (nats a word) for every row of ``docs``.

    ``target`` holds the ids of the target documents; ids without a document and nulls count nothing. Texts
    without words have null scores. Without target words, the target model is uniform over the
    vocabulary. Rows of one id are each counted and each scored; the id's hash picks the batch.
    """
    rows = inputs(docs, doc_id=id_col, text=text_col)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    batch = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(max(1, -(-chars // batch_chars)))).cast("long")
    ranges = max(1, -(-chars // range_chars))
    texts = parcels(rows.withColumn("batch", batch))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marks = target.select(target[id_col].cast(kind).alias("doc_id")).dropna().distinct().withColumn("batch", batch)

    def count(parcel: pa.Table, mark: pa.Table) -> pa.Table:
        """A batch's counts, a block for each range of keys."""
        out: dict[str, list] = {"range": [], "batch": [], "block": []}
        if parcel.num_rows:
            own = _open(parcel.column("parcel"))
            _, distinct, _, _, n_all, n_target = _local(own, set(mark.column("doc_id").to_pylist()))
            first = int(np.searchsorted(distinct, 1))  # key 0 stands for no pair
            distinct, n_all, n_target = distinct[first:], n_all[first:], n_target[first:]
            at = (distinct >> np.uint64(KEY_BITS - 32)) * np.uint64(ranges) >> np.uint64(32)
            cuts = np.searchsorted(at, np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[r], cuts[r + 1])
                out["range"].append(r)
                out["batch"].append(parcel.column("batch")[0].as_py())
                out["block"].append(pack(distinct[part], n_all[part], n_target[part]))
        return pa.table([pa.array(out["range"], pa.int64()), pa.array(out["batch"], pa.int64()), pa.array(out["block"], pa.binary())], list(out))

    def add(blocks: pa.Table) -> pa.Table:
        """Totals of one range: what batches share goes back to them; the row without batch has the sums."""
        owners = blocks.column("batch").to_pylist()
        parts = [unpack(b, 2) for b in blocks.column("block").to_pylist()]
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        key, n_all, n_target = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(key, kind="stable")
        key, n_all, n_target, owner = key[order], n_all[order], n_target[order], owner[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        held = np.diff(np.r_[starts, len(key)])
        sums = [np.add.reduceat(c, starts) for c in (n_all, n_target)]
        single = (key[starts] & np.uint64(1)).astype(bool)
        total = [int(sums[0][single].sum()), int(sums[1][single].sum()), int(single.sum())]
        shared = np.repeat(held > 1, held)
        key, owner, totals = key[shared], owner[shared], [np.repeat(c, held)[shared] for c in sums]
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(parts) + 1))
        out = [(None, None, *total)]
        for k, name in enumerate(owners):
            mine = order[cuts[k] : cuts[k + 1]]
            if len(mine):
                out.append((name, pack(key[mine], *(c[mine] for c in totals)), 0, 0, 0))
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["batch", "block", "n_all", "n_target", "words"])

    blocks = texts.groupBy("batch").cogroup(marks.groupBy("batch")).applyInArrow(count, "range long, batch long, block binary")
    totals = blocks.groupBy("range").applyInArrow(add, "batch long, block binary, n_all long, n_target long, words long")
    totals = saved(totals, "ngram-totals")
    sums = totals.agg(F.sum("n_all"), F.sum("n_target"), F.sum("words")).first()
    all_words, target_words, vocabulary = float(sums[0] or 0), float(sums[1] or 0), float(sums[2] or 1)

    def score(parcel: pa.Table, known: pa.Table) -> pa.Table:
        own = _open(parcel.column("parcel"))
        chosen = set(known.column("mark").drop_null().to_pylist())
        sizes, distinct, single, pairs, n_all, n_target = _local(own, chosen)
        for block in known.column("block").drop_null().to_pylist():
            key, more, more_target = unpack(block, 2)
            at = np.searchsorted(distinct, key)
            n_all[at], n_target[at] = more, more_target
        apart = pairs == 0 if len(distinct) and distinct[0] == 0 else np.zeros(len(pairs), bool)
        owner, entropy = np.repeat(np.arange(len(sizes)), sizes), {}
        for side, counts, total in (("all", n_all, all_words), ("target", n_target, target_words)):
            uni, pair = counts[single].astype(np.float64), np.where(apart, 0.0, counts[pairs])
            history = np.zeros(len(uni))
            history[1:] = uni[:-1]
            history[apart] = 0
            logs = log_p(uni, pair, history, total, vocabulary)
            entropy[side] = -np.bincount(owner, logs, len(sizes)) / np.maximum(sizes, 1)
        empty = sizes == 0
        return pa.table({
            "doc_id": own.column("doc_id") if parcel.num_rows else pa.array([], known.schema.field("mark").type),
            "n_words": pa.array(sizes),
            "ce_target": pa.array(entropy["target"], mask=empty),
            "ce_background": pa.array(entropy["all"], mask=empty),
            "score": pa.array(entropy["target"] - entropy["all"], mask=empty),
        })

    known = totals.where("batch is not null").select("batch", "block", F.lit(None).cast(kind).alias("mark"))
    known = known.union(marks.select("batch", F.lit(None).cast("binary"), "doc_id"))
    return texts.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(
        score, f"doc_id {kind}, n_words long, ce_target double, ce_background double, score double"
    )
