"""Token ids of documents in compressed shards.

Documents are encoded in ascending order of their ids and gathered into shards. A shard's ids are
compressed by Re-Pair: frequent pairs of neighbouring symbols are replaced by new symbols, round after
round, until no pair is frequent. The file format is a Parquet table with a row for each shard: the
rules, each rule's expansion length, the symbols, and the documents with the end of each. The lengths
give the symbol that holds any position, so one document is decoded without the others.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.common import inputs, slices

END_ID = 2
SHARD_IDS = 1 << 20
#: A pair is replaced while it occurs so often; a rule takes 12 bytes of a shard.
MIN_PAIRS = 32
#: Pieces a worker remembers.
REMEMBERED = 800_000
#: Bytes of text encoded together.
AT_ONCE = 1 << 20
# Characters on which all regex and case-folding versions agree; other texts take the library's whole way.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‧€]*")
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Byte-level vocabularies write a byte as itself if it is a visible Latin-1 character, else as one from U+0100 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = {b: 0x100 + k for k, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}
_ALPHABET = "".join(chr(_OTHERS.get(b, b)) for b in range(0x100))
#: The cuts that ``_cuts`` makes.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_KINDS = np.full(0x3000, _OTHER, np.uint8)  # plain characters and their lower case
_KINDS[:0x21] = _SPACE
for _kind, _class in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
    _KINDS[[m.start() for m in regex.finditer(_class, "".join(map(chr, range(len(_KINDS)))))]] = _kind
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts, exactly as the tokenizers library gives them.

    A vocabulary whose pre-tokenizer cuts the text by ``_PATTERN`` gives each piece the same ids wherever
    it stands. Such a piece is given to the library's model once and remembered. Texts with special
    tokens or with characters beyond the plain ones, and all texts of other vocabularies, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        steps = (config.get("normalizer") or {}).get("normalizers", [])
        cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_run = (
            [s["type"] for s in steps] == _NORMALIZERS
            and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _PATTERN}
            and (cuts[0]["behavior"], cuts[0]["invert"], cuts[1]["use_regex"]) == ("Removed", True, False)
            and not cuts[1]["add_prefix_space"]
            and config["model"]["type"] == "BPE"
        )
        self.special = tuple(t["content"] for t in config.get("added_tokens") or ())

    @classmethod
    def at(cls, path: str) -> Encoder:
        """The worker's own, which later tasks use again."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts, one after the other, and where those of each text end.

        The pieces of all texts are cut and numbered together, and each different one is looked up once.
        """
        if len(texts) == 1 and self._plain(texts[0]) and len(parts := _portions(texts[0])) > 1:
            ids = np.concatenate([self.encode(t) for t in parts])
            return ids, np.array([len(ids)])
        odd = {k: self.library.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts) if not self._plain(t)}
        # No plain text holds U+0000, so it can stand between them.
        joined = "\0".join(["", *("" if k in odd else t for k, t in enumerate(texts)), ""]).lower()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(joined.encode(), np.uint8)
        new = _cuts(points)
        starts, borders = np.flatnonzero(new), np.flatnonzero(points == 0)
        shown = points > 0x20
        places = np.flatnonzero(new[shown])
        if len(data) > len(points):
            points = points[shown]
            places = np.r_[0, np.cumsum(1 + (points >= 0x80).view(np.int8) + (points >= 0x800).view(np.int8))][places]
        data = data[data > 0x20]
        buffers = [None, pa.py_buffer(np.r_[places, len(data)]), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        spelled = self._spelled(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        flat = np.frombuffer(b"".join(spelled), np.uint32)
        ids, stops = _gather(flat, np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy())
        ends = np.r_[0, stops][np.searchsorted(starts, borders[1:])]
        if odd:
            parts = np.split(ids, ends[:-1])
            for k, own in odd.items():
                parts[k] = np.array(own, np.uint32)
            ids, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return ids, ends

    def _plain(self, text: str) -> bool:
        """Whether the text's pieces may be encoded each for itself."""
        return self.by_run and _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _spelled(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. They are remembered in two halves: what is not asked for while one half fills is forgotten."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        known, older, tokenize = self.known, self.older, self.model.tokenize
        out = list(map(known.get, pieces))
        for k in [k for k, ids in enumerate(out) if ids is None]:
            piece = pieces[k]
            ids = older.get(piece)
            if ids is None:
                spelled = piece if piece.isascii() else charmap_decode(piece.encode(), "strict", _ALPHABET)[0]
                ids = array("I", [t.id for t in tokenize(spelled)]).tobytes()
            out[k] = known[piece] = ids
        return out


def _portions(text: str) -> list[str]:
    """The text cut at white space, if it has some, into parts of at most ``AT_ONCE`` characters."""
    parts, at = [], 0
    while len(text) - at > AT_ONCE:
        cut = max(text.rfind(c, at + 1, at + AT_ONCE) for c in " \n\r\t")
        if cut < 0:
            break
        parts.append(text[at:cut])
        at = cut
    return [*parts, text[at:]]


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of ``AT_ONCE`` bytes at most; a longer one stands alone."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        yield at, stop
        at = stop


def _cuts(points: np.ndarray) -> np.ndarray:
    """Where a piece of ``_PATTERN`` starts, in the code points of plain lower-case texts after a U+0000 each."""
    kinds = _KINDS[points]
    new = np.zeros(len(points), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
    new &= kinds != _SPACE
    quotes = np.flatnonzero(points == ord("'"))
    quotes = quotes[kinds[quotes - 1] != _OTHER]  # inside a run of signs it starts nothing
    after = np.r_[points, 0, 0]
    first, second = after[quotes + 1], after[quotes + 2]
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = np.isin(first, [ord(c) for c in "rv"]) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    new[quotes[short | long] + 1] = False
    rest = np.r_[quotes[short] + 2, quotes[long] + 3]
    new[rest] = kinds[rest] != _SPACE
    return new


def _gather(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` named by ``which``, one after the other, and where each ends."""
    own = sizes[which]
    ends = np.cumsum(own)
    at = np.repeat(begin[which] - (ends - own), own)
    at += np.arange(len(at))
    return flat[at], ends


def frequent_pairs(keys: np.ndarray, min_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, often): the pairs that occur at least an eighth as often as the most frequent one, and ``min_pairs``
    times; sorted. And the places of all keys that may belong to a pair that occurs ``min_pairs`` times.

    Pairs are first counted by bits of a hash. Only those in full buckets, a small part of all, are sorted
    and counted exactly; a bucket never holds fewer than one of its pairs does.
    """
    bits = min(20, max(8, len(keys).bit_length()))
    spot = _spot(keys, bits)
    held = np.bincount(spot, minlength=1 << bits)
    often = np.flatnonzero((held >= min_pairs).take(spot))
    keys, spot = keys.take(often), spot.take(often)
    least = max(min_pairs, int(held.max()) // 8)
    while True:
        ranked = np.sort(keys.take(np.flatnonzero((held >= least).take(spot))))
        if not len(ranked):
            return ranked, often
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        counts = np.diff(np.r_[starts, len(ranked)])
        wanted = max(min_pairs, int(counts.max()) // 8)
        if wanted >= least:
            return ranked[starts[counts >= wanted]], often
        least = wanted  # the fullest bucket held several pairs: the most frequent one has fewer


def compress(ids: np.ndarray, base: int, min_pairs: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): rule k is the pair that symbol ``base + k`` stands for.

    Each round counts pairs and replaces those that occur at least an eighth as often as the most
    frequent one. Where chosen pairs overlap, every other one from the left is replaced; a pair that this
    leaves in one place gets no rule. A pair never becomes more frequent after the round that made it, so
    places of a pair that occurs less than ``min_pairs`` times are not counted again until a neighbour is replaced.
    """
    symbols, rules, top = ids.astype(np.uint32), [], base
    at = np.arange(len(symbols) - 1)
    while len(symbols) > 1:
        shift = 16 if top <= 1 << 16 else 32
        kind = np.uint32 if shift == 16 else np.uint64
        keys = (symbols.take(at).astype(kind, copy=False) << kind(shift)) | symbols.take(at + 1)
        chosen, often = frequent_pairs(keys, min_pairs)
        if not len(chosen):
            break
        at, keys = at.take(often), keys.take(often)
        live = np.zeros(len(symbols), bool)
        live[at] = True
        sieve = np.zeros(1 << 16, bool)
        sieve[_spot(chosen, 16)] = True
        some = np.flatnonzero(sieve.take(_spot(keys, 16)))
        at, keys = at.take(some), keys.take(some)
        rule = np.searchsorted(chosen, keys)
        hit = np.flatnonzero(chosen.take(rule, mode="clip") == keys)
        at, rule = at.take(hit), rule.take(hit)
        fresh = np.r_[True, at[1:] != at[:-1] + 1]  # a run of overlapping pairs starts here
        place = np.arange(len(at))
        place -= np.maximum.accumulate(np.where(fresh, place, 0))
        even = np.flatnonzero(place & 1 == 0)
        at, rule = at.take(even), rule.take(even)
        several = np.bincount(rule, minlength=len(chosen)) > 1
        if not several.any():
            break
        used = np.flatnonzero(several.take(rule))
        at, rule = at.take(used), (np.cumsum(several) - 1).take(rule.take(used))
        pairs = chosen[several].astype(np.uint64)
        rules.append(np.stack([pairs >> np.uint64(shift), pairs & np.uint64((1 << shift) - 1)], 1).astype(np.uint32))
        symbols[at] = top + rule
        live[at] = live[np.maximum(at, 1) - 1] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        kept = np.flatnonzero(keep)
        symbols, live = symbols.take(kept), live.take(kept)
        at = np.flatnonzero(live[:-1])
        top += len(pairs)
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), symbols


def _spot(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper bits of a hash."""
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.uint32)


def expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids each rule stands for."""
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((1 if a < base else lengths[a - base]) + (1 if b < base else lengths[b - base]))
    return np.array(lengths, np.int64)


class Shard:
    """A stored shard; ``ids(a, b)`` decodes the positions from a up to b alone."""

    def __init__(self, base: int, rules: bytes, lengths: bytes, symbols: bytes) -> None:
        self.base = base
        self.symbols = np.frombuffer(symbols, "<u4")
        self.lengths = np.frombuffer(lengths, "<i8")
        spelled: list[list[int]] = []
        for a, b in np.frombuffer(rules, "<u4").reshape(-1, 2).tolist():
            spelled.append(([a] if a < base else spelled[a - base]) + ([b] if b < base else spelled[b - base]))
        # a base symbol stands for itself: it is found in front, at its own number
        self.flat = np.r_[np.arange(base, dtype=np.uint32), np.fromiter(chain.from_iterable(spelled), np.uint32)]
        self.size = np.r_[np.ones(base, np.int64), self.lengths]
        self.start = np.cumsum(self.size) - self.size
        self.ends = np.cumsum(self.size[self.symbols])

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.uint32)
        lo, hi = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.ends, b, "left") + 1
        out, _ = _gather(self.flat, self.start, self.size, self.symbols[lo:hi])
        skip = a - (int(self.ends[lo - 1]) if lo else 0)
        return out[skip : skip + b - a]


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    min_pairs: int = MIN_PAIRS,
) -> None:
    """Write the shards of all rows below ``path``, which all executors must be able to reach.

    Null ids come first; rows of one id follow each other by text. A null text is empty and is its end
    id alone. A shard closes when it holds ``shard_ids`` ids, so a document is never cut. The
    vocabulary file is read on the executors.
    """
    rows = inputs(docs, doc_id=id_col, text=text_col)
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder.at(vocabulary), TaskContext.get().partitionId(), 0
        base = max(encoder.library.get_vocab_size(), end_id + 1)
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []  # ids, number of each document's, names
        size = 0

        def shard() -> pa.RecordBatch:
            ids, sizes, names = zip(*held)
            ends = np.cumsum(np.concatenate(sizes))
            rules, symbols = compress(np.concatenate(ids), base, min_pairs)
            lengths = expansions(rules, base)
            whole = pa.array([0, len(ends)], pa.int32())
            cells = [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()),
                pa.array([base], pa.int64()), pa.ListArray.from_arrays(whole, pa.concat_arrays(names)),
                pa.ListArray.from_arrays(whole, pa.array(ends, pa.int64())),
                *(pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((rules, "<u4"), (lengths, "<i8"), (symbols, "<u4"))),
            ]
            return pa.RecordBatch.from_arrays(cells, SHARD_COLUMNS)

        for batch in batches:
            texts = batch.column("text").fill_null("")
            for lo, hi in _groups(pc.binary_length(texts).to_numpy()):
                ids, ends = encoder.encode_all(texts.slice(lo, hi - lo).to_pylist())
                ids = np.insert(ids, ends, np.uint32(end_id))
                ends = np.r_[0, ends + np.arange(1, len(ends) + 1)]
                k = 0
                while k < hi - lo:
                    # the document that fills the shard is its last
                    stop = min(int(np.searchsorted(ends, ends[k] + shard_ids - size)), hi - lo)
                    held.append((ids[ends[k] : ends[stop]], np.diff(ends[k : stop + 1]), batch.column("doc_id").slice(lo + k, stop - k)))
                    size += int(ends[stop] - ends[k])
                    k = stop
                    if size >= shard_ids:
                        yield shard()
                        held, size, number = [], 0, number + 1
        if held:
            yield shard()

    schema = f"part int, number int, n_ids long, base long, doc_ids array<{kind}>, ends array<long>, rules binary, lengths binary, symbols binary"
    rows.mapInArrow(run, schema).write.parquet(path)


SHARD_COLUMNS = ["part", "number", "n_ids", "base", "doc_ids", "ends", "rules", "lengths", "symbols"]


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored shards, one row each."""
    return spark.read.parquet(path)


def offsets(shards: DataFrame) -> DataFrame:
    """``part, number, before``: the ids of all shards before each. Sizes of a part's shards add up
    within the part, those of the parts over the parts."""
    sizes = shards.select("part", "number", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("outside"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    places = sizes.withColumn("inside", inside).join(parts, "part")
    return places.select("part", "number", (F.col("inside") + F.col("outside")).alias("before"))


def digests(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the stored shards.

    ``start``: ids of all documents before it; ``ids_crc32``: unsigned CRC-32 of its ids as little-endian
    unsigned 32-bit integers. Shards are decoded where they are read; only the digests meet the offsets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = {c: batch.column(c)[0].as_py() for c in ("base", "rules", "lengths", "symbols")}
            ends = batch.column("ends").flatten().to_numpy()
            ids = Shard(row["base"], row["rules"], row["lengths"], row["symbols"]).ids(0, int(ends[-1])).astype("<u4", copy=False)
            starts = np.r_[0, ends[:-1]]
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            same = pa.array(np.zeros(len(ends), np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part").take(same), batch.column("number").take(same), batch.column("doc_ids").flatten(),
                    *map(pa.array, (starts, ends - starts, np.array(sums, np.int64))),
                ],
                ["part", "number", "doc_id", "within", "n_tokens", "ids_crc32"],
            )

    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    each = shards.mapInArrow(run, f"part int, number int, doc_id {kind}, within long, n_tokens long, ids_crc32 long")
    return each.join(offsets(shards), ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def decoded(shards: DataFrame) -> DataFrame:
    """``doc_id, ids``: each document's ids, decoded alone by random access."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = {c: batch.column(c)[0].as_py() for c in ("base", "ends", "rules", "lengths", "symbols")}
            shard = Shard(row["base"], row["rules"], row["lengths"], row["symbols"])
            ends = row["ends"]
            for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids").flatten().slice(k, 1), pa.array([shard.ids(a, b).tolist()], pa.list_(pa.int64()))],
                    ["doc_id", "ids"],
                )

    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    return shards.mapInArrow(run, f"doc_id {kind}, ids array<long>")
