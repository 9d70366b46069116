"""Collocations of two to five words by best-first branch and bound, language by language.

A phrase scores at most 1000 * n / f for the count f of its first and of its last word, since every cut leaves a
part that occurs as often as the phrase at least. Words therefore form a frontier by falling bound: the
rarest are grown first, and more frequent ones only until a language's last wanted score passes the
bound of all words that are left. Growth goes from words to pairs to longer phrases, through frequent
prefixes only.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, saved, slices

#: Phrases returned for each language, least count of a phrase, and words of the longest.
TOP, LEAST, LONGEST = 2000, 100, 5
#: Words of a language that are grown first, for each phrase wanted. Only the number of passes depends on it.
FRONTIER = 10
#: Bits of the sets of frequent words and pairs that tasks get: 16 MB whatever the corpus. What they let
#: through is counted exactly, so that a full set costs time and changes no result.
SET_BITS = 27
#: Parts of a language whose best phrases are found apart before they are ranked together.
PARTS = 128
#: Bytes of text whose counts a task adds up before it sends them.
BATCH_BYTES = 8_000_000

_LOWER_AND_SPLIT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz.......... ")
_COUNTS = "lang string, phrase string, a long"


def words(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only); a full stop stands between pieces."""
    return text.translate(_LOWER_AND_SPLIT).replace(b".", b" . ").split()


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """The text, cut between pieces where it is longer than ``size``."""
    text, at = text.translate(_LOWER_AND_SPLIT), 0
    while len(text) - at > size:
        end = text.rfind(b".", at, at + size)
        end = end if end >= 0 else text.find(b".", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def counted(docs: DataFrame, count: Callable[[str, list[bytes]], Iterator[tuple[bytes | None, int]]], batch_bytes: int) -> DataFrame:
    """``lang, phrase, a``: what ``count`` finds in the words of each language, summed over batches of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                found = list(count(lang, words(b".".join(texts))))
                for at in range(0, len(found), 100_000):
                    phrase, n = zip(*found[at : at + 100_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang), len(n)), pa.array(phrase, pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "a"]
                    )
            held.clear()

        for some in slices(batches):
            for lang, text in zip(some.column("lang").to_pylist(), some.column("text").cast(pa.binary()).to_pylist()):
                for part in parts(text, batch_bytes):
                    held[lang].append(part)
                    size += len(part)
                    if size >= batch_bytes:
                        yield from flush()
                        size = 0
        yield from flush()

    return docs.mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def word_counts(lang: str, tokens: list[bytes]) -> Iterator[tuple[bytes | None, int]]:
    """Every word; the row without phrase is the number of all words."""
    found = Counter(tokens)
    del found[b"."]
    yield None, sum(found.values())
    yield from found.items()


def bit_set(spark: SparkSession, phrases: DataFrame) -> Broadcast:
    """The hashes of ``lang, phrase`` as a set of 2^SET_BITS bits, built by Spark block by block."""
    bit = F.expr(f"pmod(xxhash64(lang, phrase), {1 << SET_BITS}L)")
    blocks = phrases.groupBy(F.shiftright(bit, 15).alias("block")).agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    out = np.zeros((1 << SET_BITS) // 8, np.uint8)
    for r in blocks.collect():
        out[r.block * 4096 : (r.block + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(out)


def members(bits: list[np.ndarray], lang: str, phrases: list[bytes]) -> list[np.ndarray]:
    """Which phrases may be in each of the sets."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    at = np.array([xxhash.xxh64_intdigest(p, seed) for p in phrases], np.uint64) & np.uint64((1 << SET_BITS) - 1)
    return [(b[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool) for b in bits]


class Grown:
    """Growth of the frontier within one batch: all counts of phrases that touch it at one end at least."""

    def __init__(self, lang: str, tokens: list[bytes], known: Broadcast, front: Broadcast):
        number: dict = defaultdict(itertools.count().__next__)
        number[b"."]
        self.lang, self.ids = lang, np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.names = list(number)
        known_names, front_names = members([known.value, front.value], lang, self.names)
        known_names[0] = False
        self.known, self.front = known_names[self.ids], (front_names & known_names)[self.ids]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pairs of known words that touch the frontier, a place of each distinct pair, and which it is."""
        at = np.flatnonzero(self.known[:-1] & self.known[1:] & (self.front[:-1] | self.front[1:]))
        code = self.ids[at] * len(self.names) + self.ids[at + 1]
        _, first, which = np.unique(code, return_index=True, return_inverse=True)
        return at, at[first], which

    def phrase(self, at: int, size: int) -> bytes:
        return b" ".join([self.names[i] for i in self.ids[at : at + size].tolist()])

    def longer(self, frequent: Broadcast) -> Iterator[tuple[bytes, int]]:
        """Phrases of three words and more whose pairs, where they touch the frontier, are all frequent."""
        at, first, which = self.pairs()
        linked = np.zeros(len(self.ids), bool)
        linked[:-1] = self.known[:-1] & self.known[1:]
        linked[at] = members([frequent.value], self.lang, [self.phrase(p, 2) for p in first.tolist()])[0][which]
        at, code = np.flatnonzero(linked), None
        for size in range(3, LONGEST + 1):
            more = linked[at + size - 2] if len(at) else np.zeros(0, bool)
            if code is None:
                code = self.ids[at] * len(self.names) + self.ids[at + 1]
            at, code = at[more], code[more]
            code = np.unique(code, return_inverse=True)[1] * len(self.names) + self.ids[at + size - 1]
            touches = self.front[at] | self.front[at + size - 1]
            _, first, n = np.unique(code[touches], return_index=True, return_counts=True)
            for p, c in zip(at[touches][first].tolist(), n.tolist()):
                yield self.phrase(p, size), c


def expand(docs: DataFrame, known: DataFrame, front: DataFrame, least: int, batch_bytes: int) -> DataFrame:
    """``lang, phrase, a`` of all phrases of two words and more, frequent and with a frontier word at one end."""
    spark = docs.sparkSession
    sets = bit_set(spark, known), bit_set(spark, front)

    def pair_counts(lang: str, tokens: list[bytes]) -> Iterator[tuple[bytes, int]]:
        own = Grown(lang, tokens, *sets)
        _, first, which = own.pairs()
        yield from zip([own.phrase(p, 2) for p in first.tolist()], np.bincount(which, minlength=len(first)).tolist())

    pairs = saved(counted(docs, pair_counts, batch_bytes).where(F.col("a") >= least), "phrase-pairs")
    frequent = bit_set(spark, pairs)
    longer = counted(docs, lambda lang, tokens: Grown(lang, tokens, *sets).longer(frequent), batch_bytes)
    found = saved(pairs.union(longer.where(F.col("a") >= least)), "phrases")
    for b in (*sets, frequent):
        b.unpersist()
    return found


def survivors(found: DataFrame, known: DataFrame, state: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of phrases with both ends in the frontier that no longer one replaces.

    ``state`` has ``lang, n, reach``: the size of a language and the largest count of its frontier words.
    """
    size = F.size(F.split("phrase", " "))
    left = F.expr("substring_index(phrase, ' ', k)")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumn("words", size)
    cuts = cuts.withColumns({"left": left, "right": F.expr("substring_index(phrase, ' ', k - words)")})
    every = known.unionByName(found)
    lefts = every.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    rights = every.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    cuts = cuts.join(lefts, ["lang", "left"], "left").join(rights, ["lang", "right"], "left")
    cuts = cuts.join(F.broadcast(state), "lang")  # one row a language
    score = "cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    scored = cuts.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "a", "n").agg(
        F.max(F.expr("greatest(if(k = 1, l, 0), if(k = words - 1, r, 0)) > reach")).alias("beyond"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    within = F.array(
        F.expr("substr(phrase, length(substring_index(phrase, ' ', 1)) + 2)"),
        F.expr("substr(phrase, 1, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)"),
    )
    covered = found.where(size > 2).select("lang", F.explode(within).alias("phrase"), "a").distinct()
    kept = scored.where("not beyond").join(covered, ["lang", "phrase", "a"], "left_anti")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, first within parts of it, so that no task orders a whole language."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    some = some.where(F.col("place") <= top).drop("part", "place")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    return some.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    least: int = LEAST,
    frontier: int = FRONTIER,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line breaks, then at spaces and tabs. ``a`` counts a
    phrase, ``n`` all words of the language; ``l`` and ``r`` count the two sides of the cut with the lowest
    score, floor(1000 * a * n / (l * r)), the leftmost among equals. Phrases that occur less than
    ``least`` times, or always within one longer phrase, are left out. Null texts are empty, a null language is
    ``und``, repeated rows count each; equal scores are ordered by ``a``, then by bytes. Without texts
    there are no rows.

    A word or phrase that is everywhere is one row for each batch of texts. Counts of all words are kept on Spark;
    the driver sees a histogram and one score for each language, and the sets of fixed size.
    """
    rows = inputs(docs, text=text_col, lang=lang_col).where("text is not null")
    rows = rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    spark = docs.sparkSession
    counts = saved(counted(rows, word_counts, batch_bytes).where(F.col("phrase").isNull() | (F.col("a") >= least)), "phrase-words")
    known = counts.where("phrase is not null")
    sizes = {r.lang: r.a for r in counts.where("phrase is null").collect()}
    # the number of words by the power of two of their counts: at most 64 rows a language
    steps: dict[str, dict[int, tuple]] = defaultdict(dict)
    for r in known.groupBy("lang", F.expr("length(bin(a))").alias("p")).agg(F.count("*").alias("c"), F.max("a").alias("top")).collect():
        steps[r.lang][r.p] = (r.c, r.top)
    reach, most = {}, {lang: max(t for _, t in s.values()) for lang, s in steps.items()}
    for lang, s in steps.items():
        total = 0
        for p in sorted(s):
            total += s[p][0]
            reach[lang] = s[p][1]
            if total >= frontier * top:
                break
    done = []
    while reach:
        state = spark.createDataFrame([(x, sizes[x], reach[x]) for x in reach], "lang string, n long, reach long")
        now = known.join(F.broadcast(state.select("lang", "reach")), "lang")
        found = expand(
            rows.where(F.col("lang").isin(list(reach))), now.drop("reach"), now.where("a <= reach").drop("reach"), least, batch_bytes
        )
        best = saved(ranked(survivors(found, known, state), top), "phrase-best")
        last = {r.lang: r.score for r in best.where(F.col("rank") == top).collect()}
        settled, later = [], {}
        for lang, f in reach.items():
            if f >= most[lang] or (lang in last and last[lang] > 1000 * sizes[lang] // (f + 1)):
                settled.append(lang)
            else:
                far = 1000 * sizes[lang] // last[lang] if last.get(lang) else 64 * f
                later[lang] = min(most[lang], far)
        done.append(best.where(F.col("lang").isin(settled)))
        reach = later
    if not done:
        done.append(ranked(survivors(known.limit(0), known, spark.createDataFrame([], "lang string, n long, reach long")), top))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
