"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    crossparse, hamming, licences, lmscore, maintext, packing, phrases, simhash, spans, tiling, tokenids, toxicity, trie,
)
from lakeops.llm.common import saved, table
from lakeops.session import scratch_path
from lakeops.suite.registry import Query, Run

LLM: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(run: Run) -> Run:
        LLM[run.__name__] = Query(run, sql)
        return run

    return add


# words as the operator takes them: lower case, between ASCII white space
_SIDE = """
  CASE WHEN {n} = 0 THEN ln(1e0 / v) ELSE ln(
    CASE WHEN coalesce(h.{c}, 0) > 0
      THEN 0.6e0 * coalesce(b.{c}, 0) / h.{c} + 0.3e0 * u.{c} / {n} ELSE 0.9e0 * u.{c} / {n} END + 0.1e0 / v) END"""
LM_SQL = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS chosen
  FROM documents),
tokens AS (
  SELECT doc_id, chosen, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS p
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM split)),
uni AS (SELECT w, count(*) AS a, count(*) FILTER (chosen) AS t FROM tokens GROUP BY w),
bi AS (SELECT p, w, count(*) AS a, count(*) FILTER (chosen) AS t FROM tokens WHERE p IS NOT NULL GROUP BY p, w),
total AS (SELECT sum(a)::DOUBLE AS na, sum(t)::DOUBLE AS nt, count(*) AS v FROM uni),
logs AS (
  SELECT doc_id, {_SIDE.format(c="a", n="na")} AS la, {_SIDE.format(c="t", n="nt")} AS lt
  FROM tokens JOIN uni u USING (w) LEFT JOIN uni h ON h.w = tokens.p
  LEFT JOIN bi b ON b.p = tokens.p AND b.w = tokens.w, total)
SELECT split.doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(-avg(lt), 6) AS ce_target,
  round(-avg(la), 6) AS ce_background, round(avg(la) - avg(lt), 6) AS score
FROM split LEFT JOIN logs USING (doc_id) GROUP BY split.doc_id, len(ws)
"""


@query(LM_SQL)
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closeness of every document to the ones labelled good, against all documents."""
    chosen = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = lmscore.cross_entropy_difference(table(spark, sf_dir, "documents"), chosen)
    return scored.withColumns({c: F.round(c, 6) for c in ("ce_target", "ce_background", "score")})


@query()
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it leaks."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from the compressed shards."""
    path = scratch_path(spark, "token-shards")
    tokenids.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenids.digests(tokenids.stored(spark, path))


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in every document."""
    return licences.notices(table(spark, sf_dir, "documents"))


@query()
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences that were there before."""
    return spans.without_repeats(table(spark, sf_dir, "documents"))


@query()
def op6_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return hamming.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    pages = table(spark, sf_dir, "pages")
    return maintext.main_text(pages, maintext.train(pages))


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bin and offset of every piece of every document; copies and documents of one source are kept apart."""
    return packing.best_fit(packing.measured(table(spark, sf_dir, "documents")))


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


# bit by bit, from the lowest, over the bytes of a decimal number
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)),
    lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295)"""
TRIE_SQL = f"""
WITH filled AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || ':' || text)) - 1 AS pos
  FROM filled),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC.format(x="conv_id")} % 4 AS h FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE pos < h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h),
s AS (
  SELECT conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS seq
  FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
p AS (SELECT conv_id, seq[1:d] AS path, d, d = len(seq) AS done FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    len(list_filter(string_split_regex(coalesce(path[d].t, ''), '[ \\t-\\r]+'), lambda x: x <> '')) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (done), '') AS ends
  FROM p GROUP BY path, d),
k AS (SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM n b WHERE b.d = n.d + 1 AND b.path[1:n.d] = n.path) AS n_children
  FROM n LEFT JOIN n u ON n.d = u.d + 1 AND n.path[1:u.d] = u.path)
SELECT k.conv_id, k.d AS depth, k.parent_conv_id, k.n_convs, k.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
  sum((b.n_convs - 1) * b.words)::BIGINT AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN k b ON b.d >= k.d AND b.path[1:k.d] = k.path
GROUP BY k.path, k.conv_id, k.d, k.parent_conv_id, k.n_convs, k.n_children, k.ends
"""


def branched(turns: DataFrame) -> DataFrame:
    """Conversations that share beginnings: c has the first h turns of c - c % 20, then its own after h.

    h is crc32 of the decimal id, modulo 4. A row without turn names each conversation.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    base = F.expr("conv_id - conv_id % 20")
    each = turns.where("pos = 0").select("conv_id", base.alias("base"), h.alias("h"))
    heads = turns.where((F.col("conv_id") == base) & (F.col("pos") < 3))
    heads = heads.select(F.col("conv_id").alias("base"), "pos", "turn_key", "n_words")
    taken = each.join(heads, "base").where("pos < h").select("conv_id", "pos", "turn_key", "n_words")
    own = turns.where(F.col("pos") >= h).select("conv_id", "pos", "turn_key", "n_words")
    names = each.selectExpr("conv_id", "cast(null as bigint) pos", "cast(null as binary) turn_key", "0L n_words")
    return own.unionByName(taken).unionByName(names)


@query(TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the branched conversations, with its members, children, leaves and ends."""
    turns = trie.turns(table(spark, sf_dir, "conversations")).select("conv_id", "pos", "turn_key", "n_words")
    return trie.prefix_trie(branched(saved(turns, "turns"))).drop("node_a", "node_b")


@query()
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out; a row without id is neither."""
    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    found = crossparse.identify(docs, crossparse.learn(docs.where(rest != 2)))
    return found.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))


# all phrases of one to five words, counted; then every cut of every candidate
PHRASE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM split, (SELECT unnest(range(1, 6)) AS m))),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.m, c.ws, k, l.a AS l, r.a AS r, n,
    (1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN total USING (lang) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand q WHERE q.lang = b.lang AND q.m > b.m AND 100 * q.a >= 100 * b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


@query(PHRASE_SQL)
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
