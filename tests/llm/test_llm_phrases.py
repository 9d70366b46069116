import random
import re
from collections import Counter

import pytest

from lakeops.llm import phrases as ph

SCHEMA = "text string, lang string"
COLUMNS = "lang rank phrase a l r n score".split()
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows: list, top: int, least: int) -> list[tuple]:
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            own.update(tuple(ws[i : i + m]) for m in range(1, 6) for i in range(len(ws) - m + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in cand.items()):
                continue
            s, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), a, own[p[:k]], own[p[k:]]))
        for rank, (s, _, p, a, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), a, l, r, n[lang], -s))
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def made(seed: int, n: int) -> list[tuple]:
    """Texts with words of falling frequency, fixed phrases within them, and odd characters."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ünter", "x\x1cy", "é"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    fixed = ["New York city", "as well as", "a b c d e f g", "go go go go", "Ünter den x\x1cy"]
    rows = []
    for _ in range(n):
        bits = [rng.choice(fixed) if rng.random() < 0.2 else rng.choices(vocabulary, weights)[0] for _ in range(rng.randint(0, 60))]
        text = "".join(b + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  ", "\x0b"]) for b in bits)
        rows.append((text, rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("top,least,frontier,batch", [(1000, 3, 10, 10**6), (15, 3, 1, 2000), (5, 2, 0, 300), (3, 4, 2, 10**6)])
def test_against_brute_force(spark, top, least, frontier, batch):
    rows = made(top, 120) + [(None, "en"), ("", "de"), ("only", "xx"), (" . ; ", "yy")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as a", "'x' as phrase", "2 as n").repartition(3)
    assert found(ph.collocations(df, top=top, least=least, frontier=frontier, batch_bytes=batch)) == plain(rows, top, least)


def test_a_phrase_that_is_everywhere_and_repeated_rows(spark):
    rows = [("The end of it", "en")] * 300 + [("the end", "en")] * 20 + [("of it the end of it", "en")] * 5
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(ph.collocations(df)) == plain(rows, 2000, 100)


def test_a_very_long_text(spark):
    rows = [("one two three. " * 40_000 + "four five " * 30_000, "en")]
    assert found(ph.collocations(spark.createDataFrame(rows, SCHEMA), batch_bytes=100_000)) == plain(rows, 2000, 100)


def test_no_texts(spark):
    for rows in ([], [(None, None)], [("", "en")]):
        assert found(ph.collocations(spark.createDataFrame(rows, SCHEMA))) == []


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(3)
    n = 10**14 + 7
    word, pair = {}, {}
    for k in range(50):
        word[f"a{k}"], word[f"b{k}"] = rng.randrange(10**12, 10**13), rng.randrange(10**12, 10**13)
        pair[f"a{k} b{k}"] = rng.randrange(10**11, 10**12)
    known = spark.createDataFrame([("en", p, a) for p, a in word.items()], "lang string, phrase string, a long")
    grown = spark.createDataFrame([("en", p, a) for p, a in pair.items()], known.schema)
    state = spark.createDataFrame([("en", n, 10**14)], "lang string, n long, reach long")
    got = {r.phrase: r.score for r in ph.survivors(grown, known, state).collect()}
    assert got == {p: 1000 * a * n // (word[p.split()[0]] * word[p.split()[1]]) for p, a in pair.items()}


def test_words_and_parts():
    assert ph.words(b"A\tb,C d\x0be\x00 \xc3\x84") == [b"a", b"b", b".", b"c", b"d", b".", b"e\x00", b"\xc3\x84"]
    text = b"ab cd. ef gh! ij kl mn"
    for size in (1, 4, 8, 100):
        assert b" ".join(b" . ".join(ph.parts(text, size)).replace(b".", b" . ").split()) == b" ".join(ph.words(text))
