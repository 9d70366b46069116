import random
from collections import Counter

import pytest
from llm_cases import documents, prose, rows

from lakeops.llm import licences
from lakeops.llm.common import table


def plain(text: str, t: float = licences.THRESHOLD) -> list[tuple]:
    """All windows that start at a shared bigram and span the template's size, trimmed to shared bigrams."""
    ws = licences.words(text)
    grams, out = list(zip(ws, ws[1:])), []
    for name, template in licences.TEMPLATES.items():
        tw = licences.words(template)
        own = Counter(zip(tw, tw[1:]))
        size, found = sum(own.values()), []
        for a in range(len(grams)):
            if grams[a] not in own:
                continue
            b = max(k + 1 for k in range(a, min(a + size, len(grams))) if grams[k] in own)
            score = 2 * sum((Counter(grams[a:b]) & own).values()) / (b - a + size)
            if score >= t:
                found.append((-score, a, b))
        taken = []
        for score, a, b in sorted(found):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((name, -score, a, b - a + 1))
    return sorted(out)


def settled(found: list[tuple]) -> list[tuple]:
    """What is left when windows of different templates on much the same words compete, best first."""
    left: list[tuple] = []
    for x in sorted(found, key=lambda x: (-x[1], -x[3], x[2], x[0])):
        rivals = [y for y in left if y[0] != x[0] and 2 * len({*range(x[2], x[2] + x[3])} & {*range(y[2], y[2] + y[3])}) > max(x[3], y[3])]
        left += [] if rivals else [x]
    return sorted(left)


def test_all_documents_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = sorted((r.doc_id, *x) for r in docs.where("text ilike '%licen%' or text ilike '%rights%'").collect() for x in plain(r.text))
    got = rows(licences.notices(docs), "doc_id", "licence", "dice", "at_word", "n_words")
    assert want and got == want


@pytest.mark.parametrize("name", sorted(licences.TEMPLATES))
def test_each_template_is_found_in_prose(name):
    text = prose(1, 80) + "\n\n" + licences.TEMPLATES[name].upper().replace(" ", "\n * ") + "\n" + prose(2, 80)
    found = list(licences.Scanner(licences.TEMPLATES, licences.THRESHOLD).scan(text))
    assert (name, 1.0, 80) in [x[:3] for x in found]
    assert sorted(found) == settled(plain(text))


def test_changed_wording_and_size_bounds():
    mit = licences.words(licences.TEMPLATES["MIT"])
    scan = licences.Scanner(licences.TEMPLATES, licences.THRESHOLD).scan
    changed = mit[:20] + ["program"] + mit[21:60] + mit[62:]
    [(name, score, at, n)] = list(scan(" ".join(changed)))
    assert name == "MIT" and 0.85 <= score < 1 and score == pytest.approx(licences.dice(changed, mit))
    assert not list(scan(" ".join(mit[:50]))) and not list(scan("permission is hereby granted " * 40))


def test_nulls_repeats_ties_and_empty_tables(spark):
    notice = "Released under the MIT License."
    docs = documents(spark, [None, "", notice, notice, f"{notice} {prose(4, 30_000)} {notice}", "under the MIT"], ids=[0, 1, 2, 2, 3, None])
    got = rows(licences.notices(docs), "doc_id", "licence", "at_word", "n_words")
    assert got == [(2, "MIT-notice", 0, 5)] * 2 + [(3, "MIT-notice", 0, 5), (3, "MIT-notice", 30_005, 5)]
    assert licences.notices(documents(spark, [])).count() == 0


def every_window(text: str, t: float = licences.THRESHOLD) -> list[tuple]:
    """All windows of all lengths between two shared bigrams, best first, without overlaps."""
    ws = licences.words(text)
    grams, out = list(zip(ws, ws[1:])), []
    for name, template in licences.TEMPLATES.items():
        tw = licences.words(template)
        own = Counter(zip(tw, tw[1:]))
        size, found = sum(own.values()), []
        for a in range(len(grams)):
            held, common = Counter(), 0
            for b in range(a + 1, len(grams) + 1) if grams[a] in own else ():
                held[grams[b - 1]] += 1
                common += held[grams[b - 1]] <= own[grams[b - 1]]
                if grams[b - 1] in own and 2 * common / (b - a + size) >= t:
                    found.append((-2 * common / (b - a + size), a, b))
        taken = []
        for score, a, b in sorted(found):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((name, -score, a, b - a + 1))
    return sorted(out)


def test_inserted_and_shortened_notices_against_all_lengths():
    scan = licences.Scanner(licences.TEMPLATES, licences.THRESHOLD).scan
    mit, apache = (licences.words(licences.TEMPLATES[x]) for x in ("MIT", "Apache-2.0-header"))
    line = [f"owner{k}" for k in range(19)]
    cases = {
        "MIT": [mit[:44] + line[:18] + mit[44:], mit[:70] + "and that is all of the text that the copies of the tool have to be in".split()],
        "Apache-2.0-header": [apache[:50] + line + apache[50:]],
    }
    for name, texts in cases.items():
        for ws in texts:
            found = sorted(scan(" ".join(ws)))
            assert name in [x[0] for x in found] and found == every_window(" ".join(ws))


@pytest.mark.parametrize("seed", range(30))
def test_edited_neighbouring_notices_against_all_lengths(seed):
    rng, ws = random.Random(seed), []
    for _ in range(4):
        part = licences.words(licences.TEMPLATES[rng.choice(["MIT", "ISC", "Apache-2.0-header", "BSD-2-Clause", "GPL-3.0-notice"])])
        part = part[rng.choice([0, 0, 3]) : len(part) - rng.choice([0, 0, 5, 9])]
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(part) + 1)
            part[at : at + rng.randint(0, 2)] = rng.choice([[], ["other"], ["of", "the"], ["x"] * 8])
        ws += part * rng.choice([1, 1, 2]) + ["of", "the", "word"] * rng.choice([0, 0, 2])
    text = " ".join(ws)
    assert sorted(licences.Scanner(licences.TEMPLATES, licences.THRESHOLD).scan(text)) == every_window(text)


def overlap(x: tuple, y: tuple) -> int:
    return min(x[2] + x[3], y[2] + y[3]) - max(x[2], y[2])


@pytest.mark.parametrize("name", sorted(licences.ALL))
def test_each_licence_is_reported_alone_among_its_neighbours(name):
    before = prose(1, 80)
    text = before + "\n\n" + licences.ALL[name].upper().replace(" ", "\n * ") + "\n" + prose(2, 80)
    found = list(licences.Scanner(licences.ALL, licences.THRESHOLD).scan(text))
    size = len(licences.words(licences.ALL[name]))
    assert (name, 1.0, 80, size) in found
    # what else is found is a short notice within the text
    assert all(2 * x[3] < size and 80 <= x[2] and x[2] + x[3] <= 80 + size for x in found if x[0] != name)


def test_windows_compete_as_pairs_say():
    scanner = licences.Scanner(licences.ALL, licences.THRESHOLD)
    rng = random.Random(2)
    for _ in range(60):
        ws: list[str] = []
        for _ in range(3):
            part = licences.words(licences.ALL[rng.choice(sorted(licences.ALL))])
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(part) + 1)
                part[at : at + rng.randint(0, 2)] = rng.choice([[], ["other"], ["of", "the"]])
            ws += part
        every, left = list(scanner.windows(" ".join(ws))), list(scanner.scan(" ".join(ws)))
        better = lambda x, y: (-x[1], -x[3], x[2], x[0]) < (-y[1], -y[3], y[2], y[0])
        beaten = lambda y: [x for x in left if x[0] != y[0] and better(x, y) and 2 * overlap(x, y) > max(x[3], y[3])]
        assert left == [y for y in every if not beaten(y)]


def test_licences_that_differ_in_a_word(spark):
    texts = {
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0-long-notice",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0-notice",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0-notice",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "SPDX:GPL-2.0-or-later",
        "// spdx-license-identifier: bsd-3-clause": "SPDX:BSD-3-Clause",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0-notice",
    }
    got = rows(licences.notices(documents(spark, list(texts))), "doc_id", "licence", "dice")
    assert got == [(k, name, 1.0) for k, name in enumerate(texts.values())]
