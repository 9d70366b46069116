import re
from html.parser import HTMLParser

import pytest
from llm_cases import rows

from lakeops.llm import maintext
from lakeops.llm.common import table


class Article(HTMLParser):
    """What lies in the article element, by Python's own parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in maintext.BLOCKS:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in maintext.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def plain(page: str) -> str:
    parser = Article()
    parser.feed(page)
    parser.close()
    return "\n".join(b for b in (" ".join(x.split()) for x in parser.blocks) if b)


@pytest.fixture(scope="module")
def weights(spark):
    return maintext.train(table(spark, "/root/testdata/sf0.01", "pages"))


def test_words_score_above_and_tags_below_zero(weights):
    assert weights.word > 0 and weights.link_word > 0 and weights.other < 0
    assert weights.tags and all(w < 0 for _, w in weights.tags)


def test_all_pages(spark, weights):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in maintext.main_text(pages, weights).collect()}
    for p in pages.collect():
        assert got[p.page_id].text == plain(p.html) and got[p.page_id].url == p.url
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


CLUTTER = """<!DOCTYPE html><html><head><title>Site &mdash; title words here</title><style>p{}</style></head><body class="has-sidebar">
<header class="site"><h2>Site name and many words of slogan</h2></header><nav><ul><li><a href=/>Home page<li><a href=/b>Blog</ul></nav>
<div id="cookie-notice"><p>We use cookies on this site, please accept them all now.</p></div>
<div class="breadcrumb"><a href=/>Home</a> &gt; <a href=/x>News</a></div>
%s
<section id="comments"><p>First reader comment with quite a lot of words to read.</p><p>Second comment.</p></section>
<form><label>Your name</label><input name=a><textarea>draft text</textarea><button>Send it</button></form>
<footer>&copy; 2020 all the rights &middot; <a href=/t>Terms</a></footer><script>document.write("<p>script words</p>")</script></body></html>"""
BODY = """<h1>A  headline\n&amp; more</h1><p>First <b>bold</b>er para&shy;graph, a&nbsp;b &lt;c&gt;.<br>Next line
<script>var x = "</p>";</script> end.<p>Unclosed one<div class="ad banner">Buy <p>this</p> now</div>
<aside><p>Side words</p></aside><ul><li>one item<li>two items</ul><p>Last word.</p>"""
TEXT = "A headline & more\nFirst bolder para­graph, a b <c>. Next line end.\nUnclosed one\none item\ntwo items\nLast word."


@pytest.mark.parametrize("shell", ["<article>%s</article>", "<main><header>%s</header></main>", '<div class="content no-sidebar">%s</div>'])
def test_clutter_goes(weights, shell):
    assert maintext.extract(CLUTTER % (shell % BODY), weights) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("plain words only", "plain words only"), ("<script>a</script>", ""),
        ("a < b and c", "a < b and c"), ("<p>cut <b", "cut"), ("<!-- x --><p>y &notit; &#x41;&#66;", "y ¬it; AB"), ("<style>never closed <p>z", ""),
        ('<p title="a > b">in</p>', "in"), ("<![CDATA[ x ]]><p>ok", "ok"), ("<article><nav>unclosed <p>menu</article><p>", ""),
    ],
)
def test_odd_pages(weights, page, text):
    assert maintext.extract(page, weights) == text


def test_the_scan_finds_the_greatest_sum(weights):
    page = "<div>" + "".join(f"<a>{'w ' * (k % 4)}</a><p>{'x ' * (k % 7)}</p><hr>" for k in range(14)) + "</div>"
    heavy = maintext.Weights(1.0, 0.2, (("<p", -1.0), ("</p", -1.0), ("<hr", -4.0)), -0.7)
    stream = list(maintext.tokens(page))
    score = dict(heavy.tags)
    values = [
        len(v.split()) * (heavy.word if k == "text" else heavy.link_word) if k in ("text", "link")
        else score.get(("<" if k == "open" else "</") + v, heavy.other)
        for k, v, _ in stream
    ]
    sums = {(a, b): sum(values[a:b]) for a in range(len(values)) for b in range(a + 1, len(values) + 1)}
    (a, b), _ = max(sums.items(), key=lambda x: (round(x[1], 9), -x[0][0], -x[0][1]))
    want = " ".join(v for k, v, _ in stream[a:b] if k in ("text", "link")).split()
    assert re.findall(r"\w+", maintext.extract(page, heavy)) == want


def test_long_page_nulls_and_empty_tables(spark, weights):
    long = "<article>" + "<p>some words in a paragraph</p>" * 20_000 + "</article>"
    kind = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", long, "t"), (None, None, None, None), (1, "u", "<p>a b</p>", "t"), (1, "u", "<p>a b</p>", "t")], kind)
    got = rows(maintext.main_text(pages, weights), "page_id", "url", "n_chars")
    assert got == [(1, "u", 3), (1, "u", 3), (1, "u", 20_000 * 26 - 1), (None, None, 0)]
    none = spark.createDataFrame([], kind)
    assert maintext.main_text(none, maintext.train(none)).count() == 0
    assert maintext.train(none).word > 0


def plain_extract(page: str, weights) -> str:
    """All runs tried, and all elements listed with their ends: the least one around the best run."""
    stream, score = list(maintext.tokens(page)), dict(weights.tags)
    values = [
        len(v.split()) * (weights.word if k == "text" else weights.link_word) if k in ("text", "link")
        else score.get(("<" if k == "open" else "</") + v, weights.other)
        for k, v, _ in stream
    ]
    best, span = 0.0, None
    for a in range(len(stream)):
        total = 0.0
        for b in range(a, len(stream)):
            total += values[b]
            if total > best + 1e-9:
                best, span = total, (a, b + 1)
    if span is None:
        return ""
    open_, elements = [], []
    for k, (kind, value, _) in enumerate(stream):
        if kind == "open" and value in maintext.HOLDERS:
            open_.append((value, k))
        elif kind == "close" and value in [v for v, _ in open_]:
            while open_[-1][0] != value:
                elements.append((*open_.pop(), len(stream)))
            elements.append((*open_.pop(), k + 1))
    elements += [(v, k, len(stream)) for v, k in open_]
    around = sorted((e - s, s, e, v) for v, s, e in elements if s < span[0] and span[1] <= e)
    around = [x for x in around if x[3] in maintext.CONTENT] or around
    size = lambda a, b: sum(len(v.split()) for k, v, _ in stream[a:b] if k in ("text", "link"))
    if around and (around[0][3] in maintext.CONTENT or 2 * size(*span) >= size(*around[0][1:3])):
        span = around[0][1:3]
    lines = [""]
    for kind, value, _ in stream[slice(*span)]:
        if kind in ("text", "link"):
            lines[-1] += value
        elif value == "br":
            lines[-1] += " "
        elif value in maintext.BLOCKS:
            lines.append("")
    return "\n".join(t for t in (" ".join(x.split()) for x in lines) if t)


WORDS = "some words of a paragraph that goes on for a while and says a thing or two about the matter at hand"
ENDINGS = {
    "list": "<ul><li>one</li><li>two</li></ul>",
    "table": "<table><tr><td>cell a</td><td>cell b</td></tr></table>",
    "links": "<p><a href=/x>linked words</a> <a href=/y>and more</a></p>",
    "linked list": "<ol><li><a href=/1>first source</a><li><a href=/2>second source</a></ol>",
    "related work": '<div class="related-work"><p>Others did it before.</p></div>',
}


@pytest.mark.parametrize("name", ENDINGS)
@pytest.mark.parametrize("shell", ["<article>%s</article>", "<main>%s</main>", "<section>%s</section>", "<div>%s</div>", "<div><div>%s</div></div>"])
def test_an_article_keeps_its_ends(weights, shell, name):
    before = "<div><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/k>Contact</a></ul></div>"
    after = "<div><a href=/t>Terms</a> <a href=/p>Privacy</a></div>"
    if name == "related work" and shell not in ("<article>%s</article>", "<main>%s</main>"):
        return  # such a class counts outside of an article
    body = f"{ENDINGS[name]}<h1>Headline</h1><p>{WORDS}</p><p>{WORDS}</p>{ENDINGS[name]}"
    page = f"<html><body>{before}{shell % body}{after}</body></html>"
    end = plain("<article>" + ENDINGS[name] + "</article>")
    assert maintext.extract(page, weights) == f"{end}\nHeadline\n{WORDS}\n{WORDS}\n{end}"
    assert maintext.extract(page, weights) == plain_extract(page, weights)


@pytest.mark.parametrize("hint", ["related-posts", "comment-list", "ad", "social-share", "ad-2"])
def test_clutter_within_an_article_goes(weights, hint):
    page = f'<article><p>{WORDS}</p><div class="{hint}"><p>Not of the article.</p></div><p>The end.</p></article>'
    assert maintext.extract(page, weights) == f"{WORDS}\nThe end."


def test_extraction_against_brute_force(spark, weights):
    import random

    rng, some = random.Random(6), [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").limit(40).collect()]
    for page in some:
        assert maintext.extract(page, weights) == plain_extract(page, weights)
    names = ["div", "section", "p", "ul", "li", "a", "b", "td", "article", "h2"]
    for _ in range(150):
        page, open_ = "", []
        for _ in range(rng.randint(1, 40)):
            if open_ and rng.random() < 0.4:
                page += f"</{open_.pop() if rng.random() < 0.9 else rng.choice(names)}>"
            elif rng.random() < 0.5:
                open_.append(rng.choice(names))
                page += f"<{open_[-1]}>"
            else:
                page += " ".join(rng.choice(["word", "text", "it"]) for _ in range(rng.randint(0, 12))) + " "
        assert maintext.extract(page, weights) == plain_extract(page, weights), page
