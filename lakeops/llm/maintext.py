"""Main text of web pages by the maximum-scoring run of tokens.

Words score positive and tags negative, each by the log odds of standing inside the content of
labelled pages, all other parts of these pages being outside; the run of tokens with the greatest sum, found
in one scan, says where the content is. It is completed to the ends of the element that holds it, so that an
article keeps a list, a table or a paragraph of links at its start or end. Elements that are never content
(scripts, menus, notices, forms, ...) are taken out before the scan.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import inputs, slices

#: Pages the weights are learned from, at most.
MAX_PAGES = 2_000
#: Words score at least, and tags at most, so much: the signs are the method's, the sizes are learned.
LEAST_WORD, LEAST_LINK, LEAST_TAG = 0.5, 0.05, -0.01
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_HINT = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.I)
# fixed values: element names of the HTML standard
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
NEVER = RAW | {
    "nav", "aside", "footer", "form", "button", "select", "option", "dialog", "menu", "svg", "canvas", "object",
    "audio", "video", "map", "input", "label", "head",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
}
#: An unclosed one of these ends where the next block starts.
LOOSE = {"p", "li", "dt", "dd", "td", "th", "tr"}
CONTENT = {"article", "main"}
#: Words in class, id or role of elements that are not content.
HINTS = {
    "ad", "ads", "adv", "advert", "advertisement", "adsense", "banner", "promo", "promotion", "sponsor", "sponsored",
    "sidebar", "aside", "complementary", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
    "header", "masthead", "contentinfo", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter",
    "subscribe", "signup", "share", "sharing", "social", "related", "recommended", "comment", "comments", "reply", "replies",
    "respond", "disqus", "login", "search", "pagination", "pager", "widget", "toolbar", "paywall", "skip",
}

#: A class that starts so tells of another element: no-sidebar, has-comments.
ABOUT = {"no", "not", "has", "with", "without"}
#: Within an article a class counts if it has no other words than hints and these: related-posts, not related-work.
PLAIN = {
    "area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "form", "icons", "inner", "item", "items",
    "left", "link", "links", "list", "post", "posts", "right", "row", "section", "slot", "stories", "top", "unit", "wrap", "wrapper",
}
#: Elements whose ends may be those of the content.
HOLDERS = CONTENT | {"section", "div", "td", "blockquote", "center", "pre", "table"}


@dataclass(frozen=True)
class Weights:
    """Score of a word, a word in a link, and each tag; a tag not learned scores ``other``."""

    word: float
    link_word: float
    tags: tuple[tuple[str, float], ...]
    other: float


def _dropped(name: str, rest: str, in_content: bool) -> bool:
    if name in NEVER or _HIDDEN.search(rest):
        return True
    if name == "header":
        return not in_content
    if name in ("html", "body", *CONTENT):
        return False
    for m in _HINT.finditer(rest):
        for value in (m[2] or m[3] or m[4] or "").lower().split():
            first, *others = parts = re.split(r"[^a-z0-9]+", value)
            found = HINTS.intersection(parts)
            if not found or (others and first in ABOUT):
                continue
            if not in_content or (found != {"header"} and all(w in HINTS or w in PLAIN or w.isdigit() for w in parts)):
                return True
    return False


def tokens(page: str, whole: bool = False) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, inside article or main) of what may be content: kind is text, link, open or close.

    Character references are decoded in texts. An element that is left out is passed over with all in it;
    ``whole`` leaves out only what is never shown as text, and tells of all other parts of the page.
    """
    at, n, links, content = 0, len(page), 0, 0
    skip, depth = "", 0
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if not skip and not m[0].startswith("<!") and not m[0].startswith(("<?", "</")):
                yield ("link" if links else "text"), html.unescape(m[0]), content > 0
            continue
        opened, empty = not m["close"], m["rest"].endswith("/") or name in VOID
        if opened and name in RAW and not m["rest"].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if skip:
            loose_end = skip in LOOSE and depth == 1 and opened and name in BLOCKS and (name == skip or skip == "p")
            if not loose_end:
                if name == skip and not (opened and empty):
                    depth += 1 if opened else -1
                if name in CONTENT and not opened and content:
                    content, depth = content - 1, 0  # the article ends whatever is open in it
                    yield "close", name, content > 0
                if depth <= 0 or name in ("body", "html") and not opened:
                    skip = ""
                continue
            skip = ""
        if opened and not whole and _dropped(name, m["rest"], content > 0):
            if not empty:
                skip, depth = name, 1
            yield "open", "p" if name in BLOCKS else "span", content > 0  # a block that is left out still parts two others
            continue
        if name == "a":
            links = 1 if opened else 0
        if name in CONTENT:
            content = max(0, content + (1 if opened else -1))
        inside = content > 0 and not (name in CONTENT and opened)
        yield ("open" if opened else "close"), name, inside


def learned(counts: Counter, smoothing: float = 1.0) -> Weights:
    """Weights from counts of (kind of token, inside): words above zero, tags below; a tag that no page had scores
    the mean of the others."""
    inside = sum(c for (_, i), c in counts.items() if i) + smoothing
    outside = sum(c for (_, i), c in counts.items() if not i) + smoothing

    def odds(kind: str) -> float:
        a, b = counts[kind, True] + smoothing, counts[kind, False] + smoothing
        return math.log(a / inside) - math.log(b / outside)

    tags = {t: min(LEAST_TAG, odds(t)) for t in sorted({k for k, _ in counts if k[0] == "<"})}
    return Weights(
        max(LEAST_WORD, odds("word")),
        max(LEAST_LINK, odds("link word")),
        tuple(tags.items()),
        sum(tags.values()) / len(tags) if tags else -0.5,
    )


def count_tokens(page: str) -> Counter:
    """Counts of (kind, inside) on a page whose content is marked as article or main; others count nothing."""
    out: Counter = Counter()
    marked = False
    for kind, value, inside in tokens(page, whole=True):
        if kind in ("text", "link"):
            out["word" if kind == "text" else "link word", inside] += len(value.split())
        else:
            marked |= value in CONTENT
            out[("<" if kind == "open" else "</") + value, inside] += 1
    return out if marked else Counter()


def extract(page: str | None, weights: Weights) -> str:
    """Blocks of the content, one to a line; empty if no run scores above zero."""
    stream = list(tokens(page or ""))
    blocks: list[str] = []
    part: list[str] = []
    for kind, value, _ in stream[slice(*completed(stream, best_run(stream, weights)))]:
        if kind in ("text", "link"):
            part.append(value)
        elif value == "br":
            part.append("\n")
        elif value in BLOCKS:
            blocks.append("".join(part))
            part = []
    blocks.append("".join(part))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def best_run(stream: list[tuple[str, str, bool]], weights: Weights) -> tuple[int, int]:
    """(first, after last) of the tokens with the greatest sum; of equal sums the first, (0, 0) if none is above zero."""
    score = dict(weights.tags)
    best, total, start, span = 0.0, 0.0, 0, (0, 0)
    for k, (kind, value, _) in enumerate(stream):
        if total <= 0:
            total, start = 0.0, k
        if kind in ("text", "link"):
            total += len(value.split()) * (weights.word if kind == "text" else weights.link_word)
        else:
            total += score.get(("<" if kind == "open" else "</") + value, weights.other)
        if total > best:
            best, span = total, (start, k + 1)
    return span


def completed(stream: list[tuple[str, str, bool]], span: tuple[int, int]) -> tuple[int, int]:
    """The run, completed to the ends of the element that holds it: the innermost article or main that is open all
    through the run, else the innermost other of `HOLDERS`, if the run has at least half of its words. Other runs
    stay as they are.
    """
    first, after = span
    if first >= after:
        return span
    held: list[tuple[str, int]] = []  # elements open before the run, and where they start
    for k, (kind, value, _) in enumerate(stream[:after]):
        if value not in HOLDERS:
            continue
        if kind == "open" and k < first:
            held.append((value, k))
        elif kind == "open":
            held.append((value, -1))
        elif kind == "close":
            at = max((i for i, (name, _) in enumerate(held) if name == value), default=-1)
            if at >= 0:
                del held[at:]
    around = [(name, k) for name, k in held if k >= 0]
    if not around:
        return span
    name, start = next((x for x in reversed(around) if x[0] in CONTENT), around[-1])
    depth = 0
    for k in range(start, len(stream)):
        kind, value, _ = stream[k]
        if value == name:
            depth += (kind == "open") - (kind == "close")
            if not depth and k + 1 >= after:
                break
    end = k + 1
    if name not in CONTENT and 2 * n_words(stream, span) < n_words(stream, (start, end)):
        return span
    return start, end


def n_words(stream: list[tuple[str, str, bool]], span: tuple[int, int]) -> int:
    return sum(len(value.split()) for kind, value, _ in stream[slice(*span)] if kind in ("text", "link"))


def train(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> Weights:
    """Weights from at most ``max_pages`` pages, chosen by a hash of their text.

    A page labels itself where its source marks an article; others teach nothing. The counts are
    added up on the executors; the driver gets one row for each kind of token.
    """
    rows = inputs(pages, html=html_col).where("html is not null")
    share = min(1.0, max_pages / max(rows.count(), 1))
    spot = F.pmod(F.xxhash64("html", F.lit(3)), F.lit(1 << 30))
    some = rows.where(spot < int(share * (1 << 30)) + 1).orderBy(spot, "html").limit(max_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for page in batch.column("html").to_pylist():
                total.update(count_tokens(page))
        if total:
            kinds, inside = zip(*total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(inside), pa.array(total.values(), pa.int64())], ["kind", "inside", "n"]
            )

    counts = some.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    return learned(Counter({(r.kind, r.inside): r.n for r in counts.collect()}))


def main_text(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; a null page is empty and has an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(p, weights) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = inputs(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
