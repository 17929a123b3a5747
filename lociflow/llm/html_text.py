"""Main text of web pages by the maximum-scoring subsequence (operator 9).

A page is read once, from left to right, as blocks of words and the tags between them.  The
words of a block score by its role (the nearest element that gives one), its length and
whether it is mostly links; tags score below zero.  One linear scan (running sum, restarted
when it falls below zero) finds the contiguous region with the greatest sum.  The blocks of that
region, without those in elements that are no part of an article, are the result.

Weights are log-odds counted on labelled pages and shrunk towards priors: of blocks, of tags,
and of the names of elements (tag, and each whole class, id and role word).  The priors know whole
names, and compound ones (``user-comments``) by their first or last part.  Any noise name
between a block and its main element makes the block noise, with nested articles' own
names; names above the main element do not count.  Names hang on the path of elements that gave them,
without a limit.  Labelled pages are those with one main element (``article``, else
``main``); no weight knows whether a word stands in it, so the weights serve pages without one.  The fit counts
at most about ``SAMPLE_PAGES`` pages (a documented bound); every page is extracted from its
whole html.

A page that names its main element (one ``article`` with ``SHARE`` of all article words, noise left out, else one
``main``) is scanned inside it; without one, or when nothing there scores above zero, the whole page is,
and when that is all noise, once more without the verdicts on parts of names.

Text rules: character references are decoded, white space inside a block becomes one space,
blocks are trimmed, empty blocks go, and blocks are joined in page order by one newline.

Edge cases: null and empty html, and pages without a word that scores above zero, give the
empty text; a tag that never closes, an unclosed comment and an unclosed script run to the end and give no text; unclosed
elements end with their container or the page; a self-closed raw element has no content; very
long pages, deep nesting and broken quotes are read in linear time; equal sums keep the earlier
region; repeated rows get equal results; pages without an id are extracted like others; clashing
columns are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.llm.common import small_batches

SAMPLE_PAGES, SHARE, LONG = 2000, 0.8, 10
#: A start tag after its "<": possessive, so that a tag without an end fails in one pass.
_START = re.compile(r"([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'\s])|(?=\s*\Z)))*+)>")
_NAMED = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
#: Elements whose content is raw text and no part of an article.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
#: Elements inside a block whose content is no part of its text.
MUTE = {"button", "select", "template", "noscript", "svg", "object", "canvas"}
#: Prior weights of element names: below ``NOISE_AT`` they hold no article text.
NOISE_TAGS = {"nav", "footer", "aside", "form", "head", "header", "menu", "dialog"}
NOISE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsored", "promo", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "masthead",
    "sidebar", "widget", "comment", "comments", "replies", "cookie", "cookies", "consent", "notice", "notices", "popup", "modal", "newsletter", "subscribe", "share", "sharing",
    "social", "related", "recommended", "login", "complementary", "contentinfo", "alert", "cookie-banner", "cookie-notice", "comment-list", "related-posts", "site-header", "site-footer",
}
#: Parts of compound names that speak of the layout around a text, which is then no noise.
LAYOUT_PARTS = {"wrap", "wrapper", "layout", "has", "with", "no", "without", "page", "main", "grid", "columns"}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Names that are noise outside a main element only: an article may have a header of its own.
_OUTER_ONLY = {"header", "footer"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that start and end a block of text.
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6",
    "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | NOISE_TAGS
MAIN = {"article", "main"}
#: Start tags that end an open element of a group, unless one of the barriers stands between.
_GROUPS = (
    ({"p"}, BLOCK, {"table", "td", "th", "caption", "button", "object", "template"}),
    ({"li"}, {"li"}, {"ul", "ol", "menu"}),
    ({"td", "th"}, {"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    ({"tr"}, {"tr", "tbody", "thead", "tfoot"}, {"table"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"option"}, {"option", "optgroup"}, {"select"}),
)
#: Prior weights of blocks by role; of blocks of other roles when long and when short; cost of a tag at least and at most.
PRIOR_ROLE = {"p": 1.0, "h1": 1.0, "h2": 1.0, "h3": 1.0, "h4": 1.0, "h5": 1.0, "h6": 1.0, "blockquote": 1.0, "pre": 1.0, "figcaption": 0.5, "dd": 0.5, "dt": 0.5, "td": 0.4, "th": 0.4, "li": 0.3}
PRIOR_LONG, PRIOR_SHORT, LINKED = 0.5, -0.1, -1.0
NOISE_AT, PRIOR_NOISE, PRIOR_PART, PRIOR_COUNT, TAG_LEAST, TAG_MOST = -0.5, -2.0, -1.0, 50, 0.02, 1.0


class Scope:
    """An element that has names or is a main element, and the scope around it."""

    __slots__ = ("names", "above", "main")

    def __init__(self, names: tuple[str, ...], above: Scope | None, main: tuple[str, int] | None):
        self.names, self.above, self.main = names, above, main


@dataclass
class Block:
    """Text of one block, and where it stands."""

    text: str
    role: str
    words: int
    linked: int
    scope: Scope | None
    article: int
    main: int

    @property
    def feature(self) -> str:
        return f"{self.role}|{'long' if self.words >= LONG else 'short'}|{'links' if 2 * self.linked > self.words else 'text'}"


def parse(page: str) -> Iterator[Block | str]:
    """Blocks (with text) and the names of the tags between them, in page order and linear time."""
    stack: list[tuple[str, bool, Scope | None, int, int, str]] = []  # tag, link, scope, article, main, role
    counts: Counter = Counter()
    groups: list[list[int]] = [[] for _ in _GROUPS]  # places of open elements of a group, -1 for a barrier
    articles = mains = 0
    at, end = 0, len(page)
    parts: list[str] = []
    linked, muted = [0], [0]
    state = [False, None, -1, -1, ""]  # link, scope, article, main, role

    def reread() -> None:
        state[:] = list(stack[-1][1:]) if stack else [False, None, -1, -1, ""]

    def flush() -> Iterator[Block]:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                yield Block(text, state[4], text.count(" ") + 1, linked[0], state[1], state[2], state[3])
            parts.clear()
        linked[0] = 0

    def close(k: int) -> None:
        while len(stack) > k:
            tag = stack.pop()[0]
            counts[tag] -= 1
            muted[0] -= tag in MUTE
            for g, (members, _, barriers) in enumerate(_GROUPS):
                if (tag in members or tag in barriers) and groups[g]:
                    groups[g].pop()
        reread()

    while at < end:
        if page[at] != "<":
            stop = page.find("<", at)
            stop = end if stop < 0 else stop
            if not muted[0]:
                parts.append(page[at:stop])
                if state[0]:
                    linked[0] += len(page[at:stop].split())
            at = stop
            continue
        if page.startswith("<!--", at):
            found = page.find("-->", at + 4)
            at = end if found < 0 else found + 3
            continue
        following = page[at + 1 : at + 3]
        if following[:1] in ("!", "?") or (following[:1] == "/" and not following[1:].isalpha()):
            found = page.find(">", at)
            at = end if found < 0 else found + 1
            continue
        closing = following[:1] == "/"
        m = _START.match(page, at + 1 + closing)
        if m is None:
            if following[closing : closing + 1].isascii() and following[closing : closing + 1].isalpha():
                break  # a tag that never closes: the rest is markup
            if not muted[0]:
                parts.append("<")
            at += 1
            continue
        at = m.end()
        tag = m[1].lower()
        if tag in BLOCK:
            yield from flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            if counts[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
            yield tag
            continue
        for g, (_, starts, _) in enumerate(_GROUPS):
            if tag in starts and groups[g] and groups[g][-1] >= 0:
                close(groups[g][-1])
        yield tag
        closed = m[2].rstrip().endswith("/")
        if tag in RAW and not closed:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            at = found.end() if found else end
            continue
        if tag in VOID or closed:
            continue
        link, scope, article, main, role = state
        own = [f"<{tag}>"] if tag in NOISE_TAGS and not (tag in _OUTER_ONLY and (article >= 0 or main >= 0)) else []
        if m[2] and tag not in ("html", "body"):
            own += [w for found in _NAMED.finditer(m[2]) for w in (found[1] or found[2] or found[3] or "").split()]
        opens = None
        if tag == "article" and article < 0:
            article, articles = articles, articles + 1
            opens = (tag, article)
        elif tag == "main" and main < 0:
            main, mains = mains, mains + 1
            opens = (tag, main)
        if own or opens:
            scope = Scope(tuple(dict.fromkeys(own)), scope, opens)
        if tag in BLOCK:
            role = tag
        for g, (members, _, barriers) in enumerate(_GROUPS):
            if tag in members:
                groups[g].append(len(stack))
            elif tag in barriers:
                groups[g].append(-1)
        muted[0] += tag in MUTE
        stack.append((tag, link or tag == "a", scope, article, main, role))
        counts[tag] += 1
        reread()
    yield from flush()


def main_element(items: list[Block | str]) -> tuple[str, int] | None:
    """The page's own main element: the one article that holds most article words, else the one main.

    Words in noise count only when all are.
    """
    noise = Noise({}, None)
    for kind in ("article", "main"):
        every: Counter = Counter()
        clean: Counter = Counter()
        for x in items:
            if isinstance(x, Block) and getattr(x, kind) >= 0:
                every[getattr(x, kind)] += x.words
                if not noise(x):
                    clean[getattr(x, kind)] += x.words
        words = clean or every
        if words:
            best, most = min(words.items(), key=lambda w: (-w[1], w[0]))
            if most >= SHARE * sum(words.values()):
                return kind, best
    return None


def _shrunk(inside: int, outside: int, prior: float) -> float:
    n = inside + outside
    odds = max(-3.0, min(3.0, math.log((inside + 1) / (outside + 1))))
    return (odds * n + prior * PRIOR_COUNT) / (n + PRIOR_COUNT)


def _prior_of_name(name: str, by_parts: bool = True) -> float:
    if name[:1] == "<" or name.lower() in NOISE_NAMES:
        return PRIOR_NOISE
    parts = [x.lower() for x in _PARTS.findall(name)] if by_parts else []
    return PRIOR_PART if len(parts) > 1 and not LAYOUT_PARTS & {*parts} and (parts[0] in NOISE_NAMES or parts[-1] in NOISE_NAMES) else 0.0


class Noise:
    """Whether a block lies in a noise element below ``own`` (or anywhere); every scope is settled once."""

    def __init__(self, weights: dict[str, float], own: tuple[str, int] | None, by_parts: bool = True):
        self.weights, self.own, self.by_parts = weights, own, by_parts
        self.settled: dict[Scope, bool] = {}

    def __call__(self, block: Block) -> bool:
        path, scope, verdict = [], block.scope, False
        while scope is not None and not (self.own is not None and scope.main == self.own):
            if scope in self.settled:
                verdict = self.settled[scope]
                break
            path.append(scope)
            scope = scope.above
        for scope in reversed(path):
            verdict = self.settled[scope] = verdict or any(self.weights.get(f"name {n.lower()}", _prior_of_name(n, self.by_parts)) < NOISE_AT for n in scope.names)
        return verdict


def _counts(pages: DataFrame, html: str, features) -> dict[str, tuple[int, int, int]]:
    """Per feature: amounts inside and outside of main elements, and pages that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                items = list(parse(page or ""))
                own = main_element(items)
                if own is None:
                    continue
                here: dict[str, list[int]] = {}
                for feature, inside, n in features(items, own):
                    here.setdefault(feature, [0, 0])[0 if inside else 1] += n
                for feature, (a, b) in here.items():
                    total = seen.setdefault(feature, [0, 0, 0])
                    total[0], total[1], total[2] = total[0] + a, total[1] + b, total[2] + 1
        keys = list(seen)
        yield pa.record_batch([pa.array(keys, pa.string()), *(pa.array([seen[k][i] for k in keys], pa.int64()) for i in range(3))], ["feature", "inside", "outside", "pages"])

    counted = pages.select(html).mapInArrow(count, "feature string, inside long, outside long, pages long")
    found = counted.groupBy("feature").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"), F.sum("pages").alias("p")).where("p >= 2")
    return {r.feature: (r.i, r.o, r.p) for r in found.collect()}  # names of at most SAMPLE_PAGES pages


def _name_features(items: list[Block | str], own: tuple[str, int]) -> Iterator[tuple[str, bool, int]]:
    """Names with the words below them, inside and outside of the main element ``own``."""
    words: dict[Scope, int] = {}
    within: dict[Scope, bool] = {}
    for x in items:
        if isinstance(x, Block) and x.scope is not None:
            words[x.scope] = words.get(x.scope, 0) + x.words
            within[x.scope] = getattr(x, own[0]) == own[1]
    depth: dict[Scope, int] = {}
    for scope in list(words):
        path = []
        while scope is not None and scope not in depth:
            path.append(scope)
            scope = None if scope.main == own else scope.above
        below = depth[scope] if scope is not None else 0
        for k, at in enumerate(reversed(path)):
            depth[at] = below + k + 1
    for scope in sorted(depth, key=depth.__getitem__, reverse=True):  # from the leaves up
        n, inside = words.get(scope, 0), within.get(scope, False)
        if scope.main == own:
            continue
        for name in scope.names:
            yield f"name {name.lower()}", inside, n
        if scope.above is not None:
            words[scope.above] = words.get(scope.above, 0) + n
            within.setdefault(scope.above, inside)


def fit_weights(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> dict[str, float]:
    """Weights of names, blocks and tags, counted in two passes over the sample (names first)."""
    rows = pages.where(F.col(html).rlike("(?i)<(article|main)[\\s/>]"))
    n = rows.count()
    if not n:
        return {}
    draw = F.pmod(F.xxhash64(F.col(page_id).cast("string"), F.col(html), F.lit("html")), F.lit(1 << 30)) / float(1 << 30)
    small_batches(pages.sparkSession, 256)
    sample = rows.where(draw < min(1.0, SAMPLE_PAGES / n))
    names = _counts(sample, html, _name_features)
    weights = {f: _shrunk(i, o, _prior_of_name(f[5:])) for f, (i, o, _) in names.items()}

    def rest(items: list[Block | str], own: tuple[str, int]) -> Iterator[tuple[str, bool, int]]:
        noise = Noise(weights, own)
        spans = [k for k, x in enumerate(items) if isinstance(x, Block) and getattr(x, own[0]) == own[1]]
        for k, x in enumerate(items):
            if isinstance(x, str):
                yield f"tag {x}", bool(spans) and spans[0] < k < spans[-1], 1
            elif not noise(x):
                yield f"block {x.feature}", getattr(x, own[0]) == own[1], x.words

    for f, (i, o, _) in _counts(sample, html, rest).items():
        kind, _, value = f.partition(" ")
        weights[f] = _shrunk(i, o, _prior_of_block(value) if kind == "block" else 0.0)
    return weights


def _prior_of_block(feature: str) -> float:
    role, length, links = feature.split("|")
    if links == "links" and not role.startswith("h"):
        return LINKED
    return PRIOR_ROLE.get(role, PRIOR_LONG if length == "long" else PRIOR_SHORT)


def _block_score(block: Block, weights: dict[str, float]) -> float:
    learned = weights.get(f"block {block.feature}")
    return max(-1.0, min(1.0, _prior_of_block(block.feature) if learned is None else learned))


def _tag_score(tag: str, weights: dict[str, float]) -> float:
    return -min(TAG_MOST, TAG_LEAST + max(0.0, -weights.get(f"tag {tag}", 0.0)) / 3)


def best_region(items: list[Block | str], weights: dict[str, float], noise: Noise) -> list[str]:
    """Texts of the contiguous region with the greatest sum."""
    best, best_sum, run, run_from = (0, 0), 0.0, 0.0, 0
    for k, x in enumerate(items):
        if isinstance(x, Block):
            if noise(x):  # never part of the result, so it neither ends nor extends a region
                continue
            run += _block_score(x, weights) * x.words
        else:
            run += _tag_score(x, weights)
        if run <= 0.0:
            run, run_from = 0.0, k + 1
        elif run > best_sum:
            best_sum, best = run, (run_from, k + 1)
    return [x.text for x in items[best[0] : best[1]] if isinstance(x, Block) and not noise(x)]


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    items = list(parse(page))
    own = main_element(items)
    texts: list[str] = []
    if own:
        inside = [k for k, x in enumerate(items) if isinstance(x, Block) and getattr(x, own[0]) == own[1]]
        texts = best_region([x for x in items[inside[0] : inside[-1] + 1] if isinstance(x, str) or getattr(x, own[0]) == own[1]], weights, Noise(weights, own))
    return "\n".join(texts or best_region(items, weights, Noise(weights, None)) or best_region(items, weights, Noise(weights, None, by_parts=False)))


def extract(pages: DataFrame, weights: dict[str, float], html: str = "html") -> DataFrame:
    """``pages`` without html, with text and n_chars (code points)."""
    small_batches(pages.sparkSession, 256)
    pages = pages.drop(*[c for c in pages.columns if c.lower() in ("text", "n_chars")])
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    fields = [f for f in rows.schema.fields if f.name != html]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
