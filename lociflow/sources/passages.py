"""Passages of full text in document order: one reader with a stack for HTML pages and one for JATS XML.

Both run in Arrow batches, one text at a time, and are linear in it.  An element's text is a slice of the pieces read so far,
so nested elements cost nothing.  Rows: key, idx, section_type, passage_type, text, section_title.

Null, empty and malformed texts have no passages; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.entities import name2codepoint
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lociflow.functions import patterns as P

_SPACE = re.compile(r"\s+")
_SITE_NAME = re.compile(r"\s*[-|].*PMC.*$")
_PROLOGUE = re.compile(r"\s*(?:<\?xml[^>]*\?>)?\s*(?:<!DOCTYPE[^>\[]*(?:\[[^\]]*\])?[^>]*>)?", re.I)
#: Start tags that end an open paragraph.
_ENDS_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 div section article ul ol dl table figure blockquote pre header footer nav aside main hr form".split())
_HEADINGS, _VOID = frozenset(("h1", "h2", "h3", "h4")), frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(("script", "style", "noscript"))
LONG_HEADING = 120


def section_of(title: str | None, table: tuple = P.SECTION_WORDS) -> str:
    """Type of a section by the first group of words that its title has."""
    low = (title or "").lower()
    return next((kind for kind, words in table if any(w in low for w in words)), "FIG" if low.startswith("fig") and table is P.SECTION_WORDS else "OTHER")


def _flat(parts: list[str]) -> str:
    return _SPACE.sub(" ", "".join(parts)).strip()


class _Page(HTMLParser):
    """Title, headings and paragraphs of a page; every section has the type of its own heading, else that of the section around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.rows: list[tuple[int, str, str | None, str, int]] = []  # piece where it starts, section, heading, text, article
        self.stack: list[tuple[str, bool, bool]] = []  # tag, hidden, opens a section
        self.frames: list[list] = [["OTHER", None, 0, False, 0]]  # type, heading, first piece, has paragraphs, article
        self.open: tuple[str, int, bool] | None = None  # paragraph or heading: tag, first piece, class of a section title
        self.titles: dict[str, str] = {}
        self.counts: Counter = Counter()
        self.hidden = self.articles = self.inside = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.open and tag in _ENDS_PARAGRAPH:
            self.finish()
        self.parts.append(" ")
        if tag in _VOID:
            return
        named = {k: v or "" for k, v in attrs}
        css = named.get("class", "")
        hidden = tag in _HIDDEN or (tag == "section" and "ref" in named.get("id", "")) or (tag == "div" and "ref-list" in css)
        self.hidden += hidden
        section = tag == "section" and not self.hidden
        if tag == "article" and not self.hidden:
            self.articles += 1
            self.inside = self.inside or self.articles
        if section:
            self.frames.append([*self.frames[-1][:2], len(self.parts), False, self.inside])
        self.stack.append((tag, hidden, section))
        self.counts[tag] += 1
        if not self.hidden and (tag == "p" or tag in _HEADINGS or (tag == "title" and "title" not in self.titles)):
            self.open = (tag, len(self.parts), ("pmc_sec_title" if tag != "h1" or "pmc_sec_title" in css else "title") in css)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.parts.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if self.open and (tag == self.open[0] or (self.counts[tag] and tag in _ENDS_PARAGRAPH)):
            self.finish()
        self.parts.append(" ")
        closing = self.counts[tag] > 0
        while closing:
            name, hidden, section = self.stack.pop()
            self.counts[name] -= 1
            self.hidden -= hidden
            if section:
                self.leave_section()
            if name == "article" and not self.counts[name]:
                self.inside = 0
            closing = name != tag

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)

    def leave_section(self) -> None:
        kind, heading, first, filled, article = self.frames.pop()
        text = "" if filled else _flat(self.parts[first:])
        if text:  # a section without paragraphs is one
            self.rows.append((first, kind, heading, text.removeprefix(heading or "").strip(), article))
        if not filled and text:
            self.frames[-1][3] = True

    def finish(self) -> None:
        tag, first, marked = self.open
        self.open = None
        text = _flat(self.parts[first:])
        if tag == "title":
            self.titles["title"] = text
        elif tag in _HEADINGS:
            if tag == "h1" and marked:
                self.titles.setdefault("h1", text)
            if marked or len(text) < LONG_HEADING:
                self.frames[-1][0], self.frames[-1][1] = section_of(text), text or None
        else:
            for frame in reversed(self.frames):
                if frame[3]:
                    break  # so have all around it
                frame[3] = True
            if text and not text.lower().startswith("open in a new tab"):
                self.rows.append((first, self.frames[-1][0], self.frames[-1][1], text, self.inside))

    def passages(self) -> list[tuple]:
        if self.open:
            self.finish()
        while len(self.frames) > 1:
            self.leave_section()
        title = _SITE_NAME.sub("", self.titles.get("h1") or self.titles.get("title") or "").strip()
        own = [r for r in sorted(self.rows, key=lambda r: r[0]) if not self.articles or r[4] == 1]
        head = [("TITLE", "title", title, None)] if len(title) > 5 else []
        return head + [(kind, "paragraph", text, heading) for _, kind, heading, text, _ in own]


def html_page(page: str | None) -> list[tuple]:
    """(section_type, passage_type, text, section_title) of a page; of the first article, where there is one."""
    if not page:
        return []
    reader = _Page()
    reader.feed(page)
    reader.close()
    return reader.passages()


class _Jats:
    """First title, abstracts, and the paragraphs of the first body under the last section title before them."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.rows: list[tuple[int, int, str, str, str, str | None]] = []  # group, start, section, type, text, heading
        self.stack: list[tuple[str, int, int]] = []  # name, first piece, order
        self.body, self.bodies, self.started = 0, 0, 0
        self.section, self.heading = "OTHER", None
        self.titled = False

    def start(self, tag: str, _attrs: dict) -> None:
        name = tag.rpartition(":")[2]
        self.started += 1
        if name == "body":
            self.bodies += 1
            self.body = self.body or (len(self.stack) + 1 if self.bodies == 1 else 0)
        elif name == "title" and self.body:
            self.section, self.heading = "OTHER", None  # until its words are read
        if name == "p" and self.body:
            self.rows.append((2, self.started, self.section, "paragraph", "", self.heading))
        self.stack.append((name, len(self.parts), self.started))

    def end(self, tag: str) -> None:
        name, first, order = self.stack.pop()
        if self.body and len(self.stack) < self.body:
            self.body = 0
        elif name == "title" and self.body:
            self.heading = _flat(self.parts[first:])
            self.section = section_of(self.heading, P.JATS_SECTION_WORDS)
        elif name == "p" and self.body:
            k = next(k for k in range(len(self.rows) - 1, -1, -1) if self.rows[k][1] == order)
            self.rows[k] = (*self.rows[k][:4], _flat(self.parts[first:]), self.rows[k][5])
        elif name == "abstract":
            self.rows.append((1, order, "ABSTRACT", "abstract", _flat(self.parts[first:]), None))
        elif name == "article-title" and not self.titled:
            self.titled = True
            self.rows.append((0, order, "TITLE", "title", _flat(self.parts[first:]), None))

    def skipped(self, name: str, is_parameter: bool) -> None:
        if not is_parameter and name in name2codepoint:
            self.parts.append(chr(name2codepoint[name]))


def jats_article(xml: str | None) -> list[tuple]:
    """(section_type, passage_type, text, section_title) of a JATS article; fragments without one root are read too."""
    if not xml:
        return []
    reader, parser = _Jats(), expat.ParserCreate()
    parser.buffer_text = True
    parser.UseForeignDTD(True)  # named characters of a DTD that is not there are skipped, and looked up by name
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler, parser.SkippedEntityHandler = reader.start, reader.end, reader.parts.append, reader.skipped
    parser.ExternalEntityRefHandler = lambda *_: 1
    try:
        parser.Parse("<root>", False)
        parser.Parse(xml[_PROLOGUE.match(xml).end() :], False)
        parser.Parse("</root>", True)
    except expat.ExpatError:
        return []
    return [row[2:] for row in sorted(reader.rows, key=lambda r: r[:2]) if row[4]]


_SECTION_LINE = re.compile(P.SECTION_LINE, re.I)


def plain_text(text: str | None) -> list[tuple]:
    """(section_type, passage_type, text, section_title) of the blocks between blank lines; a short first line that names a section, or is all capitals, starts one."""
    out, kind, heading = [], "OTHER", None
    for block in re.split(r"\n{2,}", (text or "").replace("\r\n", "\n").replace("\r", "\n").replace("\x0c", "\n\n")):
        lines = [line for line in map(str.strip, map(lambda x: _SPACE.sub(" ", x), block.split("\n"))) if line]
        if lines and len(lines[0]) < 100 and (lines[0].isupper() or _SECTION_LINE.match(lines[0])):
            heading = lines.pop(0)
            kind = section_of(heading)
        if lines:
            out.append((kind, "paragraph", " ".join(lines), heading))
    return out


def read_passages(df: DataFrame, text: str, key: str, read: Callable[[str | None], list[tuple]]) -> DataFrame:
    """Passages of every row of ``df`` in document order."""
    rows = df.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [(k, i, p) for k, t in enumerate(part.column(1).to_pylist()) for i, p in enumerate(read(t))]
                columns = [pa.array([p[c] for _, _, p in found], pa.string()) for c in range(4)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([k for k, _, _ in found], pa.int64())), pa.array([i for _, i, _ in found], pa.int32()), *columns], names=[key, "idx", "section_type", "passage_type", "text", "section_title"])

    kinds = [("idx", T.IntegerType()), *((c, T.StringType()) for c in ("section_type", "passage_type", "text", "section_title"))]
    return rows.mapInArrow(run, T.StructType([rows.schema[0], *(T.StructField(n, k) for n, k in kinds)]))


def html_passages(df: DataFrame, html: str, key: str) -> DataFrame:
    """Title and paragraphs of pages in page order; each has the type of its section's heading."""
    return read_passages(df, html, key, html_page)


def plain_passages(df: DataFrame, text: str, key: str) -> DataFrame:
    """Paragraphs of plain text under the section lines before them."""
    return read_passages(df, text, key, plain_text)


def jats_passages(df: DataFrame, xml: str, key: str) -> DataFrame:
    """Title, abstracts and body paragraphs of JATS XML; each paragraph has the type of the last section title before it."""
    return read_passages(df, xml, key, jats_article)
