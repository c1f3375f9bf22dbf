"""Main text of web pages, by removal of site templates.

Each page is read into blocks of text and the element subtrees around them, a
subtree being a run of blocks with a hash of its tag, its text and its subtrees.
Spark counts subtrees per host; those that recur on many pages of a host are its
template and are deleted wherever they stand. What names itself as no part of the
article (menus, headers, footers, sidebars, notices, adverts, forms, comments, by
tag, role, class or id) is deleted on any page, seen often or not.

Copies of a page don't make its article a template: of pages of a host with the
same text only one is counted. Pages are cut once for the counts and once more for
the result, so that only their blocks are shuffled, not their HTML.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b as _blake
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import words
from dealscope.llm.tables import kept

# The names of HTML.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg select object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Per tag the open elements that it ends, and those past which they aren't looked for.
ENDS = {tag: (frozenset(ends.split()), frozenset(stop.split())) for tag, ends, stop in (
    ("li", "li", "ul ol menu dir"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"), ("tr", "tr td th", "table"),
    ("td", "td th", "tr table"), ("th", "td th", "tr table"), ("tbody", "thead tbody tfoot", "table"),
    ("tfoot", "thead tbody tfoot", "table"))}
#: Elements out of which no open paragraph is ended from inside.
KEEPS_P = frozenset("td th table caption button html body".split())

# What says that an element is no part of the article: its tag, its role, or a word of its class or id.
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu button label search".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar footer colophon sidebar aside ad ads adv advert "
    "adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert disclaimer newsletter subscribe subscription signup popup modal overlay share "
    "sharing social related recommended recommendations teaser widget toolbar pagination pager login search skip".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
HEADER_NAMES = frozenset("header masthead".split())
#: Tags that say something by themselves; what speaks against an element, and for one as the article's.
KINDS = BOILERPLATE_TAGS | {"article", "main", "header"}
AGAINST, MAIN = frozenset({"out", "comments", "header", "named"}), ("article", "main", "body")
#: Names of the element that holds the article on pages without such a tag.
BODY_NAMES = frozenset("articlebody postbody entrycontent postcontent articlecontent maincontent".split())

#: A tag; with its end, if it has no quotes.
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>\"'<]*)(?:([^\"'<>]*)>)?|!--|[!?/])")
#: The rest of a tag with quotes; if they are unpaired or very long, it ends at the next ``>``.
_REST = re.compile(r"((?:[^\"'>]{1,1000}+|\"[^\"]{0,2000}\"|'[^']{0,2000}'){0,200}+)>")
_ATTRIBUTE = re.compile(r"""(?i)(?<![^\s"'/])(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)")
_PARAGRAPH = frozenset({"p"})
_ODD, _MASK = 0x9E3779B97F4A7C15, 2**64 - 1
_SUBTREES = pa.list_(pa.struct([("mark", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))


class Page(NamedTuple):
    """Blocks of text in order; per subtree its hash and the blocks that it holds, from and to before a place; and
    whether an element holds the article."""

    blocks: list[str]
    subtrees: list[tuple[int, int, int]]
    marked: bool


def _digest(text: str) -> int:
    return int.from_bytes(_blake(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class _Element:
    """An open element: its first block, its text and subtrees so far, and what it says about itself."""

    __slots__ = ("tag", "first", "parts", "kind", "skips")

    def __init__(self, tag: str, first: int, kind: str, skips: bool = False):
        self.tag, self.first, self.kind, self.skips, self.parts = tag, first, kind, skips, []


class _Closed(NamedTuple):
    """A closed element with text, after those inside it: its hash, and its blocks from ``first`` to before ``last``."""

    tag: str
    kind: str
    mark: int
    first: int
    last: int


def _kind(tag: str, rest: str) -> str:
    """``out`` for what is no part of the article by tag, role or for being hidden, ``comments``, ``header`` and
    ``named`` by class or id, ``article``, ``main`` and ``body`` for what holds the article, or nothing."""
    kind = "out" if tag in BOILERPLATE_TAGS else tag if tag in ("article", "main", "header") else ""
    if not rest or rest.isspace():
        return kind
    for match in _ATTRIBUTE.finditer(rest):
        name, value = match[1].lower(), html.unescape((match[2] or "").strip("\"'")).strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return "out"
        if name == "role":
            if value.lower() in BOILERPLATE_ROLES:
                return "out"
            if value.lower() in ("main", "article") and not kind:
                kind = value.lower()
        elif name == "itemprop" and value.lower() == "articlebody" and not kind:
            kind = "body"
        elif name in ("class", "id") and tag not in ("html", "body", "main") and kind != "out":
            parts = {part.lower() for part in _NAME.findall(value)}
            if parts & COMMENT_NAMES:
                kind = "comments"
            elif parts & BOILERPLATE_NAMES:
                kind = kind if kind in ("comments", "header") else "named"
            elif parts & HEADER_NAMES and not kind:
                kind = "header"
            elif not kind and any(re.sub("[^a-z]", "", word.lower()) in BODY_NAMES for word in value.split()):
                kind = "body"
    return kind


class _Reader:
    """Reads a page tag by tag; elements that a page leaves open end where HTML says so.

    The stack holds blocks, and inside a block only what is no part of the article
    and so is left out at once.
    """

    def __init__(self):
        self.blocks: list[str] = []
        self.closed: list[_Closed] = []
        self.text: list[str] = []
        self.stack = [_Element("", 0, "")]
        self.count: dict[str, int] = {}
        self.skipping = 0

    def flush(self) -> None:
        if self.text:
            whole = "".join(self.text)
            self.text.clear()
            block = " ".join((html.unescape(whole) if "&" in whole else whole).split())
            if block:
                self.blocks.append(block)
                self.stack[-1].parts.append(block)

    def close(self, height: int) -> None:
        stack = self.stack
        while len(stack) > height:
            if self.text and not stack[-1].skips:
                self.flush()
            element = stack.pop()
            self.count[element.tag] -= 1
            if element.skips:
                self.skipping -= 1
            elif element.first < len(self.blocks):
                mark = _digest("\x00".join([element.tag, *element.parts]))
                stack[-1].parts.append(f"\x01{mark}")
                self.closed.append(_Closed(element.tag, element.kind, mark, element.first, len(self.blocks)))

    def end_open(self, wanted: frozenset[str], stop: frozenset[str]) -> None:
        """Close the outermost open element of ``wanted`` that no element of ``stop`` shuts off."""
        found = None
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in wanted:
                found = i
            elif self.stack[i].tag in stop:
                break
        if found is not None:
            self.close(found)

    def start(self, tag: str, rest: str) -> None:
        kind = _kind(tag, rest) if rest or tag in KINDS else ""
        if tag not in BLOCKS and "-" not in tag:
            skips = kind in AGAINST
            if skips or self.skipping:
                self.stack.append(_Element(tag, len(self.blocks), "", True))
                self.count[tag] = self.count.get(tag, 0) + 1
                self.skipping += 1
            return
        if self.count.get("p"):
            self.end_open(_PARAGRAPH, KEEPS_P)
        if tag in ENDS and any(self.count.get(t) for t in ENDS[tag][0]):
            self.end_open(*ENDS[tag])
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.close(len(self.stack) - 1)
        if self.text:
            self.flush()
        self.stack.append(_Element(tag, len(self.blocks), kind))
        self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if self.count.get(tag):
            block = tag in BLOCKS or "-" in tag
            i = len(self.stack) - 1
            while self.stack[i].tag != tag:
                # An inline end tag doesn't end the block that it stands in.
                if not block and not self.stack[i].skips:
                    return
                i -= 1
            self.close(i)
        elif tag == "p":
            self.flush()

    def read(self, source: str) -> None:
        at, size, text = 0, len(source), self.text
        search = _TAG.search
        while (match := search(source, at)) is not None:
            close, tag, rest = match.groups()
            if match.start() > at and not self.skipping:
                text.append(source[at:match.start()])
            at = match.end()
            if rest is None:
                if tag is None:
                    mark = "-->" if match[0] == "<!--" else ">"
                    end = source.find(mark, at)
                    at = end + len(mark) if end >= 0 else size
                    continue
                if (tail := _REST.match(source, at)) is not None:
                    at, rest = tail.end(), tail[1]
                elif (end := source.find(">", at)) >= 0:
                    at, rest = end + 1, source[at:end]
                else:
                    at = size
                    break
            tag = tag.lower()
            if close:
                self.end(tag)
            elif tag in VOID:
                if tag == "hr":
                    self.flush()
                elif tag == "br" and not self.skipping:
                    text.append(" ")
            elif tag in RAW:
                end = re.compile(rf"(?i)</{re.escape(tag)}\s*>").search(source, at)
                at = end.end() if end else size
            else:
                self.start(tag, rest)
        if at < size and not self.skipping:
            text.append(source[at:])
        self.close(1)
        self.flush()


def _digest(text: str) -> int:
    return int.from_bytes(_blake(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _cover(spans: Iterable[_Closed], size: int) -> list[bool]:
    steps = [0] * (size + 1)
    for element in spans:
        steps[element.first] += 1
        steps[element.last] -= 1
    return [n > 0 for n in accumulate(steps[:size])]


def parsed(source: str) -> Page:
    """Blocks and subtrees of a page's main part, without what names itself as no part of it.

    The main part is what the ``article`` elements hold, else the ``main`` element, else
    one named as the article's body, else the page. Those in a sidebar or among
    comments count only if there are no others. What encloses the main part stays
    whatever its name; so does what has at least half of its text, if only a class, an
    id or a form speaks against it. Of a header in an article the headings stay.
    """
    reader = _Reader()
    reader.read(source)
    blocks, closed = reader.blocks, reader.closed
    size = len(blocks)
    against = [(i, e) for i, e in enumerate(closed) if e.kind in AGAINST]
    lengths = [0, *accumulate(map(len, blocks))]
    main: list[tuple[int, _Closed]] = []
    for wanted in MAIN:
        if found := [(i, e) for i, e in enumerate(closed) if e.kind == wanted]:
            inside = _cover([e for _, e in against], size)
            main = [(i, e) for i, e in found if not inside[e.first]] or [
                max(found, key=lambda x: lengths[x[1].last] - lengths[x[1].first])]
            break
    gone = [not inside for inside in _cover([e for _, e in main], size)] if main else [False] * size
    total = sum(len(b) for b, out in zip(blocks, gone) if not out)
    headings = _cover([e for e in closed if e.tag in HEADINGS], size) if main else gone
    for i, e in against:
        if all(gone[e.first:e.last]) or any(i > j and e.first <= m.first and m.last <= e.last for j, m in main):
            continue
        doubtful = e.kind == "named" or e.kind == "out" and e.tag == "form"
        if doubtful and 2 * (lengths[e.last] - lengths[e.first]) >= total:
            continue
        for k in range(e.first, e.last):
            gone[k] |= not (main and e.kind == "header" and headings[k])
    number = [0, *accumulate(int(not out) for out in gone)]
    subtrees = [(e.mark, number[e.first], number[e.last]) for e in closed
                if number[e.first] < number[e.last] and e.kind not in MAIN and e.tag not in ("html", "body")]
    return Page([b for b, out in zip(blocks, gone) if not out], subtrees, bool(main))


def host_of(url: str | None) -> str | None:
    match = _HOST.match(url) if url else None
    return match[1].lower() if match else None


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Page], pa.Array, list[int | None]]]:
    """Small pieces of the batches (url, html, ...) with their pages, a hash of host and HTML, and one of the host."""
    for batch in batches:
        for piece in words.pieces(batch, "html"):
            hosts = [host_of(u) for u in piece.column(0).to_pylist()]
            sources = [s or "" for s in piece.column(1).to_pylist()]
            keys = pa.array([_blake(f"{h}\x00{s}".encode(), digest_size=16).digest()
                             for h, s in zip(hosts, sources)], pa.binary())
            yield piece, [parsed(s) for s in sources], keys, [None if h is None else _digest(h) for h in hosts]


def _marks(host: int, page: Page) -> list[int]:
    """A page's distinct subtrees, each hashed with its host."""
    return sorted({(mark ^ host * _ODD) & _MASK for mark, _, _ in page.subtrees})


def _signed(values: list[int]) -> list[int]:
    return [v - (v >> 63 << 64) for v in values]


def page_subtrees(pages: DataFrame) -> DataFrame:
    """``key, host, same, marked, subtrees`` of pages that have a host and text: a hash of host and HTML, one of the host,
    one of the text, whether an element holds the article, and the distinct subtrees."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, keys, hosts in _pages(batches):
            use = [i for i, (h, p) in enumerate(zip(hosts, found)) if h is not None and p.subtrees]
            yield pa.RecordBatch.from_arrays([
                keys.take(pa.array(use, pa.int64())), pa.array([hosts[i] for i in use], pa.int64()),
                pa.array([_digest("\n".join(found[i].blocks)) for i in use], pa.int64()),
                pa.array([found[i].marked for i in use], pa.bool_()),
                pa.array([_signed(_marks(hosts[i], found[i])) for i in use], pa.list_(pa.int64()))],
                ["key", "host", "same", "marked", "subtrees"])
    return pages.select("url", "html").mapInArrow(
        rows, "key binary, host long, same long, marked boolean, subtrees array<long>")


def site_templates(subtrees: DataFrame, least_pages: int, share: float) -> DataFrame:
    """``subtree, n, total``: subtrees on at least ``least_pages`` pages and that share of the pages of their host;
    pages of a host with the same text count once."""
    pages = subtrees.groupBy("host", "same").agg(F.max("subtrees").alias("subtrees"))
    pages = kept(pages, "site-pages")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= least_pages)
    counts = pages.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    return counts.join(totals, "host").where(F.col("n") >= F.lit(share) * F.col("total")).select("subtree", "n", "total")


def main_text(pages: DataFrame, least_pages: int = 5, share: float = 2 / 3, loose_share: float = 0.2) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``: the text of its article.

    Character references are decoded, white space inside a block is one space, blocks
    are joined by line feeds. A subtree is a template, and goes, if it is on at least
    ``least_pages`` pages of its host that differ in text and on that ``share`` of them;
    on pages where no element holds the article ``loose_share`` is enough. Null and
    empty pages have an empty text; pages without a host (null or odd urls) lose no
    templates. Rows may repeat ids, urls and pages; each has its result. Further
    columns are not read.
    """
    if not 0 < loose_share <= share <= 1:
        raise ValueError("shares must satisfy 0 < loose_share <= share <= 1")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found, keys, hosts in _pages(batches):
            subtrees = [[{"mark": m, "first": a, "last": b} for m, (_, a, b) in zip(
                _signed([(mark ^ h * _ODD) & _MASK for mark, _, _ in p.subtrees]), p.subtrees)] if h is not None else []
                for h, p in zip(hosts, found)]
            yield pa.RecordBatch.from_arrays([
                keys, piece.column(2), piece.column(0), pa.array([p.blocks for p in found], pa.list_(pa.string())),
                pa.array(subtrees, _SUBTREES)], ["key", "page_id", "url", "blocks", "subtrees"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for blocks, subtrees, marks in zip(*(batch.column(c) for c in range(2, 5))):
                blocks, marks = blocks.as_py(), set(marks.as_py() or ())
                gone = np.zeros(len(blocks), bool)
                for subtree in subtrees.as_py() if marks else ():
                    if subtree["mark"] in marks:
                        gone[subtree["first"]:subtree["last"]] = True
                out.append("\n".join(b for b, g in zip(blocks, gone.tolist()) if not g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    subtrees = page_subtrees(pages)
    templates = site_templates(subtrees, least_pages, loose_share)
    on_page = subtrees.select("key", "marked", F.explode("subtrees").alias("subtree")).join(templates, "subtree").where(
        F.col("n") >= F.when(F.col("marked"), share).otherwise(loose_share) * F.col("total"))
    marks = on_page.groupBy("key").agg(F.collect_set("subtree").alias("marks"))
    source = pages.select("url", "html", F.col("page_id").cast("long"))
    cuts = source.mapInArrow(cut, "key binary, page_id long, url string, blocks array<string>, "
                                  "subtrees array<struct<mark:long,first:int,last:int>>")
    both = cuts.join(marks, "key", "left").select("page_id", "url", "blocks", "subtrees", "marks")
    return both.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
