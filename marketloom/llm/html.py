"""Main text of web pages by host suffix arrays.

1. A page is cut into blocks of visible text (``blocks``).  Each is marked as article
   (inside an element that says so), as furniture (menus, headers, footers,
   sidebars, notices, adverts, forms, comments, by element, role, class or id) or
   not at all.
2. The blocks' tokens, in page order, are the page's stream.  A task concatenates
   the streams of the pages it reads, host by host, into one string with a
   separator after every page, and sorts the suffixes on their first ``window``
   tokens by doubling.  Neighbours in the suffix array that agree so far are one
   repeated substring; a host's substring is handed on once per task, with the
   least and the greatest page that hold it.  Sums over tasks merge, so a host
   of any size is no group.  A substring with two different pages is a repeat.
   Windows wholly inside a marked article are left out, because they decide nothing.
3. Every page learns which of its windows are repeats.  Tokens covered by one are
   boilerplate and go, unique runs stay.
4. What the page says of itself comes on top: furniture goes even where a host has
   too few pages to show it, a marked article stays even where pages share it
   (quotations and copies are no boilerplate), and on a page with a marked article,
   or else a main part, the rest goes.

Pages with equal streams count as one page, so copies of a page do not make its text a
repeat.  A page without a host has no host to be compared with: marks alone
decide.  Character references are decoded; white space inside a block becomes one
space; blocks are joined by two newlines.

Nulls: a null html is an empty page, a null URL has no host, a null id is carried.
Pages shorter than a window have no windows.  Repeated rows are copies.  Empty tables
give no rows.  Very long pages are read whole; their windows leave the task in
batches.  Only id, URL and html are read, so extra columns of any name do no harm.
Tokens and windows are compared by 64-bit and 128-bit hashes, rows by two of 64
bits that tell null from empty."""

from __future__ import annotations

import hashlib
import html as references
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marketloom.llm.common import broadcast_if_small
from marketloom.llm.urls import parts
from marketloom.llm.words import mix, word_hashes
from marketloom.sources.tables import write_scratch

#: Tokens of a repeated substring.
WINDOW = 8
#: Tokens that a task concatenates, and windows of pages that it hands on at a time.
STREAM_TOKENS = 500_000
FLUSH_WINDOWS = 100_000

ARTICLE, FURNITURE, OPEN, MAIN, HIDDEN = 0, 1, 2, 3, -1

# Elements by what they hold, and words in roles, classes and ids.
UNSEEN = frozenset(
    "head script style noscript template title svg math iframe object canvas audio video "
    "select option datalist textarea button map".split()
)
RAW = frozenset("script style textarea title noscript iframe".split())
FURNITURE_ELEMENTS = frozenset("nav footer aside form menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar aside rail "
    "menu menubar nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer colophon copyright "
    "comment comments respond disqus reply replies share sharing social related recommended widget widgets "
    "pagination pager login signup search toolbar skip complementary contentinfo form".split()
)
LAYOUT_WORDS = frozenset("has with no without".split())
#: Elements that an element of the key closes, besides an open paragraph.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@lru_cache(maxsize=10_000)
def _mark(tag: str, attributes: str, in_article: bool) -> int | None:
    """What an element says of its content; nothing is None."""
    if tag in UNSEEN:
        return HIDDEN
    found: dict[str, str] = {}
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), references.unescape(a or b or c))
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return HIDDEN
    if tag in INLINE:
        return None
    if tag in FURNITURE_ELEMENTS or (tag == "header" and not in_article):
        return FURNITURE
    words = {w.lower() for w in _NAME.findall(" ".join(found.get(k, "") for k in ("role", "class", "id")))}
    # what holds the whole page is no furniture, nor is an article's own header
    if tag not in ("html", "body", "main", "h1", "header") and not words & LAYOUT_WORDS:
        if words & FURNITURE_WORDS - ({"header"} if in_article else set()):
            return FURNITURE
    if tag == "article" or found.get("role") == "article" or found.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    if tag == "main" or found.get("role") == "main":
        return MAIN
    return None


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, mark) of the visible blocks with text, in page order."""
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    # element, mark of its content, whether it is inside an article
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]

    def close():
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append((text, next(m for _, m, _ in reversed(stack) if m != HIDDEN)))

    def leave(tag: str):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return

    at, end, search = 0, len(page), _TAG.search
    while at < end:
        found = search(page, at)
        stop = found.start() if found else end
        if stop > at and stack[-1][1] != HIDDEN:
            text = page[at:stop]
            pieces.append(references.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        ends, tag, attributes = found.groups()
        if not tag:  # a comment or a declaration
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
        elif ends:
            if tag in INLINE or tag in UNSEEN or stack[-1][1] == HIDDEN:
                leave(tag)
            elif tag not in VOID:
                close()
                leave(tag)
        elif tag in INLINE and not (attributes and re.search("hidden|style", attributes, re.I)):
            continue
        else:
            if tag == "body":
                leave("head")
            _, mark, in_article = stack[-1]
            own = HIDDEN if mark == HIDDEN else _mark(tag, attributes, in_article)
            if own == HIDDEN:
                if tag in RAW:
                    raw = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = raw.end() if raw else end
                elif tag not in VOID:
                    if tag not in INLINE and tag not in UNSEEN and mark != HIDDEN:
                        close()
                    stack.append((tag, HIDDEN, in_article))
            elif tag not in INLINE:
                if tag not in VOID or tag == "hr":
                    close()
                if tag in VOID:
                    continue
                if stack[-1][0] == "p":
                    stack.pop()
                for closed in _CLOSES.get(tag, ()):
                    if stack[-1][0] == closed:
                        stack.pop()
                _, mark, in_article = stack[-1]
                if own is None or (own in (ARTICLE, MAIN) and mark in (ARTICLE, FURNITURE)):
                    own = mark  # an article inside furniture is a comment or a teaser
                stack.append((tag, own, in_article or own == ARTICLE))
    close()
    return out


class Stream:
    """The tokens of a page with what the marks say."""

    def __init__(self, page: str | None):
        self.blocks = blocks(page or "")
        self.sizes = [text.count(" ") + 1 for text, _ in self.blocks]
        self.marks = np.repeat(
            np.array([m for _, m in self.blocks], dtype=np.int8), self.sizes
        ) if self.blocks else np.zeros(0, dtype=np.int8)

    def windows(self, window: int) -> np.ndarray:
        """Starts of the windows that are not wholly inside a marked article."""
        n = len(self.marks) - window + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        outside = np.r_[0, np.cumsum(self.marks != ARTICLE)]
        return np.flatnonzero(outside[window : window + n] > outside[:n])

    def needed(self, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the tokens that windows at ``starts`` cover, and the starts
        among them."""
        inside = np.cumsum(covering(starts, window, len(self.marks))) > 0
        # a block's text has single spaces only, all others are part of its tokens
        words = " ".join(t for t, _ in self.blocks).split(" ")
        text = " ".join([words[i] for i in np.flatnonzero(inside).tolist()])
        return word_hashes(text.encode("utf-8", "replace")), (np.cumsum(inside) - 1)[starts]

    def name(self) -> int:
        """A signed name of the stream: pages with equal streams are one."""
        text = " ".join(t for t, _ in self.blocks).encode("utf-8", "replace")
        return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)

    def text(self, covered: np.ndarray) -> str:
        """What stays, given which tokens are covered by repeats."""
        # the closest that the page has to a marked article
        present = set(self.marks.tolist())
        wanted = next((m for m in (ARTICLE, MAIN) if m in present), OPEN)
        kept, at = [], 0
        for (text, mark), size in zip(self.blocks, self.sizes):
            if mark == wanted == ARTICLE:
                kept.append(text)
            elif mark == wanted:
                gone = covered[at : at + size]
                if not gone.any():
                    kept.append(text)
                elif not gone.all():
                    kept.append(" ".join(w for w, g in zip(text.split(" "), gone.tolist()) if not g))
            at += size
        return "\n\n".join(kept)


def repeated_substrings(streams: list[tuple[int, int, np.ndarray, np.ndarray]], window: int):
    """Suffix array of the concatenated (host, page, tokens, starts of windows): for
    every substring of ``window`` tokens at those starts its two 64-bit digests,
    the host mixed in, with the least and the greatest page."""
    sizes = [len(t) for _, _, t, _ in streams]
    first = np.cumsum([0, *(n + 1 for n in sizes)])
    text = np.zeros(first[-1], dtype=np.int64)
    values, ranks = np.unique(np.concatenate([t for *_, t, _ in streams]), return_inverse=True)
    ranks = ranks.astype(np.int64) + 1 + len(streams)
    done = 0
    for no, n in enumerate(sizes):
        text[first[no] : first[no] + n] = ranks[done : done + n]
        text[first[no] + n] = no + 1  # a separator of its own: no substring crosses pages
        done += n
    # prefix doubling, up to the length of a window
    rank, width = text, 1
    while width < window:
        step = min(width, window - width)
        second = np.r_[rank[step:], np.zeros(step, dtype=np.int64)]
        order = np.lexsort((second, rank))
        turn = np.r_[True, (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])]
        named = np.empty_like(rank)
        named[order] = np.cumsum(turn)
        rank, width = named, width + step
    starts = np.concatenate([first[no] + s for no, (*_, s) in enumerate(streams)])
    host = np.repeat(np.array([h for h, *_ in streams], dtype=np.int64), [len(s) for *_, s in streams])
    page = np.repeat(np.array([p for _, p, *_ in streams], dtype=np.int64), [len(s) for *_, s in streams])
    suffixes = np.lexsort((page, rank[starts], host))
    starts, host, page = starts[suffixes], host[suffixes], page[suffixes]
    agree = rank[starts]
    turn = np.flatnonzero(np.r_[True, (host[1:] != host[:-1]) | (agree[1:] != agree[:-1])])
    last = np.r_[turn[1:], len(starts)] - 1
    hashes = np.zeros(first[-1], dtype=np.uint64)
    at = np.concatenate([np.arange(first[no], first[no] + n) for no, n in enumerate(sizes)])
    hashes[at] = np.concatenate([t for *_, t, _ in streams])
    d1, d2 = digests(hashes, starts[turn], host[turn], window)
    return d1, d2, page[turn], page[last]


def digests(tokens: np.ndarray, starts: np.ndarray, host, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of the windows at ``starts`` of one host."""
    seeds = np.broadcast_to(np.asarray(host, dtype=np.int64), starts.shape).astype(np.int64).view(np.uint64)
    a, b = mix(seeds), mix(seeds ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    for i in range(window):
        word = tokens[starts + i]
        a = mix(a * np.uint64(0x9E3779B97F4A7C15) + word)
        b = mix((b ^ word) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(i))
    return a.view(np.int64), b.view(np.int64)


def covering(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """By how much the number of windows over each of ``n`` tokens changes there."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return change[:-1]


def _names(*columns: Column) -> list[Column]:
    """Two 64-bit names of a row; null is none of the other values."""
    told = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(i), *told).alias(f"r{i}") for i in (1, 2)]


def _source(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host, _ = parts(F.col(url_col))
    return pages.select(
        *_names(F.col(id_col), F.col(url_col), F.col(html_col)),
        F.when(host != "", F.xxhash64(host)).alias("host"), F.col(html_col).alias("html"),
    )


def _substrings(source: DataFrame, window: int) -> DataFrame:
    """(d1, d2, least, greatest) of the hosts' substrings, once per task's stretch."""

    def run(batches):
        held, size = [], 0

        def handed():
            columns = repeated_substrings(held, window)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d1", "d2", "least", "greatest"])

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if host is None:
                    continue
                stream = Stream(page)
                starts = stream.windows(window)
                if len(starts):
                    tokens, starts = stream.needed(starts, window)
                    held.append((host, stream.name(), tokens, starts))
                    size += len(tokens)
                if size >= STREAM_TOKENS:
                    yield handed()
                    held, size = [], 0
        if held:
            yield handed()

    return source.select("host", "html").mapInArrow(run, "d1 long, d2 long, least long, greatest long")


def _places(source: DataFrame, window: int) -> DataFrame:
    """(r1, r2, at, d1, d2) of every window of every page."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r1, r2, host, page in zip(*(batch.column(c).to_pylist() for c in ("r1", "r2", "host", "html"))):
                if host is None:
                    continue
                stream = Stream(page)
                starts = stream.windows(window)
                if not len(starts):
                    continue
                tokens, places = stream.needed(starts, window)
                for i in range(0, len(starts), FLUSH_WINDOWS):
                    part = starts[i : i + FLUSH_WINDOWS]
                    d1, d2 = digests(tokens, places[i : i + FLUSH_WINDOWS], host, window)
                    held.append((np.full(len(part), r1), np.full(len(part), r2), part, d1, d2))
                    size += len(part)
                    if size >= FLUSH_WINDOWS:
                        yield handed(held)
                        held, size = [], 0
        if held:
            yield handed(held)

    def handed(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*held)], ["r1", "r2", "at", "d1", "d2"]
        )

    return source.mapInArrow(run, "r1 long, r2 long, at long, d1 long, d2 long")


def repeated_places(source: DataFrame, window: int) -> DataFrame:
    """(r1, r2, starts): where each page's windows repeat on the host, written."""
    found = _substrings(source, window).groupBy("d1", "d2").agg(
        F.min("least").alias("least"), F.max("greatest").alias("greatest")
    ).filter("least < greatest").select("d1", "d2")
    repeats = write_scratch(found, "repeats")
    met = _places(source, window).join(broadcast_if_small(repeats), ["d1", "d2"], "left_semi")
    # repeated rows have the same starts: once each, they are no more than the page's tokens
    return write_scratch(
        met.select("r1", "r2", "at").distinct().groupBy("r1", "r2").agg(F.collect_list("at").alias("starts")),
        "covered",
    )


RESULT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_repeated", T.LongType()),
])


def main_text(
    pages: DataFrame, window: int = WINDOW, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """id, url, text, n_chars (code points), n_tokens (visible ones) and n_repeated
    (those of them that repeats of the host cover, outside of marked articles)."""
    covered = repeated_places(_source(pages, id_col, url_col, html_col), window)
    rows = pages.select(
        F.struct(F.col(id_col).alias("id"), F.col(url_col).alias("url")).alias("row"),
        *_names(F.col(id_col), F.col(url_col), F.col(html_col)), F.col(html_col).alias("html"),
    ).join(covered, ["r1", "r2"], "left").select("row", "html", "starts")
    fields = list(to_arrow_type(RESULT))

    def run(batches):
        for batch in batches:
            out = []
            for page, starts in zip(batch.column("html").to_pylist(), batch.column("starts").to_pylist()):
                stream = Stream(page)
                n = len(stream.marks)
                gone = np.cumsum(covering(np.array(starts or [], dtype=np.int64), window, n)) > 0
                text = stream.text(gone)
                out.append((text, len(text), n, int((gone & (stream.marks != ARTICLE)).sum())))
            columns = list(zip(*out)) or [()] * len(fields)
            struct = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), struct], ["row", "out"])

    found = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("out", RESULT)]))
    return found.select(F.col("row.id").alias(id_col), F.col("row.url").alias(url_col), "out.*")
