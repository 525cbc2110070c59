"""Main text of web pages by structure and by differencing a page with its nearest neighbour.

Pages are paired by URL: each with the page of its host whose path is nearest. Their blocks of text are
aligned by a longest common subsequence, and what both pages say in the same order is taken for the
site's, not the page's: shared blocks are deleted. Where a page marks its article, that mark decides:
an article that is published twice is not deleted, and what stands outside is not kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import text_or_empty
from claimlens.operators.rowid import number_rows
from claimlens.session import stage

# Elements whose text is never part of an article.
LEFT_OUT = frozenset(
    "head title script style noscript template nav footer aside form button select textarea iframe object "
    "embed svg canvas audio video dialog menu".split()
)
# Words in a class, id or role that mark such elements.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices newsletter subscribe subscription signup popup modal overlay sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments reply replies respond "
    "disqus share sharing social related recommended widget pagination pager login search contentinfo "
    "complementary alert".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# An element that ends an open one of the kinds named, if nothing but inline elements lies between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# A name that begins or ends with one of these says something of the page around it: it is no mark.
MODIFIERS = frozenset("with without has no is not show hide js".split())
STATES = frozenset("visible hidden open opened closed collapsed expanded active enabled disabled".split())
# Zones of a block: 0 none, MAIN in a main element, HEADING a first heading there, from ARTICLE on the articles.
MAIN, HEADING, ARTICLE = 1, 2, 3
TEASER = 0.25  # an article of less than this share of the longest one's characters is none
# Bits of a table of common lengths that is held at once.
TABLE_BITS = 1 << 23

_WORDS = re.compile(r"[a-z0-9]+")
_ARTICLES = re.compile(r"<article[\s/>]", re.IGNORECASE)
# Why an element is left out: its name or that it is hidden, or the words in its attributes.
BY_MARK, BY_KIND = 1, 2


def marked(names: str) -> bool:
    """Whether one of the names, as they stand in a class, id or role, has a marked word."""
    for name in names.split():
        words = _WORDS.findall(name)
        if words and words[0] not in MODIFIERS and words[-1] not in STATES and not MARKS.isdisjoint(words):
            return True
    return False


class Blocks(HTMLParser):
    """The blocks of a page in order, as (text, zone). Blocks of elements that are left out do not appear. A mark
    on an element does not leave out a main element inside it, nor the page's only article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int]] = []
        self._open: list[tuple[str, int, int]] = []  # (name, why it is left out, zone)
        self._names: Counter[str] = Counter()
        self._text: list[str] = []
        self._articles = self._seen = 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._close()
            self._end_open({"p"} if tag not in ENDS else ENDS[tag])
        if tag in VOID:
            return
        out, zone = self._state()
        values = {k: (v or "").lower() for k, v in attrs}
        if tag == "main" or values.get("role") == "main":
            out, zone = (0 if out == BY_MARK else out), max(zone, MAIN)
        elif tag == "article":
            own = set(_WORDS.findall(f"{values.get('class', '')} {values.get('id', '')}"))
            if own & {"comment", "comments", "reply"}:
                out = max(out, BY_MARK)
            elif out == BY_MARK and self._articles == 1:
                out = 0
            if zone < ARTICLE:
                zone = ARTICLE + self._seen
                self._seen += 1
        elif tag not in ("body", "html"):
            hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
            # A heading element within an article is the article's own.
            if tag in LEFT_OUT or hidden or (tag == "header" and zone < ARTICLE):
                out = BY_KIND
            elif marked(" ".join(values.get(k, "") for k in ("class", "id", "role"))):
                out = max(out, BY_MARK)
            if tag == "h1" and zone == MAIN:
                zone = HEADING
        if out != self._state()[0]:
            self._close()
        self._open.append((tag, out, zone))
        self._names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self._close()
        if not self._names[tag]:
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                if any(o[1] != self._open[i][1] for o in self._open[i:]) or self._open[i][1]:
                    self._close()
                self._end_from(i)
                return

    def handle_data(self, data):
        if not self._state()[0]:
            self._text.append(data)

    def finished(self, html: str) -> list[tuple[str, int]]:
        self._articles = len(_ARTICLES.findall(html))
        self.feed(html)
        self.close()
        self._close()
        return self.blocks

    def _state(self) -> tuple[int, int]:
        return self._open[-1][1:] if self._open else (0, 0)

    def _end_from(self, i: int) -> None:
        self._names.subtract(name for name, _, _ in self._open[i:])
        del self._open[i:]

    def _end_open(self, kinds: set[str]) -> None:
        for i in range(len(self._open) - 1, -1, -1):
            name = self._open[i][0]
            if name in kinds:
                self._end_from(i)
                return
            if name not in INLINE:
                return

    def _close(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text.clear()
        if text:
            self.blocks.append((text, self._state()[1]))


def common_subsequence(a: list, b: list) -> set[int]:
    """Places in ``a`` of a longest common subsequence of both. Memory grows with the sum of their lengths: a table
    of more than ``TABLE_BITS`` is divided where an optimal path crosses the middle of ``b``."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found = {*range(start), *range(len(a) - end, len(a))}
    shared = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    places = [i for i in range(start, len(a) - end) if a[i] in shared]
    left = [([a[i] for i in places], [v for v in b[start : len(b) - end] if v in shared], 0)]
    while left:
        x, y, at = left.pop()
        if len(x) * len(y) <= TABLE_BITS or len(y) < 2:
            found.update(places[at + i] for i in _traced(x, y))
        else:
            middle = len(y) // 2
            before, after = _lengths(x, y[:middle]), _lengths(x[::-1], y[:middle - 1 : -1])
            cut = int(np.argmax(before + after[::-1]))
            left += [(x[:cut], y[:middle], at), (x[cut:], y[middle:], at + cut)]
    return found


def _columns(x: list, y: list) -> Iterator[int]:
    """Columns of the table of lengths, one for each item of ``y``: integers whose bit i is 0 where the length
    grows from i to i + 1 items of ``x``."""
    at: dict = {}
    for i, v in enumerate(x):
        at[v] = at.get(v, 0) | 1 << i
    full = (1 << len(x)) - 1
    column = full
    for v in y:
        here = at.get(v, 0)
        column = ((column + (column & here)) | (column & ~here)) & full
        yield column


def _lengths(x: list, y: list) -> np.ndarray:
    """Of each beginning of ``x``: how long its longest common subsequence with ``y`` is."""
    column = (1 << len(x)) - 1
    for column in _columns(x, y):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(column.to_bytes(len(x) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.r_[0, np.cumsum(1 - bits[: len(x)].astype(np.int64))]


def _traced(x: list, y: list) -> list[int]:
    columns = list(_columns(x, y))
    found = []
    i, j = len(x), len(y)
    while i and j:
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            found.append(i)
        elif columns[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return found


def main_text(blocks: list[tuple[str, int]], keys: list[int], neighbour: list[int]) -> str:
    """What a mark says is the article's, with the first heading of a main element around it; without a mark, the
    blocks that are not shared with the neighbour. If all are shared the pages are copies, and the pair tells
    nothing. Of several articles, those of less than ``TEASER`` of the longest one's text are left out."""
    sizes: Counter[int] = Counter()
    for text, zone in blocks:
        if zone >= ARTICLE:
            sizes[zone] += len(text)
    if sizes:
        zones = {z for z, n in sizes.items() if n >= TEASER * max(sizes.values())} | {HEADING}
    elif any(z for _, z in blocks):
        zones = {MAIN, HEADING}
    else:
        shared = common_subsequence(keys, neighbour)
        if len(shared) == len(blocks):
            shared = set()
        return " ".join(t for i, (t, _) in enumerate(blocks) if i not in shared)
    return " ".join(t for t, z in blocks if z in zones)


def block_key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def parsed(pages: DataFrame) -> DataFrame:
    """row, page_id, url, host, path, and the blocks of each page as texts, zones and keys."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [Blocks().finished(h) for h in batch.column(5).to_pylist()]
            yield pa.record_batch(
                [
                    *batch.columns[:5],
                    pa.array([[t for t, _ in b] for b in blocks], pa.list_(pa.string())),
                    pa.array([[z for _, z in b] for b in blocks], pa.list_(pa.int32())),
                    pa.array([[block_key(t) for t, _ in b] for b in blocks], pa.list_(pa.int64())),
                ],
                ["row", "page_id", "url", "host", "path", "texts", "zones", "keys"],
            )

    url = F.col("url").cast("string")
    plain = F.regexp_replace(url, r"[?#].*$", "")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        url.alias("url"),
        F.lower(F.regexp_extract(plain, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/]*)", 1)).alias("host"),
        F.regexp_replace(plain, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*", "").alias("path"),
        text_or_empty("html").alias("html"),
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(
        parse, f"row bigint, page_id {kind}, url string, host string, path string, texts array<string>, zones array<int>, keys array<bigint>"
    )


def shared_path(a, b):
    """How many characters two paths have in common at their start."""
    width = F.greatest(F.length(a), F.length(b), F.lit(1))
    same = F.filter(
        F.sequence(F.lit(1), width),
        lambda i: (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)) & (F.length(a) >= i) & (F.length(b) >= i),
    )
    return F.size(same)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page.

    A null html is empty, and gives an empty text. A page without a URL or host has no neighbour; nor has
    the only page of a host. Repeated rows are pages of their own, and neighbours of each other. Of two pages as
    near, the one before in the order of paths is the neighbour. A page of any length is read whole. An
    empty table gives no rows; other columns are not read.

    Pages are numbered in the order of host and path without bringing a host together, and a page meets
    its neighbours by number: every key of these joins is one row, however large a host is. Only the
    blocks' hashes are ordered and paired; the texts move once, to meet the hashes of their neighbour.
    A page is known by its place in ``pages``, which is read twice: it must be a table, or the result
    of a checkpoint.
    """
    blocks = parsed(pages)
    slim = stage(blocks.select("row", "host", "path", "page_id", "keys"), "page-keys")
    rows = number_rows(slim.drop("keys"), ["host", "path", "page_id", "row"], "place")
    rows = stage(rows.select("place", "row", "host", "path"), "page-order")
    keys = rows.select("place", "host", "path")
    before = keys.select((F.col("place") + 1).alias("place"), F.col("host").alias("host0"), F.col("path").alias("path0"))
    after = keys.select((F.col("place") - 1).alias("place"), F.col("host").alias("host2"), F.col("path").alias("path2"))
    near = keys.where(F.col("host") != "").join(before, "place", "left").join(after, "place", "left")
    # -1: no page of this host on that side.
    left = F.when(F.col("host0") == F.col("host"), shared_path(F.col("path"), F.col("path0"))).otherwise(-1)
    right = F.when(F.col("host2") == F.col("host"), shared_path(F.col("path"), F.col("path2"))).otherwise(-1)
    near = near.select("place", left.alias("left"), right.alias("right")).where("left >= 0 or right >= 0")
    near = near.select(
        "place", F.when(F.col("left") >= F.col("right"), F.col("place") - 1).otherwise(F.col("place") + 1).alias("other")
    )
    others = near.join(rows.select(F.col("place").alias("other"), F.col("row").alias("other_row")), "other")
    others = others.join(rows.select("place", "row"), "place").select("row", "other_row")
    others = others.join(slim.select(F.col("row").alias("other_row"), F.col("keys").alias("neighbour")), "other_row")
    others = stage(others.select("row", "neighbour"), "page-neighbours")
    paired = blocks.drop("host", "path", "keys").join(others, "row", "left")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, zones, other = (batch.column(i).to_pylist() for i in range(2, 5))
            found = [
                main_text(list(zip(t, z, strict=True)), [block_key(x) for x in t], n or [])
                for t, z, n in zip(texts, zones, other, strict=True)
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return paired.select("page_id", "url", "texts", "zones", "neighbour").mapInArrow(
        difference, f"page_id {kind}, url string, text string, n_chars bigint"
    )
