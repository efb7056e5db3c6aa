"""Main text of web pages by differencing each page against its nearest neighbour on the same host.

Pages are read as lines: the texts between block tags. Pages of a host are ordered by URL path, and each is paired with the
neighbour whose path agrees with its own for longer. The lines of the two are aligned by a longest common subsequence; lines
that both have are the site's, not the page's, and go. Markup decides first where it speaks for itself: lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments never stay, also when no neighbour repeats them, and lines inside an
article or main element always stay, as two pages may well quote the same passage or be copies.

Only line hashes are compared: pages are read once for hashes, which are ordered, paired and aligned, and once for the text.
Decisions exist for pages that lose a line, and only those meet the pages in a join.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyline.llm import blocks
from tallyline.operators.ordering import global_row_number
from tallyline.operators.skew import broadcast_if_small
from tallyline.sources.lake import Scratch

OPEN, MAIN, SITE, ASIDE = 0, 1, 2, 3  # what markup says of a line: nothing, the article, not the article (element, or class and id)

# Element names of the HTML standard, by what they do to text.
BLOCK = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
            "select summary table tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
NEVER = set("script style head title nav footer aside form button select textarea noscript template iframe object svg canvas dialog "
            "menu search noembed noframes datalist audio video math".split())
# Words in class, id and role that name parts of a page beside its article.
SITE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
                 "cookie cookies disqus footer gdpr header masthead menu menubar modal nav navbar navigation navigation-bar newsletter notice notices "
                 "overlay pagination paywall pager popup promo promoted promotion promotions related replies respond search share sharing sidebar "
                 "sidenav social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
REPLY_WORDS = {"comment", "comments", "reply", "replies", "respond"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_WORD = re.compile(r"[a-z]+")
_CLOSES_P = BLOCK - {"br", "option", "optgroup", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "head", "html"}


def lines_of(page: str) -> Iterator[tuple[int, str]]:
    """(what markup says, text) of every line of a page in order; white space is one space, references are decoded.

    Tags that are cut off or never closed do no harm: an end tag closes up to its own start tag, and is ignored without one.
    """
    stack: list[tuple[str, int]] = []
    unclosed: Counter[str] = Counter()
    parts: list[str] = []
    zone, begun = OPEN, OPEN
    at = 0

    def flush():
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        return text

    for tag in _TAG.finditer(page):
        if tag.start() < at:
            continue
        if tag.start() > at:
            parts.append(page[at:tag.start()])
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK or name in NEVER and name not in ("script", "style"):
            if parts and (text := flush()):
                yield begun, text
        if tag[1]:
            while unclosed[name]:
                closed, zone = stack.pop()
                unclosed[closed] -= 1
                if closed == name:
                    break
        elif name not in VOID:
            if name in _CLOSES_P and stack and stack[-1][0] == "p":
                zone = stack.pop()[1]
                unclosed["p"] -= 1
            if name in _RAW_END:
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
                continue
            if not tag[3].rstrip().endswith("/") or name in BLOCK:
                stack.append((name, zone))
                unclosed[name] += 1
                zone = _zone(name, tag[3], zone)
        if not parts:
            begun = zone
        elif zone >= SITE or begun >= SITE:  # an inline element of the site inside a line, or its end
            if text := flush():
                yield begun, text
            begun = zone
    if at < len(page):
        parts.append(page[at:])
    if parts and (text := flush()):
        yield begun, text


def _zone(name: str, attributes: str, zone: int) -> int:
    """What markup says inside an element that begins where ``zone`` held.

    A class may name a whole layout, such as one with a sidebar, so a main element inside it is the article all the same.
    """
    if zone == SITE or name in NEVER or name == "header" and zone != MAIN:
        return SITE
    if name in ("html", "body"):
        return zone
    main, words, role = name == "main", set(), ""
    for key, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return SITE
        if key in ("class", "id", "role"):
            words.update(_WORD.findall(value))
            role = value if key == "role" else role
    if main or role == "main":
        return MAIN
    article = name == "article" or role == "article"
    named = words & (REPLY_WORDS if article else SITE_WORDS)
    if zone == ASIDE or named - ({"header"} if zone == MAIN else set()):
        return ASIDE
    return MAIN if article else zone


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` a longest common subsequence with ``b`` takes.

    Equal ends are taken at once and lines the other side has not are left out. The rest is cut in half again and again where
    the two halves' lengths add up best (bit-parallel rows of the table), so memory is that of one row.
    """
    taken = np.zeros(len(a), bool)
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    n -= head
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = n if same.all() else int(same.argmin())
    taken[:head] = True
    taken[len(a) - tail:] = True
    places = np.arange(head, len(a) - tail)
    places = places[np.isin(a[places], b[head:len(b) - tail])]
    other = b[head:len(b) - tail]
    other = other[np.isin(other, a[places])]
    todo = [(places, other)]
    while todo:
        left, right = todo.pop()
        if not len(left) or not len(right):
            continue
        if len(left) == 1:
            taken[left[0]] = bool((right == a[left[0]]).any())
            continue
        middle = len(left) // 2
        first = _lengths(a[left[:middle]], right)
        last = _lengths(a[left[middle:]][::-1], right[::-1])[::-1]
        cut = int((first + last).argmax())
        todo += [(left[:middle], right[:cut]), (left[middle:], right[cut:])]
    return taken


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common subsequence of ``a`` and each prefix of ``b``."""
    where: dict[int, int] = {}
    for k, value in enumerate(b.tolist()):
        where[value] = where.get(value, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for value in a.tolist():
        hit = row & where.get(value, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


_URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)"


def site_of(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path without last slash); null host where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r":\d*$", "")
    return F.when(host != "", host), F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", "")


def _page_key() -> Column:
    """16 bytes that stand for a row's address and content. Rows that repeat a page share its key, lines and fate."""
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col("url"), F.lit("")), F.coalesce(F.col("html"), F.lit(""))).cast("binary")))


def shared_lines(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(page, drop): for pages that lose lines to their neighbour, which lines do not stay, one bit each in order."""
    host, path = site_of(F.col("url"))
    read = pages.select(_page_key().alias("page"), host.alias("host"), path.alias("path"), "html").filter("host IS NOT NULL")
    lines = read.mapInArrow(_hashes, "page binary, host string, path string, hashes binary, zones binary")
    # pages that repeat a page are one
    single = lines.groupBy("page").agg(*[F.first(c).alias(c) for c in ("host", "path", "hashes", "zones")])
    placed = scratch.write(global_row_number(single, ["host", "path", "page"], scratch, "place"))
    beside = placed.select("place", "host", "path", "hashes")
    before = beside.select((F.col("place") + 1).alias("place"), *[F.col(c).alias(f"{c}_1") for c in ("host", "path", "hashes")])
    after = beside.select((F.col("place") - 1).alias("place"), *[F.col(c).alias(f"{c}_2") for c in ("host", "path", "hashes")])
    both = placed.join(before, "place", "left").join(after, "place", "left")
    return both.select("page", "host", "path", "hashes", "zones", "host_1", "path_1", "hashes_1", "host_2", "path_2", "hashes_2").mapInArrow(
        _compare, "page binary, drop binary")


def extract(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``pages`` (url, html and any other columns but text and n_chars) with ``text`` and ``n_chars`` for ``html``.

    ``text`` is the lines that stay, joined by one space; ``n_chars`` its code points. Null html is empty; a page without url or
    without a neighbour on its host is judged by markup alone. A neighbour that would take every line outside of site markup is
    a copy and takes none. Equal paths are neighbours; ties go to the page before. Repeated rows come out each.
    """
    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    drops = broadcast_if_small(scratch.write(shared_lines(pages, scratch)), 20_000)
    rows = pages.select(F.struct(*kept).alias("_row"), F.col("html"), _page_key().alias("page")).join(drops, "page", "left")
    schema = StructType([*rows.select("_row").schema, StructField("text", StringType()), StructField("n_chars", LongType())])
    found = rows.select("_row", "html", "drop").mapInArrow(_texts, schema)
    return found.select(*[F.col("_row").getField(c).alias(c) for c in kept], "text", "n_chars")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, zones = [], []
        for page in batch.column(3):
            found = list(lines_of(page.as_py() or ""))
            hashes.append(_digests([text for _, text in found]).tobytes())
            zones.append(bytes(z for z, _ in found))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hashes, pa.binary()), pa.array(zones, pa.binary())],
                                         [*batch.schema.names[:3], "hashes", "zones"])


def _digests(lines: list[str]) -> np.ndarray:
    """64-bit hashes of whole lines."""
    if not lines:
        return np.zeros(0, np.uint64)
    raw = [line.encode("utf-8", "surrogatepass") for line in lines]
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw])
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(first, sizes)
    values = blocks._BYTE_VALUES[data] * blocks.powers(int(sizes.max()))[place]
    return blocks.mix(np.add.reduceat(values, first) + sizes.astype(np.uint64))


def _agreement(a: str, b: str) -> tuple[int, int]:
    """How far two paths agree: whole segments, then characters of the next."""
    x, y = a.split("/"), b.split("/")
    n = next((k for k, (s, t) in enumerate(zip(x, y, strict=False)) if s != t), min(len(x), len(y)))
    s, t = "/".join(x[n:n + 1]), "/".join(y[n:n + 1])
    return n, next((k for k, (c, d) in enumerate(zip(s, t, strict=False)) if c != d), min(len(s), len(t)))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, drops = [], []
        for page, host, path, hashes, zones, host_1, path_1, hashes_1, host_2, path_2, hashes_2 in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            near = [(_agreement(path, p), h) for p, h, o in ((path_1, hashes_1, host_1), (path_2, hashes_2, host_2)) if o == host]
            if not near:
                continue
            zone = np.frombuffer(zones, np.uint8)
            own = np.frombuffer(hashes, np.uint64)
            shared = common_lines(own, np.frombuffer(max(near, key=lambda x: x[0])[1], np.uint64))
            drop = shared & (zone == OPEN)
            if drop.any() and not shared[zone < SITE].all():
                pages.append(page)
                drops.append(np.packbits(drop, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(pages, pa.binary()), pa.array(drops, pa.binary())], ["page", "drop"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, drop in zip(batch.column(1), batch.column(2), strict=True):
            found = list(lines_of(page.as_py() or ""))
            gone = np.zeros(len(found), bool)
            if drop.is_valid:
                gone = np.unpackbits(np.frombuffer(drop.as_py(), np.uint8), bitorder="little")[:len(found)].astype(bool)
            texts.append(" ".join(text for (zone, text), out in zip(found, gone.tolist(), strict=True) if zone < SITE and not out))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         ["_row", "text", "n_chars"])
