"""Main text of web pages: block extraction and nearest-URL differencing.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by their markup wherever they stand. Every page is
paired with the page of its host that stands nearest by URL path, the lines of
both are aligned by their longest common subsequence, and the shared ones are
template lines, which are deleted. A check by markup follows: mirrored articles
share their lines and must keep them, so lines in an article element come back;
lines of a main element but no article come back if most of the text is shared,
as the page is then another copy; and where a page has such an element, nothing
outside it is its text.

Lines are compared by 128-bit digests, so only those travel to the neighbour.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, spread, stored, table

# Fixed values of HTML: elements by how they end and whether they make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title object math xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
LEFT_OUT = frozenset("nav footer aside form button select option dialog menu head fieldset".split())
MAIN = frozenset(("article", "main"))
_WIDTH = 16  # bytes of a line's digest
# Names that say so in a class, id or role.
NAMES = frozenset("ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                  "alert warning sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs comment comments commentlist disqus replies "
                  "respond share sharing social related recommended newsletter subscribe subscription popup modal overlay footer widget widgets "
                  "toolbar pagination pager login signup search contentinfo complementary dialog form skip hidden copyright".split())
PAGE_NAMES = frozenset("header masthead topbar".split())  # outside an article only
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def _left_out(name: str, attributes: str, in_main: bool) -> bool:
    if name in LEFT_OUT or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body") or name in MAIN and not in_main:
        return False
    if _HIDDEN.search(re.sub(r"\"[^\"]*\"", lambda m: m[0] if "none" in m[0] or m[0] == '"true"' else '""', attributes)):
        return True
    for mark in _MARK.finditer(attributes):
        parts = set(_PARTS.split((mark[2] or mark[3] or mark[4] or "").lower()))
        if parts & NAMES or (not in_main and parts & PAGE_NAMES):
            return True
    return False


OUTSIDE, IN_MAIN, IN_ARTICLE = range(3)  # where a line stands


def lines(page: str) -> tuple[list[tuple[int, str]], bool]:
    """The blocks of a page, each with where it stands, without what is left
    out; whether the page has an article or main element."""
    found: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, int]] = []  # name, left out, where
    held: list[str] = []
    out, main, marked, at = False, OUTSIDE, False, 0

    def flush() -> None:
        if held:
            line = " ".join("".join(held).split())
            held.clear()
            if line:
                found.append((main, line))

    def close(depth: int) -> None:
        nonlocal out, main
        del stack[depth:]
        out, main = stack[-1][1:] if stack else (False, OUTSIDE)

    def text(upto: int) -> None:
        if not out and upto > at:
            piece = page[at:upto]
            held.append(html.unescape(piece) if "&" in piece else piece)

    match = _TOKEN.search(page)
    while match:
        text(match.start())
        at = match.end()
        name = (match[2] or "").lower()
        if name in RAW and not match[1]:
            end = re.compile(rf"</{name}\b[^>]*>|$", re.I).search(page, at) if not match[3].endswith("/") else None
            at = end.end() if end else at
        elif name == "br" or name in ("wbr", "img"):
            if name != "wbr" and not out:
                held.append(" ")
        elif name:
            if name not in INLINE:
                flush()
            if match[1]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        if any(x[0] not in INLINE for x in stack[depth:]):
                            flush()
                        close(depth)
                        break
            elif name not in VOID:
                if name not in INLINE:
                    names = [x[0] for x in stack]
                    if name not in ("html", "head", "link", "meta") and "head" in names:
                        close(names.index("head"))
                        names = [x[0] for x in stack]
                    # An open paragraph ends before a block, an open item before the next.
                    last = max((k for k, x in enumerate(names) if x not in INLINE), default=-1)
                    if last >= 0 and (names[last] == "p" or name in ("li", "dd", "dt", "td", "th", "tr", "option") and names[last] == name):
                        close(last)
                if not match[3].endswith("/") or name not in INLINE:
                    where = max(main, IN_ARTICLE if name == "article" else IN_MAIN if name in MAIN else OUTSIDE)
                    stack.append((name, out or _left_out(name, match[3], bool(main)), where))
                    out, main = stack[-1][1:]
                    marked = marked or (main > OUTSIDE and not out)
        match = _TOKEN.search(page, at)
    text(len(page))
    flush()
    return found, marked


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """``(article, outside, marked)``: the blocks inside article or main
    elements and those outside."""
    found, marked = lines(page)
    return [x for where, x in found if where], [x for where, x in found if not where], marked


_LINES = "uid long, url string, marked boolean, places binary, sizes array<int>, digests binary"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page the lines that are aligned: those inside article or main
    elements, then those outside; their places, sizes and digests."""
    for batch in batches:
        marks, places, sizes, digests = [], [], [], []
        for page in batch.column(2).to_pylist():
            found, marked = lines(page)
            found.sort(key=lambda x: x[0] == OUTSIDE)
            marks.append(marked)
            places.append(bytes(where for where, _ in found))
            sizes.append([len(x) for _, x in found])
            digests.append(b"".join(hashlib.blake2b(x.encode(), digest_size=_WIDTH).digest() for _, x in found))
        yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(1), pa.array(marks, pa.bool_()), pa.array(places, pa.binary()),
                                          pa.array(sizes, pa.list_(pa.int32())), pa.array(digests, pa.binary())],
                                         names=[x.split()[0] for x in _LINES.split(", ")])


def aligned(own: list, other: list) -> set[int]:
    """The lines of ``own`` (their numbers) in its longest common subsequence
    with ``other``."""
    where: dict = {}
    for k, line in enumerate(other):
        where.setdefault(line, []).append(k)
    tails: list[int] = []
    heads: list[tuple] = []  # for each length the line of own that ends it, and what is before
    for i, line in enumerate(own):
        for k in reversed(where.get(line, ())):
            at = bisect_left(tails, k)
            link = (i, heads[at - 1] if at else None)
            if at == len(tails):
                tails.append(k)
                heads.append(link)
            else:
                tails[at], heads[at] = k, link
    shared, link = set(), heads[-1] if heads else None
    while link:
        shared.add(link[0])
        link = link[1]
    return shared


OFTEN = 64  # equal lines from which a mask of them is kept


def aligned_rows(own: list, other: list) -> set[int]:
    """As ``aligned``, for pages of a few lines that come very often: time goes
    with lines by lines by bits, not with pairs of equal lines. Of equally long
    subsequences it may find another."""
    where: dict = {}
    for k, line in enumerate(other):
        where.setdefault(line, []).append(k)
    kept = {line: sum(1 << k for k in at) for line, at in where.items() if len(at) > OFTEN}
    full = (1 << len(other)) - 1

    def after(row: int, line) -> int:  # a bit is 0 where the subsequence grows
        hit = row & (kept.get(line) or sum(1 << k for k in where.get(line, ())))
        return (row + hit | row - hit) & full

    size, row, starts = isqrt(len(own)) + 1, full, []
    for i, line in enumerate(own):
        if i % size == 0:
            starts.append(row)
        row = after(row, line)
    shared, column = set(), len(other)
    for part in reversed(range(len(starts))):
        rows = [starts[part]]
        for line in own[part * size:(part + 1) * size]:
            rows.append(after(rows[-1], line))
        at = len(rows) - 1
        while at and column:
            if rows[at] >> (column - 1) & 1:
                column -= 1
                continue
            at -= 1
            if rows[at] >> (column - 1) & 1:
                shared.add(part * size + at)
                column -= 1
    return shared


def unshared(own: list[str], other: list[str]) -> list[str]:
    """The lines of ``own`` outside its longest common subsequence with
    ``other``; all, if the pages have the same lines."""
    if own == other:
        return own
    shared = aligned(own, other)
    return [line for i, line in enumerate(own) if i not in shared]


def checked(shared: set[int], marked: bool, places: bytes, sizes: list[int]) -> set[int]:
    """Of the shared lines those that markup lets go: all on a page without an
    article or main element; else those of a main element that stand in no
    article, unless more than half of the text is shared."""
    if not marked:
        return shared
    text = sum(size for where, size in zip(places, sizes, strict=True) if where)
    if 2 * sum(sizes[i] for i in shared if places[i]) > text:
        return set()
    return {i for i in shared if places[i] == IN_MAIN}


def _equal_pairs(own: list, other: list) -> int:
    there = Counter(other)
    return sum(n * there[line] for line, n in Counter(own).items())


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, gone = [], []
        for marked, places, sizes, own, other in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
            own, other = ([x[k:k + _WIDTH] for k in range(0, len(x), _WIDTH)] for x in (own, other))
            if own == other:
                shared = set(range(len(own)))
            elif marked and _equal_pairs(own, other) > OFTEN * (len(own) + len(other)):
                shared = aligned_rows(own, other)
            else:
                shared = aligned(own, other)
            counts.append(len(shared))
            gone.append(sorted(checked(shared, marked, places, sizes)) if own != other else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), pa.array(gone, pa.list_(pa.int32()))], names=["uid", "n_shared", "gone"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages and the numbers of their lines that go, to texts."""
    for batch in batches:
        texts = []
        for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            inside, outside, marked = blocks(page)
            gone = set(gone or ())
            texts.append("\n".join(x for k, x in enumerate(inside if marked else outside) if k not in gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def _neighbours(pages: DataFrame) -> DataFrame:
    """``(uid, other)`` for each page whose host has another: the page of its
    host nearest by URL path, the one before or the one after in order of path."""
    keys = pages.select("uid", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"))
    keys = keys.fillna("", ["host", "path"])
    order = ["host", "path", "uid"]
    placed = stored(keys.repartitionByRange(spread(pages), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "page-order")
    part = F.shiftright("at", 33).cast("int")
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("part")).agg(F.count("*")).collect())  # one per partition
    first, total = {}, 0
    for k, n in sizes:
        first[k], total = total, total + n
    starts = F.create_map(*[F.lit(x) for k, n in ({-1: 0} | first).items() for x in (k, n)])  # a map of no entry has no type
    ranked = placed.withColumn("rank", (F.element_at(starts, part) + F.col("at").bitwiseAND((1 << 33) - 1)).cast("long"))
    wanted = ranked.select("uid", "host", "path", F.explode(F.array(F.col("rank") - 1, F.col("rank") + 1)).alias("rank"))
    other = ranked.select(F.col("uid").alias("other"), F.col("host").alias("host2"), F.col("path").alias("path2"), "rank")
    met = wanted.join(other, "rank").where("host = host2 and host != ''")
    common = F.length(F.regexp_extract(F.concat("path", F.lit("\n"), "path2"), r"^(.*).*\n\1", 1))
    return met.groupBy("uid").agg(F.max_by("other", F.struct(common, F.col("other"))).alias("other"))


def differenced(rows: DataFrame) -> DataFrame:
    """``(uid, n_shared, gone)`` for each page whose host has another: how many
    of its lines the nearest page shares, and the numbers of those that go."""
    # A repeated row is one page.
    marks = stored(rows.mapInArrow(_digests, _LINES).dropDuplicates(["uid"]), "page-lines")
    pairs = stored(_neighbours(marks), "page-pairs")
    other = marks.select(F.col("uid").alias("other"), F.col("digests").alias("other_digests"))
    met = pairs.join(marks, "uid").join(other, "other")
    return met.select("uid", "marked", "places", "sizes", "digests", "other_digests").mapInArrow(_align, "uid long, n_shared int, gone array<int>")


def numbered(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, uid``; equal rows have equal uids."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.withColumn("uid", F.xxhash64("page_id", "url", "html"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Null and empty html give an empty text; a null id or url stays null (a
    page without a host has no neighbour and keeps its lines); repeated rows
    give equal rows; other columns are ignored; no row gives no row.
    """
    rows = numbered(pages)
    gone = stored(differenced(rows).where(F.size("gone") > 0).select("uid", "gone"), "page-template")
    texts = rows.join(gone, "uid", "left").select("page_id", "url", "html", "gone").mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the main text of every page."""
    prepare(spark)
    return main_text(table(spark, sf_dir, "pages"))
