"""HTML extraction by nearest-URL page differencing, held to the page's own structure where it marks its article.

Every page is paired with the pages of the nearest URL paths on its host: both pages' text lines are aligned by a
longest common subsequence, and shared lines are deleted, as is declared furniture.  How much it takes to delete a line
depends on the marks.  On a page without any, sharing with the nearest page that is no copy is enough.  Where a page
marks its article (or main part), lines outside go, shared or not, as a menu or an advert may change from page to page;
lines inside are protected, as articles repeat lines of their neighbours by chance or as quotations, and go only if
every neighbour that is no copy shares them, of which there must be several: notices that nothing declares.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, columns, tidied

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")

#: Fixed values of HTML: elements whose content is no text of the page; elements without content; elements that stand in a line.
_OPAQUE = frozenset("script style title template textarea noscript iframe object svg math xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Elements and roles of page furniture.
_FURNITURE = frozenset("nav footer aside form header menu button select dialog fieldset input option datalist optgroup".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar status toolbar".split())
#: Words that name furniture in a class or id, and words that may stand beside them there; any other word (`side-effects`) makes another name.
_PARTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars side menu menus nav navbar navigation breadcrumb breadcrumbs footer foot header masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion social share sharing related recommended recommendations widget widgets pagination pager skip tags".split())
_BESIDE = frozenset("site page main top bottom left right primary secondary global sticky fixed mobile desktop bar box list slot unit wrapper wrap container holder area block section inner outer row col column panel group links link items item buttons button icons form thread post posts article articles content text message law eu info module region zone".split())


@dataclass
class Page:
    lines: list[str]
    slot: list[int]  # a number for the containers around each line
    inside: list[bool]  # within the article
    furniture: list[bool]
    heading: list[bool]


def _names_furniture(name: str) -> bool:
    """Whether a class or an id names page furniture: a word for it, alone or with others of its kind, numbers and words of layout."""
    parts = [x for x in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", name) if x and not x.isdigit()]
    return any(x in _PARTS for x in parts) and all(x in _PARTS or x in _BESIDE for x in parts)


def _odd(tag: str, attrs: str) -> bool:
    """Whether an element's attributes say that it is page furniture or not shown."""
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), html.unescape(next((v for v in values if v), "")).lower()
        if name in ("class", "id") and tag not in ("body", "html") and any(map(_names_furniture, value.split())):
            return True
        if name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def parse(source: str) -> Page:
    """The page's blocks in order; white space in a block is one space, character references are decoded."""
    page = Page([], [], [], [], [])
    open_tags: list[tuple[str, bool, int, int]] = []  # name, furniture, kind: 2 article, 1 main; number of the containers down to it
    depth: dict[str, int] = {}  # open elements by name
    text: list[str] = []
    kinds: list[int] = []
    state = [0, 0, 0]  # furniture, main and article elements that are open

    def close_block() -> None:
        if text:
            line = " ".join("".join(text).split())
            text.clear()
            if line:
                page.lines.append(line)
                page.slot.append(open_tags[-1][3] if open_tags else 0)
                page.furniture.append(state[0] > 0)
                page.heading.append(any(map(depth.get, _HEADINGS)))
                kinds.append(2 if state[2] else 1 if state[1] else 0)

    def add(raw: str) -> None:
        if raw:
            text.append(html.unescape(raw) if "&" in raw else raw)

    def shift(entry: tuple[str, bool, int, int], by: int) -> None:
        depth[entry[0]] = depth.get(entry[0], 0) + by
        state[0] += by * entry[1]
        if entry[2]:
            state[entry[2]] += by

    at, n = 0, len(source)
    while at < n:
        m = _TAG.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
        elif m[1]:
            if name not in _INLINE:
                close_block()
            if depth.get(name):
                while True:
                    entry = open_tags.pop()
                    shift(entry, -1)
                    if entry[0] == name:
                        break
        elif name == "br":
            text.append(" ")
        elif name in _VOID:
            if name not in ("img", "wbr", "input", "embed"):
                close_block()
        elif name in _OPAQUE:
            if not m[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else n
        else:
            inline = name in _INLINE
            attrs = m[3]
            odd = bool(attrs) and _odd(name, attrs)
            if not inline:
                close_block()
                if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # these end an open one of their kind
                    same = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
                    if name == "p" or open_tags:
                        for k in range(len(open_tags) - 1, -1, -1):
                            if open_tags[k][0] in same:
                                for entry in open_tags[k:]:
                                    shift(entry, -1)
                                del open_tags[k:]
                                break
                            if open_tags[k][0] not in _INLINE:
                                break
            elif not odd:
                if attrs.endswith("/"):
                    continue
            kind = 2 if name == "article" else 1 if name == "main" or re.search(r"\brole\s*=\s*[\"']?main\b", attrs, re.I) else 0
            within = state[2] > 0
            around = open_tags[-1][3] if open_tags else 0
            entry = (name, odd or name in _FURNITURE and not (name == "header" and within), 0 if odd else kind, around if inline else zlib.crc32(name.encode(), around))
            open_tags.append(entry)
            shift(entry, 1)
    close_block()
    # the article, else the main part, else the whole body
    best = max((k for k, f in zip(kinds, page.furniture) if not f), default=0)
    page.inside = [k >= best and best > 0 for k in kinds]
    return page


def shared_lines(a: list[tuple[str, str]], b: list[tuple[str, str]]) -> list[bool]:
    """Which lines of a are in a longest common subsequence of a and b."""
    out = [False] * len(a)
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        out[low] = True
        low += 1
    end = 0
    while end < min(len(a), len(b)) - low and a[-1 - end] == b[-1 - end]:
        out[-1 - end] = True
        end += 1
    places: dict[tuple[str, str], list[int]] = {}
    for j in range(low, len(b) - end):
        places.setdefault(b[j], []).append(j)
    # the longest ascending chain of matches, a line's matches taken from the last
    ends: list[int] = []
    links: list[tuple[int, object] | None] = []
    for i in range(low, len(a) - end):
        for j in reversed(places.get(a[i], ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link is not None:
        out[link[0]] = True
        link = link[1]
    return out


def repeated(page: Page, own: list[int], neighbours: list[Page], part: float, least: int) -> list[bool]:
    """Which lines `own` of a marked article every neighbour shares, except those that share `part` of its characters or more, of which `least` must be left.

    Headings stay: articles of a site often have the same ones.
    """
    out = [len(neighbours) >= least and not page.heading[k] for k in own]
    keys = [(page.slot[k], page.lines[k]) for k in own]
    text, compared = sum(len(x) for _, x in keys), 0
    for k, other in enumerate(neighbours):
        if not any(out) or compared + len(neighbours) - k < least:
            return [False] * len(own)
        shared = shared_lines(keys, [(s, x) for s, x, inside, f in zip(other.slot, other.lines, other.inside, other.furniture) if inside and not f])
        if sum(len(x) for (_, x), s in zip(keys, shared) if s) < part * text:
            out, compared = [x and s for x, s in zip(out, shared)], compared + 1
    return out if compared >= least else [False] * len(own)


def main_lines(page: Page, neighbours: list[Page], whole: float = 0.9, part: float = 0.5, least: int = 4) -> list[str]:
    """The page's main text against its neighbours, the nearest first.

    A neighbour that shares `whole` of the characters outside furniture, or more, is a copy: the next one is tried
    instead, and where all are copies nothing is deleted for being shared.  Lines of a marked article need more to go,
    see `repeated`; with fewer than `least` neighbours they all stay.
    """
    if any(page.inside):
        own = [k for k, (f, inside) in enumerate(zip(page.furniture, page.inside)) if inside and not f]
        return [page.lines[k] for k, s in zip(own, repeated(page, own, neighbours, part, least)) if not s]
    keys = list(zip(page.slot, page.lines))
    text = sum(len(x) for x, f in zip(page.lines, page.furniture) if not f)
    for other in neighbours:
        shared = shared_lines(keys, [(s, x) for s, x, inside in zip(other.slot, other.lines, other.inside) if not inside])
        if sum(len(x) for x, s, f in zip(page.lines, shared, page.furniture) if s and not f) < whole * text:
            return [x for x, s, f in zip(page.lines, shared, page.furniture) if not (s or f)]
    return [x for x, f in zip(page.lines, page.furniture) if not f]


def url_path(url: Column) -> Column:
    """The path without query, fragment, `.html` and a slash at the end."""
    path = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    return F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.x?html?$", "")


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


_KEY = "struct<host string, path string, named boolean, page_id bigint>"


def _deal(rows: DataFrame, near: int, most_parts: int, part_rows: int) -> DataFrame:
    """Rows (key, part, own, ...) sorted by part and key: a part's own rows are a range of keys, and the `near` rows before and after it are there too.

    Cuts come from a sample of keys.  Rows at them are found on a table of keys alone, so html is shuffled once.
    """
    spark, keys = rows.sparkSession, checkpoint(rows.select("key"))
    n = keys.count()
    parts = max(1, min(most_parts, n // part_rows))
    sample = keys.where(F.pmod(F.xxhash64("key"), F.lit(max(1, n // (64 * parts)))) == 0).distinct()
    order = lambda k: (k["host"].encode(), k["path"].encode(), k["named"], k["page_id"])
    got = sorted({order(r["key"]): r["key"].asDict() for r in sample.collect()}.items()) if parts > 1 else []  # about 64 keys a part
    cuts = [got[k * len(got) // parts][1] for k in range(1, parts)] if len(got) >= parts else []
    ends = F.from_json(F.lit(json.dumps(cuts)), f"array<{_KEY}>")
    numbered = keys.withColumn("part", F.size(F.filter(ends, lambda c: c <= F.col("key"))))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A part's first and last `near` rows, in order."""
        first: dict[int, list] = {}
        last: dict[int, deque] = {}
        for batch in batches:
            for part, key in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                if len(first.setdefault(part, [])) < near:
                    first[part].append(key)
                last.setdefault(part, deque(maxlen=near)).append(key)
        out = [{"part": p, "first": json.dumps(first[p]), "last": json.dumps(list(last[p]))} for p in first]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string())]))

    ranges = [{"part": 0, "low": None, "start": None, "stop": None, "high": None}]
    if cuts:
        at = numbered.repartition("part").sortWithinPartitions("part", "key").mapInArrow(tidied(edges), "part int, first string, last string").collect()
        first, last = ({r["part"]: json.loads(r[c]) for r in at} for c in ("first", "last"))
        ranges = []
        for p in range(len(cuts) + 1):
            before = after = None
            have = 0
            for q in range(p - 1, -1, -1):
                for key in reversed(last.get(q, [])):
                    if have < near:
                        before, have = key, have + 1
                if have == near:
                    break
            have = 0
            for q in range(p + 1, len(cuts) + 1):
                for key in first.get(q, []):
                    if have < near:
                        after, have = key, have + 1
                if have == near:
                    break
            start, stop = cuts[p - 1] if p else None, cuts[p] if p < len(cuts) else None
            ranges.append({"part": p, "low": before or start, "start": start, "stop": stop, "high": after})
    sent = F.from_json(F.lit(json.dumps(ranges)), f"array<struct<part int, low {_KEY}, start {_KEY}, stop {_KEY}, high {_KEY}>>")
    key = F.col("key")
    own = lambda r: (r["start"].isNull() | (key >= r["start"])) & (r["stop"].isNull() | (key < r["stop"]))
    # a border row of another host is no neighbour
    near_by = lambda r: (r["low"].isNull() | (key >= r["low"])) & (r["high"].isNull() & r["stop"].isNull() | (key < r["stop"]) | (key <= r["high"]))
    to = F.transform(F.filter(sent, lambda r: own(r) | near_by(r)), lambda r: F.struct(r["part"].alias("part"), own(r).alias("own")))
    dealt = rows.withColumn("to", F.explode(to)).select("key", "to.part", "to.own", "url", "html", "page_id")
    return dealt.repartition("part").sortWithinPartitions("part", "key")


def extract(pages: DataFrame, near: int = 4, most_parts: int = 512, part_rows: int = 256) -> DataFrame:
    """(page_id, url, text, n_chars) of each row.

    A page's neighbours are the `near` ones before and after it on its host by path (then page_id), the one that
    shares the longest beginning of the path first, then the closest, the one before if equal: the
    first of them is the nearest of the whole host.  Pages are dealt out by ranges of host and path, with the pages
    at each range's borders, so a host of any size is split, and a task holds 2 * near + 1 pages at a
    time.  A page alone on its host is judged by its structure alone, lines inside a marked article by it and all those neighbours.  Null or empty html has no text; null urls
    share an empty host and path.  Repeated rows and copies of a page keep their text: see `main_lines`.
    """
    rows = columns(pages, "page_id", "url", "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    key = F.struct(host.alias("host"), url_path(F.col("url")).alias("path"), F.col("page_id").isNotNull().alias("named"), F.coalesce("page_id", F.lit(0)).cast("long").alias("page_id"))
    rows = _deal(rows.select(key.alias("key"), "url", "html", "page_id"), near, most_parts, part_rows)
    rows = rows.select("part", "own", "key.host", "key.path", "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        done: list[tuple] = []
        before: deque[tuple] = deque(maxlen=near)
        ahead: deque[tuple] = deque()  # the page whose turn it is, and up to `near` after it

        def finish() -> None:
            here = ahead.popleft()
            if here[1]:
                close = [(-_alike(x[3], here[3]), d, x[6]) for side in (reversed(before), ahead) for d, x in enumerate(side) if x[0] == here[0] and x[2] == here[2] and x[6].lines]
                text = "\n\n".join(main_lines(here[6], [x[2] for x in sorted(close, key=lambda x: x[:2])]))
                done.append((here[4], here[5], text, len(text)))
            before.append(here)

        for batch in batches:
            for *place, source in zip(*(c.to_pylist() for c in batch.columns)):
                ahead.append((*place, parse(source or "")))
                if len(ahead) > near:
                    finish()
                if len(done) >= 512:
                    yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x)) for x in done], schema=kind)
                    done = []
        while ahead:
            finish()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x)) for x in done], schema=kind)

    return rows.mapInArrow(tidied(run), "page_id long, url string, text string, n_chars long")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
