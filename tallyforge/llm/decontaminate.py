"""Benchmark decontamination by one Aho-Corasick automaton over the normalised items, texts scanned once."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, columns, documents, filter_rows, held_by_worker, tidied, utf8

#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z: every other byte becomes a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalise(text: bytes) -> bytes:
    """The lower-cased words of a UTF-8 text, a space before and after each."""
    words = text.translate(_NORMAL).split()
    return b" " + b" ".join(words) + b" " if words else b""


def anchor_of(width: int) -> tuple[int, int]:
    """Words of an anchor and of the step between two: each run of `width` words of an item holds a whole one."""
    words = 2 * width // 3 + 1
    return words, width - words + 1


class Matcher:
    """One Aho-Corasick automaton over the normalised items.

    Its patterns are anchors, runs of words at even steps through each item, so the trie has fewer than two nodes for
    each byte of the items, not one for each byte of each window.  Where an anchor occurs, the text and the item are
    compared on both sides of it, word by word; a run of equal words as long as a window is a hit.  An item of fewer
    words than a window is a pattern of its own.
    """

    def __init__(self, items: list[tuple[int, str | None]], width: int):
        import ahocorasick

        self.width = width
        words, step = anchor_of(width)
        self.texts = [(item, normalise((text or "").encode("utf-8", "surrogatepass")).decode("latin-1")) for item, text in items]
        found: dict[str, list[tuple[int, int]]] = {}  # anchor to items and its places there; -1: the item is the pattern
        for k, (_, text) in enumerate(self.texts):
            if not text:
                continue
            spaces = [m.start() for m in re.finditer(" ", text)]
            n = len(spaces) - 1
            if n < width:
                found.setdefault(text, []).append((k, -1))
            else:
                for w in range(0, n - words + 1, step):
                    found.setdefault(text[spaces[w] : spaces[w + words] + 1], []).append((k, spaces[w]))
        self.automaton = None
        if found:
            self.automaton = ahocorasick.Automaton()
            for anchor, where in found.items():
                self.automaton.add_word(anchor, (len(anchor), where))
            self.automaton.make_automaton()

    @staticmethod
    def _alike(x: str, p: int, y: str, q: int) -> int:
        """Characters that are equal from x[p] and y[q] on."""
        n = 0
        while x[p + n : p + n + 64] == y[q + n : q + n + 64] and p + n < len(x) and q + n < len(y):
            n += 64
        n = min(n, len(x) - p, len(y) - q)
        while p + n < len(x) and q + n < len(y) and x[p + n] == y[q + n]:
            n += 1
        return n

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(place of the space before, place of the space behind, item) of each run of words found in a normalised text."""
        if self.automaton is None or not text:
            return
        seen: dict[tuple[int, int], int] = {}  # where the last run of an item at a shift ends
        turned: str | None = None
        for end, (n, where) in self.automaton.iter(text):
            at = end + 1 - n
            for k, place in where:
                item, own = self.texts[k]
                if place < 0:
                    yield at, end, item
                    continue
                if seen.get((k, at - place), -1) > at:
                    continue
                high = end + 1 + self._alike(text, end + 1, own, place + n)
                if turned is None:
                    turned = text[::-1]
                low = at - self._alike(turned, len(text) - at, own[::-1], len(own) - place)
                low, high = text.index(" ", low), text.rindex(" ", 0, high)
                seen[k, at - place] = high
                if text.count(" ", low, high) >= self.width:
                    yield low, high, item


#: What the last pass returns.
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("contaminated", pa.bool_())])


def _found(doc_id: int | None, text: bytes, n_words: int, spans: list[dict]) -> tuple:
    merged = _merge([(s["first"], s["last"]) for s in spans])
    items = sorted({str(s["item"]) for s in spans})
    places = [m.span() for m in _WORD.finditer(text)] if merged else []
    return doc_id, n_words, sum(b - a for a, b in merged), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), [int(i) for i in items], [{"start": places[a][0], "end": places[b - 1][1]} for a, b in merged], bool(merged)


def _matcher(spark: SparkSession, items: list[tuple[int, str | None]], width: int) -> Callable[[], Matcher]:
    """For executors: one for each worker, built by its first task.  The items are broadcast; `hits` bounds their size."""
    sent, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex
    return lambda: held_by_worker("matcher", name, lambda: Matcher(sent.value, width))


def scan(docs: DataFrame, items: list[tuple[int, str | None]], width: int, last: bool) -> DataFrame:
    """`docs(doc_id, text, spans)` with these items' windows added to spans, as word positions; the last pass closes the books."""
    make = _matcher(docs.sparkSession, items, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = make()
        for batch in batches:
            data, at = utf8(batch.column(1))
            ids, spans, rows = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for d in range(batch.num_rows):
                text = data[at[d] : at[d + 1]].tobytes()
                normal = normalise(text)
                new = list(matcher.find(normal.decode("latin-1")))
                if new:  # word positions are counts of spaces
                    spaces = np.cumsum(np.frombuffer(normal, np.uint8) == 32)
                    spans[d] = spans[d] + [{"item": i, "first": int(spaces[a]) - 1, "last": int(spaces[b]) - 1} for a, b, i in new]
                if last:
                    rows.append(_found(ids[d], text, max(0, normal.count(b" ") - 1), spans[d]))
            if last:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(FOUND), FOUND.types)], schema=FOUND)
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, batch.schema.field(2).type)], schema=batch.schema)

    return docs.mapInArrow(tidied(run), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, items array<long>, spans array<struct<start:long,end:long>>, contaminated boolean" if last else docs.schema)


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_nodes: int = 4 << 20) -> DataFrame:
    """The findings in each document.

    The items go to the executors, so their size is checked: beyond `most_nodes` trie nodes (about 55 bytes each in every
    worker, 2.4 MB of items in all) they are dealt to several automata, and the documents pass through one after the
    other, written between two so that a worker holds one.
    """
    passes = _passes(benchmark, width, most_nodes)
    out = columns(docs, "doc_id", "text").withColumn("spans", F.expr("cast(array() as array<struct<item:bigint,first:bigint,last:bigint>>)"))
    for k in range(passes):
        out = scan(out if k == 0 else checkpoint(out), _part(benchmark, k, passes), width, k == passes - 1)
    return out


def _passes(benchmark: DataFrame, width: int, most_nodes: int) -> int:
    words, step = anchor_of(width)
    total = columns(benchmark, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(total) * max(words, step) // step // most_nodes))


def _part(benchmark: DataFrame, k: int, passes: int) -> list[tuple[int, str | None]]:
    items = columns(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    return sorted(((r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).toLocalIterator()), key=str)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10, most_nodes: int = 4 << 20) -> DataFrame:
    """The rows, with all their columns, in which no window of any item occurs."""
    passes = _passes(benchmark, width, most_nodes)
    for k in range(passes):
        matcher_of = _matcher(docs.sparkSession, _part(benchmark, k, passes), width)

        def make(matcher_of=matcher_of):
            matcher = matcher_of()

            def keep(text: pa.Array) -> np.ndarray:
                data, at = utf8(text)
                texts = (data[a:b].tobytes() for a, b in zip(at[:-1], at[1:]))
                return np.array([next(matcher.find(normalise(x).decode("latin-1")), None) is None for x in texts], bool)

            return keep

        docs = filter_rows(docs if k == 0 else checkpoint(docs), ("text",), make)
    return docs


def original_spans(text: str | None, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges of the whole UTF-8 text for ranges of words, merged."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw)]
    return [(places[a][0], places[b - 1][1]) for a, b in _merge(spans)]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated) of each document.

    A window is `width` words of an item; an item of fewer is one window.  `spans` are the byte ranges
    of the hit words in the whole original text.  Null, empty and wordless texts have no words and are
    clean, as all documents are where the benchmark is empty; items without an id or text are left out.  Rows stand for
    themselves, whether or not another has the same doc_id.  No other columns are read.
    """
    return hits(docs, benchmark, width)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS x
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM words, sizes)),
found AS (SELECT DISTINCT s.doc_id, s.k, s.size, t.item_id FROM starts s JOIN windows t ON s.x = t.x AND s.size = t.size),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
