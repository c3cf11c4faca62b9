"""Rule statistics of whole texts, for the quality rules and the quality classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, blocks, columns, mix, span_hashes, tidied, utf8, windows

_U = np.uint64
#: Fixed: the symbols that the rules count.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_LETTER = np.array([chr(b).isalpha() if b < 128 else b >= 0xC2 for b in range(256)])

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "bangs", "upper", "adjacent", "distinct", "stops", "digits", "short", "long", "line_words")


def _distinct(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> np.ndarray:
    """Distinct hashes of each text."""
    key = mix(hashes + mix(doc.astype(np.uint64) + _U(1)))
    _, at = np.unique(key, return_index=True)
    return np.bincount(doc[at], minlength=n_docs)


def _repeated(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash stands twice or more in its text."""
    key = mix(hashes + mix(doc.astype(np.uint64) + _U(1)))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each line that has a word."""
    breaks = np.flatnonzero(w.data == 10)
    start = np.unique(np.concatenate([w.at[:-1], breaks + 1]))
    start = start[start < len(w.data)]
    doc = np.searchsorted(w.at, start, "right") - 1
    end = np.append(breaks, len(w.data))[np.searchsorted(breaks, start)]
    end = np.minimum(end, w.at[doc + 1])
    sums = np.concatenate([[0], np.cumsum(w.inside)])
    keep = sums[end] > sums[start]
    return start[keep], end[keep], doc[keep]


def of_block(data: np.ndarray, at: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, BASE) counts and (texts, FEATURES) ratios."""
    w = Words(data, at, i, j, lower=False)
    n, n_docs = w.counts, w.n_docs
    if not len(w.data):
        return np.zeros((n_docs, len(BASE)), np.int64), np.zeros((n_docs, len(FEATURES)))
    h, doc = w.hashes(), w.doc()
    start, end, line_doc = _lines(w)
    n_lines = np.bincount(line_doc, minlength=n_docs)
    dup = n_lines - _distinct(line_doc, span_hashes(w.data, start, end), n_docs)
    got, place = windows(h, w.first, 3)
    place = place[_repeated(doc[place], got)]
    cover = np.zeros(len(h) + 1, np.int64)
    flags = np.zeros(len(h), bool)
    for k in range(3):
        flags[place + k] = True
    np.cumsum(flags, out=cover[1:])
    repeats = cover[w.first[1:]] - cover[w.first[:-1]]
    chars = w.per_doc(w.inside & ((w.data & 0xC0) != 0x80))
    symbols = w.per_doc(_SYMBOL[w.data])
    base = np.stack([n, chars, symbols, dup, repeats], axis=1).astype(np.int64)

    upper = (w.data >= 0x41) & (w.data <= 0x5A)
    upper[:-1] |= (w.data[:-1] == 0xC3) & (w.data[1:] >= 0x80) & (w.data[1:] <= 0x9E)
    size = w.end - w.start
    last = w.data[w.end - 1]
    near = np.zeros(len(h), bool)
    near[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    by_word = lambda x: np.bincount(doc, weights=x, minlength=n_docs)
    m, letters = np.maximum(n, 1), np.maximum(w.per_doc(_LETTER[w.data]), 1)
    features = np.stack([
        np.log1p(n), chars / m, symbols / m, dup / np.maximum(n_lines, 1), repeats / m, w.per_doc(w.data == 0x21) / m, w.per_doc(upper) / letters, by_word(near) / m,
        _distinct(doc, h, n_docs) / m, by_word((last == 0x2E) | (last == 0x2C)) / m, w.per_doc((w.data >= 0x30) & (w.data <= 0x39)) / letters, by_word(size <= 3) / m, by_word(size >= 9) / m, np.log1p(n / np.maximum(n_lines, 1)),
    ], axis=1)
    return base, features


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, BASE..., f) of each row; null, empty and wordless texts have zeros (but for their characters)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in blocks(at, 1 << 19):
                base, features = of_block(data, at, i, j)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *[pa.array(c) for c in base.T], pa.FixedSizeListArray.from_arrays(pa.array(features.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["doc_id", *BASE, "f"])

    return columns(docs, "doc_id", "text").mapInArrow(tidied(run), "doc_id long, " + ", ".join(f"{b} long" for b in BASE) + ", f array<double>")
