"""Language identification by prediction by partial matching over bytes, with frozen statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, blocks, checkpoint, columns, crc_mod, documents, tidied, utf8

#: What a byte is to the model: A-Z as a-z, digits as 0, white space as a space.
_FOLD = LOWER.copy()
_FOLD[0x30:0x3A] = 0x30
_FOLD[0x09:0x0E] = 0x20
_PAD = 0x20
ORDER = 3


def _before(x: np.ndarray, at: np.ndarray, k: int, pad: int) -> np.ndarray:
    """The k-th value before each, `pad` where the text begins."""
    out = np.empty_like(x)
    out[:k] = pad
    out[k:] = x[:-k] if k < len(x) else x[:0]
    for j in range(k):
        head = at[:-1] + j
        out[head[head < len(x)]] = pad
    return out


def grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each folded byte with the three before it, as one number."""
    x = _FOLD[data].astype(np.uint32)
    code = x.copy()
    for k in range(1, ORDER + 1):
        code |= _before(x, at, k, _PAD) << np.uint32(8 * k)
    return code


@dataclass
class ContextTree:
    """Code lengths in bits of each byte class after each context held, by language.

    Contexts of three and two byte classes are held where met twice, if a size is given by frequency as far as it allows; all of one are.
    A class is coded in the longest context held that the language has seen; if it never followed there,
    an escape is paid and the next shorter context codes it, down to equal shares of all classes.
    """

    langs: list[str]
    classes: np.ndarray  # (256,) byte to class
    two: np.ndarray  # (k * k) to a row of `bits`; falls to one-class contexts
    inner: np.ndarray  # (k * k) to 1 + number of a two-class context held, or 0
    three: np.ndarray  # (held + 1, k) to a row of `bits`, or -1
    bits: list[np.ndarray]  # for each language (contexts * k)
    k: int

    @classmethod
    def train(cls, counts: list[tuple[str, int, int]], table_bytes: int | None = None, seen: np.ndarray | None = None) -> ContextTree:
        """From (lang, code, n); `seen` are the bytes of all languages, where these are some of them only."""
        langs = sorted({lang for lang, _, _ in counts})
        which = {lang: i for i, lang in enumerate(langs)}
        lang = np.array([which[x] for x, _, _ in counts])
        code = np.array([x for _, x, _ in counts], np.int64)
        n = np.array([x for _, _, x in counts], float)
        if seen is None:
            seen = np.unique(np.concatenate([(code >> (8 * j)) & 255 for j in range(ORDER + 1)]))
        classes = np.zeros(256, np.int64)  # class 0: bytes that the training texts lack
        classes[seen] = np.arange(1, len(seen) + 1)
        k, m = len(seen) + 1, len(langs)
        s = [classes[(code >> (8 * j)) & 255] for j in range(ORDER + 1)]  # s[0] the byte, s[j] the j-th before

        room = len(code) * 3 if table_bytes is None else max(64, table_bytes // (4 * k * m))
        held: list[np.ndarray] = []
        for order, share in ((2, room // 3), (3, room)):
            key = sum(s[j] * k ** (j - 1) for j in range(1, order + 1))
            names, inverse = np.unique(key, return_inverse=True)
            weight = np.bincount(inverse, weights=n)
            if order == 3:  # only below a two-class context that is held
                weight = np.where(np.isin(names // k, held[0]), weight, 0)
            best = np.argsort(-weight, kind="stable")[:share]
            held.append(np.sort(names[best[weight[best] >= 2]]))

        def tally(order: int, names: np.ndarray) -> np.ndarray:
            out = np.zeros((m, len(names), k))
            key = sum((s[j] * k ** (j - 1) for j in range(1, order + 1)), np.zeros(len(code), np.int64))
            at = np.minimum(np.searchsorted(names, key), len(names) - 1) if len(names) else key
            ok = names[at] == key if len(names) else np.zeros(len(key), bool)
            np.add.at(out, (lang[ok], at[ok], s[0][ok]), n[ok])
            return out

        def code_lengths(count: np.ndarray, shorter: np.ndarray) -> np.ndarray:
            total, distinct = count.sum(2, keepdims=True), (count > 0).sum(2, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                direct = np.log2(total + distinct) - np.log2(count)
                escape = np.log2(total + distinct) - np.log2(np.maximum(distinct, 1))
            return np.where(count > 0, direct, np.where(total > 0, escape, 0) + shorter)

        none = code_lengths(tally(0, np.zeros(1, np.int64)), np.full((m, 1, k), np.log2(k)))
        one = code_lengths(tally(1, np.arange(k)), none)
        two = code_lengths(tally(2, held[0]), one[:, held[0] % k])
        tail = held[1] % (k * k)
        spot = np.minimum(np.searchsorted(held[0], tail), max(len(held[0]) - 1, 0))
        under = two[:, spot] if len(held[0]) else np.zeros((m, 0, k))
        lacks = held[0][spot] != tail if len(held[0]) else np.zeros(0, bool)
        under[:, lacks] = one[:, tail[lacks] % k]
        three = code_lengths(tally(3, held[1]), under)

        rows2 = np.tile(np.arange(k), k)  # key = before1 + k * before2
        rows2[held[0]] = k + np.arange(len(held[0]))
        inner = np.zeros(k * k, np.int64)
        inner[held[0]] = 1 + np.arange(len(held[0]))
        rows3 = np.full((len(held[0]) + 1, k), -1)
        rows3[inner[held[1] // k], held[1] % k] = k + len(held[0]) + np.arange(len(held[1]))
        bits = np.concatenate([one, two, three], axis=1).astype(np.float32).reshape(m, -1)
        return cls(langs, classes.astype(np.int32), rows2.astype(np.int32), inner.astype(np.int32), rows3.astype(np.int32), list(bits), k)

    def lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(texts, languages) exact code lengths in bits; texts must not be empty."""
        k = self.k
        s = self.classes[_FOLD[data]]
        b1, b2, b3 = (_before(s, at, j, int(self.classes[_PAD])) for j in (1, 2, 3))
        row = self.three[self.inner[b2 + k * b3], b1]
        row = np.where(row >= 0, row, self.two[b1 + k * b2]) * k + s
        return np.stack([np.add.reduceat(bits[row], at[:-1], dtype=np.float64) for bits in self.bits], axis=1)


def train(docs: DataFrame, per_language: int = 2000, block_bytes: int = 64 << 20) -> Iterator[ContextTree]:
    """From (doc_id, text, lang): of each language at most about `per_language` labelled texts, whole, those with the lowest hashes.

    Trees of some languages each, as many as `block_bytes` hold with all their contexts, one at least.  All have the same
    byte classes, so their code lengths can be compared.
    """
    rows = docs.where("lang is not null and text is not null")
    known = rows.groupBy("lang").count()
    share = known.select("lang", (F.lit(float(per_language)) / F.col("count")).alias("share"))  # one row for each language
    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(17)), 11)).cast("double") / F.lit(float(1 << 53))
    sample = rows.join(F.broadcast(share), "lang").where(unit < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, at = utf8(batch.column(1))
            for i, j in blocks(at):
                code = grams(data[at[i] : at[j]], at[i : j + 1] - at[i])
                owner = np.repeat(langs[i:j], np.diff(at[i : j + 1]))
                for lang in dict.fromkeys(langs[i:j]):
                    got, n = np.unique(code[owner == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(got), pa.string()), pa.array(got.astype(np.int64)), pa.array(n)], names=["lang", "code", "n"])

    counts = checkpoint(sample.mapInArrow(tidied(run), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")))
    octets = [F.shiftright("code", 8 * k).bitwiseAND(255) for k in range(ORDER + 1)]
    seen = np.array(sorted(r[0] for r in counts.select(F.explode(F.array_distinct(F.array(*octets)))).distinct().collect()), np.int64)  # 256 at most
    before = F.shiftright("code", 8)
    sizes = counts.groupBy("lang").agg((F.countDistinct(before) + F.countDistinct(before.bitwiseAND(0xFFFF)) + F.lit(len(seen) + 1)).alias("n"))
    block: list[str] = []
    total = 0

    def tree() -> ContextTree:
        got = [(r[0], r[1], r[2]) for r in counts.where(F.col("lang").isin(block)).collect()]  # bounded by the sample of these languages
        return ContextTree.train(got, seen=seen)

    for lang, n in sizes.orderBy("lang").toLocalIterator():
        if block and 4 * (total + n) * (len(seen) + 1) * (len(block) + 1) > block_bytes:
            yield tree()
            block, total = [], 0
        block, total = [*block, lang], total + n
    if block:
        yield tree()


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def language_id(docs: DataFrame, block_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row.

    Learns from a bounded sample of the rows whose crc32(doc_id) mod 5 is not 0 and whose lang is not
    null.  `score` is the share of the predicted language in the sum of 2 ** -length; equal lengths go to
    the first language by name.  A text that is null, empty or without a letter is `und` with score 0, as
    every text is where nothing is labelled.  Rows are judged each by its text; an empty table gives none.
    There may be any number of languages: beyond what one tree holds, texts are read once for each tree.
    """
    docs = columns(docs, "doc_id", "text", "lang")
    held = crc_mod("doc_id", 5) == 0
    context = docs.sparkSession.sparkContext
    trees = [context.broadcast(vars(tree)) for tree in train(docs.where(~held), block_bytes=block_bytes)] or [context.broadcast(None)]
    texts = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    if len(trees) > 1:
        texts = checkpoint(texts.select(F.monotonically_increasing_id().alias("row"), "*"))
    kind = "doc_id long, held_out boolean, lang_pred string, score double, bits double"

    def judge(sent) -> DataFrame:  # noqa: ANN001  a broadcast
        named = ["row"] if len(trees) > 1 else []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = ContextTree(**sent.value) if sent.value else None
            for batch in batches:
                data, at = utf8(batch.column(len(named) + 2))
                n = batch.num_rows
                langs, score, least = np.full(n, "und", object), np.zeros(n), np.zeros(n)
                for i, j in blocks(at, 1 << 18):
                    part, cuts = data[at[i] : at[j]], at[i : j + 1] - at[i]
                    plain = ((part | 0x20) >= 0x61) & ((part | 0x20) <= 0x7A)
                    sums = np.concatenate([[0], np.cumsum(plain)])
                    sure = sums[cuts[1:]] > sums[cuts[:-1]]
                    if tree is None:
                        continue
                    full = np.flatnonzero(np.diff(cuts))
                    if not len(full):
                        continue
                    bits = tree.lengths(part, np.append(cuts[:-1][full], cuts[-1]))
                    best = bits.argmin(1)
                    share = 1 / np.exp2(bits.min(1)[:, None] - bits).sum(1)
                    for d, b, p, low in zip(full, best, share, bits.min(1)):
                        if sure[d] or _has_letter(part[cuts[d] : cuts[d + 1]].tobytes()):
                            langs[i + d], score[i + d], least[i + d] = tree.langs[b], float(p) if named else round(float(p), 9), low
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(named) + 2], pa.array(langs, pa.string()), pa.array(score), pa.array(least)], names=[*named, "doc_id", "held_out", "lang_pred", "score", "bits"])

        return texts.mapInArrow(tidied(run), "row long, " * len(named) + kind)

    if len(trees) == 1:
        return judge(trees[0]).drop("bits")
    parts = reduce(DataFrame.unionAll, map(judge, trees))
    # a tree's sum of 2 ** -length is 2 ** -bits / score
    best = F.min(F.struct("bits", "lang_pred"))
    rows = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), best.alias("best"), F.collect_list(F.struct("bits", "score")).alias("all"))
    total = F.aggregate("all", F.lit(0.0), lambda s, x: s + F.when(x["score"] > 0, F.pow(F.lit(2.0), F.col("best.bits") - x["bits"]) / x["score"]).otherwise(0.0))
    return rows.select("doc_id", "held_out", F.col("best.lang_pred").alias("lang_pred"), F.when(F.exists("all", lambda x: x["score"] == 0), F.lit(0.0)).otherwise(F.round(F.lit(1.0) / total, 9)).alias("score"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))
