"""N-gram Jaccard join by signature trees.

Every text becomes the set of its distinct word shingles (64-bit hashes, 128 bits for a whole set).  Rows
with equal sets are one representative from then on, numbered by itself, so that a doc_id in several rows
with different texts is several representatives.

A pair of sets that reaches the threshold shares `ceil(t * n)` shingles of either's n or more, so both have a
common one among their first `n - ceil(t * n) + 1` in any one order of all shingles (prefix filter).  The tree's
first level has a node for each shingle, holding the representatives that have it among these; pairs of nodes
of different shingles need no visit, whatever their members, as every pair that could reach the threshold
meets in one.  No pair is missed.  The order only decides how large the nodes are: shingles in many texts
come last, by their number of texts, the rest by hash.

Within a first-level node, in this order:

1. each member is compared with four of the first members of its nodes, those it shares most nodes with, and the
   links found are merged into components.  This only saves work: pairs of one component need no visit later.
   In nodes of more than `block / 8` members each one is then compared with four of the partners that step 2 leaves
   it, two that look nearest and two by hash, and links are merged again: a group of near copies whose links are
   dense becomes a component before its pairs are listed, and what it lists are pairs that hardly link.
2. Nodes that still hold several components are searched completely: members are dealt to nodes of `block` by
   size (large components to nodes of their own), and below these stands a signature tree.  All nodes hold
   the OR of their members' token bitmaps, their size range and their component if it is one.  A dual
   traversal leaves a pair of nodes out when both lie in one component, when the sizes exclude the
   threshold, or when the greatest possible overlap, seen from the bits that the other lacks, is too small.
   Members of nodes of more than `block / 8` carry the names of their first such nodes, smaller ones first, so that a
   pair which meets in many of them is listed in one, with their number.  As a pair needs a number of common names
   that follows from its sizes (see 3), members don't go to tasks of nodes under which too few of their names are left.
3. A pair found in c first-level nodes shares c shingles among both sides' first ones, and beyond the first ones of
   one side only that side's other shingles can be shared; where these are too few, the pair goes.

Pairs that survive are verified on whole texts, word by word, so links don't rest on hashes.  Nothing is
capped: pairs of the nodes of a large first-level node are separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Tally, Words, blocks, checkpoint, columns, documents, least_count, mix, tidied, utf8, windows
from .graph import components

_U = np.uint64
BITS = 1024
#: Shingles with lower hashes are counted to find those in many texts; few sets' first ones reach beyond.
_COUNTED = _U(3 << 60)
#: High bits of a shingle's hash that name it in counts and in the first level.  Two shingles of one name share a node there, no more.
_COUNT_BITS, _NODE_BITS = 40, 48
#: Names of crowded nodes that a member carries at most; a pair is listed once for these and once for each further one.
LISTED = 96
_UNBOUNDED = 1 << 40
#: In how many of these partners are looked for before pairs are listed.
SAMPLED = 16


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their offsets by text."""
    h = words.hashes()
    got, at = windows(h, words.first, width)
    doc = np.searchsorted(words.first, at, "right") - 1
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(few):  # the whole sequence, with its length, as one shingle
        whole = np.empty(len(few), np.uint64)
        for i, d in enumerate(few):
            run = h[words.first[d] : words.first[d + 1]]
            whole[i] = mix(np.array([len(run)], np.uint64) + np.add.reduce(mix(run + np.arange(1, len(run) + 1, dtype=np.uint64))))[0]
        got, doc = np.concatenate([got, whole]), np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        got, doc = got[order], doc[order]
    cuts = np.searchsorted(doc, np.arange(words.n_docs + 1))
    sets = [np.unique(got[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    offsets = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    return (np.concatenate(sets) if sets else got), offsets


def set_names(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each whole set, as two signed numbers."""
    out = []
    for salt in (0x1F, 0x2F):
        total = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(mix(sets ^ _U(salt << 40)), out=total[1:])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def frequent_shingles(docs: DataFrame, width: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Names, ascending, of counted shingles in `least` rows or more, and their rank by rows; at most `most`, the most frequent ones.

    They are broadcast, 16 bytes each; more would only make first-level nodes smaller.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            data, at = utf8(batch.column(0))
            for i, j in blocks(at):
                sets = shingles(Words(data, at, i, j), width)[0]
                yield from tally.add(sets[sets < _COUNTED] >> _U(64 - _COUNT_BITS))
        yield from tally.rest()

    counts = columns(docs, "text").mapInArrow(tidied(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = checkpoint(counts.where(F.col("n") >= least), narrow=True)
    cut = least_count(counts, most)
    got = counts.where(F.col("n") >= cut if cut is not None else F.lit(False)).toArrow()
    names, n = got.column("key").to_numpy().astype(np.int64).view(np.uint64), got.column("n").to_numpy()
    rank = np.empty(len(names), np.int64)
    rank[np.lexsort((names, n))] = np.arange(1, len(names) + 1)
    order = np.argsort(names)
    return names[order], rank[order]


def prefixes(sets: np.ndarray, offsets: np.ndarray, num: int, den: int, names: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(num / den * n) + 1 shingles of each set of n, frequent ones last, end to end, and their offsets."""
    n = np.diff(offsets)
    keep = np.where(n > 0, n - (num * n + den - 1) // den + 1, 0)
    late = np.zeros(len(sets), np.int64)
    if len(names):
        low = np.flatnonzero(sets < _COUNTED)
        short = sets[low] >> _U(64 - _COUNT_BITS)
        at = np.minimum(np.searchsorted(names, short), len(names) - 1)
        hit = names[at] == short
        late[low[hit]] = rank[at[hit]]
    doc = np.repeat(np.arange(len(n)), n)
    order = np.argsort(doc * (len(names) + 1) + late, kind="stable")  # a set's hashes ascend already
    place = np.arange(len(sets)) - np.repeat(offsets[:-1], n)
    return sets[order[place < np.repeat(keep, n)]], np.concatenate([[0], np.cumsum(keep)])


def signatures(docs: DataFrame, width: int, num: int, den: int, names: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(doc_id, n, hi, lo, first, bits) of each row; `first` are the names of its first shingles."""
    sent = docs.sparkSession.sparkContext.broadcast((names, rank))  # bounded: see frequent_shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in blocks(at):
                sets, offsets = shingles(Words(data, at, i, j), width)
                n = np.diff(offsets)
                hi, lo = set_names(sets, offsets)
                first, cuts = prefixes(sets, offsets, num, den, *sent.value)
                bits = np.zeros((j - i, BITS), bool)
                bits[np.repeat(np.arange(j - i), n), (sets >> _U(64 - BITS.bit_length() + 1)).astype(np.int64)] = True
                words = np.packbits(bits, axis=1).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(hi), pa.array(lo), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array((first >> _U(64 - _NODE_BITS)).astype(np.int64))), pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, BITS // 64), pa.int32()), pa.array(words))],
                    names=["doc_id", "n", "hi", "lo", "first", "bits"],
                )

    return columns(docs, "doc_id", "text").mapInArrow(tidied(run), "doc_id long, n long, hi long, lo long, first array<long>, bits array<long>")


class SignatureTree:
    """A tree over (n, bitmap, component) rows, and its traversal against another or itself."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, bits: np.ndarray, comp: np.ndarray, fan: int = 4, leaf: int = 8):
        order = np.lexsort((ids, comp, n))
        self.ids, self.n, self.bits, self.comp = ids[order], n[order], bits[order], comp[order]
        self.n_bits = np.bitwise_count(self.bits).sum(1).astype(np.int64)
        self.levels: list[dict[str, np.ndarray]] = []
        cuts = np.arange(0, len(ids), leaf)
        self.leaf, self.fan = leaf, fan
        level = {"low": np.minimum.reduceat(self.n, cuts), "high": np.maximum.reduceat(self.n, cuts), "bits": np.bitwise_or.reduceat(self.bits, cuts, axis=0), "least": np.minimum.reduceat(self.n_bits, cuts)}
        first, last = np.minimum.reduceat(self.comp, cuts), np.maximum.reduceat(self.comp, cuts)
        level |= {"c0": first, "c1": last}
        self.levels.append(level)
        while len(self.levels[-1]["low"]) > 1:
            x = self.levels[-1]
            cuts = np.arange(0, len(x["low"]), fan)
            self.levels.append({"low": np.minimum.reduceat(x["low"], cuts), "high": np.maximum.reduceat(x["high"], cuts), "bits": np.bitwise_or.reduceat(x["bits"], cuts, axis=0), "least": np.minimum.reduceat(x["least"], cuts), "c0": np.minimum.reduceat(x["c0"], cuts), "c1": np.maximum.reduceat(x["c1"], cuts)})

    def pairs(self, other: SignatureTree, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate pairs (ids here, ids there): no pair with den * |both| >= num * |either| in two components is missing."""
        same = self is other
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        depth = max(len(self.levels), len(other.levels)) - 1
        for d in range(depth, -1, -1):
            x, y = self.levels[min(d, len(self.levels) - 1)], other.levels[min(d, len(other.levels) - 1)]
            keep = self._may(x, y, a, b, num, den)
            a, b = a[keep], b[keep]
            if d:
                a, b = self._down(a, b, d, other, same)
        for k in range(0, len(a), 4096):
            i = (a[k : k + 4096, None] * self.leaf + np.arange(self.leaf))[:, :, None]
            j = (b[k : k + 4096, None] * other.leaf + np.arange(other.leaf))[:, None, :]
            i, j = (z.ravel() for z in np.broadcast_arrays(i, j))
            keep = (i < len(self.ids)) & (j < len(other.ids))
            if same:
                keep &= i < j
            i, j = i[keep], j[keep]
            keep = self.comp[i] != other.comp[j]
            i, j = i[keep], j[keep]
            ni, nj = self.n[i], other.n[j]
            keep = den * np.minimum(ni, nj) >= num * np.maximum(ni, nj)
            i, j, ni, nj = i[keep], j[keep], ni[keep], nj[keep]
            shared = np.bitwise_count(self.bits[i] & other.bits[j]).sum(1).astype(np.int64)
            # tokens in bits that the other lacks are not shared
            most = np.minimum(ni - (self.n_bits[i] - shared), nj - (other.n_bits[j] - shared))
            keep = (den + num) * most >= num * (ni + nj)
            yield self.ids[i[keep]], other.ids[j[keep]]

    @staticmethod
    def _may(x: dict, y: dict, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
        one = (x["c0"][a] == x["c1"][a]) & (y["c0"][b] == y["c1"][b]) & (x["c0"][a] == y["c0"][b])
        fits = (den * x["high"][a] >= num * y["low"][b]) & (den * y["high"][b] >= num * x["low"][a])
        shared = np.zeros(len(a), np.int64)
        for k in range(0, len(a), 65536):
            shared[k : k + 65536] = np.bitwise_count(x["bits"][a[k : k + 65536]] & y["bits"][b[k : k + 65536]]).sum(1)
        # no member shares more tokens than its size less the bits that the other node lacks
        most = np.minimum(x["high"][a] - np.maximum(0, x["least"][a] - shared), y["high"][b] - np.maximum(0, y["least"][b] - shared))
        return ~one & fits & ((den + num) * most >= num * (x["low"][a] + y["low"][b]))

    def _down(self, a: np.ndarray, b: np.ndarray, d: int, other: SignatureTree, same: bool) -> tuple[np.ndarray, np.ndarray]:
        def under(k: np.ndarray, tree: SignatureTree) -> np.ndarray:
            if d >= len(tree.levels):  # this tree is lower: its root stays
                return k[:, None]
            return k[:, None] * tree.fan + np.arange(tree.fan)

        i, j = under(a, self), under(b, other)
        i, j = (z.ravel() for z in np.broadcast_arrays(i[:, :, None], j[:, None, :]))
        size = lambda tree: len(tree.levels[min(d - 1, len(tree.levels) - 1)]["low"])
        keep = (i < size(self)) & (j < size(other))
        if same:
            keep &= i <= j
        return i[keep], j[keep]


def marks(ids: DataFrame, n: int, least: int = 1 << 20, most: int = 1 << 28) -> tuple[np.ndarray, int]:
    """A bitmap of at most n doc_ids, by hash, and the bits of its numbers.  It has 16 bits for each and is broadcast: 32 MB at most, beyond which it lets more pass."""
    wide = min(most, max(least, 16 * n)).bit_length() - 1
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - wide)
    pieces = ids.groupBy(F.shiftright(place, 15).alias("piece")).agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits"))  # 4 KB each
    out = np.zeros((1 << wide) >> 3, np.uint8)
    for piece, bits in pieces.collect():
        out[piece << 12 : (piece + 1) << 12] = np.frombuffer(bits, np.uint8)
    return out, wide


def named(docs: DataFrame, ids: DataFrame, n: int, width: int) -> DataFrame:
    """(doc_id, hi, lo, text) of the rows whose doc_id is one of ids(doc_id), at most n, and of few others: only these are hashed and shuffled."""
    bitmap, wide = marks(ids, n)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column(2))
            batch = batch.filter(pa.array((sent.value[place >> 3] >> (place & 7)) & 1 == 1))
            data, at = utf8(batch.column(1))
            for i, j in blocks(at):
                hi, lo = set_names(*shingles(Words(data, at, i, j), width))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(hi), pa.array(lo), batch.column(1).slice(i, j - i)], names=["doc_id", "hi", "lo", "text"])

    rows = columns(docs, "doc_id", "text").where("doc_id is not null").select("doc_id", "text", F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 64 - wide).alias("place"))
    return rows.mapInArrow(tidied(run), "doc_id long, hi long, lo long, text string")


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, hi, lo) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in blocks(at):
                sets, offsets = shingles(Words(data, at, i, j), width)
                hi, lo = set_names(sets, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(offsets), pa.int64()), pa.array(hi), pa.array(lo)], names=["doc_id", "n", "hi", "lo"])

    return columns(docs, "doc_id", "text").mapInArrow(tidied(run), "doc_id long, n long, hi long, lo long")


def exact_shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of each distinct shingle of `width` words, ascending; numbers are equal only where all words' bytes are."""
    if len(w.start) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(np.append(0, w.end - w.start)).astype(np.int64)
    word = pa.Array.from_buffers(pa.large_binary(), len(w.start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(w.data[w.inside]))])
    word = word.dictionary_encode().indices.to_numpy().astype(np.int64)
    doc, n_words = w.doc(), int(word.max()) + 1
    at = np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, most = word[at], n_words
    for k in range(1, width):
        if most * n_words > 1 << 62:
            names, code = np.unique(code, return_inverse=True)
            most = len(names)
        code, most = code * n_words + word[at + k], most * n_words
    names, code = np.unique(code, return_inverse=True)
    key = np.unique(doc[at] * len(names) + code)
    return key // len(names), key % len(names)


def linked(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int, together: int = 256) -> DataFrame:
    """The pairs (a, b) of representatives, of pairs(a, b, text_a, text_b) with struct(doc_id, hi, lo) for each text, whose texts meet the threshold, those that pass compared word by word.

    A pair's second text travels to its first one, which has a copy for every `together` partners, so a hot one's are
    many tasks.  Texts of fewer words than `width` differ from every other representative's.
    """

    def alike(data: np.ndarray, at: np.ndarray, who: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Whether each text of `who` and its head meet the threshold: by hashes first, and those that do word by word."""
        sets, offsets = shingles(Words(data, at, 0, len(at) - 1), width)
        likely = []
        for k in who:
            p, q = (sets[offsets[x] : offsets[x + 1]] for x in (head[k], k))
            place = np.minimum(np.searchsorted(p, q), max(len(p) - 1, 0))
            both = int((p[place] == q).sum()) if len(p) else 0
            likely.append(both > 0 and den * both >= num * (len(p) + len(q) - both))
        ok = np.array(likely, bool)
        who = who[ok]
        if len(who):
            texts, place = np.unique(np.concatenate([head[who], who]), return_inverse=True)
            parts = [data[at[x] : at[x + 1]] for x in texts]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            doc, code = exact_shingles(Words(np.concatenate(parts), cuts, 0, len(parts)), width)
            wide = int(code.max(initial=0)) + 1
            key = doc * wide + code
            first = np.searchsorted(doc, np.arange(len(parts) + 1))
            for i, (x, y) in enumerate(zip(place[: len(who)], place[len(who) :])):
                p, q = (code[first[z] : first[z + 1]] for z in (x, y))
                both = int(np.isin(key[first[y] : first[y + 1]] + (x - y) * wide, key[first[x] : first[x + 1]], assume_unique=True).sum())
                likely_at = np.flatnonzero(ok)[i]
                likely[likely_at] = both > 0 and den * both >= num * (len(p) + len(q) - both)
        return np.array(likely, bool)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (a, salt, kind, b, text) in order: a first text, of kind 0, and its partners."""
        held: tuple[int, np.ndarray] | None = None  # the last first text
        for batch in batches:
            a, kind, b = (np.asarray(batch.column(k)) for k in (0, 2, 3))
            data, at = utf8(batch.column(4))
            for i, j in blocks(at):
                own, cuts = data[at[i] : at[j]], at[i : j + 1] - at[i]
                block_a, block_kind, block_b = a[i:j], kind[i:j], b[i:j]
                if held is not None:
                    own, cuts = np.concatenate([held[1], own]), np.concatenate([[0], cuts + len(held[1])])
                    block_a, block_kind, block_b = np.append(held[0], block_a), np.append(0, block_kind), np.append(held[0], block_b)
                head = np.maximum.accumulate(np.where(block_kind == 0, np.arange(len(block_a)), 0))
                who = np.flatnonzero((block_kind == 1) & (block_a == block_a[head]))
                who = who[alike(own, cuts, who, head)] if len(who) else who
                yield pa.RecordBatch.from_arrays([pa.array(block_a[who]), pa.array(block_b[who])], names=["a", "b"])
                k = int(head[-1])
                held = int(block_a[k]), own[cuts[k] : cuts[k + 1]].copy()

    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / together).cast("int").alias("salts"), F.any_value("text_a").alias("text"))
    members = pairs.join(load.drop("text"), "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "b", "text_b.*")
    heads = load.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("b"), "text.*")
    ids = pairs.select(F.explode(F.array("text_a.doc_id", "text_b.doc_id")).alias("doc_id"))
    rows = named(docs, ids, 2 * pairs.count(), width).join(members.unionAll(heads), ["doc_id", "hi", "lo"]).select("a", "salt", "kind", "b", "text")
    order = ("a", "salt")
    return rows.repartition(*order).sortWithinPartitions(*order, "kind").mapInArrow(tidied(compare), "a long, b long").distinct()


def _bits(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).view(np.uint64).reshape(n, BITS // 64)


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """members(key, id, n, lost, bits, label, keys) with `node`: a range of sizes of about `block` members; a component larger than that has ranges of its own."""
    of_large = members.groupBy("key", "label", "n").agg(F.count("*").alias("m"))
    of_large = checkpoint(of_large, narrow=True)
    own = of_large.groupBy("key", "label").agg(F.sum("m").alias("all")).where(F.col("all") > block).select("key", "label", F.col("label").alias("part"))
    sizes = of_large.join(own, ["key", "label"], "left").groupBy("key", "part", "n").agg(F.sum("m").alias("m"))
    before = Window.partitionBy("key", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)  # one row for each size
    spans = sizes.select("key", "part", "n", F.floor(F.coalesce(F.sum("m").over(before), F.lit(0)) / block).alias("span"), F.ceil(F.col("m") / block).alias("split"))
    spans = checkpoint(spans.withColumn("part", F.coalesce("part", F.lit(-1))), narrow=True)
    parts = members.join(own, ["key", "label"], "left").withColumn("part", F.coalesce("part", F.lit(-1)))  # a component's label is 0 or more
    node = F.xxhash64("part", "span", F.pmod(F.xxhash64("id", "key"), F.col("split")))  # members meet others under each key
    return parts.join(spans, ["key", "part", "n"]).select(node.alias("node"), *members.columns)


def node_pairs(dealt: DataFrame, num: int, den: int) -> DataFrame:
    """(key, node, x_node, y_node, low, high, slack): the pairs of nodes of dealt(key, node, n, lost, bits, label, keys) to be visited, a row for each node of a pair with the other one's sizes and greatest `lost`."""
    kind = "key long, node long, low long, high long, c0 long, c1 long, least long, slack long, bits array<long>"
    names = [x.split()[0] for x in kind.split(", ")]

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows to a row for each run of (key, node) in a batch, and the last one's go on in the next."""
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, n, label, slack = (np.asarray(batch.column(k)) for k in range(5))
            bits = _bits(batch.column(5), batch.num_rows)
            ones = np.bitwise_count(bits).sum(1).astype(np.int64)
            rows = [key, node, n, n, label, label, ones, slack, bits]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            cuts = np.concatenate([[0], np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1])
            least, most = np.minimum.reduceat, np.maximum.reduceat
            out = [rows[0][cuts], rows[1][cuts], *(f(x, cuts) for f, x in zip((least, most, least, most, least, most), rows[2:8])), np.bitwise_or.reduceat(rows[8], cuts, axis=0)]
            held = [x[-1:] for x in out]
            yield packed([x[:-1] for x in out])
        if held is not None:
            yield packed(held)

    def packed(rows: list[np.ndarray]) -> pa.RecordBatch:
        words = rows[8].view(np.int64).ravel()
        return pa.RecordBatch.from_arrays([*map(pa.array, rows[:8]), pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, BITS // 64), pa.int32()), pa.array(words))], names=names)

    slack = F.when(F.size("keys") >= LISTED, F.lit(_UNBOUNDED)).otherwise(F.col("lost")).cast("long").alias("slack")
    nodes = dealt.select("key", "node", "n", "label", slack, "bits").repartition("key", "node").sortWithinPartitions("key", "node").mapInArrow(tidied(summary), kind)
    nodes = checkpoint(nodes, narrow=True)
    left, right = (nodes.select("key", *[F.col(c).alias(f"{x}_{c}") for c in nodes.columns if c != "key"]) for x in "xy")
    one = "x_c0 = x_c1 AND y_c0 = y_c1 AND x_c0 = y_c0"
    sizes = (den * F.col("x_high") >= num * F.col("y_low")) & (den * F.col("y_high") >= num * F.col("x_low"))
    sides = [f"{x}_{c}" for x in "xy" for c in ("node", "low", "high", "least", "bits", "slack")]
    tasks = left.join(right, "key").where("x_node <= y_node").where(f"NOT ({one})").where(sizes).select("key", *sides)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose greatest possible overlap, seen from the bits that the other lacks, is enough."""
        for batch in batches:
            key, x, x_low, x_high, x_least, x_slack, y, y_low, y_high, y_least, y_slack = (np.asarray(batch.column(k)) for k in range(13) if k not in (5, 11))
            shared = np.bitwise_count(_bits(batch.column(5), batch.num_rows) & _bits(batch.column(11), batch.num_rows)).sum(1).astype(np.int64)
            most = np.minimum(x_high - np.maximum(0, x_least - shared), y_high - np.maximum(0, y_least - shared))
            ok = (den + num) * most >= num * (x_low + y_low)
            yield pa.RecordBatch.from_arrays([pa.array(c[ok]) for c in (key, x, y, x_low, x_high, x_slack, y_low, y_high, y_slack)], names=out)

    out = ["key", "x_node", "y_node", "x_low", "x_high", "x_slack", "y_low", "y_high", "y_slack"]
    tasks = tasks.mapInArrow(tidied(visited), ", ".join(f"{c} long" for c in out))
    side = lambda x, y: F.struct(F.col(f"{x}_node").alias("node"), *[F.col(f"{y}_{c}").alias(c) for c in ("low", "high", "slack")])
    return tasks.select("key", "x_node", "y_node", F.explode(F.array_distinct(F.array(side("x", "y"), side("y", "x")))).alias("s")).select("key", "x_node", "y_node", "s.*")


def task_rows(dealt: DataFrame, num: int, den: int) -> DataFrame:
    """dealt(key, node, id, n, lost, bits, label, keys, met) in a row for each pair of nodes (x_node, y_node) that a member is to be visited in.

    `met` is in how many first-level nodes with others a member lies.  A pair is listed under the least name that both list, so
    it has no more in common than the names of either side that don't come before: members that have too few of these left
    for any partner of the other node's sizes don't go to its tasks.  Where the other node has a member whose list is cut off, all go.
    """
    met = F.col("met") - F.greatest(F.array_position("keys", F.col("key")) - 1, F.lit(0))
    tasks = node_pairs(dealt, num, den).withColumnRenamed("node", "own").withColumnRenamed("key", "of")
    low, high = F.greatest(F.col("low"), F.ceil(num * F.col("n") / den)), F.least(F.col("high"), F.floor(den * F.col("n") / num))
    # need >= num * (n + m) / (den + num) - num * max(n, m) / den - slack, which is concave in m: its least value is at an end
    have = den * (den + num) * (met + F.greatest("lost", "slack"))
    needs = lambda m: num * den * (F.col("n") + m) - num * (den + num) * F.greatest(F.col("n"), m)
    fits = (low <= high) & ((have >= needs(low)) | (have >= needs(high)))
    return tasks.join(dealt, (F.col("of") == F.col("key")) & (F.col("own") == F.col("node")) & fits).drop("of", "own", "low", "high", "slack")


def _common(key: int, keys: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For how many nodes each pair of rows counts in the node `key`: all names that both list in the least of these, none in the others, and one in a node that they don't both list."""
    names, code = np.unique(keys, return_inverse=True)
    has = np.zeros((len(keys), -(-len(names) // 64) * 64), bool)
    has[np.arange(len(keys))[:, None], code.reshape(keys.shape)] = True
    has[:, : np.searchsorted(names, 0)] = False  # what fills short lists
    at = int(np.searchsorted(names, key))
    if at == len(names) or names[at] != key:
        return np.ones(len(x), np.int64)
    lower = np.zeros(has.shape[1], bool)
    lower[:at] = True
    lower, bits = (np.packbits(z, axis=-1).view(np.uint64) for z in (lower, has))
    out = np.ones(len(x), np.int64)
    for k in range(0, len(x), 8192):
        i, j = x[k : k + 8192], y[k : k + 8192]
        both = bits[i] & bits[j]
        count = np.where((both & lower).any(1), 0, np.bitwise_count(both).sum(1))
        out[k : k + 8192] = np.where(has[i, at] & has[j, at], count, 1)
    return out


def _chosen(ids: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """(a, b, alike, draw): of the pairs of rows (x, y), each a's partner b that looks nearest by the bitmaps, and the one of the least hash."""
    alike = np.zeros(len(x))
    for k in range(0, len(x), 65536):
        p, q = bits[x[k : k + 65536]], bits[y[k : k + 65536]]
        alike[k : k + 65536] = np.bitwise_count(p & q).sum(1) / np.maximum(1, np.bitwise_count(p | q).sum(1))
    low, high = np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])
    draw = (mix(mix(low.astype(np.uint64)) + high.astype(np.uint64)) >> _U(1)).astype(np.int64)
    a, b, alike, draw = np.concatenate([ids[x], ids[y]]), np.concatenate([ids[y], ids[x]]), np.tile(alike, 2), np.tile(draw, 2)
    take = []
    for order in (np.lexsort((draw, -alike, a)), np.lexsort((draw, a))):
        take.append(order[np.flatnonzero(np.diff(a[order], prepend=-1))])
    take = np.unique(np.concatenate(take))
    return pa.RecordBatch.from_arrays([pa.array(z[take]) for z in (a, b, alike, draw)], names=["a", "b", "alike", "draw"])


def cross_pairs(members: DataFrame, large: DataFrame, met: DataFrame, block: int, num: int, den: int, some: bool = False) -> DataFrame:
    """(a, b, need, c) of pairs of different components under a key that may reach the threshold, from members(key, id, n, lost, bits, label, keys).

    large(key) are the keys with more than `block` members, met(id, met) in how many keys a member is; `keys` are ascending names of crowded keys, or none.  `c`
    is for how many keys a row counts, `need` in how many a pair must be found; see `likely`.  With `some`,
    (a, b, alike, draw): two of each member's partners in each batch at most, see `_chosen`.
    """
    own = F.lit(0).cast("long")
    rows = members.select("key", own.alias("x_node"), own.alias("y_node"), own.alias("node"), "id", "n", "lost", "label", "bits", "keys")
    if not large.isEmpty():
        large = checkpoint(large, narrow=True)
        of_large = members.join(large, "key")
        dealt = checkpoint(_dealt(checkpoint(of_large if some else of_large.join(met, "id")), block))
        if some:  # nodes by themselves, so that a member is in one task for each key
            in_tasks = dealt.withColumns({"x_node": F.col("node"), "y_node": F.col("node")})
        else:
            in_tasks = task_rows(dealt, num, den)
        rows = rows.join(large, "key", "left_anti").select(rows.columns).unionAll(in_tasks.select(rows.columns))

    def listed(column: pa.Array) -> np.ndarray:
        """Lists of names, filled up with -1."""
        ends = np.asarray(column.offsets)
        size = np.diff(ends)
        out = np.full((len(size), int(size.max(initial=0))), -1, np.int64)
        out[np.repeat(np.arange(len(size)), size), np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], size)] = np.asarray(column.flatten())
        return out

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of many tasks; a task's rows lie together, and only the last one's wait for the next batch."""
        held: list[np.ndarray] | None = None

        def pairs(part: list[np.ndarray]) -> pa.RecordBatch:
            task, node, ids, n, lost, label, bits, keys = part
            cuts = np.concatenate([[0], np.flatnonzero((task[1:] != task[:-1]).any(1)) + 1, [len(task)]])
            places = np.arange(len(ids))
            none = np.zeros(0, np.int64)
            found, counts = [(none, none)], [none]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if j - i < 2:
                    continue
                parts = [node[i:j] == x for x in dict.fromkeys(task[i, 1:])]
                if not all(m.any() for m in parts):  # none of a node's members can have a partner in the other
                    continue
                trees = [SignatureTree(places[i:j][m], n[i:j][m], bits[i:j][m], label[i:j][m]) for m in parts]
                crowded = keys.shape[1] > 0 and not some and bool((keys[i:j] >= 0).any())
                for x, y in trees[0].pairs(trees[-1], num, den):
                    c = _common(int(task[i, 0]), keys[i:j], x - i, y - i) if crowded else np.ones(len(x), np.int64)
                    found.append((x[c > 0], y[c > 0]))
                    counts.append(c[c > 0])
            x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            if some:
                return _chosen(ids, bits, x, y)
            rest = -(-num * n // den) - 1
            need = np.maximum(1, -(-num * (n[x] + n[y]) // (den + num)) - np.maximum(rest[x], rest[y]) - np.maximum(lost[x], lost[y]))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[x], ids[y])), pa.array(np.maximum(ids[x], ids[y])), pa.array(need.astype(np.int32)), pa.array(np.concatenate(counts))], names=["a", "b", "need", "c"])

        for batch in batches:
            numbers = [np.asarray(batch.column(k)).astype(np.int64) for k in range(8)]
            part = [np.stack(numbers[:3], axis=1), *numbers[3:], _bits(batch.column(8), batch.num_rows), listed(batch.column(9))]
            if held is not None:
                wide = max(held[-1].shape[1], part[-1].shape[1])
                held[-1], part[-1] = (np.pad(z, ((0, 0), (0, wide - z.shape[1])), constant_values=-1) for z in (held[-1], part[-1]))
                part = [np.concatenate(x) for x in zip(held, part)]
            last = int(np.flatnonzero((part[0] != part[0][-1]).any(1)).max(initial=-1)) + 1 if len(part[0]) else 0
            if last:
                yield pairs([x[:last] for x in part])
            held = [x[last:] for x in part]
        if held is not None and len(held[0]):
            yield pairs(held)

    order = ("key", "x_node", "y_node")
    kind = "a long, b long, alike double, draw long" if some else "a long, b long, need int, c long"
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(tidied(traverse), kind)


def classes(docs: DataFrame, width: int, num: int, den: int, block: int, least: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, hi, lo), one for each of docs, and sets (hi, lo, label, component_id)."""
    sigs = signatures(docs, width, num, den, *frequent_shingles(docs, width, least, most))
    # equal sets have equal other columns, so any of them will do
    groups = sigs.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("first").alias("first"), F.any_value("bits").alias("bits"))
    groups = groups.select(F.monotonically_increasing_id().alias("id"), "hi", "lo", "doc_id", "n", F.array_distinct("first").alias("first"), (F.size("first") - F.size(F.array_distinct("first"))).alias("lost"), "bits")
    groups = checkpoint(groups)
    entries = groups.where("doc_id is not null").select(F.explode("first").alias("key"), "id")
    nodes = entries.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("head")).where("m > 1")
    # keys are renamed so that smaller nodes come first in lists
    entries = checkpoint(entries.join(nodes, "key").withColumn("key", F.shiftleft(F.floor(500 * F.log2("m")), _NODE_BITS) + F.col("key")))
    met = entries.groupBy("id").agg(F.count("*").alias("met"))
    firsts = entries.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"), "m")

    def enough(counted: DataFrame) -> DataFrame:
        """(a, b, text_a, text_b) of the pairs (a, b, c), found in c nodes, that may reach the threshold."""
        side = lambda x: groups.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("lost").alias(f"lost_{x}"), F.struct("doc_id", "hi", "lo").alias(f"text_{x}"))
        both = counted.join(side("a"), "a").join(side("b"), "b")
        n = F.col("n_a") + F.col("n_b")
        rest = lambda x: F.ceil(num * F.col(x) / den) - 1  # noqa: E731  shingles that are not among the first ones
        need = F.ceil(num * n / (den + num)) - F.greatest(rest("n_a"), rest("n_b")) - F.greatest("lost_a", "lost_b")
        fits = den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")
        return both.where(fits & (F.col("c") >= need)).select("a", "b", "text_a", "text_b")

    def likely(found: DataFrame) -> DataFrame:
        """The same of the pairs (a, b, need, c), in rows for the nodes that hold both.  Pairs whose need is known are counted and left out before anything is joined to them."""
        return enough(found.groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("need").alias("need")).where("need IS NULL OR c >= need").drop("need"))

    def label(x: str) -> DataFrame:
        return labels.select(F.col("v").alias(x), F.col("label").alias(f"label_{x}"))

    def merged(pairs: DataFrame) -> DataFrame:
        """The labels after the links among pairs(a, b, text_a, text_b); what is new are links of whole components."""
        more = checkpoint(linked(pairs, docs, width, num, den), narrow=True)
        between = more.join(label("a"), "a").join(label("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        to = components(labels.select(F.col("label").alias("v")).distinct(), between).select(F.col("v").alias("label"), F.col("label").alias("to"))
        return checkpoint(labels.join(to, "label").select("v", F.col("to").alias("label")), narrow=True)

    def members(of: DataFrame) -> DataFrame:
        """(key, id, n, lost, bits, label, keys) of the entries of(key, id, m) under keys with several components."""
        first = checkpoint(of.join(labels.withColumnRenamed("v", "id"), "id"), narrow=True)
        open_keys = first.groupBy("key").agg(F.min("label").alias("c0"), F.max("label").alias("c1")).where("c0 <> c1").select("key")
        first = checkpoint(first.join(open_keys, "key"), narrow=True)
        lists = first.where(crowded).groupBy("id").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LISTED).alias("keys"))  # no more than its first shingles
        keys = F.when(crowded, F.col("keys")).otherwise(F.array().cast("array<long>"))
        return first.join(groups.select("id", "n", "lost", "bits"), "id").join(lists, "id", "left").select("key", "id", "n", "lost", "bits", "label", keys.alias("keys"))

    unknown, crowded = F.lit(None).cast("int").alias("need"), F.col("m") > max(2, block // 8)
    # each member with the four of the first members it meets that it shares most nodes with; it has as many as first shingles at most
    heads = firsts.where("m > 2").groupBy("a", "b").agg(F.count("*").alias("c"))
    heads = heads.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", (-F.col("a")).alias("a"))), asc=False), 1, 4).alias("h"))
    heads = heads.select("b", F.explode("h").alias("h")).select((-F.col("h.a")).alias("a"), "b", "h.c")
    seeds = checkpoint(enough(heads), narrow=True)
    links = checkpoint(linked(seeds, docs, width, num, den), narrow=True)
    labels = checkpoint(components(groups.select(F.col("id").alias("v")), links), narrow=True)
    seeds = seeds.select("a", "b")
    shared = entries.where("m > 2").select("key", "id", "m")
    large = entries.where(F.col("m") > block).select("key").distinct()
    if not shared.where(crowded).isEmpty():
        some = members(shared.where(crowded)).where(F.array_position("keys", F.col("key")).between(1, SAMPLED))
        some = cross_pairs(some, large, met, block, num, den, some=True)
        two = lambda x: F.slice(F.sort_array(F.collect_set(F.struct(x.alias("x"), "b"))), 1, 2)["b"]
        some = some.groupBy("a").agg(F.array_union(two(-F.col("alike")), two(F.col("draw"))).alias("b"))
        some = some.select("a", F.explode("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        some = some.join(seeds, ["a", "b"], "left_anti")
        side = lambda x: groups.select(F.col("id").alias(x), F.struct("doc_id", "hi", "lo").alias(f"text_{x}"))
        some = checkpoint(some.join(side("a"), "a").join(side("b"), "b"), narrow=True)
        if not some.isEmpty():
            labels, seeds = merged(some), seeds.unionAll(some.select("a", "b"))
    found = cross_pairs(members(shared), large, met, block, num, den).unionAll(firsts.where("m = 2").select("a", "b", unknown, F.lit(1).cast("long").alias("c")))
    pairs = likely(found).join(seeds, ["a", "b"], "left_anti").join(label("a"), "a").join(label("b"), "b").where("label_a <> label_b")
    pairs = checkpoint(pairs.select("a", "b", "text_a", "text_b"), narrow=True)
    if not pairs.isEmpty():
        labels = merged(pairs)
    sets = groups.select("hi", "lo", "doc_id", F.col("id").alias("v")).join(labels, "v").select("hi", "lo", "doc_id", "label")
    names = sets.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return set_rows(docs, width), sets.join(names, "label").select("hi", "lo", "label", "component_id")


def jaccard_join(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, block: int = 512, least: int = 32, most: int = 1 << 20) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row.

    Two texts link when den * |both| >= num * |either| over their distinct shingles of `width` words;
    a text of fewer words is one shingle.  Null and wordless texts have no shingles and link with
    nothing.  Rows are linked each by its own text: a doc_id in several rows with different texts may be in
    several components, and there is one row for each row given.  A row without a doc_id joins the component of an
    equal set that has one, else its component is null.  An empty table gives an empty result; columns besides
    doc_id and text are not read.
    """
    rows, sets = classes(docs, width, num, den, block, least, most)
    out = rows.join(sets, ["hi", "lo"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, block: int = 512, least: int = 32, most: int = 1 << 20) -> DataFrame:
    """The rows, with all their columns, that their component is named after, one of each.

    Rows with one doc_id and one set are one document, whose least text stays, null first; where a doc_id has
    several sets in a component, one of them.  Rows without a doc_id can't be named and stay.
    """
    rows, sets = classes(docs.where("doc_id is not null"), width, num, den, block, least, most)
    rows = checkpoint(rows.groupBy("doc_id", "hi", "lo").agg(F.min("n").alias("n"), F.count("*").alias("copies")).join(sets, ["hi", "lo"], "left"), narrow=True)
    linked_rows = rows.where("n > 0 AND doc_id = component_id").groupBy("label", "doc_id").agg(F.min(F.struct("hi", "lo")).alias("s")).select("doc_id", "s.hi", "s.lo")
    kept = checkpoint(linked_rows.union(rows.where("n = 0").select("doc_id", "hi", "lo")), narrow=True)
    stay = docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(docs.columns)
    several = checkpoint(rows.groupBy("doc_id").agg(F.sum("copies").alias("copies")).where("copies > 1").select("doc_id"), narrow=True)
    if not several.isEmpty():

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, at = utf8(batch.column(1))
                for i, j in blocks(at):
                    hi, lo = set_names(*shingles(Words(data, at, i, j), width))
                    yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(hi), pa.array(lo)], names=["doc_id", "text", "row", "hi", "lo"])

        row = F.struct("*").alias("row")
        again = columns(docs.select(row, "doc_id", "text"), "doc_id", "text", "row").join(several, "doc_id", "left_semi").select("doc_id", "text", "row")
        kind = again.schema["row"].dataType.simpleString()
        again = again.mapInArrow(tidied(run), f"doc_id long, text string, row {kind}, hi long, lo long").join(kept, ["doc_id", "hi", "lo"], "left_semi")
        least_text = F.struct(F.col("text").isNotNull(), F.coalesce("text", F.lit("")))
        again = again.groupBy("doc_id", "hi", "lo").agg(F.min_by("row", least_text).alias("row")).select("row.*")
        stay = stay.join(several, "doc_id", "left_anti").select(docs.columns).unionAll(again)
    return stay.unionAll(docs.where("doc_id is null"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))
