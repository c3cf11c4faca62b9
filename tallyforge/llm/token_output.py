"""Token-ID output: shards of raw ids in document order, each with a minimal perfect hash index.

File format (a Parquet table, so that any store Spark writes to will do), one row per shard:
`part`, `seq` order the shards; `before` is the number of ids in the part before the shard; `width`
is 2 or 4, the bytes of an id; `payload` the raw little-endian ids of the shard's records, end ids
included; `offsets` int64, the place of each record in ids, one more at the end; `keys` int64, each
record's document; `seeds`, `prints`, `records` the index.  A key's bucket gives a seed; the seed and the
key give a slot; the slot holds a 32-bit fingerprint and the key's first record.  A lookup reads one
entry of each array, whatever the shard's size.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, columns, documents, eights, ensure_checkpoints, held_by_worker, mix, span_hashes, tidied, utf8

_U = np.uint64
SHARDS = "part int, seq int, before long, n_ids long, width int, payload binary, offsets binary, keys binary, nulls int, seeds binary, prints binary, records binary"

_WHITE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_ALPHA = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_MARK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_SHORT = 16  # bytes of a piece that its first and last eight and its length tell apart from all others


class _Table:
    """Pieces of up to 16 bytes by hash, ascending, with all their bytes, their place among the pooled ids and how often they were met."""

    def __init__(self):
        self.hash, self.form = np.zeros(0, np.uint64), np.zeros((0, 3), np.uint64)  # form: first and last eight bytes, length: the whole piece
        self.off = self.len = self.hits = np.zeros(0, np.int64)
        self._index()

    def _index(self) -> None:
        """Where the hashes with each of the highest bits begin."""
        self.shift = np.uint64(64 - max(8, len(self.hash).bit_length()))
        self.first = np.searchsorted(self.hash, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift).astype(np.int32)

    def place(self, h: np.ndarray, form: np.ndarray) -> np.ndarray:
        n = len(self.hash)
        if not n:
            return np.full(len(h), -1)
        at = self.first[(h >> self.shift).astype(np.int64)].astype(np.int64)
        low = np.flatnonzero((at < n) & (self.hash[np.minimum(at, n - 1)] < h))
        while len(low):
            at[low] += 1
            low = low[at[low] < n]
            low = low[self.hash[at[low]] < h[low]]
        at = np.minimum(at, n - 1)
        return np.where((self.hash[at] == h) & (self.form[at] == form).all(1), at, -1)

    def add(self, *more: np.ndarray) -> None:
        """Merge another ascending run: hash, form, off, len, hits."""
        order = np.argsort(np.concatenate([self.hash, more[0]]), kind="stable")
        self.hash, self.form, self.off, self.len, self.hits = (np.concatenate([x, y])[order] for x, y in zip((self.hash, self.form, self.off, self.len, self.hits), more))
        self._index()

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.hash, self.form, self.off, self.len, self.hits


class Encoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    The library's pre-tokenizer never joins white space and what follows, but for one space before a
    word, nor a letter and a mark after it.  So a text's ids are those of its pieces between such places,
    and each distinct piece is encoded once, many in a call.  Pieces are equal only where all their bytes are:
    those of up to 16 bytes lie in tables by hash, longer ones in a dictionary.  About `most` short and
    `most` / 8 long pieces are held; beyond, the half of the short ones that was met most often stays and the long
    ones are met anew.  Texts with white space beyond ASCII's or with a special token are encoded whole.
    """

    @staticmethod
    def shared(spec: str) -> Encoder:
        """One for each worker process, as workers outlive tasks."""
        return held_by_worker("encoder", spec, lambda: Encoder(spec))

    def __init__(self, spec: str, most: int = 400_000):
        import re

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        names = [self.tok.id_to_token(k) or "" for k in range(size)]
        self.spaced = np.array([x.startswith("Ġ") for x in names])
        self.line = self.tok.token_to_id("Ċ")
        special = [re.escape(t.content.encode()) for t in self.tok.get_added_tokens_decoder().values()]
        # fixed: the bytes of NEL, the no-break space, and the blocks that hold Unicode's other spaces; control characters that some take for spaces
        self.whole = re.compile(b"|".join([b"[\x1c-\x1f]", b"\xc2[\x85\xa0]", b"\xe1\x9a\x80", b"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", b"\xe2\x81\x9f", b"\xe3\x80\x80", *special]))
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.most = most
        self.old, self.new = _Table(), _Table()  # pieces join the small table first, so that a block's few don't move all
        self.pool = np.zeros(0, np.uint32)
        self.far: dict[bytes, np.ndarray] = {}

    def _pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        white = _WHITE[data]
        head = np.zeros(len(data) + 1, bool)
        head[at] = True  # where a text begins, or all end
        begins = head[:-1].copy()
        after = white.copy()
        after[0] = False
        after[1:] = white[:-1] & ~head[1:-1]  # white space of the same text stands before
        begins |= white & ~after
        begins |= ~white & after
        space = np.zeros(len(data), bool)
        space[1:] = (data[:-1] == 0x20) & ~head[1:-1]
        begins &= ~(~white & space) | head[:-1]
        ends_run = white.copy()
        ends_run[:-1] &= ~white[1:] & ~head[1:-1]
        ends_run[-1] = False
        begins |= ends_run
        begins[1:] |= _ALPHA[data[:-1]] & _MARK[data[1:]]
        start = np.flatnonzero(begins)
        return start, np.append(start[1:], len(data))

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray, form: np.ndarray) -> None:
        raw = data.tobytes()
        pieces = [raw[a:b].decode("utf-8") for a, b in zip(start, end)]
        groups: dict[str, list[int]] = {"": [], "\n": [], "other": []}
        for k, x in enumerate(pieces):
            groups["other" if x.isspace() else "" if x[0] == " " else "\n"].append(k)
        where, size = np.zeros((len(pieces), 2), np.int64), len(self.pool)
        pool = [self.pool]
        for lead in ("", "\n"):
            for g in range(0, len(groups[lead]), 2048):
                part = groups[lead][g : g + 2048]
                ids = np.array(self.tok.encode_batch_fast([lead + lead.join(pieces[k] for k in part)], add_special_tokens=False)[0].ids, np.uint32)
                first = np.flatnonzero(self.spaced[ids] if not lead else ids == self.line)
                if len(first) != len(part):
                    groups["other"] += part
                    continue
                where[part] = np.stack([size + first + len(lead), np.diff(np.append(first, len(ids))) - len(lead)], axis=1)
                pool.append(ids)
                size += len(ids)
        for k in groups["other"]:
            ids = np.array(self.tok.encode(pieces[k], add_special_tokens=False).ids, np.uint32)
            where[k] = size, len(ids)
            pool.append(ids)
            size += len(ids)
        self.pool = np.concatenate(pool)
        self.new.add(h, form, where[:, 0], where[:, 1], np.zeros(len(where), np.int64))

    def _settle(self) -> None:
        """Merge the small table into the large one; beyond `most`, the half met most often stays."""
        if len(self.new.hash) > 1 << 16:
            self.old.add(*self.new.parts())
            self.new = _Table()
            if len(self.old.hash) > self.most:
                hash_, form, off, n, hits = self.old.parts()
                keep = np.sort(np.argsort(-hits, kind="stable")[: self.most // 2])
                off, n = off[keep], n[keep]
                ends = np.cumsum(n)
                self.pool = self.pool[np.repeat(off - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
                self.old = _Table()
                self.old.add(hash_[keep], form[keep], ends - n, n, hits[keep] // 2)

    def encode(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of each text data[at[k] : at[k + 1]] of UTF-8 bytes."""
        self._settle()
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * (len(at) - 1)
        raw = data[at[0] : at[-1]].tobytes()
        cuts = at - at[0]
        odd = {int(np.searchsorted(cuts, m.start(), "right")) - 1 for m in self.whole.finditer(raw)}
        for d in odd:
            out[d] = np.array(self.tok.encode(raw[cuts[d] : cuts[d + 1]].decode("utf-8"), add_special_tokens=False).ids, np.uint32)
        data = data[at[0] : at[-1]]
        if not len(data):
            return out
        start, end = self._pieces(data, cuts)
        size = end - start
        eight = eights(np.concatenate([np.zeros(8, np.uint8), data]))
        short = np.minimum(size, 8)
        h = span_hashes(data, start, end)
        form = np.stack([eight[start + 8] & _TAIL[short], eight[end] >> ((8 - short) * 8).astype(np.uint64), size.astype(np.uint64)], axis=1)
        kept = np.ones(len(h), bool)  # pieces of texts that are not encoded whole
        if odd:
            kept = ~np.isin(np.searchsorted(cuts, start, "right") - 1, list(odd))
        near = np.flatnonzero(kept & (size <= _SHORT))
        place = self.old.place(h[near], form[near])
        rest = near[place < 0]
        late = self.new.place(h[rest], form[rest])
        new = rest[late < 0]
        if len(new):
            _, first = np.unique(h[new], return_index=True)
            first = new[first]
            self._learn(data, start[first], end[first], h[first], form[first])
            late = self.new.place(h[rest], form[rest])
        off, n = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        for table, who, at_ in ((self.old, near[place >= 0], place[place >= 0]), (self.new, rest[late >= 0], late[late >= 0])):
            off[who], n[who] = table.off[at_], table.len[at_]
            table.hits += np.bincount(at_, minlength=len(table.hits))
        lone = rest[late < 0]  # equal hashes of different pieces
        pool = self._far(raw, start, end, np.concatenate([np.flatnonzero(kept & (size > _SHORT)), lone]), off, n)
        ends = np.cumsum(n)
        ids = pool[np.repeat(off - ends + n, n) + np.arange(int(ends[-1]))]
        marks = np.concatenate([[0], ends])[np.searchsorted(start, cuts)]
        for d in range(len(out)):
            if d not in odd:
                out[d] = ids[marks[d] : marks[d + 1]]
        return out

    def _far(self, raw: bytes, start: np.ndarray, end: np.ndarray, who: np.ndarray, off: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The pool with the ids of these pieces behind it; sets their places in off and n."""
        if not len(who):
            return self.pool
        if len(self.far) > self.most // 8:
            self.far.clear()
        pieces = [raw[a:b] for a, b in zip(start[who].tolist(), end[who].tolist())]
        new = [x for x in dict.fromkeys(pieces) if x not in self.far]
        for x, got in zip(new, self.tok.encode_batch_fast([x.decode("utf-8") for x in new], add_special_tokens=False)):
            self.far[x] = np.array(got.ids, np.uint32)
        parts = [self.far[x] for x in pieces]
        n[who] = [len(x) for x in parts]
        ends = len(self.pool) + np.cumsum(n[who])
        off[who] = ends - n[who]
        return np.concatenate([self.pool, *parts])


def _key_hash(keys: np.ndarray, null: np.ndarray | None = None) -> np.ndarray:
    h = mix(keys.astype(np.int64).view(np.uint64) + _U(0x632BE59BD9B4E019))
    if null is not None:
        h[null] = mix(np.array([0x9D], np.uint64))[0]
    return h


def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix(h + seed.astype(np.uint64) * _U(0x9FB21C651E98DF25)) % _U(n)).astype(np.int64)


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds by bucket, slot of each distinct hash): hash and displace; a negative seed names the slot of a lone key."""
    n = len(h)
    n_buckets = max(1, n // 3)
    bucket = (h % _U(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=n_buckets)
    first = np.concatenate([[0], np.cumsum(counts)])
    seeds, slots, taken = np.zeros(n_buckets, np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-counts, kind="stable"):
        if counts[b] < 2:
            break
        who = order[first[b] : first[b + 1]]
        k = 1
        while True:
            tries = np.arange(k, k + 32)
            s = _slot(h[who][None, :], tries[:, None], n)
            ok = ~taken[s].any(1) & (np.diff(np.sort(s, axis=1), axis=1) > 0).all(1)
            if ok.any():
                t = int(np.argmax(ok))
                seeds[b], slots[who] = tries[t], s[t]
                taken[s[t]] = True
                break
            k += 32
    free = np.flatnonzero(~taken)
    lone = np.flatnonzero(counts == 1)
    seeds[lone] = -1 - free[: len(lone)]
    slots[order[first[lone]]] = free[: len(lone)]
    return seeds, slots


def _shard(part: int, seq: int, before: int, ids: list[np.ndarray], keys: list[int | None], dtype: type) -> dict:
    null = np.array([k is None for k in keys])
    key = np.array([0 if k is None else k for k in keys], np.int64)
    h = _key_hash(key, null)
    distinct, first = np.unique(h, return_index=True)  # records of a key are neighbours
    seeds, slots = perfect_hash(distinct)
    prints, records = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slots], records[slots] = (distinct >> _U(32)).astype(np.uint32), first
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<i8")
    payload = np.concatenate(ids).astype(np.dtype(dtype).newbyteorder("<"))
    return {"part": part, "seq": seq, "before": before, "n_ids": int(offsets[-1]), "width": payload.itemsize, "payload": payload.tobytes(), "offsets": offsets.tobytes(), "keys": key.astype("<i8").tobytes(), "nulls": int(null.sum()), "seeds": seeds.astype("<i4").tobytes(), "prints": prints.tobytes(), "records": records.tobytes()}


@dataclass
class Shard:
    """One row of the table, opened for lookups."""

    row: dict

    def __post_init__(self):
        get = lambda k, kind: np.frombuffer(self.row[k], kind)
        self.offsets, self.keys, self.seeds = get("offsets", "<i8"), get("keys", "<i8"), get("seeds", "<i4")
        self.prints, self.records = get("prints", "<u4"), get("records", "<u4")
        self.ids = get("payload", f"<u{self.row['width']}")

    def null(self, record: np.ndarray) -> np.ndarray:
        return record < self.row["nulls"]  # nulls sort first

    def find(self, keys: np.ndarray, null: np.ndarray | None = None) -> np.ndarray:
        """The first record of each key; -1 where the fingerprint differs."""
        h = _key_hash(keys, null)
        seed = self.seeds[(h % _U(len(self.seeds))).astype(np.int64)].astype(np.int64)
        slot = np.where(seed < 0, -1 - seed, _slot(h, np.maximum(seed, 0), len(self.prints)))
        return np.where(self.prints[slot] == (h >> _U(32)).astype(np.uint32), self.records[slot].astype(np.int64), -1)


def write_ids(docs: DataFrame, path: str, spec: str, end_id: int = 0, shard_ids: int = 1 << 19, partitions: int | None = None) -> None:
    """Write the ids of each row's text (null: empty), an end id after each, by ascending doc_id (null first, equal ids by the beginning of their text).

    A row with the same doc_id as another has its own record, in the same shard or the next; a doc_id in very many
    rows, or none, fills as many shards and tasks as its rows need.  An empty table writes no shard.
    """
    spark = docs.sparkSession
    spec_sent = spark.sparkContext.broadcast(spec)  # a vocabulary file, a few MB whatever the corpus
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), None
        held, keys, size, seq, before = [], [], 0, 0, 0

        def shard() -> pa.RecordBatch:
            row = _shard(part, seq, before, held, keys, encoder.dtype)
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()), ("offsets", pa.binary()), ("keys", pa.binary()), ("nulls", pa.int32()), ("seeds", pa.binary()), ("prints", pa.binary()), ("records", pa.binary())]))

        for batch in batches:
            encoder = encoder or Encoder.shared(spec_sent.value)
            data, at = utf8(batch.column(1))
            for i, j in blocks(at, 1 << 20):
                for key, ids in zip(batch.column(0).slice(i, j - i).to_pylist(), encoder.encode(data, at[i : j + 1])):
                    if size >= shard_ids:
                        yield shard()
                        seq, before = seq + 1, before + size
                        held, keys, size = [], [], 0
                    held.append(np.append(ids, np.uint32(end_id)).astype(encoder.dtype))
                    keys.append(key)
                    size += len(ids) + 1
        if held:
            yield shard()

    # the beginning of the text and, where rows are alike, their number split a doc_id with very many rows
    dealt = columns(docs, "doc_id", "text").withColumns({"head": F.substring("text", 1, 64), "row": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(n, "doc_id", "head", "row").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    dealt.mapInArrow(tidied(run), SHARDS).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with `base`, the ids of the whole corpus before each."""
    shards = spark.read.schema(SHARDS).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base"))
    # one row for each write partition, so its size is bounded by the cluster, not by the corpus
    return shards.join(F.broadcast(bases), "part").withColumn("base", F.col("base") + F.col("before"))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each record; every record is fetched by its key through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
                shard = Shard(row)
                n = len(shard.keys)
                null = shard.null(np.arange(n))
                heads = shard.find(shard.keys, null)
                # a record of a repeated key stands so many places behind the key's first
                fresh = np.ones(n, bool)
                fresh[1:] = (shard.keys[1:] != shard.keys[:-1]) | (null[1:] != null[:-1])
                at = heads + np.arange(n) - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
                a, b = shard.offsets[at], shard.offsets[at + 1]
                crc = [zlib.crc32(shard.ids[x:y].astype("<u4").tobytes()) for x, y in zip(a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.keys, mask=null), pa.array(row["base"] + a, pa.int64()), pa.array(b - a, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, path).select("base", "width", "payload", "offsets", "keys", "nulls", "seeds", "prints", "records").mapInArrow(tidied(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of each record whose key is in `keys(doc_id)`, repeated keys' records each; null keys have none.

    Keys meet the shards of their range in cells of equal width, one for each shard, and are then looked up.
    """
    shards = spark.read.schema(SHARDS).parquet(path)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(x.as_py(), "<i8") for x in batch.column(2)]
            nulls = batch.column(3).to_pylist()
            low = [int(x[n]) if n < len(x) else None for x, n in zip(keys, nulls)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low, pa.int64()), pa.array([int(x[-1]) for x in keys], pa.int64())], names=["part", "seq", "low", "high"])

    ranges = shards.select("part", "seq", "keys", "nulls").mapInArrow(tidied(ends), "part int, seq int, low long, high long").where("low is not null")
    n, least, most = ranges.agg(F.count("*"), F.min("low"), F.max("high")).first()
    wide = max(1, -(-((most or 0) - (least or 0) + 1) // max(n, 1)))
    cell = lambda x: F.floor((F.col(x).cast("decimal(20,0)") - F.lit(least or 0)) / F.lit(wide)).cast("long")
    ranges = ranges.select("*", F.explode(F.sequence(cell("low"), cell("high"))).alias("cell"))
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").between(F.lit(least or 0), F.lit(most or 0))).distinct().select("doc_id", cell("doc_id").alias("cell"))
    routed = asked.join(ranges, "cell").where("doc_id >= low AND doc_id <= high")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
                shard, want = Shard(row), np.array(row["want"], np.int64)
                at = shard.find(want)
                ok = (at >= 0) & (shard.keys[np.maximum(at, 0)] == want) & ~shard.null(at)
                # a key's records are neighbours
                runs = np.append(np.flatnonzero(np.diff(shard.keys)) + 1, len(shard.keys))
                n = runs[np.searchsorted(runs, at[ok], "right")] - at[ok]
                records = np.repeat(at[ok] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                ids = [shard.ids[shard.offsets[r] : shard.offsets[r + 1]].astype(np.int64) for r in records]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(want[ok], n)), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    wanted = routed.groupBy("part", "seq").agg(F.collect_list("doc_id").alias("want"))  # a shard's keys at most
    return shards.join(wanted, ["part", "seq"]).select("width", "payload", "offsets", "keys", "nulls", "seeds", "prints", "records", "want").mapInArrow(tidied(look), "doc_id long, ids array<long>")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_output(docs: DataFrame, vocabulary: str | None = None, path: str | None = None) -> DataFrame:
    """Encode, write, read back.  The files go to `path`, or to a new folder in the shared checkpoint folder."""
    spark = docs.sparkSession
    if path is None:
        ensure_checkpoints(spark)
        path = f"{spark.sparkContext.getCheckpointDir()}/ids-{uuid.uuid4().hex}"
    with open(vocabulary or tokenizer_path(), encoding="utf-8") as f:
        write_ids(docs, path, f.read())
    return read_back(spark, path)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(documents(spark, sf_dir))
