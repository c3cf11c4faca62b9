"""What the text operators share: checkpoints, byte-level words and 64-bit hashes over Arrow batches.

Texts are handled as the UTF-8 bytes of an Arrow string column; no Python string is made for a
text.  Every separator used here is ASCII, so words found on bytes are the words of the text.
"""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words `[^\x20\x09-\x0D]+`.
SPACED = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
#: A-Z to a-z, other bytes as they are.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
#: The same words for Spark's and DuckDB's regular expressions.
WORD_RE = r"[^\x20\x09-\x0D]+"

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (multiply and shift)."""
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_LONG = 64  # bytes; longer spans are hashed one at a time


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of `data` and its end, as a number; zeros follow the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", wide, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes give equal hashes anywhere in any batch.

    Eight bytes at a time go through `mix`, each step on the last one's result, so that no sum or power of
    bytes can cancel; spans over 64 bytes go through xxh3.  Spans of one length of eight bytes or fewer
    never collide.
    """
    size = end - start
    h = mix(size.astype(np.uint64) + _U(0x8CB92BA72F3D8DD7))
    if not len(h):
        return h
    lanes = eights(data)
    h = mix(h + (lanes[start] & _TAIL[np.minimum(size, 8)]))
    live = np.flatnonzero((size > 8) & (size <= _LONG))
    k = 8
    while len(live):
        h[live] = mix(h[live] + (lanes[start[live] + k] & _TAIL[np.minimum(size[live] - k, 8)]))
        k += 8
        live = live[size[live] > k]
    far = np.flatnonzero(size > _LONG)
    if len(far):
        from xxhash import xxh3_64_intdigest

        raw = memoryview(np.ascontiguousarray(data))
        h[far] = [xxh3_64_intdigest(raw[a:b], 0x5EED) for a, b in zip(start[far].tolist(), end[far].tolist())]
    return h


def held_by_worker(name: str, key: object, make: Callable[[], object]) -> object:
    """make() for this name and key, kept by the worker process for its next tasks; another key replaces it.

    Functions travel by value and share no state, so a module of its own holds what is kept.
    """
    import sys
    import types

    held = sys.modules.setdefault("_held_by_worker", types.ModuleType("_held_by_worker")).__dict__
    if name not in held or held[name][0] != key:
        held.pop(name, None)
        held[name] = (key, make())
    return held[name][1]


class Tally:
    """Counts of 64-bit keys in one task: handed over when more than about `most` distinct ones are held."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.size, self.held = most, 0, []

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        names, at = np.unique(np.concatenate([p[0] for p in self.held]), return_inverse=True)
        return names, np.bincount(at, weights=np.concatenate([p[1] for p in self.held])).astype(np.int64)

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(np.unique(keys, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size > self.most:
            self.held = [self._merged()]
            self.size = len(self.held[0][0])
            if self.size > self.most // 2:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            names, n = self._merged()
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], names=["key", "n"])
        self.size, self.held = 0, []


def least_count(counts: DataFrame, most: int) -> int | None:
    """The least n such that at most `most` rows of counts(n) have it or more; None where the most frequent are too many."""
    step = F.when(F.col("n") < 4096, F.col("n").cast("double")).otherwise(F.floor(F.log2("n") * 64) + 10_000)
    total, least = 0, None
    for _, size, low in counts.groupBy(step.alias("step")).agg(F.count("*"), F.min("n")).orderBy(F.desc("step")).collect():  # 7,000 rows at most
        if total + size > most:
            break
        total, least = total + size, low
    return least


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function for mapInArrow; when a task's batches are done, its worker, which waits for others, gives freed memory back."""

    def tidy_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return tidy_run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, without copying the bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of whole texts with about `limit` bytes, so that temporary arrays stay small."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """The words of some texts: `start`, `end` in `data`, and `first`, the index of each text's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int, is_word: np.ndarray = SPACED, lower: bool = True):
        self.raw = data[offsets[i] : offsets[j]]
        self.data = LOWER[self.raw] if lower else self.raw
        self.at = offsets[i : j + 1] - offsets[i]
        self.n_docs = j - i
        inside = is_word[self.data]
        begins, ends = inside.copy(), inside.copy()
        cut = self.at[(self.at > 0) & (self.at < len(self.data))]  # no word crosses texts
        begins[1:] &= ~inside[:-1]
        begins[cut] = inside[cut]
        ends[:-1] &= ~inside[1:]
        ends[cut - 1] = inside[cut - 1]
        self.inside = inside
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.at)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a value for each byte over each text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.at[1:]] - sums[self.at[:-1]]


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of each run of `width` words that lies within a text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * _U((0xBF58476D1CE4E5B9 * (2 * k + 3)) % (1 << 64) | 1)
    keep = np.ones(n, bool)
    for k in range(1, width):  # runs that begin in the last words of a text
        late = first[1:] - k
        keep[late[(late >= 0) & (late < n)]] = False
    # a text of fewer words than width is covered as well: its words are all among its last width - 1
    at = np.flatnonzero(keep)
    return mix(total[at]), at


#: Texts of any length travel in Arrow batches of so many rows at most, instead of Spark's 10,000.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size where it is higher; it bounds memory and changes no result."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def columns(spark_df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; others, whatever their names, never reach an operator's internals."""
    bounded_batches(spark_df.sparkSession)
    return spark_df.select(*[F.col(f"`{n}`") for n in names])


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the key as text, modulo m."""
    return F.crc32(F.col(key).cast("string")) % F.lit(m)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder that the session names in spark.checkpoint.dir.  Without one, a session on one machine gets its own; on a cluster nothing could outlive an executor."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What queries planned meanwhile have shuffled goes when they end; else it stays until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Written to the shared folder and read from there; its shuffle files go.  Tables of a few numbers a row make an eighth of the usual number of files."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    with shuffles_removed(spark):  # a plan of its own, so that the caller's shuffles stay
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)) if narrow else df.select("*")
        return df.checkpoint(eager=True)


def filter_rows(df: DataFrame, columns: tuple[str, ...], make: Callable[[], Callable[..., np.ndarray]]) -> DataFrame:
    """The rows, with all their columns, for which make()(the named columns as Arrow arrays) is true; make is called once a task."""
    bounded_batches(df.sparkSession)
    at = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            yield batch.filter(pa.array(keep(*[batch.column(k) for k in at]), pa.bool_()))

    return df.mapInArrow(tidied(run), df.schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
