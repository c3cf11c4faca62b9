"""Quality rules: isolation forests on rule statistics, with thresholds calibrated from labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, columns, documents, tidied
from .statistics import BASE, FEATURES, statistics

#: The statistics that each forest splits on.
VIEWS = (("symbols",), ("bangs", "upper"), ("word_length", "long", "short"), ("repeats", "adjacent", "distinct"), ("dup_lines",), ("digits",), ("stops", "line_words"))


#: The base rules; the forests judge what passes them.
BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def _mean_path(n: np.ndarray) -> np.ndarray:
    """The mean path length of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: split column (-1: leaf), split value, left child (the right one follows) and path length at a leaf."""

    column: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    @classmethod
    def grow(cls, x: np.ndarray, trees: int, sample: int, rng: np.random.Generator) -> Forest:
        sample = min(sample, len(x))
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))) + 4)
        grown = []
        for _ in range(trees):
            nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
            todo = [(0, x[rng.choice(len(x), sample, replace=False)], 0)]
            while todo:
                k, rows, d = todo.pop()
                low, high = rows.min(0), rows.max(0)
                wide = np.flatnonzero(high > low)
                if d == depth or len(rows) < 2 or not len(wide):
                    nodes[k] = [-1, 0.0, 0, d + float(_mean_path(len(rows)))]
                    continue
                c = int(rng.choice(wide))
                v = rng.uniform(low[c], high[c])
                left = rows[:, c] <= v
                nodes[k] = [c, v, len(nodes), 0.0]
                todo += [(len(nodes), rows[left], d + 1), (len(nodes) + 1, rows[~left], d + 1)]
                nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
            grown.append(np.array(nodes))
        size = max(map(len, grown))
        packed = np.zeros((trees, size, 4))
        for t, nodes in enumerate(grown):
            packed[t, : len(nodes)] = nodes
        return cls(packed[:, :, 0].astype(np.int64), packed[:, :, 1], packed[:, :, 2].astype(np.int64), packed[:, :, 3], depth, float(_mean_path(sample)) or 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / its expectation): near 1 for anomalies, below 0.5 for the usual."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for column, value, child, path in zip(self.column, self.value, self.child, self.path):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth + 1):
                c = column[at]
                down = c >= 0
                if not down.any():
                    break
                at = np.where(down, child[at] + (x[rows, np.maximum(c, 0)] > value[at]), at)
            total += path[at]
        return np.exp2(-total / len(self.column) / self.norm)


#: Scores lie in (0, 1]; thresholds are multiples of 1 / BINS.
BINS = 8192


def threshold(bad: np.ndarray, good: np.ndarray, cost: float) -> float:
    """The score from which to reject, given rows by score bin: the greatest share of bad rows less `cost` times the share of good ones; inf where none gains."""
    if not bad.sum() or not good.sum():
        return float("inf")
    gain = np.cumsum(bad[::-1])[::-1] / bad.sum() - cost * np.cumsum(good[::-1])[::-1] / good.sum()
    full = np.flatnonzero(bad + good)
    k = int(full[np.argmax(gain[full])])
    if gain[k] <= 0:
        return float("inf")
    below = full[full < k]
    return (k + (below[-1] + 1 if len(below) else k)) / 2 / BINS  # midway in the gap below


def grow(sample: np.ndarray, trees: int, size: int, seed: int) -> list[tuple[list[int], Forest]]:
    """A forest for each view."""
    rng = np.random.default_rng(seed)
    out = []
    for view in VIEWS:
        where = [FEATURES.index(v) for v in view]
        out.append((where, Forest.grow(sample[:, where], trees, size, rng)))
    return out


def _features(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, len(FEATURES)) if n else np.zeros((0, len(FEATURES)))


def calibrate(judged: DataFrame, forests: list[tuple[list[int], Forest]], cost: float) -> list[float]:
    """A threshold for each view from all labelled rows(f, quality), whatever their number; a bad row that a view rejects doesn't count for those after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(batch.column(0), batch.num_rows)
            s = np.stack([forest.score(x[:, where]) for where, forest in forests], axis=1) if len(x) else np.zeros((0, len(forests)))
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(batch.column(1)) == 0), pa.FixedSizeListArray.from_arrays(pa.array(s.ravel()), len(forests)).cast(pa.list_(pa.float64()))], names=["bad", "s"])

    left = checkpoint(judged.select("f", "quality").mapInArrow(tidied(run), "bad boolean, s array<double>"))
    limits: list[float] = []
    for k in range(len(forests)):
        score = F.col("s")[k]
        counts = np.zeros((2, BINS + 1))
        for at, bad, n in left.groupBy(F.floor(score * BINS).cast("int").alias("bin"), "bad").count().collect():  # 2 BINS rows at most
            counts[int(not bad), at] = n
        limits.append(threshold(counts[0], counts[1], cost))
        if np.isfinite(limits[-1]):
            left = left.where(~(F.col("bad") & (score >= limits[-1])))
    return limits


def quality_rules(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, trees: int = 40, size: int = 256, cost: float = 100.0, seed: int = 7) -> DataFrame:
    """(doc_id, the base statistics, base_failed, kept, anomaly) of each row.

    The forests grow on about `most_labelled` labelled rows at most, those with the lowest hashes of their
    doc_id among those that pass the base rules; thresholds come from all of these.  Rows whose quality is null
    are unlabelled; of several labels of a doc_id the least counts.  `anomaly` is the greatest ratio of a score
    to its threshold, and a row is kept if the base rules pass and no score reaches its threshold.  Without
    labelled rows of both kinds no threshold is set and the base rules alone decide.  A text without
    words fails the base rules.  Each row is judged by itself, so repeated rows agree.
    """
    stats = checkpoint(statistics(docs))
    marked = columns(labels, "doc_id", "quality").where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    judged = checkpoint(stats.where("NOT " + BASE_FAILED).join(marked, "doc_id").select("doc_id", "n_words", "f", "quality"))
    share = most_labelled / max(judged.count(), 1)
    unit = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / F.lit(float(1 << 53))
    sample = sorted((r[0], r[1], r[2]) for r in judged.where(unit < share).select("doc_id", "n_words", "f").collect())
    model: list[tuple[list[int], Forest, float]] = []
    if sample:
        forests = grow(np.array([r[2] for r in sample]), trees, size, seed)
        model = [(where, forest, limit) for (where, forest), limit in zip(forests, calibrate(judged, forests, cost)) if np.isfinite(limit)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _features(batch.column(6), n)
            worst, over = np.zeros(n), np.zeros(n, bool)
            for where, forest, limit in model if n else ():
                score = forest.score(x[:, where])
                worst, over = np.maximum(worst, score / limit), over | (score >= limit)
            words, repeats = (np.asarray(batch.column(k)) for k in (1, 5))
            failed = (words < 50) | (100 * repeats > 50 * words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(failed), pa.array(~failed & ~over), pa.array(worst)], names=["doc_id", *BASE, "base_failed", "kept", "anomaly"])

    return stats.mapInArrow(tidied(run), "doc_id long, " + ", ".join(f"{b} long" for b in BASE) + ", base_failed boolean, kept boolean, anomaly double")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
