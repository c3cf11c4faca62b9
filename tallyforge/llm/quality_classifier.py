"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, checkpoint, columns, crc_mod, documents, filter_rows, tidied, utf8
from .statistics import FEATURES, of_block, statistics


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray  # (FEATURES, d) frequencies
    b: np.ndarray  # (d,) phases
    beta: np.ndarray | None = None
    edges: np.ndarray | None = None  # raw scores and calibrated ones, both ascending
    values: np.ndarray | None = None

    def map(self, f: np.ndarray) -> np.ndarray:
        """cos(w x + b) of the standardised statistics: inner products approximate a Gaussian kernel."""
        x = np.clip((f - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, f: np.ndarray) -> np.ndarray:
        return self.map(f) @ self.beta

    def score(self, f: np.ndarray) -> np.ndarray:
        return np.round(np.clip(np.interp(self.raw(f), self.edges, self.values), 0, 1), 9)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, len(FEATURES)) if n else np.zeros((0, len(FEATURES)))


def _summed(rows: DataFrame, function, size: int) -> np.ndarray:
    """The sum over rows(f, y) of function(f, y), an array of `size`; summed within a partition, then by position in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            n = batch.num_rows
            for k in range(0, n, 8192):
                part = batch.slice(k, 8192)
                total += function(_matrix(part.column(0), part.num_rows), np.asarray(part.column(1)).astype(float))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["k", "x"])

    out = np.zeros(size)
    for k, x in rows.mapInArrow(tidied(run), "k int, x double").groupBy("k").agg(F.sum("x")).collect():  # `size` rows at most
        out[k] = x
    return out


def pool_adjacent(weight: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """The non-decreasing shares nearest to positive / weight (pool adjacent violators)."""
    stack: list[list[float]] = []
    for w, p in zip(weight, positive):
        stack.append([w, p, 1])
        while len(stack) > 1 and stack[-2][1] * stack[-1][0] >= stack[-1][1] * stack[-2][0]:
            w1, p1, n1 = stack.pop()
            stack[-1] = [stack[-1][0] + w1, stack[-1][1] + p1, stack[-1][2] + n1]
    return np.repeat([p / w for w, p, _ in stack], [int(n) for *_, n in stack])


def fit(rows: DataFrame, features: int = 160, width: float = 4.0, ridge: float = 1e-3, bins: int = 2048, seed: int = 11) -> Model | None:
    """From labelled rows(f, y), all of them; None where there are none."""
    m = len(FEATURES)
    sums = _summed(rows, lambda f, y: np.concatenate([[len(y)], f.sum(0), (f * f).sum(0)]), 1 + 2 * m)
    n = sums[0]
    if not n:
        return None
    mean = sums[1 : 1 + m] / n
    scale = np.sqrt(np.maximum(sums[1 + m :] / n - mean**2, 0))
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(m, features)) / width, rng.uniform(0, 2 * np.pi, features))
    d = features + 1
    upper = np.triu_indices(d)

    def equations(f: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.map(f)
        return np.concatenate([(z.T @ z)[upper], z.T @ y])

    sums = _summed(rows, equations, len(upper[0]) + d)
    a = np.zeros((d, d))
    a[upper] = sums[: len(upper[0])]
    a += np.triu(a, 1).T
    model.beta = np.linalg.solve(a + ridge * n / d * np.eye(d), sums[len(upper[0]) :])

    low, high = -0.5, 1.5

    def binned(f: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.raw(f) - low) / (high - low) * bins).astype(np.int64), 0, bins - 1)
        return np.concatenate([np.bincount(at, minlength=bins), np.bincount(at, weights=y, minlength=bins)])

    sums = _summed(rows, binned, 2 * bins)
    full = np.flatnonzero(sums[:bins])
    model.edges = low + (full + 0.5) * (high - low) / bins
    model.values = pool_adjacent(sums[:bins][full], sums[bins:][full])
    return model


def learn(stats: DataFrame, labels: DataFrame) -> Model | None:
    """From statistics(doc_id, f) and labels(doc_id, quality): all labelled rows whose crc32(doc_id) mod 5 is not 0."""
    marked = columns(labels, "doc_id", "quality").where("quality is not null").where(crc_mod("doc_id", 5) != 0)
    return fit(checkpoint(stats.join(marked, "doc_id").select("f", F.col("quality").cast("double").alias("y"))))


def quality_classifier(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row.

    Learns from all labelled rows whose crc32(doc_id) mod 5 is not 0; only statistics of the text are
    inputs.  A null text is an empty one, and both get a score as any other.  Rows of a doc_id are
    scored each by its text; labels of a doc_id in several rows count each.  Without any label every
    score is 0.5.  An empty table gives an empty result.
    """
    stats = checkpoint(statistics(docs).select("doc_id", "f"))
    model = learn(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            score = model.score(_matrix(batch.column(2), n)) if model is not None else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score), pa.array((score >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return stats.select("doc_id", held.alias("held_out"), "f").mapInArrow(tidied(run), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose score is at least `cut`; each is judged by its text."""
    model = learn(statistics(docs).select("doc_id", "f"), labels)

    def make():
        def keep(text: pa.Array) -> np.ndarray:
            data, at = utf8(text)
            out = [model.score(of_block(data, at, i, j)[1]) >= cut for i, j in blocks(at, 1 << 19)] if model is not None else [np.full(len(text), 0.5 >= cut)]
            return np.concatenate(out) if out else np.zeros(0, bool)

        return keep

    return filter_rows(docs, ("text",), make)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
