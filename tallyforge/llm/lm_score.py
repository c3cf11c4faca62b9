"""LM scoring: a log-bilinear neural model trained in numpy with noise-contrastive estimation.

The model predicts units: words, classes of all other words by their form, and the end of a text.  The number
of words that are units grows with the training tokens (their cube root).  A unit's context is the units at the
`POSITIONS` places before it, ends where the text begins; its vector is the sum of theirs, each weighted by its
place.  The probability of a unit is that of its group of units, the softmax of (context vector . group vector +
bias), times its own within the group, the softmax of (context vector . unit vector + bias).  A word of a class has
the class's probability times its smoothed share of the class's training tokens, so the probabilities of all
words, unknown ones included, sum to one.  Scoring normalises with batched matrix products: contexts by
groups, then contexts by the units of each group.

Training reads every training text once, in `ROUNDS` of growing parts.  In a round each task trains its own copy
of the model on its texts, in mini-batches against noise drawn from the unigram distribution, and the
copies are averaged, each row of a table by how often a task has met it.

Counts of words are taken from all training texts.  Counts of the most frequent words travel to the
executors; all others stay in a table and meet their tokens in a join.  Words are told apart by 57 bits
of a hash and their form.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tally, Words, blocks, checkpoint, columns, crc_mod, documents, least_count, tidied, utf8

_U = np.uint64
#: Low bits of a word's key hold its class: does it have other than ASCII bytes, its last letter, a mark after it.
CLASSES, END_CLASS = 108, 127
END = END_CLASS  # the key of the end of a text; words' keys end in a class below CLASSES
POSITIONS = 3
#: The sixteenths of the training texts that each round reads.
ROUNDS = ((0, 1), (1, 4), (4, 16))

_LETTER = np.full(256, 26, np.int64)
_LETTER[0x61:0x7B] = np.arange(26)
_MARK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])


def keys(w: Words) -> np.ndarray:
    """A 57-bit hash and the class of each word, as signed numbers."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    wide = np.concatenate([[0], np.cumsum(w.data >= 0x80)])
    mark = _MARK[w.data[w.end - 1]] & (w.end - w.start > 1)
    last = _LETTER[w.data[w.end - 1 - mark]]
    form = ((wide[w.end] > wide[w.start]) * 27 + last) * 2 + mark
    return ((w.hashes() & ~_U(127)) | form.astype(np.uint64)).view(np.int64)


def with_ends(w: Words, k: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the texts end to end, the end token after each, and each text's offset."""
    first = w.first + np.arange(w.n_docs + 1)
    out = np.full(len(k) + w.n_docs, end, k.dtype)
    body = np.ones(len(out), bool)
    body[first[1:] - 1] = False
    out[body] = k
    return out, first


def token_counts(docs: DataFrame) -> DataFrame:
    """(key, n) over all whole texts; pre-aggregated in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            data, at = utf8(batch.column(0))
            for i, j in blocks(at):
                w = Words(data, at, i, j)
                yield from tally.add(with_ends(w, keys(w), END)[0])
        yield from tally.rest()

    return docs.select("text").mapInArrow(tidied(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The words whose counts are broadcast, sorted by key: their counts and units (a word's own, or its class's)."""

    names: np.ndarray
    n: np.ndarray
    unit: np.ndarray
    of_class: np.ndarray  # the unit of each class, and of the end

    def look(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, place, unit) of each token."""
        at = np.minimum(np.searchsorted(self.names, tokens), max(len(self.names) - 1, 0))
        found = self.names[at] == tokens if len(self.names) else np.zeros(len(tokens), bool)
        unit = self.of_class[np.minimum(tokens & 127, CLASSES)]
        if len(self.names):
            unit = np.where(found, self.unit[at], unit)
        return found, at, unit

    def contexts(self, unit: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(tokens, POSITIONS) units before each token, the nearest first; ends where the text begins."""
        out = np.empty((len(unit), POSITIONS), np.int64)
        end = self.of_class[CLASSES]
        for k in range(1, POSITIONS + 1):
            out[:k, k - 1] = end
            out[k:, k - 1] = unit[:-k] if k < len(unit) else unit[:0]
            for j in range(k):
                head = first[:-1] + j
                out[head[head < len(unit)], k - 1] = end  # heads beyond a short text are the next one's, or its own end's
        return out


@dataclass
class Model:
    """Tables of rows of numbers; units are numbered by falling counts, and each group is a run of them."""

    context: np.ndarray  # (units, dim)
    place: np.ndarray  # (POSITIONS, dim)
    group: np.ndarray  # (groups, dim + 1), the bias last
    unit: np.ndarray  # (units, dim + 1)
    cuts: np.ndarray  # (groups + 1) first unit of each group
    share: np.ndarray  # (units) counts, as shares of all

    TABLES = ("context", "place", "group", "unit")

    @classmethod
    def start(cls, counts: np.ndarray, dim: int, seed: int) -> Model:
        """From the counts of the units, descending: groups of about equal shares, about as many as the square root of the units."""
        n, rng = len(counts), np.random.default_rng(seed)
        share = (counts + 0.5) / (counts + 0.5).sum()
        before = np.cumsum(share) - share
        wanted = max(1, int(np.sqrt(n)))
        cuts = np.append(np.flatnonzero(np.diff(np.floor(before * wanted), prepend=-1.0)), n)
        mass = np.add.reduceat(share, cuts[:-1])
        bias = np.log(share / np.repeat(mass, np.diff(cuts)))
        small = lambda *shape: rng.normal(0, 0.1, shape)
        tables = small(n, dim), np.ones((POSITIONS, dim)) / np.arange(1, POSITIONS + 1)[:, None], np.column_stack([small(len(mass), dim), np.log(mass)]), np.column_stack([small(n, dim), bias])
        return cls(*(x.astype(np.float32) for x in tables), cuts, share)

    def hidden(self, before: np.ndarray) -> np.ndarray:
        """The context vectors, a one behind each for the biases."""
        out = np.ones((len(before), self.context.shape[1] + 1), np.float32)
        total = out[:, :-1]
        np.multiply(self.context[before[:, 0]], self.place[0], out=total)
        for k in range(1, POSITIONS):
            total += self.context[before[:, k]] * self.place[k]
        return out

    def log_probabilities(self, before: np.ndarray, unit: np.ndarray, together: int = 1 << 15) -> np.ndarray:
        """log10 probability of each unit after its context."""
        out = np.empty(len(unit))
        group = np.searchsorted(self.cuts, unit, "right") - 1
        for at in range(0, len(unit), together):
            x, g, u = self.hidden(before[at : at + together]), group[at : at + together], unit[at : at + together]
            logs = _log_softmax(x @ self.group.T, g)
            order = np.argsort(g, kind="stable")
            edges = np.searchsorted(g[order], np.arange(len(self.cuts)))
            for k in np.flatnonzero(np.diff(edges)):
                low, high = self.cuts[k], self.cuts[k + 1]
                if high - low > 1:
                    who = order[edges[k] : edges[k + 1]]
                    for some in np.array_split(who, -(-len(who) * (high - low) // (1 << 22))):  # 16 MB of scores at once
                        logs[some] += _log_softmax(x[some] @ self.unit[low:high].T, u[some] - low)
            out[at : at + together] = logs
        return out / np.log(10)


def _log_softmax(scores: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The log of each row's softmax at one column."""
    scores -= scores.max(1, keepdims=True)
    picked = scores[np.arange(len(which)), which].astype(np.float64)
    np.exp(scores, out=scores)
    return picked - np.log(scores.sum(1, dtype=np.float64))


class Trainer:
    """A task's own copy of the model, trained in mini-batches; rows move by their gradients over the root of the mean squares so far."""

    def __init__(self, model: Model, squares: dict[str, np.ndarray], rate: float, noise: int, seed: int):
        self.model = Model(**{k: v.copy() if k in Model.TABLES else v for k, v in vars(model).items()})
        self.squares = {k: v.copy() for k, v in squares.items()}
        self.met = {k: np.zeros(len(v), np.float32) for k, v in squares.items()}
        self.rate, self.noise, self.rng = rate, noise, np.random.default_rng(seed)
        m = self.model
        self.mass = np.add.reduceat(m.share, m.cuts[:-1])
        self.within = np.concatenate([[0.0], np.cumsum(m.share)])
        # logs of the expected number of noise samples: of each group, and of each unit within its group
        self.log_group = np.log(noise * self.mass).astype(np.float32)
        self.log_unit = np.log(noise * m.share / np.repeat(self.mass, np.diff(m.cuts))).astype(np.float32)
        self.group_of = np.repeat(np.arange(len(self.mass)), np.diff(m.cuts))

    def _move(self, table: str, rows: np.ndarray, grads: np.ndarray, ordered: bool = False) -> None:
        """Add the gradients of rows, which may repeat."""
        if not ordered:
            order = np.argsort(rows, kind="stable")
            rows, grads = rows[order], grads[order]
        heads = np.flatnonzero(np.diff(rows, prepend=-1))
        grads, n, rows = np.add.reduceat(grads, heads, axis=0), np.diff(np.append(heads, len(rows))), rows[heads]
        self.squares[table][rows] += np.einsum("ij,ij->i", grads, grads) / grads.shape[1]
        self.met[table][rows] += n
        grads *= (self.rate / np.sqrt(self.squares[table][rows]))[:, None]
        getattr(self.model, table)[rows] += grads

    @staticmethod
    def _slopes(x: np.ndarray, own: np.ndarray, log_own: np.ndarray, other: np.ndarray, log_other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How the chances to tell data from noise change with the scores of data and of noise."""
        data = np.einsum("ij,ij->i", x, own)
        data -= log_own
        noise = x @ other.T
        noise -= log_other
        for z, sign in ((data, 1), (noise, -1)):
            np.clip(z, -30, 30, out=z)
            z *= sign
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            z *= sign
        return data, noise

    def batch(self, before: np.ndarray, unit: np.ndarray) -> None:
        """One step of noise-contrastive estimation on tokens in the order of their units; those of a group share their noise."""
        m, k = self.model, self.noise
        x = m.hidden(before)
        group = self.group_of[unit]
        edges = np.searchsorted(unit, m.cuts)
        others, slopes = [], []
        if len(self.mass) > 1:
            other = np.searchsorted(np.cumsum(self.mass), self.rng.random(k) * self.mass.sum()).clip(0, len(self.mass) - 1)
            own = m.group[group]
            data, noise = self._slopes(x, own, self.log_group[group], m.group[other], self.log_group[other])
            back = noise @ m.group[other]
            own *= data[:, None]
            back += own
            groups = (group, data[:, None] * x), (other, noise.T @ x)
        else:
            back, groups = np.zeros_like(x), ()
        own, grads = m.unit[unit], np.zeros_like(x)
        for g in np.flatnonzero(np.diff(edges)):
            low, high = m.cuts[g], m.cuts[g + 1]
            if high - low < 2:
                continue
            i, j = edges[g], edges[g + 1]
            draws = self.within[low] + self.rng.random(k) * (self.within[high] - self.within[low])
            other = np.searchsorted(self.within, draws, "right").clip(low + 1, high) - 1
            noise_rows = m.unit[other]
            data, noise = self._slopes(x[i:j], own[i:j], self.log_unit[unit[i:j]], noise_rows, self.log_unit[other])
            back[i:j] += noise @ noise_rows
            back[i:j] += data[:, None] * own[i:j]
            np.multiply(x[i:j], data[:, None], out=grads[i:j])
            others.append(other)
            slopes.append(noise.T @ x[i:j])
        back = back[:, :-1]
        near = [m.context[before[:, p]] for p in range(POSITIONS)]
        places = np.stack([np.einsum("ij,ij->j", back, near[p]) / len(unit) for p in range(POSITIONS)])
        self._move("context", before.T.ravel(), np.concatenate([back * m.place[p] for p in range(POSITIONS)]))
        self._move("place", np.arange(POSITIONS), places, True)
        for n, part in enumerate(groups):
            self._move("group", *part, ordered=n == 0)
        self._move("unit", unit, grads, True)
        if others:
            self._move("unit", np.concatenate(others), np.concatenate(slopes))

    def learn(self, before: np.ndarray, unit: np.ndarray, repeats: int, size: int = 8192) -> None:
        for _ in range(repeats):
            order = self.rng.permutation(len(unit))
            for part in np.array_split(order, max(1, len(order) // size)):
                part = part[np.argsort(unit[part], kind="stable")]
                self.batch(before[part], unit[part])


#: Rows of a table that travel together.
_PIECE = 1024


def _pieces(trainer: Trainer) -> Iterator[tuple[str, int, bytes]]:
    """Rows of all tables times their weight, with the weight and the mean squares."""
    for table in Model.TABLES:
        values, met = getattr(trainer.model, table), trainer.met[table]
        rows = np.column_stack([values * met[:, None], trainer.squares[table] * met, met]).astype("<f4")
        for k in range(0, len(rows), _PIECE):
            if met[k : k + _PIECE].any():
                yield table, k, rows[k : k + _PIECE].tobytes()


def train_round(docs: DataFrame, vocab: Vocabulary, model: Model, squares: dict[str, np.ndarray], part: tuple[int, int], repeats: int, rate: float, noise: int, seed: int) -> tuple[Model, dict[str, np.ndarray]]:
    """The average of the copies that tasks train on a part of the texts.

    There are at most four tasks for each core of the cluster, so what copies weigh doesn't grow with the number of
    input files.  The driver gets one model, whatever their number.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((vars(vocab), vars(model), squares))  # bounded by the vocabulary
    low, high = part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts, tables, held = sent.value
        words, trainer = Vocabulary(**parts), Trainer(Model(**tables), held, rate, noise, seed * 1_000_003 + TaskContext.get().partitionId())
        for batch in batches:
            data, at = utf8(batch.column(0))
            for i, j in blocks(at):
                w = Words(data, at, i, j)
                tokens, first = with_ends(w, keys(w), END)
                unit = words.look(tokens)[2]
                trainer.learn(words.contexts(unit, first), unit, repeats)
        for table, k, rows in _pieces(trainer):
            yield pa.RecordBatch.from_arrays([pa.array([table]), pa.array([k], pa.int32()), pa.array([rows], pa.binary())], names=["name", "row", "rows"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of pieces that lie together."""
        now: tuple[str, int] | None = None
        total = np.zeros(0)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["name", "row", "rows"])

        for batch in batches:
            for name, row, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                values = np.frombuffer(rows.as_buffer(), "<f4").astype(np.float64)
                if (name, row) != now:
                    if now is not None:
                        yield out()
                    now, total = (name, row), values
                else:
                    total = total + values
        if now is not None:
            yield out()

    kind = "name string, row int, rows binary"
    sixteenth = F.pmod(F.xxhash64("doc_id", "text"), F.lit(16))
    texts = docs.where((sixteenth >= low) & (sixteenth < high)).select("text").coalesce(4 * spark.sparkContext.defaultParallelism)
    sums = texts.mapInArrow(tidied(run), kind).repartition("name", "row").sortWithinPartitions("name", "row").mapInArrow(tidied(add), kind)
    tables, held = {k: v.copy() if k in Model.TABLES else v for k, v in vars(model).items()}, {k: v.copy() for k, v in squares.items()}
    for name, row, rows in sums.toLocalIterator():
        wide = tables[name].shape[1] + 2
        got = np.frombuffer(rows, "<f8").reshape(-1, wide)
        met = np.flatnonzero(got[:, -1] > 0)
        tables[name][row + met] = got[met, :-2] / got[met, -1:]
        held[name][row + met] = got[met, -2] / got[met, -1]
    return Model(**tables), held


@dataclass
class Fitted:
    """What scoring needs: counts of words, the vocabulary, the model, and the logs of the classes' smoothed counts by unit."""

    counts: DataFrame
    n_all: int
    v_all: int
    vocab: Vocabulary
    model: Model
    shares: np.ndarray
    is_class: np.ndarray


def fit(docs: DataFrame, words_for_token: float = 20.0, n_sent: int = 1 << 18, dim: int = 24, rate: float = 0.1, noise: int = 24, least_tokens: int = 4_000_000, seed: int = 3) -> Fitted:
    """Learn from docs(doc_id, text).

    Words that are units: `words_for_token` times the cube root of the training tokens, the most frequent ones.  A
    corpus of fewer than `least_tokens` tokens is gone through several times, 12 at most.
    """
    counts = checkpoint(token_counts(docs))
    form = F.col("key").bitwiseAND(127).cast("int")
    by_form = {r[0]: (r[1], r[2]) for r in counts.groupBy(form.alias("form")).agg(F.sum("n"), F.count("*")).collect()}  # 109 rows
    n_all, v_all = (sum(x[k] for x in by_form.values()) for k in (0, 1))
    n_words = int(words_for_token * np.cbrt(n_all))
    cut = least_count(counts, max(n_sent, 2 * n_words))  # all of a count or none, so that no task sends words in vain
    got = counts.where(F.col("n") >= cut if cut is not None else F.lit(False)).toArrow()
    names, n = (got.column(c).to_numpy() for c in ("key", "n"))
    order = np.lexsort((names, -n))
    names, n = names[order], n[order]
    kind = np.minimum(names & 127, CLASSES)
    is_word = np.flatnonzero(kind < CLASSES)[:n_words]
    in_class = np.zeros((CLASSES + 1, 2))  # tokens and words that are no units
    for k, x in by_form.items():
        in_class[min(k, CLASSES)] = x
    np.subtract.at(in_class, (kind[is_word], 0), n[is_word])
    np.subtract.at(in_class, (kind[is_word], 1), 1)
    sizes = np.concatenate([n[is_word].astype(float), in_class[:, 0]])
    falling = np.argsort(-sizes, kind="stable")
    number = np.empty(len(sizes), np.int64)
    number[falling] = np.arange(len(sizes))
    of_class = number[len(is_word) :]
    unit = of_class[kind]
    unit[is_word] = number[: len(is_word)]
    order = np.argsort(names)
    vocab = Vocabulary(names[order], n[order], unit[order], of_class)
    shares, is_class = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    is_class[of_class[:CLASSES]] = True
    shares[of_class[:CLASSES]] = np.log10(in_class[:CLASSES, 0] + 0.5 * (in_class[:CLASSES, 1] + 1))
    model = Model.start(sizes[falling], dim, seed)
    squares = {k: np.full(len(getattr(model, k)), 1e-2, np.float32) for k in Model.TABLES}
    small = Vocabulary(*(x[np.isin(order, is_word)] for x in (vocab.names, vocab.n, vocab.unit)), of_class)
    repeats = int(np.clip(least_tokens // max(n_all, 1), 1, 12))
    for k, part in enumerate(ROUNDS if n_all else ()):
        model, squares = train_round(docs, small, model, squares, part, repeats, rate, noise, seed + k)
    return Fitted(counts, int(n_all), int(v_all), vocab, model, shares, is_class)


def lm_score(docs: DataFrame, fitted: Fitted | None = None, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learns from the rows whose crc32(doc_id) mod 5 is not 1 (a null doc_id counts among them).  A null
    text is an empty one: its only token is the end.  `score` is the model's log10 probability of the
    text, `base_score` the smoothed unigram one.  With no training rows the counts are 0 and both scores
    are those of the smoothing alone.  Rows with the same doc_id are scored each by its text.  The model depends
    on how the texts lie in tasks, as copies are averaged; the same layout gives the same scores.
    """
    spark = docs.sparkSession
    docs = columns(docs, "doc_id", "text").withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False)))
    fitted = fitted or fit(docs.where(~F.col("held_out")).select("doc_id", "text"), **options)
    counts, n_all, v_all = fitted.counts, fitted.n_all, fitted.v_all
    sent = spark.sparkContext.broadcast((vars(fitted.vocab), vars(fitted.model), fitted.shares, fitted.is_class))  # bounded by n_sent and the vocabulary
    base_log = float(np.log10(n_all + 0.5 * (v_all + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts, tables, share, is_class = sent.value
        words, model, row = Vocabulary(**parts), Model(**tables), TaskContext.get().partitionId() << 40
        log_n = np.log10(words.n + 0.5)
        for batch in batches:
            data, at = utf8(batch.column(2))
            for i, j in blocks(at):
                w = Words(data, at, i, j)
                tokens, first = with_ends(w, keys(w), END)
                found, place, unit = words.look(tokens)
                log_c = np.where(found, log_n[place], 0.0) if len(words.names) else np.zeros(len(tokens))
                score = model.log_probabilities(words.contexts(unit, first), unit) + np.where(is_class[unit], log_c - share[unit], 0.0)
                heads = first[:-1]
                rare = np.flatnonzero(~found)
                cuts = np.searchsorted(rare, first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(j - i)), batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(first)), pa.array(np.add.reduceat(found.astype(np.int64), heads)), pa.array(np.add.reduceat(log_c, heads)), pa.array(np.add.reduceat(score, heads, dtype=np.float64)), pa.ListArray.from_arrays(pa.array(cuts), pa.array(tokens[rare]))],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"],
                )
                row += j - i

    scored = checkpoint(docs.select("doc_id", "held_out", "text").mapInArrow(tidied(run), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<long>"))
    # an end that the training texts lack (there are none) is a token of count 0 as any other
    rare = scored.select("row", F.explode("rare").alias("key")).join(counts, "key", "left")
    log_c = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    is_end = F.col("key").bitwiseAND(127) == END_CLASS
    rare = rare.groupBy("row").agg(F.count("n").alias("more"), F.sum(log_c).alias("logs"), F.sum(F.when(~is_end, log_c).otherwise(0.0)).alias("classed"))
    logs, classed, more = (F.coalesce(F.col(c), F.lit(0)) for c in ("logs", "classed", "more"))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more).cast("long").alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + logs - F.col("n_tokens") * F.lit(base_log)).alias("base_score"), (F.col("score") + classed).alias("score")
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(documents(spark, sf_dir))
