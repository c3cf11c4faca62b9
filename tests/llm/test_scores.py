"""Quality rules, the classifier, language identification and LM scoring."""

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import language_id, lm_score, quality_classifier, quality_rules
from tallyforge.llm.common import Words, utf8
from tallyforge.llm.quality_classifier import pool_adjacent
from tallyforge.llm.statistics import FEATURES, of_block

from .helpers import ODD, SF, held, lower, rule_counts, twins, unigram

SF1 = "/root/testdata/sf0.01"


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "doc_id AS score", "text AS f", "0.5 AS kept")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_rule_counts(spark):
    x, y = twins()
    own = [*ODD, f"{x}\n{y}\n{x}", f"{x} {y} {x} {y} {x} {x} {y}", "a b c a b c", "l1\nl1\n\nl1 \nl2", "# $ %%", "p q r s p q r\np q r"]
    rows = [(i, t) for i, t in enumerate(own)] + [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = quality_rules.quality_rules(documents(spark, rows), labels(spark, [])).collect()
    assert len(got) == len(rows)
    for r in got:
        want = rule_counts(dict(rows)[r["doc_id"]])
        assert tuple(r[1:6]) == want, r
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"])  # no labels, no thresholds


def test_rules_keep_clean_and_drop_junk(spark):
    got = quality_rules.op3(spark, SF1).join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id")
    junk = got.where("quality = 0").selectExpr("avg(CAST(kept AS INT)) AS x").first()["x"]
    clean = got.where("quality = 1 AND NOT base_failed").selectExpr("avg(CAST(kept AS INT)) AS x").first()["x"]
    assert junk <= 0.02 and clean >= 0.98


def features_of(rows):
    data, at = utf8(pa.array([t for _, t in rows]))
    return of_block(data, at, 0, len(rows))


def test_rules_against_brute_force(spark):
    """Paths walked node by node, and every threshold tried."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF1}/documents.parquet").collect()]
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    base, f = features_of(rows)
    failed = [b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base]
    judged = sorted((rows[k][0], int(base[k][0]), f[k].tolist(), marks[rows[k][0]]) for k in range(len(rows)) if not failed[k] and rows[k][0] in marks)
    forests = quality_rules.grow(np.array([x[2] for x in judged]), 40, 256, 7)

    def score(where, forest, x):
        total = 0.0
        for column, value, child, path in zip(forest.column, forest.value, forest.child, forest.path):
            at = 0
            while column[at] >= 0:
                at = child[at] + int(x[where][column[at]] > value[at])
            total += path[at]
        return 2.0 ** (-total / len(forest.column) / forest.norm)

    over, left = [False] * len(rows), judged
    for where, forest in forests:
        own = [(int(score(where, forest, np.array(x[2])) * quality_rules.BINS), x) for x in left]
        bad, good = [b for b, x in own if x[3] == 0], [b for b, x in own if x[3] == 1]
        best, limit = 0.0, None
        for k in sorted({b for b, _ in own}):
            gain = sum(b >= k for b in bad) / len(bad) - 100 * sum(b >= k for b in good) / len(good) if bad else 0
            if gain > best + 1e-12:
                below = [b for b, _ in own if b < k]
                best, limit = gain, (k + (max(below) + 1 if below else k)) / 2 / quality_rules.BINS
        if limit is not None:
            over = [o or score(where, forest, x) >= limit for o, x in zip(over, f)]
            left = [x for b, x in own if not (x[3] == 0 and score(where, forest, np.array(x[2])) >= limit)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op3(spark, SF1).collect()}
    assert got == {i: not bad and not o for (i, _), bad, o in zip(rows, failed, over)}
    assert 0 < sum(over)


def test_rules_on_an_empty_table(spark):
    assert quality_rules.quality_rules(documents(spark, []), labels(spark, [(1, 1)])).count() == 0


def test_isolation_forest_finds_what_stands_apart():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 2)), [[9.0, 9.0]]])
    forest = quality_rules.Forest.grow(x, 50, 256, rng)
    score = forest.score(x)
    assert score.argmax() == 500 and 0 < score.min() and score.max() < 1
    bins = (score * quality_rules.BINS).astype(int)
    bad, good = np.zeros(quality_rules.BINS + 1), np.bincount(bins[:500], minlength=quality_rules.BINS + 1)
    assert quality_rules.threshold(bad, good, 30.0) == float("inf")
    bad[bins[500]] = 1
    limit = quality_rules.threshold(bad, good, 30.0)
    assert np.sort(score)[-2] < limit <= score[500]


def test_classifier_held_out(spark):
    got = quality_classifier.op6(spark, SF1).join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").collect()
    own = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"], 0) for r in got) and len(own) > 30
    assert np.mean([r["predicted"] == r["quality"] for r in own]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_classifier_against_brute_force(spark):
    """Ridge by least squares over all rows at once, and isotonic shares by the greatest of the least means."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF1}/documents.parquet").collect()]
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    _, f = features_of(rows)
    known = [k for k, (i, _) in enumerate(rows) if i in marks and not held(i, 0)]
    x, y = f[known], np.array([float(marks[rows[k][0]]) for k in known])
    rng, m, d, bins = np.random.default_rng(11), len(FEATURES), 161, 2048
    w, b = rng.normal(size=(m, 160)) / 4.0, rng.uniform(0, 2 * np.pi, 160)
    wide = np.where(x.std(0) > 1e-9, x.std(0), 1.0)

    def mapped(z):
        return np.column_stack([np.sqrt(2 / 160) * np.cos(np.clip((z - x.mean(0)) / wide, -6, 6) @ w + b), np.ones(len(z))])

    z = mapped(x)
    weight = np.sqrt(1e-3 * len(y) / d)  # a row for each coefficient
    beta = np.linalg.lstsq(np.vstack([z, weight * np.eye(d)]), np.concatenate([y, np.zeros(d)]), rcond=None)[0]
    at = np.clip(((z @ beta + 0.5) / 2 * bins).astype(int), 0, bins - 1)
    full = sorted(set(at))
    n, p = np.array([(at == k).sum() for k in full]), np.array([y[at == k].sum() for k in full])
    shares = [max(min(p[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, len(full))) for i in range(k + 1)) for k in range(len(full))]
    want = np.interp(mapped(f) @ beta, [-0.5 + (k + 0.5) * 2 / bins for k in full], shares)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.op6(spark, SF1).collect()}
    off = np.abs(np.array([got[i] for i, _ in rows]) - want)
    assert np.quantile(off, 0.99) < 1e-6 and off.max() < 0.05  # a raw score on a bin's border may fall to the other side


def test_classifier_takes_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(3, "again"), (None, "no id")]
    marks = labels(spark, [(i, i % 2) for i in range(len(ODD))] + [(2, None), (999, 1)])
    got = quality_classifier.quality_classifier(documents(spark, rows), marks).collect()
    assert len(got) == len(rows) and all(r["score"] is not None for r in got)
    none = quality_classifier.quality_classifier(documents(spark, rows), labels(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_classifier.quality_classifier(documents(spark, []), marks).count() == 0
    kept = quality_classifier.accepted(documents(spark, rows), labels(spark, []))
    assert kept.count() == len(rows) and kept.columns == documents(spark, []).columns


def test_isotonic_values_ascend():
    got = pool_adjacent(np.array([1.0, 1, 1, 1, 2]), np.array([0.0, 1, 0, 1, 2]))
    assert list(got) == [0, 0.5, 0.5, 1, 1]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet").select("doc_id", "lang")
    got = language_id.op7(spark, SF1).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.97


def test_language_of_odd_texts(spark):
    rows = [(i, t, ("en", "fr")[i % 2]) for i, t in enumerate(["the cat and the dog are here", "le chat et le chien sont là"] * 40)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(2000, "the dog and the cat", None), (2000, "le chien et le chat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS share", "'z' AS code")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.language_id(docs).collect()]
    assert len(got) == len(rows)
    by = {i: p for i, p, _ in got}
    for i, t in enumerate(ODD):
        assert (by[1000 + i] == "und") == (not any(c.isalpha() for c in t or ""))
    assert sorted(p for i, p, _ in got if i == 2000) == ["en", "fr"]
    assert all(0 <= s <= 1 for *_, s in got)
    blank = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in language_id.language_id(blank).collect()} == {"und"}
    assert language_id.language_id(docs.limit(0)).count() == 0


def test_any_number_of_languages(spark):
    """2100 labels; and the same result from one tree as from a tree for each language."""
    many = spark.range(6300).selectExpr("id AS doc_id", "concat('abc ', chr(CAST(97 + id % 26 AS INT)), ' def') AS text", "concat('l', id % 2100) AS lang")
    got = language_id.language_id(many)
    assert got.count() == 6300 and got.where("score <= 0 OR score > 1 OR lang_pred NOT LIKE 'l%'").count() == 0
    words = {"de": "der hund und die katze ", "en": "the dog and the cat ", "es": "el perro y el gato ", "fr": "le chien et le chat "}
    rows = [(i, w * 2, lang) for i, (lang, w) in enumerate(list(words.items()) * 20)] + [(500, None, "en"), (501, "...", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, each = (sorted((r["doc_id"], r["held_out"], r["lang_pred"]) for r in language_id.language_id(docs, block_bytes=b).collect()) for b in (64 << 20, 1))
    assert one == each and {(i, p) for i, _, p in one if i < 500} == {(i, lang) for i, _, lang in rows[:80]}


def test_code_lengths_are_exact():
    """The tree's lengths against prediction by partial matching written out for each byte."""
    rng = np.random.default_rng(1)
    train = {"a": bytes(rng.choice(list(b"abcd "), 400)), "b": bytes(rng.choice(list(b"abxy "), 400))}
    counts = []
    for lang, t in train.items():
        code = language_id.grams(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        counts += [(lang, int(c), int(n)) for c, n in zip(*np.unique(code, return_counts=True))]
    tree = language_id.ContextTree.train(counts, 1 << 20)
    k = tree.k

    def table(t: bytes, order: int) -> dict[bytes, dict[int, int]]:
        out: dict[bytes, dict[int, int]] = {}
        padded = b"   " + t
        for i in range(3, len(padded)):
            out.setdefault(padded[i - order : i], {}).setdefault(padded[i], 0)
            out[padded[i - order : i]][padded[i]] += 1
        return out

    tables = {lang: [table(t, o) for o in range(4)] for lang, t in train.items()}
    both = [{c: sum(sum(tables[x][o].get(c, {}).values()) for x in train) for c in {*tables["a"][o], *tables["b"][o]}} for o in range(4)]
    text = b"abcdxy abba z"
    padded = b"   " + text
    want = {}
    for lang in train:
        bits = 0.0
        for i in range(3, len(padded)):
            done = False
            for o in (3, 2, 1, 0):
                ctx = padded[i - o : i]
                if o >= 2 and both[o].get(ctx, 0) < 2:
                    continue
                seen = tables[lang][o].get(ctx)
                if not seen:
                    continue
                total = sum(seen.values()) + len(seen)
                if padded[i] in seen:
                    bits += np.log2(total / seen[padded[i]])
                    done = True
                    break
                bits += np.log2(total / len(seen))
            if not done:
                bits += np.log2(k)
        want[lang] = bits
    got = tree.lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    assert got == pytest.approx([want["a"], want["b"]], rel=1e-5)


@pytest.mark.parametrize("options", [{}, {"words_for_token": 1.0, "n_sent": 100}])
def test_lm_base_scores(spark, options):
    x, y = twins()
    own = [*ODD, x, f"{y} {x} {x}", f"{x}z {y}z", f"{y}z"]
    rows = [(i, t) for i, t in enumerate(own)] + [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = unigram(rows)
    got = lm_score.lm_score(documents(spark, rows), **options, least_tokens=1).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, held(r["doc_id"], 1))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_lm_scores_against_brute_force(spark):
    """Every token's probability from the model's tables, one at a time: its group among all groups, its unit in the group, its share of a class."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    docs = documents(spark, rows)
    fitted = lm_score.fit(docs.where("crc32(CAST(doc_id AS STRING)) % 5 <> 1").select("doc_id", "text"), words_for_token=3.0, least_tokens=1)
    got = {r["doc_id"]: r["score"] for r in lm_score.lm_score(docs, fitted).collect()}
    m = fitted.model
    counts = {r["key"]: r["n"] for r in fitted.counts.collect()}
    unit_of = dict(zip(fitted.vocab.names.tolist(), fitted.vocab.unit.tolist()))
    end = int(fitted.vocab.of_class[lm_score.CLASSES])
    groups = list(zip(m.cuts[:-1], m.cuts[1:]))

    def softmax(vector, table, which):
        scores = [float(np.dot(vector, row[:-1]) + row[-1]) for row in table.astype(float)]
        top = max(scores)
        return np.exp(scores[which] - top) / sum(np.exp(x - top) for x in scores)

    for i, t in rows:
        if not i < 1030 or i in (8,):  # the longest is left out
            continue
        data, at = utf8(pa.array([lower(t)]))
        keys = [*lm_score.keys(Words(data, at, 0, 1)).tolist(), lm_score.END]
        classes = fitted.vocab.of_class
        units = [unit_of.get(k, int(classes[min(k & 127, lm_score.CLASSES)])) for k in keys]
        total = 0.0
        for at_, (k, u) in enumerate(zip(keys, units)):
            before = [units[at_ - p] if at_ >= p else end for p in range(1, lm_score.POSITIONS + 1)]
            vector = sum(m.context[b].astype(float) * m.place[p] for p, b in enumerate(before))
            g = next(j for j, (low, high) in enumerate(groups) if low <= u < high)
            low, high = groups[g]
            chance = softmax(vector, m.group, g) * softmax(vector, m.unit[low:high], u - low)
            if fitted.is_class[u]:
                of_class = [n for key, n in counts.items() if key & 127 == k & 127 and unit_of.get(key, u) == u]
                chance *= (counts.get(k, 0) + 0.5) / (sum(of_class) + 0.5 * (len(of_class) + 1))
            total += np.log10(chance)
        assert got[i] == pytest.approx(total, rel=1e-3), (i, t)


def test_lm_beats_the_unigram_on_held_out_texts(spark):
    got = lm_score.op2(spark, SF1).where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b", "sum(n_tokens) AS n").first()
    assert (got["s"] - got["b"]) / got["n"] > 0.3  # in log10 for each token


def chain(n_units: int, n: int, seed: int):
    """Tokens, each of which follows from one of the two before it for the most part, and their contexts."""
    rng = np.random.default_rng(seed)
    unit = np.zeros(n, np.int64)
    for t in range(2, n):
        r = rng.random()
        unit[t] = (unit[t - 1] + 1) % n_units if r < 0.5 else (unit[t - 2] + 7) % n_units if r < 0.8 else rng.integers(n_units)
    order = np.argsort(-np.bincount(unit, minlength=n_units), kind="stable")
    unit = np.argsort(order)[unit]  # units are numbered by falling counts
    words = lm_score.Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(lm_score.CLASSES + 1, np.int64))
    return unit, words.contexts(unit, np.array([0, n]))


def test_lm_probabilities_sum_to_one_and_training_helps():
    unit, before = chain(30, 40_000, 2)
    model = lm_score.Model.start(np.bincount(unit, minlength=30).astype(float), 16, 1)
    trainer = lm_score.Trainer(model, {k: np.full(len(getattr(model, k)), 1e-2, np.float32) for k in lm_score.Model.TABLES}, 0.1, 24, 5)
    bias = model.log_probabilities(before, unit).mean()
    trainer.learn(before, unit, 6, size=1024)
    trained = trainer.model
    for row in before[5:9]:
        chances = 10.0 ** trained.log_probabilities(np.tile(row, (30, 1)), np.arange(30))
        assert chances.sum() == pytest.approx(1, abs=1e-5) and chances.min() > 0
    assert trained.log_probabilities(before, unit).mean() > bias + 0.2
    assert not np.array_equal(model.context, trained.context) and model.place.shape == (lm_score.POSITIONS, 16)


def test_lm_contexts_stop_where_a_text_begins():
    words = lm_score.Vocabulary(*(np.zeros(0, np.int64) for _ in range(3)), np.full(lm_score.CLASSES + 1, 9))
    unit, first = np.array([1, 2, 9, 9, 3, 4, 5, 6, 9]), np.array([0, 3, 4, 9])
    got = words.contexts(unit, first)
    for d in range(3):
        for t in range(first[d], first[d + 1]):
            assert got[t].tolist() == [unit[t - p] if t - p >= first[d] else 9 for p in (1, 2, 3)]


def test_lm_without_training_rows(spark):
    only = [i for i in range(60) if held(i, 1)][:3]
    got = lm_score.lm_score(documents(spark, [(i, "a b") for i in only])).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(3, 0, 0)}
    assert lm_score.lm_score(documents(spark, [])).count() == 0
