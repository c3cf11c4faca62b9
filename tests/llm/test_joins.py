"""Decontamination and the Jaccard join against brute force."""

import hashlib
import random
import time

import pytest

from tallyforge.llm import decontaminate, jaccard_join
from tallyforge.llm.common import checkpoint

from .helpers import ODD, SF, contamination, jaccard_groups, twins


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'x' AS spans", "1 AS n_words", "text", "array(1) AS bands")


def near_copies(seed: int) -> list[str]:
    rng, out = random.Random(seed), []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(rng.choice((20, 60, 150)))]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(8)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_jaccard_groups(spark, block):
    rows = list(enumerate([*near_copies(5), *ODD, "A  B", "a b", "a b c d", "a b c d e"]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows), block=block).collect()}
    assert got == jaccard_groups(rows)


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_jaccard_of_the_test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.op5(spark, folder).collect()}
    assert got == jaccard_groups(rows)


def test_frequent_shingles_change_no_link(spark):
    """Nearly all shingles count as frequent, so the order of the first ones is another."""
    rows = list(enumerate(near_copies(6)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows), block=7, least=3).collect()}
    assert got == jaccard_groups(rows)


def test_a_large_group_of_near_copies_lists_few_pairs(spark, monkeypatch):
    """Most of its pairs link or nearly do; texts of a few for each member are compared, and a pair is listed once for all its nodes."""
    rng, base, rows = random.Random(9), [f"w{i}" for i in range(150)], []
    for k in range(240):
        words = list(base)
        for _ in range(rng.choice((2, 2, 3, 4))):
            words[rng.randrange(150)] = f"x{k}y{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    listed, compared, cross, linked = [], [], jaccard_join.cross_pairs, jaccard_join.linked

    def counted(*args, **more):
        out = cross(*args, **more).cache()
        listed.append((out.count(), out.select("a", "b").distinct().count()))
        return out

    def verified(pairs, *args):
        compared.append(pairs.count())
        return linked(pairs, *args)

    monkeypatch.setattr(jaccard_join, "cross_pairs", counted)
    monkeypatch.setattr(jaccard_join, "linked", verified)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == jaccard_groups(rows)
    assert sum(compared) < 20 * len(rows), compared
    assert listed[-1][0] < 2 * listed[-1][1] + len(rows), listed


def test_a_pair_counts_once_for_all_listed_nodes():
    import numpy as np

    rng = random.Random(2)
    for listed in (3, 100):
        nodes = [sorted(rng.sample(range(30), rng.randrange(1, 12))) for _ in range(20)]
        pairs = np.array([(i, j) for i in range(20) for j in range(i)])
        total = np.zeros(len(pairs), int)
        times = np.zeros(len(pairs), int)
        for key in range(30):
            here = [k for k in range(20) if key in nodes[k]]
            place = {k: i for i, k in enumerate(here)}
            at = [p for p, (i, j) in enumerate(pairs) if i in place and j in place]
            if at:
                keys = np.full((len(here), 12), -1)
                for k, i in place.items():
                    keys[i, : len(nodes[k][:listed])] = nodes[k][:listed]
                c = jaccard_join._common(key, keys, *(np.array([place[k] for k in pairs[at, side]]) for side in (0, 1)))
                total[at] += c
                times[at] += c > 0
        both = np.array([len({*nodes[i]} & {*nodes[j]}) for i, j in pairs])
        assert (total == both).all() and (listed == 3 or times.max() == 1)


def test_a_crowd_is_visited_under_few_of_its_shingles(spark, monkeypatch):
    """Members of several components that share nearly all first shingles go to the nodes of some of these, and no link is lost."""
    rng, rows = random.Random(4), []
    for g in range(8):  # eight groups that share 115 of 150 words and don't link
        base = [f"w{i}" if i < 115 else f"g{g}w{i}" for i in range(150)]
        for _ in range(20):
            words = list(base)
            for _ in range(rng.choice((1, 2, 3))):
                words[rng.randrange(150)] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    counts, task_rows = [], jaccard_join.task_rows

    def counted(dealt, num, den):
        out = task_rows(dealt, num, den)
        tasks = jaccard_join.node_pairs(dealt, num, den).join(dealt, ["key", "node"])
        counts.append((out.count(), tasks.count()))
        return out

    monkeypatch.setattr(jaccard_join, "task_rows", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows), block=16, least=16).collect()}
    assert got == jaccard_groups(rows)
    assert counts and 0 < counts[0][0] < 0.7 * counts[0][1], counts


@pytest.mark.parametrize("listed", [2, 96])
@pytest.mark.parametrize("block", [8, 30])
def test_lists_of_any_length_lose_no_link(spark, monkeypatch, listed, block):
    monkeypatch.setattr(jaccard_join, "LISTED", listed)
    rows = list(enumerate([t for seed in (3, 8) for t in near_copies(seed)]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows), block=block, least=4).collect()}
    assert got == jaccard_groups(rows)


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    for narrow in (False, True):
        assert len(checkpoint(spark.range(1000).repartition(5).groupBy("id").count(), narrow=narrow).collect()) == 1000
    until = time.time() + 20  # executors are told, not waited for
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_doc_id_with_several_texts(spark):
    """A row for each row given, each linked by its own text."""
    near = " ".join(f"w{k}" for k in range(40))
    rows = [(1, near + " x"), (2, "quite another text of some words"), (2, near), (3, near), (2, near), (4, "quite another text of some words"), (5, None), (5, None)]
    got = sorted(tuple(r) for r in jaccard_join.jaccard_join(documents(spark, rows)).collect())
    by_place = jaccard_groups(list(enumerate(t for _, t in rows)))
    classes = {}
    for k, (n, c) in by_place.items():
        classes.setdefault(c, []).append(rows[k][0])
    assert got == sorted((rows[k][0], n, min(classes[c])) for k, (n, c) in by_place.items())
    kept = sorted((r["doc_id"], r["text"] or "") for r in jaccard_join.one_of_each(documents(spark, rows)).collect())
    assert kept == [(1, near + " x"), (2, "quite another text of some words"), (5, "")]


def test_strings_that_polynomial_hashes_take_for_one(spark):
    x, y = twins()
    rows = [(1, f"{x} {y} {x} {x} {y} {y}"), (2, f"{y} {x} {y} {y} {x} {x}"), (3, f"{x} b c d e f"), (4, f"{y} b c d e f")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == jaccard_groups(rows) and got[1][1] != got[2][1]


def test_exact_shingles():
    import numpy as np
    import pyarrow as pa

    from tallyforge.llm.common import Words, utf8

    texts = ["a b c d a b c d e", "", "x", "b c d e f", "a b c d"]
    data, at = utf8(pa.array(texts))
    doc, code = jaccard_join.exact_shingles(Words(data, at, 0, len(texts)), 4)
    assert np.bincount(doc, minlength=5).tolist() == [5, 0, 0, 2, 1]
    assert len({*code}) == 6 and set(code[doc == 4]) < set(code[doc == 0]) and len(set(code[doc == 3]) & set(code[doc == 0])) == 1


def test_jaccard_empty_table(spark):
    assert jaccard_join.jaccard_join(documents(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_null_ids(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "z y x w"), (None, "a b c d e f"), (2, "z y x w"), (4, None)]
    out = jaccard_join.one_of_each(documents(spark, rows))
    assert out.columns == ["doc_id", "spans", "n_words", "text", "bands"]
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 2, 4]


def items():
    return [(1, "one two three four five six seven eight nine ten eleven"), (2, "short Item"), (3, None), (4, "!!"), (5, "ONE-two three, four five six seven eight nine ten"), (10, "ça va très bien")]


def texts():
    return [*ODD, "x one two three four five six seven eight nine ten eleven y", "ONE, two; three four five six seven eight nine ten.", "a short item and a short item", "shortitem", "short  ITEMS", "Ça va très bien", "one two three four five six seven eight nine"]


@pytest.mark.parametrize("most_nodes", [4 << 20, 200])
def test_contamination(spark, most_nodes):
    benchmark = spark.createDataFrame([*items(), (None, "word")], "item_id long, text string")
    docs = documents(spark, list(enumerate(texts())))
    got = {r["doc_id"]: r for r in decontaminate.hits(docs, benchmark, 10, most_nodes).collect()}
    for i, t in enumerate(texts()):
        n, hit, who = contamination(t, items())
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(who), hit > 0), t
        assert r["items_sha256"] == hashlib.sha256(",".join(who).encode()).hexdigest()
    kept = {r["doc_id"] for r in decontaminate.clean(docs, benchmark, 10, most_nodes).collect()}
    assert kept == {i for i, t in enumerate(texts()) if not contamination(t, items())[1]}


def test_matches_of_few_words_against_every_window():
    """Items and texts over three words, so that runs overlap, shift and repeat."""
    rng = random.Random(8)
    for _ in range(150):
        items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(16)))) for i in range(4)]
        text = " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))
        for width in (1, 2, 4, 10):
            matcher = decontaminate.Matcher(items, width)
            hit, who = set(), set()
            for low, high, item in matcher.find(decontaminate.normalise(text.encode()).decode()):
                hit |= set(range(low // 2, high // 2))
                who.add(str(item))
            assert (len(text.split()), len(hit), sorted(who)) == contamination(text, items, width), (items, text, width)


def test_the_automaton_of_a_large_benchmark_is_small():
    rng = random.Random(3)
    items = [(k, " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60))) for k in range(400)]
    matcher = decontaminate.Matcher(items, 10)
    assert matcher.automaton.get_stats()["nodes_count"] < 2 * sum(len(t) for _, t in items)


def test_spans_are_places_in_the_original(spark):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    text = "é -- A ShOrT,  item!"
    row = decontaminate.decontaminate(documents(spark, [(1, text)]), benchmark).first()
    assert [text.encode()[s["start"] : s["end"]].decode() for s in row["spans"]] == ["ShOrT,  item"]
    assert decontaminate.original_spans(text, [(1, 2), (2, 4)]) == [(6, 20)] or decontaminate.original_spans(text, [(1, 2)])


def test_empty_tables(spark):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    assert decontaminate.decontaminate(documents(spark, []), benchmark).count() == 0
    none = decontaminate.decontaminate(documents(spark, [(1, "short item")]), benchmark.limit(0)).first()
    assert not none["contaminated"] and none["n_words"] == 2


def test_rows_without_an_id(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (None, "x y z w v"), (None, None)]
    got = sorted(map(str, jaccard_join.jaccard_join(documents(spark, rows)).selectExpr("n_shingles", "component_id").collect()))
    assert got == sorted(["Row(n_shingles=3, component_id=3)"] * 2 + ["Row(n_shingles=2, component_id=None)", "Row(n_shingles=0, component_id=None)"])


def test_components_of_chains_and_stars(spark):
    from tallyforge.llm.graph import components

    rng = random.Random(4)
    names = list(range(120))
    rng.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(59)] + [(names[60], names[k]) for k in range(61, 110)] + [(7, 7)]
    up = {v: v for v in range(120)}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame([(v,) for v in range(120)], "v long"), spark.createDataFrame(edges, "a long, b long"))
    assert {r["v"]: r["label"] for r in got.collect()} == {v: find(v) for v in range(120)}
    none = components(spark.createDataFrame([(1,)], "v long"), spark.createDataFrame([], "a long, b long"))
    assert [tuple(r) for r in none.collect()] == [(1, 1)]
