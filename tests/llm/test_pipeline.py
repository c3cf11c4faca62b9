"""The pipeline's stages, each against brute force on its own input, and the registry with and without the operators."""

import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline

from .helpers import SF, contamination, jaccard_groups

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF)
        done.write.parquet(str(folder / name))
        out[name] = (docs, spark.read.parquet(str(folder / name)))
        docs = out[name][1]
    return out


def test_stages_return_the_columns_of_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    assert after.join(marks.where("quality = 1"), "doc_id").count() >= 0.98 * before.join(marks.where("quality = 1"), "doc_id").count()
    assert after.join(marks.where("quality = 0"), "doc_id").count() <= 0.1 * before.join(marks.where("quality = 0"), "doc_id").count() + 1


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    groups = jaccard_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, (_, c) in groups.items() if i == c}


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    words = [f"w{k}" for k in range(49)]
    near = [*words[:24], "other", *words[25:]]  # 40 of 50 shingles of five words, 42 of 50 of four
    far = [*words[:20], "x1", *words[21:30], "x2", *words[31:]]
    docs = spark.createDataFrame([(k, " ".join(w), "en", "s", 1) for k, w in enumerate((words, near, far))], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in STAGES["near_duplicates"](spark, docs, SF).collect()} == {0, 2}


def test_benchmark_stage(spark, stages):
    before, after = stages["benchmark"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect() if not contamination(r["text"], items)[1]}


def test_mixture_stage(stages):
    before, after = stages["mixture"]
    have = {r["doc_id"] for r in before.collect()}
    counts = after.groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in counts} <= have and max(r["count"] for r in counts) <= 2


def test_token_stage(stages):
    before, after = stages["token_ids"]
    got = after.orderBy("start").collect()
    assert len(got) == before.count() and got[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in before.collect())


def test_run_gives_the_last_stages_rows(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages["token_ids"][1])


def test_stages_take_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a b c d e f", "en", "s", 3), (2, "", "en", None, 0), (2, "x y z w v", "en", "s", 1), (3, "x y z w v", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS key", "'a' AS reps", "array(1) AS row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() >= 0, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert STAGES["token_ids"](spark, docs, SF).count() == 5


def test_registry(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and all(isinstance(x, str) for x in entry.oracle_sql().values())


@pytest.mark.parametrize("name", ["op1_decontaminate", "op8_mix_sources", "op9_license_scan"])
def test_same_as_duckdb(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, other = entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(other.columns)
    plain = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    order = lambda columns: sorted(range(len(columns)), key=lambda k: columns[k])
    listed = lambda columns, found: sorted(tuple(plain(r[k]) for k in order(columns)) for r in found)
    assert listed(df.columns, df.collect()) == listed(other.columns, other.fetchall())


def test_the_rest_stands_without_the_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; n = e.queries(); e.oracle_sql(); print(len(n), any(x.startswith('op') or x == 'pipeline' for x in n))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0 and done.stdout.split()[-1] == "False", done.stderr[-500:]
