import json

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import describe as D
from tallyforge.plans import models
from tallyforge.sources import filings as S
from tallyforge.streaming import arrivals


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


@pytest.fixture()
def folder(tmp_path):
    for day in ("2023-01-02_a", "2024-01-02_b"):
        at = tmp_path / "10k" / "XYZ" / day
        write(at / "filing_ref.json", {"ticker": "XYZ", "cik": 12, "form": "10-K", "accession_number": "0000012-24-000001", "filing_date": day[:10], "primary_document": "x.htm"})
        write(at / "filing_index.json", {"directory": {"item": [{"last-modified": "d", "name": "x.htm", "type": "t", "size": ""}, {"last-modified": "d", "name": "y.htm", "type": "t", "size": "7"}], "name": "n", "parent-dir": "p"}})
        write(at / "small.htm", "<p>small</p>")
        write(at / "large.htm", "<p>" + "large " * 50 + "</p>")
    write(tmp_path / "10k" / "ABC" / "2024-03-01_c" / "filing_ref.json", {"ticker": "ABC", "cik": 13, "accession_number": "1-2-3", "primary_document": "p.htm"})
    write(tmp_path / "10k" / "ABC" / "2024-03-01_c" / "primary_document.html", "<p>p</p>")
    write(tmp_path / "10k" / "ABC" / "2024-03-01_c" / "exhibit.htm", "<p>" + "e" * 999 + "</p>")
    return tmp_path


def test_filings_scan(spark, folder):
    refs = S.latest_folder(S.read_filings(spark, f"{folder}/10k/*/*/filing_ref.json"))
    assert {(r["ticker"], r["dir"]) for r in refs.collect()} == {("XYZ", "2024-01-02_b"), ("ABC", "2024-03-01_c")}
    docs = S.primary_document(S.read_html(spark, f"{folder}/10k/*/*/*.htm*"))
    assert {(r["ticker"], r["file"]) for r in docs.collect()} == {("XYZ", "large.htm"), ("ABC", "primary_document.html")}
    sizes = {(r["name"], r["size"]) for r in S.read_index(spark, f"{folder}/10k/XYZ/*/filing_index.json").collect()}
    assert sizes == {("x.htm", None), ("y.htm", 7)}
    urls = {r["u"] for r in refs.select(S.document_url(F.col("cik"), F.col("accession_number"), F.col("primary_document")).alias("u")).collect()}
    assert "https://www.sec.gov/Archives/edgar/data/12/000001224000001/x.htm" in urls
    named = S.with_company_name(refs, spark.createDataFrame([("XYZ", "Xyz Inc"), ("ABC", " ")], "ticker string, name string"))
    assert {(r["ticker"], r["company"]) for r in named.collect()} == {("XYZ", "Xyz Inc"), ("ABC", "ABC")}


def test_external_totals(spark, tmp_path):
    fact = lambda *rows: {"units": {"USD": [dict(zip(("fp", "fy", "val", "filed", "end"), r)) for r in rows]}}
    write(tmp_path / "CIK0000000001.json", {"facts": {"us-gaap": {"NetRevenues": fact(("FY", 2024, 9.0, "2025", "a")), "Revenues": fact(("FY", 2023, 5.0, "2024", "a"), ("Q1", 2024, 1.0, "2024", "b"))}}})
    write(tmp_path / "CIK0000000002.json", {"facts": {"us-gaap": {"SalesRevenueNet": fact(("FY", 2024, 7.0, "2025-01", "a"), ("FY", 2024, 8.4, "2025-02", "a"))}}})
    facts = S.read_facts(spark, f"{tmp_path}/*.json")
    years = spark.createDataFrame([(1, 2024), (2, 2024)], "cik long, year int")
    assert {(r["cik"], r["external_total"]) for r in S.external_totals(facts, years).collect()} == {(2, 8)}
    assert {(r["cik"], r["external_total"]) for r in S.external_totals(facts, years, strict_year=True).collect()} == {(1, 9), (2, 8)}


def test_limiter_and_fetcher():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = S.Limiter(2.0, lambda: now[0], sleep)
    for _ in range(3):
        limiter.wait()
    assert slept == [2.0, 2.0]
    with pytest.raises(ValueError):
        S.fetcher("nobody")


def test_download_keeps_going(spark):
    filings = spark.createDataFrame([("A", 1, "1-1", "a.htm"), ("B", 2, "2-2", "bad.htm")], "ticker string, cik long, accession_number string, primary_document string")

    def make():
        def fetch(url):
            if "bad" in url or "index" in url and "/1/" in url:
                raise OSError("gone")
            return b"<p>page</p>"

        return fetch

    got = {r["ticker"]: (r["ok"], r["html"], r["error"]) for r in S.download(filings, make).collect()}
    assert got == {"A": (True, "<p>page</p>", None), "B": (False, None, "gone")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", None, "x")], "k string, n int, extra string")
    S.write_csv(df, str(tmp_path / "csv"), ["k", "n", "missing"])
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["k", "n", "missing"] and back.count() == 2
    S.append_trace(df, str(tmp_path / "trace"))
    S.append_trace(df, str(tmp_path / "trace"))
    assert spark.read.json(str(tmp_path / "trace")).count() == 4
    assert S.load_index(spark, str(tmp_path / "none")) is None
    chunks = spark.createDataFrame([("T", "c1", "text")], "ticker string, chunk_id string, text string")
    S.save_index(chunks, models.embed(chunks), str(tmp_path / "index"))
    assert S.load_index(spark, str(tmp_path / "index"))[1].first()["v"].__len__() == 64


def test_replayed_models(spark):
    replies = spark.createDataFrame([(models.sha("p1"), "layout", '```json\n{"a": 1}\n```')], "prompt_sha string, stage string, reply string")
    prompts = spark.createDataFrame([("p1",), ("p2",)], "prompt string")
    got = {r["prompt"]: r["reply"] for r in models.ReplayClient(replies).answer(prompts, "layout").collect()}
    assert got == {"p1": '{"a": 1}', "p2": None}


def test_http_model_waits_and_repairs(spark):
    def post(url, body, headers):
        prompt = json.loads(body)["messages"][0]["content"]
        text = "no json" if prompt == "odd" else '{"ok": 1}'
        return 200, json.dumps({"choices": [{"message": {"content": text}}]})

    client = models.HttpClient("http://x", "m", "k", post, rpm=100_000)
    got = {r["prompt"]: r["reply"] for r in client.answer(spark.createDataFrame([("even",), ("odd",)], "prompt string"), "s").collect()}
    assert got == {"even": '{"ok": 1}', "odd": '{"ok": 1}'}
    replies, slept = iter([(429, "Please try again in 1.5s"), (503, ""), (200, json.dumps({"choices": [{"message": {"content": "{}"}}]}))]), []
    assert models.HttpClient("u", "m", "k", lambda *a: next(replies)).ask("p", slept.append) == "{}" and slept == [1.5, 2.0]


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(1, "2024-01-01 00:00:10", "a"), (1, "2024-01-01 00:00:20", "a"), (2, "2024-01-01 01:30:00", "b")]
    for k, (i, ts, kind) in enumerate(rows):
        write(source / f"{k}.json", {"id": i, "ts": ts, "kind": kind})
    stream = arrivals.filing_arrivals(spark, str(source), "id long, ts timestamp, kind string")
    once = arrivals.each_once(stream, "id", "ts")
    out = str(tmp_path / "out")
    arrivals.run_flow(once, lambda df: df.groupBy("kind").count(), out, str(tmp_path / "cp")).awaitTermination()
    assert {(r["kind"], r["count"]) for r in spark.read.parquet(out).collect()} == {("a", 1), ("b", 1)}
    query = arrivals.counts(stream, "ts", "1 hour", None, "kind").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r["kind"], r["n"]) for r in spark.table("counted").collect()} == {("a", 2), ("b", 1)}


def test_command_line(spark, folder, tmp_path):
    from tallyforge.__main__ import load, parser

    args = parser().parse_args(["single", "--filings", f"{folder}/10k", "--tickers", "xyz"])
    got = load(spark, args.filings, args.tickers, args.facts, args.year).collect()
    assert [(r["ticker"], r["external_total"]) for r in got] == [("XYZ", None)] and "large" in got[0]["html"]


def test_native_plans_have_no_python(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    python = {"q32b_without_subtotals", "q37_chunks", "q38_toc_density", "q45_headings", "q46_html_text", "q46b_page_headings", "q54_sections", "q55_keyword_windows"}
    for name, f in entry.queries().items():
        if name.startswith("q") and name not in python:
            plan = f(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
            assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


def test_from_tickers_to_a_download(spark, tmp_path):
    for cik, forms in ((320, ["8-K", "10-K", "10-K"]), (77, ["10-Q"])):
        n = range(len(forms))
        recent = {"form": forms, "accessionNumber": [f"0-{k}" for k in n], "filingDate": [f"2024-0{k + 1}-01" for k in n], "primaryDocument": [f"d{k}.htm" for k in n]}
        write(tmp_path / "sub" / f"CIK{cik:010d}.json", {"name": "n", "filings": {"recent": recent}})
    entries = spark.createDataFrame([("abc ", "320"), ("old", "77"), ("", "5"), ("zzz", None)], "ticker string, cik_str string")
    tickers = spark.createDataFrame([("ABC",), ("Old",), ("zzz",)], "ticker string")
    wanted = S.wanted_filings(entries, S.read_submissions(spark, f"{tmp_path}/sub/*.json"), tickers)
    assert [tuple(r) for r in wanted.collect()] == [("ABC", 320, "10-K", "0-1", "2024-02-01", "d1.htm")]
    got = S.download(wanted, lambda: lambda url: url.encode()).first()
    assert got["ok"] and got["html"].endswith("/320/01/d1.htm") and got["index"].endswith("/320/01/index.json")


def test_sinks_of_candidates_coverage_and_reports(spark, tmp_path):
    S.write_candidates(spark.createDataFrame([(1, "t")], "table_idx int, caption string"), str(tmp_path / "c"))
    assert [r["schema"] for r in spark.read.json(str(tmp_path / "c")).collect()] == ["table_candidates.v2"]
    for _ in range(2):  # written anew each time
        S.write_coverage(spark.createDataFrame([("A", True)], "ticker string, covered boolean"), str(tmp_path / "v"))
    assert [tuple(r) for r in S.read_coverage(spark, str(tmp_path / "v")).select("ticker", "covered").collect()] == [("A", True)]
    write(tmp_path / "report.json", {"tickers": {"V": {"ok": True, "segment_year": 2024, "validation": {"ok": True, "table_total": 40}}, "X": {"ok": False, "errors": ["none"]}}})
    got = {r["ticker"]: (r["ok"], r["errors"], r["validation"] and r["validation"]["table_total"]) for r in S.read_report(spark, str(tmp_path / "report.json")).collect()}
    assert got == {"V": (True, None, 40), "X": (False, ["none"], None)}


def test_reconciling_again_keeps_what_comes_nearer(spark):
    from tallyforge.operators import validate as V

    kind, asked = "filing_id int, income_total long, net_total long", []

    def extract(gaps):
        asked.append(None if gaps is None else sorted((r["filing_id"], r["gap_amount"]) for r in gaps.collect()))
        again = {None: [(1, 100, 100), (2, 100, 40), (3, 100, 60)], 2: [(2, 100, 99), (3, 100, 10)], 3: [(3, 100, 50)]}
        return spark.createDataFrame(again[None if gaps is None else len(asked)], kind)

    got = {r["filing_id"]: (r["status"], r["net_total"]) for r in V.iterate(extract).collect()}
    assert got == {1: ("PASS", 100), 2: ("PASS", 99), 3: (got[3][0], 60)} and got[3][0] != "PASS"  # no pass made 3 worse
    assert [x and [i for i, _ in x] for x in asked] == [None, [2, 3], [3]]


def test_key_items_of_a_summary(spark):
    rows = spark.createDataFrame([(1, "Cloud", "We sell. Offerings include Azure Cloud, GeForce RTX and H100. More.")], "filing_id int, segment string, text string")
    got = models.key_items(rows).orderBy("pos").collect()
    assert "Azure Cloud" in {r["item"] for r in got}
    assert {r["span"] for r in got} == {"Offerings include Azure Cloud, GeForce RTX and H100."}
    assert "Azure Cloud" in {r["item"] for r in D.accepted_items(models.key_items(rows), "filing_id").collect()}
    assert D.accepted_items(models.key_items(rows).withColumn("span", F.lit("words that stand nowhere in it")), "filing_id").count() == 0


def test_key_items_that_are_whole_sentences(spark):
    """Names stay in lists of names; a plain word of its own needs another sentence, which is its evidence then."""
    rows = spark.createDataFrame([(1, "A", "More. GeForce RTX. H100."), (2, "B", "Windows. We sell Windows.")], "filing_id int, segment string, text string")
    got = {(r["filing_id"], r["item"], r["span"]) for r in models.key_items(rows).collect()}
    assert not any(item == "More" for _, item, _ in got)
    assert (1, "H100", "H100.") in got and (2, "Windows", "We sell Windows.") in got


def test_more_words_than_literals(spark):
    from tallyforge.operators import joins as J

    labels = spark.createDataFrame([("Net Sales",), ("ad",), ("zzz",), (None,)], "label string")
    words = spark.createDataFrame([("sales",), ("Adverts",), ("net",), (None,)], "word string")
    one, other = (sorted(map(tuple, J.containing(labels, words, most=n).collect())) for n in (1000, 2))
    assert one == other == [("Net Sales", "net"), ("Net Sales", "sales"), ("ad", "Adverts")]
