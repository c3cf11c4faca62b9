"""Where filings come from and where results go: cached JSON, HTML folders, a rate-limited download source, CSV and JSON sinks."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from ..operators import windows as W

FILING = "ticker string, cik long, form string, accession_number string, filing_date string, primary_document string"
INDEX = "directory struct<item:array<struct<`last-modified`:string,name:string,type:string,size:string>>,name:string,`parent-dir`:string>"
SUBMISSIONS = "name string, filings struct<recent:struct<form:array<string>,accessionNumber:array<string>,filingDate:array<string>,primaryDocument:array<string>>>"
FACTS = "facts struct<`us-gaap`:map<string,struct<units:map<string,array<struct<fp:string,fy:int,val:double,filed:string,end:string>>>>>>"
REPORT = (
    "tickers map<string,struct<ok:boolean,errors:array<string>,artifacts_dir:string,html_path:string,sec_doc_url:string,income_statement_table_id_guess:string,segment_year:int,n_segments:int,"
    "validation:struct<ok:boolean,table_total:bigint,segment_sum:bigint,adjustment_sum:bigint,external_total:bigint,delta_pct:double,notes:string>>>"
)
ARCHIVES = "https://www.sec.gov/Archives/edgar/data"


# --- derived columns ----------------------------------------------------------------------------


def cik10(cik: Column) -> Column:
    return F.lpad(cik.cast("string"), 10, "0")


def bare_accession(accession: Column) -> Column:
    return F.regexp_replace(accession, "-", "")


def document_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat_ws("/", F.lit(ARCHIVES), cik.cast("bigint").cast("string"), bare_accession(accession), document)


def index_url(cik: Column, accession: Column) -> Column:
    return F.concat_ws("/", F.lit(ARCHIVES), cik.cast("bigint").cast("string"), bare_accession(accession), F.lit("index.json"))


# --- scans --------------------------------------------------------------------------------------


def folder(path: Column) -> Column:
    """The (ticker, date_accession) part of a path …/TICKER/folder/file."""
    parts = F.split(path, "/")
    return F.struct(F.element_at(parts, -3).alias("ticker"), F.element_at(parts, -2).alias("dir"), F.element_at(parts, -1).alias("file"))


def read_filings(spark: SparkSession, glob: str) -> DataFrame:
    """filing_ref.json files with their folder; a file without an accession number is an error."""
    df = spark.read.schema(FILING).option("multiLine", True).json(glob).select("*", folder(F.col("_metadata.file_path")).alias("at"))
    ok = F.assert_true(F.col("accession_number").isNotNull(), "filing_ref.json without accession_number")
    return df.where(ok.isNull()).withColumn("dir", F.col("at.dir")).drop("at")


def read_index(spark: SparkSession, glob: str) -> DataFrame:
    """(ticker, dir, name, type, size, last_modified) of each file in the filing indexes; a blank size is null."""
    df = spark.read.schema(INDEX).option("multiLine", True).json(glob).select(folder(F.col("_metadata.file_path")).alias("at"), F.explode("directory.item").alias("i"))
    return df.select("at.ticker", "at.dir", "i.name", "i.type", F.col("i.size").try_cast("bigint").alias("size"), F.col("i.`last-modified`").alias("last_modified"))


def read_submissions(spark: SparkSession, glob: str) -> DataFrame:
    """(path, name, form[], accessionNumber[], filingDate[], primaryDocument[])."""
    df = spark.read.schema(SUBMISSIONS).option("multiLine", True).json(glob)
    return df.select(F.col("_metadata.file_path").alias("path"), "name", "filings.recent.*")


def read_facts(spark: SparkSession, glob: str) -> DataFrame:
    df = spark.read.schema(FACTS).option("multiLine", True).json(glob)
    return df.select(F.col("_metadata.file_path").alias("path"), F.regexp_extract("_metadata.file_path", r"(\d{10})", 1).cast("bigint").alias("cik"), "facts")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, ok, …, validation) of a run report."""
    df = spark.read.schema(REPORT).option("multiLine", True).json(path)
    return df.select(F.explode("tickers").alias("ticker", "r")).select("ticker", "r.*")


def read_html(spark: SparkSession, glob: str) -> DataFrame:
    """(ticker, dir, file, length, html) of whole files; the file name and length prune before any content is read."""
    df = spark.read.format("binaryFile").load(glob)
    return df.select(folder(F.col("path")).alias("at"), "length", F.decode("content", "UTF-8").alias("html")).select("at.*", "length", "html")


def latest_folder(files: DataFrame) -> DataFrame:
    """Of each ticker the folder that is last by name."""
    last = files.groupBy("ticker").agg(F.max("dir").alias("dir"))
    return files.join(last, ["ticker", "dir"])


def primary_document(files: DataFrame) -> DataFrame:
    """Of each folder primary_document.html, else the largest .htm or .html file."""
    pages = files.where(F.lower("file").rlike(r"\.html?$"))
    rest = [c for c in pages.columns if c not in ("ticker", "dir")]
    best = pages.groupBy("ticker", "dir").agg(F.max_by(F.struct(*rest), F.struct((F.col("file") == "primary_document.html"), "length", "file")).alias("r"))
    return best.select("ticker", "dir", "r.*")


def with_company_name(filings: DataFrame, names: DataFrame) -> DataFrame:
    """The name of names(ticker, name), or the ticker where it is missing or blank."""
    return filings.join(names.select("ticker", F.nullif(F.trim("name"), F.lit("")).alias("_n")), "ticker", "left").withColumn("company", F.coalesce("_n", "ticker")).drop("_n")


def external_totals(facts: DataFrame, years: DataFrame, strict_year: bool = False) -> DataFrame:
    """(cik, year, external_total) from (cik, facts) and (cik, year).

    The first tag by priority that a company has decides, even if it lacks the year; with strict_year the
    first that has it.  Of a tag's yearly figures the one with the latest (filed, end).
    """
    tags = F.array(*[F.lit(t) for t in fixed.XBRL_TAGS])
    rows = facts.select("cik", F.explode("facts.`us-gaap`").alias("tag", "u")).withColumn("place", F.array_position(tags, F.col("tag"))).where("place > 0")
    usd = rows.select("cik", "place", F.explode_outer(F.col("u.units")["USD"]).alias("f")).select("cik", "place", "f.*")
    yearly = usd.where("fp = 'FY' AND val IS NOT NULL").join(years.select("cik", F.col("year").alias("fy")).distinct(), ["cik", "fy"])
    newest = yearly.groupBy("cik", "fy", "place").agg(F.max_by("val", F.struct("filed", "end")).alias("val"))
    if strict_year:
        best = newest.groupBy("cik", "fy").agg(F.min_by("val", "place").alias("val"))
    else:
        best = newest.join(rows.groupBy("cik").agg(F.min("place").alias("place")), ["cik", "place"])
    return best.select("cik", F.col("fy").alias("year"), F.bround("val", 0).cast("bigint").alias("external_total"))


def ticker_ciks(entries: DataFrame) -> DataFrame:
    """(ticker, cik) from entries(ticker, cik_str): upper case, blanks out."""
    return entries.select(F.upper(F.trim("ticker")).alias("ticker"), F.col("cik_str").cast("bigint").alias("cik")).where("ticker <> '' AND cik IS NOT NULL").groupBy("ticker").agg(F.max("cik").alias("cik"))


def form_counts(forms: DataFrame, most: int = 10) -> DataFrame:
    """(form, n) of the most frequent forms; equal counts in order of appearance. forms(form, pos)."""
    return forms.groupBy("form").agg(F.count("*").alias("n"), F.min("pos").alias("_p")).orderBy(F.desc("n"), "_p").limit(most).drop("_p")


def still_wanted(wanted: DataFrame, downloaded: DataFrame) -> DataFrame:
    """Companies that have no folder yet, by name."""
    return wanted.join(downloaded.select("ticker").distinct(), "ticker", "left_anti").orderBy("name")


def wanted_filings(entries: DataFrame, submissions: DataFrame, tickers: DataFrame, forms: tuple[str, ...] = ("10-K",)) -> DataFrame:
    """What download takes: of each company of tickers(ticker) the first filing, as listed, of an allowed form.

    entries(ticker, cik_str) name the companies' numbers, submissions(path, form[], …) are those of read_submissions, whose file names hold them.
    """
    ciks = ticker_ciks(entries).join(tickers.select(F.upper(F.trim("ticker")).alias("ticker")).distinct(), "ticker")
    listed = submissions.withColumn("cik", F.regexp_extract("path", r"(\d{10})[^/]*$", 1).try_cast("bigint")).join(ciks, "cik")
    first = W.first_filing(listed, forms).join(ciks, "ticker")
    return first.select("ticker", "cik", "form", F.col("accessionNumber").alias("accession_number"), F.col("filingDate").alias("filing_date"), F.col("primaryDocument").alias("primary_document"))


# --- download -----------------------------------------------------------------------------------


class Limiter:
    """At most one call in `interval` seconds."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep, self.last = interval, clock, sleep, float("-inf")

    def wait(self) -> None:
        left = self.last + self.interval - self.clock()
        if left > 0:
            self.sleep(left)
        self.last = self.clock()


def fetcher(contact: str, interval: float = 0.2) -> Callable[[str], bytes]:
    """A reader of URLs that names a contact address, as the archive asks, and keeps its distance."""
    if "@" not in contact:
        raise ValueError("the user agent needs a contact e-mail address")
    limiter = Limiter(interval)

    def fetch(url: str) -> bytes:
        limiter.wait()
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": contact}), timeout=30) as reply:
            return reply.read()

    return fetch


def download(filings: DataFrame, make_fetch: Callable[[], Callable[[str], bytes]]) -> DataFrame:
    """filings(ticker, cik, accession_number, primary_document) with ok, error, html and index of each; one failure stops no other.

    One partition, so that the limit on requests holds for all: the archive's rate, not the cluster, is the bound here.
    """
    rows = filings.select("ticker", document_url(F.col("cik"), F.col("accession_number"), F.col("primary_document")).alias("url"), index_url(F.col("cik"), F.col("accession_number")).alias("index_url")).coalesce(1)

    def run(frames: Iterator) -> Iterator:
        fetch = make_fetch()
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                page, error, index = None, None, None
                try:
                    page = fetch(row.url).decode("utf-8", "replace")
                    try:  # the index is wanted, not needed
                        index = fetch(row.index_url).decode("utf-8", "replace")
                    except Exception:  # noqa: BLE001
                        index = None
                except Exception as e:  # noqa: BLE001
                    error = str(e)
                out.append((row.ticker, row.url, error is None, error, page, index))
            yield type(pdf)(out, columns=["ticker", "url", "ok", "error", "html", "index"])

    return rows.mapInPandas(run, "ticker string, url string, ok boolean, error string, html string, index string")


# --- sinks --------------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The named columns with a header; missing ones blank, others dropped, nulls blank."""
    have = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*have).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_candidates(candidates: DataFrame, path: str) -> None:
    """Candidate tables as JSON with a schema version."""
    candidates.withColumn("schema", F.lit("table_candidates.v2")).write.mode("overwrite").json(path)


def append_trace(events: DataFrame, path: str) -> None:
    """Append events to a JSON log."""
    events.write.mode("append").json(path)


def sheets(tables: dict[str, DataFrame], path: str) -> None:
    """One sheet for each small table, where a spreadsheet library is installed."""
    try:
        import openpyxl
    except ImportError as e:
        raise RuntimeError("writing sheets needs openpyxl") from e
    book = openpyxl.Workbook()
    book.remove(book.active)
    for name, df in tables.items():
        sheet = book.create_sheet("".join("_" if c in "[]:*?/\\" else c for c in name)[:31].strip() or "Sheet")
        sheet.append(df.columns)
        for row in df.toLocalIterator():
            sheet.append([*row])
    book.save(path)


def save_index(chunks: DataFrame, vectors: DataFrame, path: str) -> None:
    """Chunks and their vectors by ticker."""
    chunks.write.mode("overwrite").partitionBy("ticker").parquet(f"{path}/chunks")
    vectors.write.mode("overwrite").partitionBy("ticker").parquet(f"{path}/vectors")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """What save_index wrote; None if it is missing or unreadable."""
    from pyspark.errors import PySparkException

    try:
        return spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/vectors")
    except PySparkException:
        return None


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def write_coverage(coverage: DataFrame, path: str) -> None:
    coverage.write.mode("overwrite").json(path)


def companies(spark: SparkSession, path: str) -> DataFrame:
    """(name, ticker, industry) of a company list with a header; tickers in upper case, each once."""
    rows = spark.read.option("header", True).schema("name string, ticker string, industry string").csv(path)
    return rows.select(F.trim("name").alias("name"), F.upper(F.trim("ticker")).alias("ticker"), F.trim("industry").alias("industry")).where("ticker <> ''").dropDuplicates(["ticker"])
