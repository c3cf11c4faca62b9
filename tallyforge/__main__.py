"""python -m tallyforge single|multi --filings GLOB --out DIR: run a flow over folders of downloaded filings."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import flows
from .sources import filings as S

COLUMNS = ["company", "ticker", "revenue_group", "revenue_line", "description", "source", "fiscal_year", "revenue_musd"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyforge", description=__doc__)
    p.add_argument("flow", choices=["single", "multi"])
    p.add_argument("--filings", required=True, help="folder of TICKER/date_accession/*.html and filing_ref.json")
    p.add_argument("--facts", help="folder of company facts as JSON, for external totals")
    p.add_argument("--tickers", help="comma-separated; all by default")
    p.add_argument("--year", type=int, help="the year of the external totals")
    p.add_argument("--out", default="out")
    p.add_argument("--tolerance", type=float)
    return p


def load(spark: SparkSession, folder: str, tickers: str | None, facts: str | None, year: int | None) -> DataFrame:
    """(filing_id, ticker, company, html, external_total) of the newest folder of each ticker."""
    refs = S.latest_folder(S.read_filings(spark, f"{folder}/*/*/filing_ref.json").select("ticker", "dir", "cik"))
    pages = S.primary_document(S.read_html(spark, f"{folder}/*/*/*.htm*"))
    out = pages.join(refs, ["ticker", "dir"]).select(F.concat_ws("/", "ticker", "dir").alias("filing_id"), "ticker", F.col("ticker").alias("company"), "cik", "html")
    if tickers:
        out = out.where(F.col("ticker").isin(*tickers.upper().split(",")))
    if facts and year:
        totals = S.external_totals(S.read_facts(spark, f"{facts}/*.json"), out.select("cik", F.lit(year).alias("year")))
        return out.join(totals.select("cik", "external_total"), "cik", "left")
    return out.withColumn("external_total", F.lit(None).cast("bigint"))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tallyforge").getOrCreate()
    filings = load(spark, args.filings, args.tickers, args.facts, args.year)
    if args.flow == "single":
        lines, checked = flows.single_table(filings, tolerance=args.tolerance or 0.02)
        S.write_csv(lines, f"{args.out}/csv1_segment_revenue", COLUMNS)
    else:
        items, checked = flows.multi_table(filings, args.year, tolerance=args.tolerance or 0.05)
        S.write_csv(items, f"{args.out}/csv1_segment_revenue", ["filing_id", "name", "kind", "value"])
    checked.write.mode("overwrite").json(f"{args.out}/run_report")


if __name__ == "__main__":
    main()
