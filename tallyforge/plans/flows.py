"""The two assembled flows over all filings at once: one table each, and several tables reconciled to the income statement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stages import cut
from ..operators import classify as C
from ..operators import describe as D
from ..operators import extract as X
from ..operators import html as H
from ..operators import joins as J
from ..operators import validate as V
from ..operators import windows as W
from . import models

K = list(X.KEYS)


@dataclass
class Tables:
    """What both flows share of a set of filings."""

    filings: DataFrame
    pages: DataFrame
    grid: DataFrame
    candidates: DataFrame
    segments: DataFrame

    @classmethod
    def of(cls, filings: DataFrame, preview_cols: int = 10) -> Tables:
        """filings(filing_id, ticker, company, html[, external_total])."""
        pages = cut(H.parsed(filings, "filing_id"))
        grid = cut(H.grid(pages, "filing_id").drop("marks"))
        candidates = cut(H.candidates(pages, "filing_id", preview_cols=preview_cols))
        candidates = candidates.join(filings.select("filing_id", "ticker"), "filing_id")
        labels = F.array_join("row_label_preview", " ")
        core = T.clean(F.concat_ws(" ", "caption_text", "heading_context", F.array_join(F.slice("row_label_preview", 1, 8), " "), "nearby_text_context"))
        grid_text = F.array_join(F.transform(F.slice("preview", 1, 10), lambda r: F.array_join(r, " ")), " ")
        full = T.clean(F.concat_ws(" ", "caption_text", "heading_context", "nearby_text_context", "year_header_text", labels, grid_text))
        candidates = candidates.withColumn("gate", C.table_gate(core, full)).withColumn("blob", full).withColumn("labels", labels)
        candidates = candidates.withColumn("context", F.concat_ws(" ", "caption_text", "heading_context", "nearby_text_context"))
        candidates = cut(candidates.withColumn("dimension", C.table_dimension(F.col("caption_text"), F.col("heading_context"), F.col("row_label_preview"), F.col("ticker"))))
        spark = filings.sparkSession
        segments = cut(models.business_lines(J.item_segments(spark), filings, H.headings(pages, "filing_id")))
        return cls(filings, pages, grid, candidates, segments)

    def per_table(self) -> DataFrame:
        """Expected segments of each table."""
        return self.candidates.select(*K).join(self.segments, "filing_id")


def extracted(t: Tables, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and totals of the chosen tables by the first strategy that works."""
    grid = cut(t.grid.join(chosen.select(*K).distinct(), K))
    layout, years = (cut(x) for x in models.layouts(grid, t.candidates))
    tables = t.candidates.select(*K, "ticker", "dimension")
    return X.with_fallback(grid, layout, years, cut(t.per_table().join(chosen.select(*K).distinct(), K)), tables, J.item_segments(grid.sparkSession), *K)


def single_table(filings: DataFrame, hints: DataFrame | None = None, tolerance: float = 0.02) -> tuple[DataFrame, DataFrame]:
    """(lines, validations): for each filing the first table, in attempt order, whose rows are sane and add up.

    All candidate tables are extracted side by side, and the first success is picked afterwards.
    """
    t = Tables.of(filings)
    spark = filings.sparkSession
    allowed = t.candidates.where("gate.ok")
    some = allowed.unionByName(t.candidates.join(allowed.select("filing_id").distinct(), "filing_id", "left_anti"))  # all, where the gate leaves none
    from ..functions import fixed

    hints = hints if hints is not None else spark.createDataFrame(list(fixed.KEYWORD_HINTS), "ticker string, hint string")
    picked = models.choose_table(some)
    ways = some.withColumn("b", C.is_breakdown(F.col("labels"))).where("b.is_match").select(*K, F.col("b.is_geography").alias("is_geography"))
    attempts = cut(W.attempt_order(picked.where("pick = 1"), ways, W.hint_rank(some, hints, "filing_id"), "filing_id"))

    rows, totals = extracted(t, attempts)
    hint = F.lower(F.concat_ws(" ", "caption_text", "heading_context"))
    sane = C.sane_tables(rows.where("row_type <> 'adjustment'").join(t.candidates.select(*K, hint.alias("hint")), K), *K).where("sane").select(*K)
    kept = cut(C.without_total_rows(C.without_cost_rows(rows.join(sane, K)), *K))
    # a table that lost rows is summed by item, another by segment
    lost = rows.groupBy(*K).agg(F.count("*").alias("had")).join(kept.groupBy(*K).agg(F.count("*").alias("has")), K).withColumn("lost", F.col("had") != F.col("has")).select(*K, "lost")
    values = X.segment_sums(kept, *K).join(lost.where("NOT lost"), K).drop("lost").unionByName(X.item_values(kept, *K).join(lost.where("lost"), K).drop("lost"))
    external = F.col("external_total").cast("bigint") if "external_total" in filings.columns else F.lit(None).cast("bigint")
    sums = V.summed(values, *K).join(totals.select(*K, "table_total"), K, "left").join(filings.select("filing_id", external.alias("external_total")), "filing_id")
    sums = V.self_total(sums).withColumn("scale", V.scale_by_total(F.col("external_total"), F.col("table_total")))
    for c in ("segment_sum", "adjustment_sum", "lowest", "table_total"):
        sums = sums.withColumn(c, F.col(c) * F.col("scale"))
    checked = V.validate(sums.where(V.external_gate(F.col("table_total"), F.col("external_total"))), tolerance)
    accepted = cut(W.first_success(checked.join(attempts, K), F.col("ok"), "attempt", "filing_id"))

    final = kept.join(accepted.select(*K, "scale"), K).withColumn("value", F.col("value") * F.col("scale")).join(filings.select("filing_id", "ticker", "company"), "filing_id")
    final = cut(C.granular_over_segment(C.output_rows(cut(final)), *K))
    final = J.with_segment(final.withColumn("line", T.clean_line(F.col("item"))).withColumn("_item", F.col("item")).withColumn("item", F.col("line")), J.item_segments(spark))
    group = F.when(F.col("row_type") == "adjustment", "Adjustments / Reconciling items").otherwise(C.revenue_group(F.col("mapped"), F.col("dimension"), F.col("segment")))
    lines = described(final.withColumn("revenue_group", group), t)
    out = lines.select("filing_id", "ticker", "company", "revenue_group", F.col("line").alias("revenue_line"), "description", "source", F.col("year").alias("fiscal_year"), "value", T.in_millions(F.col("value")).alias("revenue_musd"))
    return W.output_order(out.withColumn("item", F.col("revenue_line"))).drop("item"), accepted


def described(lines: DataFrame, t: Tables) -> DataFrame:
    """Lines(filing_id, table_idx, _item, line, revenue_group) with description and source."""
    documents = H.plain_text(t.pages, "filing_id", most=1 << 30)
    under = H.under_heading(t.pages, lines.select("filing_id", F.col("line").alias("label")).distinct(), "filing_id").withColumnRenamed("text", "heading_text").withColumnRenamed("label", "line")
    notes = H.around_tables(t.pages, "filing_id").groupBy(*K).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), " ").alias("around_table"))
    marks = H.footnote_ids(t.pages, "filing_id").select(*K, F.col("label").alias("_item"), F.get("ids", F.lit(0)).alias("_n"))
    rows = lines.join(documents.withColumnRenamed("text", "document"), "filing_id", "left").join(under, ["filing_id", "line"], "left").join(notes, K, "left").join(marks, [*K, "_item"], "left")
    dom = D.footnotes(F.coalesce("around_table", F.lit("")))[F.col("_n")]
    rows = rows.withColumn("dom_footnote", F.when(F.col("_n").isNotNull(), dom)).withColumn("model_text", F.lit(None).cast("string"))
    joined = D.cascade(rows.withColumn("_line", F.col("line")).withColumn("line", F.col("_item")).withColumn("group", F.col("revenue_group")))
    return joined.withColumn("line", F.col("_line")).drop("document", "around_table", "heading_text", "dom_footnote", "model_text", "_n", "_line", "group")


def multi_table(filings: DataFrame, fiscal_year: int | None = None, tolerance: float = 0.05, max_tables: int = 10) -> tuple[DataFrame, DataFrame]:
    """(items, reconciliations): several tables of each filing against its income statement.

    Anchor, scout, pick, extract and merge; then subtotals, foreign lines, units and second views go; then reconcile.
    """
    t = Tables.of(filings, preview_cols=8)
    gated = t.candidates.where("gate.ok")
    labels = F.col("labels")
    statements = t.candidates.select(*K, C.income_statement(F.col("context"), labels).alias("confidence"), T.statement_units(F.concat_ws(" ", "caption_text", "heading_context", "nearby_text_context")).alias("units"))
    anchor = cut(V.anchors(statements, t.grid, "filing_id"))
    external = F.col("external_total").cast("bigint") if "external_total" in filings.columns else F.lit(None).cast("bigint")
    target = filings.select("filing_id", external.alias("external_total")).join(anchor.select("filing_id", "total_revenue"), "filing_id", "left").select("filing_id", F.coalesce("total_revenue", "external_total").alias("target"))
    target = cut(target)

    scouted = gated.select(*K, C.scout(F.col("context"), labels).alias("s")).select(*K, "s.*").where("priority <> ''").withColumn("is_geography", F.col("table_type") == "geography")
    scouted = scouted.join(X.total_estimate(t.grid, *K), K, "left").join(target, "filing_id")
    picked = W.budgeted_pick(cut(scouted), "filing_id", most=max_tables).withColumnRenamed("place", "pos")
    near = W.closeness_rank(picked.join(X.column_estimate(t.grid, *K), K, "left").join(target.withColumn("target", F.col("target").cast("double")), "filing_id"), "filing_id")
    near = cut(near)

    rows, _ = extracted(t, near)
    items = X.merged_tables(rows.join(near.withColumnRenamed("place", "table_pos"), K), "filing_id")
    order = rows.join(near, K).groupBy("filing_id", T.clean_line(F.col("item")).alias("name")).agg(F.min(F.struct("place", "row_idx")).alias("o"))
    revenue = items.where("kind = 'segment'").join(order, ["filing_id", "name"], "left")
    revenue = W.ranked(revenue, [F.col("o"), F.col("name")], "filing_id").select("filing_id", F.col("rank").alias("pos"), "name", "value")
    revenue = V.without_subtotals(cut(revenue), "filing_id").withColumn("item", F.col("name"))
    revenue = C.without_non_revenue(revenue.withColumn("item", F.col("name")), "filing_id").drop("item").join(target, "filing_id")
    positive = revenue.groupBy("filing_id").agg(F.sum(F.when(F.col("value") > 0, F.col("value"))).alias("p"), F.max("target").alias("t")).select("filing_id", V.scale_by_sum(F.col("t"), F.col("p")).alias("scale"))
    revenue = revenue.join(positive, "filing_id").withColumn("value", F.col("value") * F.col("scale")).drop("scale")
    revenue = V.without_alternate_views(cut(revenue), "filing_id").withColumn("kind", F.lit("segment"))
    adjust = items.where("kind = 'adjustment'").join(positive, "filing_id", "left").withColumn("value", F.col("value") * F.coalesce("scale", F.lit(1)))
    final = revenue.select("filing_id", "name", "kind", "value").unionByName(adjust.select("filing_id", "name", "kind", "value"))
    final = cut(final.where(~T.found(F.col("name"), fixed_cost())))
    net = final.groupBy("filing_id").agg(F.sum("value").alias("net_total"))
    result = V.reconcile(target.withColumnRenamed("target", "income_total").join(net, "filing_id", "left").na.fill(0, ["net_total"]), tolerance)
    result = result.withColumn("likely_cause", F.when(F.abs("gap_percent") > tolerance, V.likely_cause(F.col("gap_percent")))).withColumn("fiscal_year", F.lit(fiscal_year).cast("int"))
    return final, result


def fixed_cost() -> str:
    from ..functions import fixed

    return fixed.COST_ROW


def evidence(filings: DataFrame, lines: DataFrame, top_k: int = 10) -> DataFrame:
    """Retrieved evidence for each line: chunks, tiers, gate and product names; lines(filing_id, company, ticker, year, line, group, caption)."""
    from ..operators import chunks as Ch
    from ..operators import retrieve as R

    pages = cut(H.parsed(filings, "filing_id"))
    docs = pages.select("filing_id", F.array_join(F.transform(F.filter("nodes", lambda n: n["tag"].isin("p", "h1", "h2", "h3", "h4", "li", "td") & (n["text"] != "")), lambda n: n["text"]), "\n").alias("text"))
    full = cut(Ch.structured(cut(docs), "filing_id")).select("filing_id", F.col("chunk_id"), "text", "section", "is_toc", F.lit(2).alias("tier_no"))
    local = H.around_tables(pages, "filing_id").select("filing_id", F.concat_ws("_", F.lit("local"), "table_idx", "kind", "place").alias("chunk_id"), "text", F.concat(F.lit("table_"), "kind").alias("section"), F.lit(False).alias("is_toc"), F.lit(1).alias("tier_no"))
    chunks = cut(models.embed(full.unionByName(local)).withColumn("v", R.normalised(F.col("v"))))
    query = T.retrieval_query(F.col("company"), F.col("ticker"), F.col("year"), F.col("line"), F.col("group"), F.col("caption"))
    queries = models.embed(lines.withColumn("text", query).withColumn("query_id", F.concat_ws("/", "filing_id", "line"))).select("query_id", "filing_id", R.normalised(F.col("v")).alias("q"), "line")
    hits = [R.nearest(queries.drop("line"), chunks.where(F.col("tier_no") == n).select("filing_id", "chunk_id", "v"), 3 * top_k, "filing_id").withColumn("tier_no", F.lit(n)) for n in (1, 2)]
    found = cut(hits[0].unionByName(hits[1]).join(chunks.drop("v"), ["filing_id", "chunk_id", "tier_no"]))
    kept = R.boosted(R.two_tiers(found, top_k).join(queries.select("query_id", "line"), "query_id"), F.col("line"))
    kept = kept.join(chunks.select(F.col("chunk_id"), "filing_id", "section"), ["chunk_id"], "left").where(F.startswith("query_id", F.concat("filing_id", F.lit("/"))))
    gate = R.evidence_gate(kept.select("query_id", "tier", "section", "score"))
    texts = kept.groupBy("query_id").agg(F.array_join(F.collect_list("text"), " ").alias("text"), F.max("tier").alias("tier"), F.array_sort(F.collect_list("chunk_id")).alias("chunk_ids"))
    return texts.join(gate, "query_id").select("query_id", "tier", "passed", "chunk_ids", F.when(F.col("passed"), F.slice(D.products(F.col("text")), 1, 40)).otherwise(F.array().cast("array<string>")).alias("products"))
