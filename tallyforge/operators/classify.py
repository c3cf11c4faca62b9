"""Ladders that classify tables, rows, columns and chunks.  Each is a Column, so a plan keeps it in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as T

# --- tables -------------------------------------------------------------------------------------


def table_gate(core: Column, full: Column) -> Column:
    """struct(ok, reason, positive_hit, negative_hit): strict negatives, then positives, then context negatives without a revenue signal."""
    none = F.lit(None).cast("string")
    strict, positive, context = (T.first_hit(x, p) for x, p in ((core, fixed.GATE_STRICT), (full, fixed.GATE_POSITIVE), (full, fixed.GATE_CONTEXT)))
    verdict = lambda ok, reason, pos, neg: F.struct(F.lit(ok).alias("ok"), F.lit(reason).alias("reason"), pos.alias("positive_hit"), neg.alias("negative_hit"))
    return (
        F.when(strict.isNotNull(), verdict(False, "negative_gate_strict", none, strict))
        .when(positive.isNotNull(), verdict(True, "positive_allow", positive, none))
        .when(~T.found(full, fixed.REVENUE_SIGNAL) & context.isNotNull(), verdict(False, "negative_gate_context", none, context))
        .otherwise(verdict(True, "default_allow", none, none))
    )


def table_dimension(caption: Column, heading: Column, labels: Column, ticker: Column) -> Column:
    """What a table breaks revenue down by; labels are an array."""
    context = F.lower(F.concat_ws(" ", caption, heading))
    names = F.lower(F.array_join(labels, " "))
    has = lambda *words: [F.contains(names, F.lit(w)) for w in words]
    gaming, iphone, stores, regions = has("data center", "gaming"), has("iphone", "mac"), has("online stores", "third-party"), has("north america", "international", "aws")
    who = F.upper(ticker)
    return (
        F.when(T.found(context, fixed.DIM_PRODUCT), "product_service")
        .when(T.found(context, fixed.DIM_END_MARKET), "end_market")
        .when(T.found(context, fixed.DIM_GEOGRAPHY), "geography")
        .when(T.found(context, fixed.DIM_SEGMENT), "segment")
        .when((who == "NVDA") & gaming[0] & gaming[1], "end_market")
        .when((who == "AAPL") & iphone[0] & iphone[1], "product_service")
        .when((who == "AMZN") & (stores[0] | stores[1]), "product_service")
        .otherwise("segment")
    )


def ranking_dimension(caption: Column, heading: Column, labels: Column) -> Column:
    """The sibling used for ranking: it knows `unknown` and no end market."""
    blob = F.lower(F.concat_ws(" ", caption, heading, F.array_join(labels, " ")))
    return F.when(T.found(blob, fixed.DIM_PRODUCT), "product_service").when(T.found(blob, fixed.DIM_GEOGRAPHY), "geography").when(T.found(blob, fixed.DIM_SEGMENT), "segment").otherwise("unknown")


def scout(context: Column, labels: Column) -> Column:
    """struct(priority, table_type, confidence) of a table; priority '' for statements and tables without revenue."""
    low, names = F.lower(context), F.lower(labels)
    both = F.concat_ws(" ", low, names)
    geo = T.found(both, fixed.SCOUT_GEOGRAPHY)
    out = lambda p, kind, geo_conf, conf: F.struct(F.lit(p).alias("priority"), F.when(geo, "geography").otherwise(kind).alias("table_type"), F.when(geo, F.lit(geo_conf)).otherwise(F.lit(conf)).alias("confidence"))
    none = F.struct(F.lit("").alias("priority"), F.lit("").alias("table_type"), F.lit(0.0).alias("confidence"))
    return (
        F.when(T.found(low, fixed.SCOUT_REJECT) | (T.contained(names, fixed.PL_MARKERS) >= 2), none)
        .when(T.found(low, fixed.SCOUT_A), out("A", "disaggregation", 0.70, 0.95))
        .when(T.found(low, fixed.SCOUT_B), out("B", "segment", 0.60, 0.85))
        .when(T.found(low, fixed.SCOUT_C), out("C", "product_service", 0.50, 0.75))
        .when(F.contains(both, F.lit("revenue")) | F.contains(both, F.lit("net sales")), out("C", "unknown", 0.5, 0.5))
        .otherwise(none)
    )


def document_sections(document: Column) -> Column:
    """struct of five flags: which parts of a filing a document has."""
    low = F.lower(document)
    return F.struct(*[T.found(low, p).alias(name) for name, p in fixed.SECTIONS.items()])


def income_statement(context: Column, labels: Column) -> Column:
    """The confidence that a table is an income statement; 0 if it isn't."""
    low, names = F.lower(context), F.lower(labels)
    caption, n = T.found(low, fixed.STATEMENT_CAPTION), T.hits(names, fixed.STATEMENT_MARKERS)
    rows = names.rlike(r"\b(net\s+)?revenue[s]?\b|\bnet\s+sales\b") & names.rlike(r"\bnet\s+income\b|\bnet\s+earnings\b") & names.rlike(r"\boperating\s+expenses?\b|\bcost\s+of\b")
    return F.when(caption & (n >= 2), F.least(F.lit(0.5) + n * F.lit(0.15), F.lit(0.95))).when(rows, 0.85).when(caption, 0.6).otherwise(0.0)


def statement_score(labels: Column, money_ratio: Column, numeric_ratio: Column, has_year: Column) -> Column:
    """The additive score that picks an income statement; null without a revenue row."""
    names = F.lower(labels)
    has = lambda w, x: F.when(F.contains(names, F.lit(w)), F.lit(x)).otherwise(F.lit(0.0))
    score = has("net income", 3.0) + has("operating income", 2.0) + has("cost of", 1.5) + 3 * money_ratio + numeric_ratio + F.when(has_year, 1.0).otherwise(0.0)
    return F.when(F.contains(names, F.lit("revenue")) | F.contains(names, F.lit("net sales")), score)


def is_breakdown(labels: Column) -> Column:
    """struct(is_match, is_geography): whether the row labels are those of revenue by something."""
    names = F.lower(labels)
    return F.struct(((T.contained(names, fixed.BREAKDOWN_POSITIVE) > 0) & (T.contained(names, fixed.BREAKDOWN_NEGATIVE) == 0)).alias("is_match"), (T.contained(names, fixed.BREAKDOWN_GEOGRAPHY) > 0).alias("is_geography"))


def snippet_score(snippet: Column) -> Column:
    low = F.lower(snippet)
    return 3 * low.rlike(r"\bitem\s+8\b").cast("int") + low.rlike(r"\bnote\s+\d+.*segment").cast("int") - low.rlike(r"\bitem\s+7\b").cast("int")


# --- rows ---------------------------------------------------------------------------------------


def is_adjustment(label: Column) -> Column:
    return T.found(label, fixed.ROW_ADJUSTMENT)


def is_total(label: Column) -> Column:
    return T.found(label, fixed.ROW_TOTAL)


def is_skipped(label: Column) -> Column:
    return T.found(label, fixed.ROW_SKIP)


def is_adjustment_item(ticker: Column, label: Column) -> Column:
    """By parts of the label for every company, and by a list for one."""
    named = F.concat_ws("\t", F.upper(ticker), F.trim(label)).isin(*["\t".join(x) for x in fixed.ADJUSTMENTS])
    return (T.contained(F.lower(F.trim(label)), fixed.ADJUSTMENT_PARTS) > 0) | named


def is_total_label(label: Column) -> Column:
    return F.lower(F.trim(label)).rlike("^(" + "|".join(fixed.TOTAL_PREFIXES) + ")")


def is_subtotal(ticker: Column, label: Column) -> Column:
    return F.concat_ws("\t", F.upper(ticker), F.lower(F.trim(label))).isin(*["\t".join((t, x.lower())) for t, x in fixed.SUBTOTALS])


def row_kind(label: Column, segment: Column) -> Column:
    """skip, total, segment, adjustment or unknown; `segment` is the best expected segment, null without one."""
    x = F.trim(label)
    return F.when((F.coalesce(x, F.lit("")) == "") | is_skipped(x), "skip").when(is_total(x), "total").when(segment.isNotNull(), "segment").when(is_adjustment(x), "adjustment").otherwise("unknown")


def row_dimension(label: Column, table: Column) -> Column:
    x = F.trim(label)
    return F.when(T.found(x, fixed.ROW_SOURCE), "revenue_source").when(T.found(x, fixed.ROW_SEGMENT), "segment").otherwise(table)


def revenue_group(segment_of_item: Column, dimension: Column, segment: Column) -> Column:
    own = F.when((dimension == "segment") & (F.coalesce(segment, F.lit("")) != ""), segment)
    return F.coalesce(segment_of_item, own, F.lit("Product/Service disclosure"))


# --- filters over tables of rows ----------------------------------------------------------------


def without_cost_rows(rows: DataFrame) -> DataFrame:
    return rows.where(~T.found(F.col("item"), fixed.COST_ROW))


def without_total_rows(rows: DataFrame, *table: str) -> DataFrame:
    """Total rows go where a table has three other rows or more."""
    total = T.found(F.trim("item"), fixed.TOTAL_ROW)
    others = F.sum((~total).cast("int")).over(Window.partitionBy(*table))
    return rows.withColumn("_others", others).where(~(total & (F.col("_others") >= 3))).drop("_others")


def sane_tables(rows: DataFrame, *table: str) -> DataFrame:
    """Tables whose labels are names, not numbers, dates or staff, and whose values are money.  rows(item, value, hint)."""
    item, n = F.col("item"), F.count("*")
    share = lambda c: F.avg(c.cast("int"))
    staff = F.sum(T.found(item, fixed.STAFF_LABEL).cast("int"))
    percent = F.max(F.lower(F.coalesce("hint", F.lit(""))).rlike("%|percent")) & (F.max(F.abs("value")) <= 5)
    return rows.groupBy(*table).agg(
        ((n > 0) & (share(T.is_amount_label(item)) <= 0.5) & (share(T.found(item, fixed.DATE_LABEL)) <= 0.3) & ~((staff > 0) & (staff >= n * 0.2)) & (F.max(F.abs("value")) > 0) & ~percent).alias("sane")
    )


def output_rows(rows: DataFrame) -> DataFrame:
    """Rows that a result lists: no totals or subtotals, positive or adjustments, no costs."""
    kept = rows.where((F.col("row_type") != "total") & ~is_total_label(F.col("item")) & ~is_subtotal(F.col("ticker"), F.col("item")) & ((F.col("value") > 0) | (F.col("row_type") == "adjustment")))
    return without_cost_rows(kept)


def granular_over_segment(rows: DataFrame, *table: str) -> DataFrame:
    """Granular rows, adjustments, and the segment rows whose segment has no granular row, with or without its parenthesis."""
    bare = lambda c: F.trim(F.lower(F.get(F.split(c, r"\("), F.lit(0))))
    adjustment, granular = F.col("row_type") == "adjustment", F.col("dimension").isin("revenue_source", "product_service", "end_market")
    named = rows.where(~adjustment & granular & (F.col("segment") != ""))
    names = named.select(*table, F.explode(F.array(F.trim(F.lower("segment")), bare(F.col("segment")))).alias("_seg")).distinct()
    single = rows.where(~adjustment & (F.col("dimension") == "segment"))
    on = lambda c: [*[single[t] == names[t] for t in table], c == names["_seg"]]
    single = single.join(names, on(F.trim(F.lower(single["segment"]))), "left_anti")
    single = single.join(names, on(bare(single["segment"])), "left_anti")
    return rows.where(~adjustment & granular).unionByName(single).unionByName(rows.where(adjustment))


def without_non_revenue(rows: DataFrame, *table: str) -> DataFrame:
    """Rows that are revenue by name and at least a thousandth of their table's greatest."""
    named = rows.where(~T.found(F.col("item"), fixed.NON_REVENUE))
    top = F.max("value").over(Window.partitionBy(*table))
    return named.withColumn("_top", top).where(~((F.col("_top") > 0) & (F.col("value") > 0) & (F.col("value") * 1000 < F.col("_top")))).drop("_top")


# --- columns of a grid ----------------------------------------------------------------------------


def label_columns(cells: DataFrame, *table: str) -> DataFrame:
    """(table, col, numeric_ratio, alpha_ratio, uniqueness, mean_len, score) of each column from cells(table, row_idx, col_idx, text)."""
    full = cells.where(F.trim("text") != "").withColumn("text", F.trim("text"))
    share = lambda c: F.sum(c.cast("int")) / F.count("*")
    out = full.groupBy(*table, F.col("col_idx").alias("col")).agg(share(T.is_amount_label(F.col("text"))).alias("numeric_ratio"), share(F.col("text").rlike(r"(?U)\p{Alpha}")).alias("alpha_ratio"), (F.count_distinct(F.lower("text")) / F.count("*")).alias("uniqueness"), F.avg(F.length("text")).alias("mean_len"))
    score = -5 * F.col("numeric_ratio") + 3 * F.col("alpha_ratio") + F.col("uniqueness") + F.lit(0.05) * F.col("mean_len")
    return out.withColumn("score", F.bround(score, 3))


def choose_item_col(cells: DataFrame, proposed: DataFrame, *table: str) -> DataFrame:
    """(table, item_col, overridden): the proposed column if it is mostly text, else the one with the best score, the first of equals."""
    scored = label_columns(cells, *table)
    best = scored.groupBy(*table).agg(F.min_by("col", F.struct(-F.col("score"), "col")).alias("best"))
    own = proposed.join(scored.select(*table, F.col("col").alias("proposed"), F.bround("numeric_ratio", 3).alias("n"), F.bround("alpha_ratio", 3).alias("a")), [*table, "proposed"], "left")
    ok = F.coalesce((F.col("n") < 0.5) & (F.col("a") > 0.3), F.lit(False))
    return best.join(own, list(table), "left").select(*table, F.when(ok, F.col("proposed")).otherwise(F.col("best")).alias("item_col"), (~ok & F.col("proposed").isNotNull()).alias("overridden"))


def segment_col_fits(values: DataFrame, segments: DataFrame, *table: str) -> DataFrame:
    """(table, fits): whether a column's values name expected segments; values(table, value), segments(table, segment)."""
    v = values.select(*table, F.trim(F.lower("value")).alias("v")).where(F.length("v") > 1).distinct()
    e = segments.groupBy(*table).agg(F.collect_set(F.lower("segment")).alias("e"))
    near = F.exists(F.coalesce("e", F.array().cast("array<string>")), lambda s: F.contains(F.col("v"), s) | F.contains(s, F.col("v")))
    return v.join(e, list(table), "left").groupBy(*table).agg((~((F.avg(near.cast("int")) < 0.3) & (F.count("*") > 2))).alias("fits"))


def veto_year_cols(cells: DataFrame, layout: DataFrame, *table: str) -> DataFrame:
    """(table, year, col): a year's column, moved left past columns of changes or percentages.

    cells(table, row_idx, col_idx, text, is_header), layout(table, year, col).
    """
    by_col = cells.groupBy(*table, "col_idx").agg(
        F.coalesce(F.max((F.col("is_header") & T.found(F.coalesce("text", F.lit("")), r"%|\b(percent|change|variance|increase|decrease)\b"))), F.lit(False)).alias("change"),
        F.sum(F.contains(F.coalesce("text", F.lit("")), F.lit("%")).cast("int")).alias("pct"),
    )
    n = cells.groupBy(*table).agg((F.max("row_idx") + 1).alias("n_rows"))
    here = layout.join(by_col.withColumnRenamed("col_idx", "col"), [*table, "col"], "left").join(n, list(table))
    here = here.withColumn("bad", F.coalesce("change", F.lit(False)) | (F.coalesce("pct", F.lit(0)) > F.col("n_rows") * 0.3))
    left = by_col.select(*table, F.col("col_idx").alias("alt"), F.col("change").alias("alt_change"), F.col("pct").alias("alt_pct"))
    other = here.where("bad").join(left, list(table)).where("alt < col AND NOT alt_change AND alt_pct < pct").groupBy(*table, "year").agg(F.max("alt").alias("alt"))
    return here.join(other, [*table, "year"], "left").select(*table, "year", F.when(F.col("bad"), F.coalesce("alt", "col")).otherwise(F.col("col")).alias("col"))


def year_cols(cells: DataFrame, *table: str, rows: int = 12, low: int = 2018, high: int = 2030) -> DataFrame:
    """(table, year, col): the first column that names each year in the first rows."""
    named = T.once(cells.where(F.col("row_idx") < rows), "year", T.header_year(F.col("text"), low, high)).where("year is not null")
    return named.groupBy(*table, "year").agg(F.min_by("col_idx", F.struct("row_idx", "col_idx")).alias("col"))


def header_mode(rows: DataFrame, segments: DataFrame, *table: str) -> DataFrame:
    """(table, header_mode): whether a segment's name, or `total`, heads a block with a `revenue` row; rows(table, row_idx, first)."""
    first = rows.where("row_idx < 50").withColumn("first", F.trim(F.lower("first")))
    names = segments.select(*table, F.lower("segment").alias("first")).distinct().withColumn("named", F.lit(True))
    marked = first.join(names, [*table, "first"], "left")
    head = F.min(F.when(F.coalesce("named", F.lit(False)) | (F.col("first") == "total"), F.col("row_idx")))
    last = F.max(F.when((F.col("first") == "revenue") & ~F.coalesce("named", F.lit(False)), F.col("row_idx")))
    return marked.groupBy(*table).agg(F.coalesce(head < last, F.lit(False)).alias("header_mode"))


# --- chunks -----------------------------------------------------------------------------------------


def is_contents_chunk(text: Column, start: Column, regions: Column) -> Column:
    """Whether a chunk belongs to a table of contents; regions is an array of struct(start, end)."""
    within = F.exists(regions, lambda r: (start >= r["start"]) & (start < r["end"]))
    return within | (F.regexp_count(text, F.lit(r"\.{3,}")) > 5) | (F.regexp_count(text, F.lit(r"(?m)\.\s*\d{1,3}\s*$")) > 8)


def has_body_density(text: Column) -> Column:
    """Prose: few dotted leaders, lines of 30 characters on average, few page numbers."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.trim(s) != "")
    mean = F.aggregate(lines, F.lit(0), lambda a, s: a + F.length(s)) / F.size(lines)
    return (F.coalesce(F.length(text), F.lit(0)) > 0) & (F.regexp_count(text, F.lit(r"\.{3,}")) <= 5) & ((F.size(lines) == 0) | (mean >= 30)) & (F.regexp_count(text, F.lit(r"(?m)\b\d{1,3}\s*$")) <= 10)


def note_kind(text: Column) -> Column:
    """A revenue note's chunk: what revenue is, how it is booked, or undecided."""
    d, a = T.hits(text, fixed.NOTE_DEFINITION), T.hits(text, fixed.NOTE_ACCOUNTING)
    return F.when((a >= 2) & (a > d), "note_revenue_recognition").when((d >= 2) & (d > a), "note_revenue_sources").when(T.found(text, fixed.NOTE_STRONG), "note_revenue_recognition").otherwise("note_revenue")


def is_content(tag: Column, text: Column) -> Column:
    return tag.isin("p", "div", "span", "section", "article") & (F.length(F.trim(text)) > 20)
