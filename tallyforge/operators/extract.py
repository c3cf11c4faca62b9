"""From grids to revenue rows: header mode, row mode, granular items, and layouts tried side by side.

A grid is rows(table..., row_idx, cells); a layout is (table..., item_col, segment_col, year, col, header_rows,
units).  Segments are (table..., segment, pos).  All tables of all filings are extracted at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stages import cut
from . import classify as C
from . import joins as J
from . import windows as W

KEYS = ("filing_id", "table_idx")


def cells(grid: DataFrame, *keys: str) -> DataFrame:
    """(keys, row_idx, col_idx, text) of every cell."""
    return grid.select(*keys, "row_idx", F.posexplode("cells").alias("col_idx", "text"))


def cell(col: str):
    return F.trim(F.coalesce(F.get("cells", F.col(col)), F.lit("")))


def newest_year(layout: DataFrame, *keys: str) -> DataFrame:
    """(keys, year, val_col): the newest year of a layout and its column."""
    return layout.groupBy(*keys).agg(F.max("year").alias("year"), F.max_by("col", "year").alias("val_col"))


def laid_out(grid: DataFrame, layout: DataFrame, years: DataFrame, *keys: str) -> DataFrame:
    """Rows that are neither headers nor blank, with their label and value; tables without a year column have none."""
    k = list(keys)
    rows = grid.join(layout.select(*k, "item_col", "segment_col", "header_rows", F.greatest(F.coalesce("units", F.lit(1)), F.lit(1)).cast("bigint").alias("units")), k).join(newest_year(years, *k), k)
    rows = rows.where(~F.coalesce(F.array_contains("header_rows", F.col("row_idx")), F.lit(False))).where(F.exists("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    rows = rows.withColumn("item_label", cell("item_col")).withColumn("seg_label", F.when(F.col("segment_col").isNotNull(), cell("segment_col")).otherwise(F.lit("")))
    return T.once(rows, "val", T.money_near(F.col("cells"), F.col("val_col")) * F.col("units"))


def with_year_cols(grid: DataFrame, layout_years: DataFrame, *keys: str) -> DataFrame:
    """A layout's year columns, or detected ones for the tables it has none for."""
    found = C.year_cols(cells(grid, *keys), *keys)
    return layout_years.select(*keys, "year", "col").unionByName(found.join(layout_years.select(*keys).distinct(), list(keys), "left_anti"))


def unified(grid: DataFrame, layout: DataFrame, years: DataFrame, segments: DataFrame, *keys: str, unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows (keys, row_idx, segment, item, value, row_type, year) and totals (keys, table_total), by segment headers where a table has them, else by rows."""
    k = list(keys)
    rows = laid_out(grid, layout, years, *k)
    rows = W.fill_down(rows, "seg_label", ("row_idx",), *k).withColumn("label", F.coalesce(F.nullif("seg_label", F.lit("")), F.col("item_label"))).where("label <> ''")
    mode = C.header_mode(grid.select(*k, "row_idx", F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))).alias("first")), segments, *k)
    rows = cut(rows.join(mode, k, "left").withColumn("header_mode", F.coalesce("header_mode", F.lit(False))))

    heads = J.best_segment(rows.where("header_mode").select(*k, F.col("item_label").alias("label")), segments, 0.8, *k).select(*k, F.col("label").alias("item_label"), F.col("segment").alias("head"))
    low = F.lower("item_label")
    rows = rows.join(heads, [*k, "item_label"], "left").withColumn("head", F.when(F.col("header_mode"), F.when(low == "total", "Total").when(low != "revenue", F.col("head"))))
    rows = cut(W.under_headers(rows, F.col("head"), ("row_idx",), *k))
    metric = F.col("header_mode") & (low == "revenue") & F.col("current").isNotNull()
    by_head = rows.where(metric & F.col("val").isNotNull())

    plain = rows.where(~metric & F.col("head").isNull())
    named = J.best_segment(plain.select(*k, "label"), segments, 0.6, *k).select(*k, "label", F.col("segment").alias("best"))
    plain = cut(plain.join(named, [*k, "label"], "left").withColumn("row_type", C.row_kind(F.col("label"), F.col("best"))).where("row_type <> 'skip' AND val IS NOT NULL"))

    own = T.clean_segment(F.col("label"))
    kinds = ("segment", "adjustment", "unknown") if unknown else ("segment", "adjustment")
    by_row = plain.where(F.col("row_type").isin(*kinds)).select(*k, "row_idx", F.when(F.col("row_type") == "adjustment", "").when(F.col("row_type") == "segment", T.clean_segment(F.col("best"))).otherwise(own).alias("segment"), own.alias("item"), F.col("val").alias("value"), "row_type", "year")
    head_rows = by_head.where("current <> 'Total'").select(*k, "row_idx", F.col("current").alias("segment"), F.col("current").alias("item"), F.col("val").alias("value"), F.lit("segment").alias("row_type"), "year")
    total_rows = by_head.where("current = 'Total'").select(*k, "row_idx", "val").unionByName(plain.where("row_type = 'total'").select(*k, "row_idx", "val"))
    return head_rows.unionByName(by_row), last_total(total_rows, *k)


def last_total(totals: DataFrame, *keys: str) -> DataFrame:
    """(keys, table_total): the last total row's value."""
    return totals.groupBy(*keys).agg(F.max_by("val", "row_idx").alias("table_total"))


def granular(grid: DataFrame, layout: DataFrame, years: DataFrame, segments: DataFrame, tables: DataFrame, dimension: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Every line item with its segment; the last total; tables(keys, ticker, dimension) names the company and the table's dimension.

    A label counts once in a table, with the first value that it has; total, skipped and subtotal rows don't count.
    """
    k = list(keys)
    rows = laid_out(grid, layout, years, *k).join(tables.select(*k, "ticker", F.col("dimension").alias("table_dimension")), k).where("item_label <> '' AND val IS NOT NULL")
    label = F.col("item_label")
    total = C.is_total(label)
    items = rows.where(~total & ~C.is_skipped(label) & ~C.is_subtotal(F.col("ticker"), label))
    first = F.min_by(F.struct("row_idx", "ticker", "item_label", "val", "year", "table_dimension"), "row_idx")  # reduced before the shuffle
    items = items.groupBy(*k, F.lower(label).alias("_low")).agg(first.alias("f")).select(*k, "_low", "f.*")
    # a total that repeats a label listed before is passed over as a repeat
    totals = rows.where(total).withColumn("_low", F.lower(label)).join(items.select(*k, "_low", F.col("row_idx").alias("_first")), [*k, "_low"], "left").where(~F.coalesce(F.col("_first") < F.col("row_idx"), F.lit(False)))
    items = J.with_segment(items.withColumn("item", label), dimension)
    guess = J.best_segment(items.select(*k, F.col("item").alias("label")), segments, 0.7, *k).select(*k, F.col("label").alias("item"), F.col("segment").alias("guess"))
    items = items.join(guess, [*k, "item"], "left")
    adjustment = C.is_adjustment_item(F.col("ticker"), F.col("item")) | C.is_adjustment(F.col("item"))
    segment = F.when(adjustment, "Other").otherwise(F.coalesce("mapped", "guess", T.clean_segment(F.col("item"))))
    out = items.select(*k, "row_idx", "ticker", segment.alias("segment"), "item", F.col("val").alias("value"), F.when(adjustment, "adjustment").otherwise("item").alias("row_type"), "year", C.row_dimension(F.col("item"), F.col("table_dimension")).alias("dimension"))
    return out, last_total(totals, *k)


GRANULAR = ("product_service", "revenue_source", "end_market", "geography")


def segment_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, name, kind, value): revenue by segment and by adjustment; a segment's own row is left out where it has granular ones."""
    k = list(keys)
    deep = rows.where((F.col("segment") != "") & F.col("dimension").isin(*GRANULAR)).select(*k, "segment").distinct()
    shadowed = rows.where((F.col("row_type") != "adjustment") & (F.col("dimension") == "segment")).join(deep, [*k, "segment"], "left_anti")
    others = rows.where((F.col("row_type") != "adjustment") & (F.col("dimension") != "segment"))
    revenue = shadowed.unionByName(others).where("segment <> ''").groupBy(*k, F.col("segment").alias("name")).agg(F.sum("value").alias("value")).withColumn("kind", F.lit("segment"))
    adjust = rows.where("row_type = 'adjustment'").groupBy(*k, F.col("item").alias("name")).agg(F.sum("value").alias("value")).withColumn("kind", F.lit("adjustment"))
    return revenue.unionByName(adjust)


def item_values(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, name, kind, value) re-keyed by item after filtering: the last value of a label wins, positive ones only but for adjustments."""
    kind = F.when(F.col("row_type") == "adjustment", "adjustment").otherwise("segment")
    kept = rows.where((F.col("row_type") == "adjustment") | (F.col("row_type").isin("item", "segment", "unknown") & (F.col("value") > 0)))
    return kept.groupBy(*keys, F.col("item").alias("name"), kind.alias("kind")).agg(F.max_by("value", "row_idx").alias("value"))


def merged_tables(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, name, kind, value) over several tables: the first table's revenue, the last one's adjustment; rows(…, table_pos)."""
    kind = F.when(F.col("row_type") == "adjustment", "adjustment").otherwise("segment")
    place = F.struct("table_pos", "row_idx")
    both = rows.groupBy(*keys, T.clean_line(F.col("item")).alias("name"), kind.alias("kind")).agg(F.min_by("value", place).alias("first"), F.max_by("value", place).alias("last"))
    return both.select(*keys, "name", "kind", F.when(F.col("kind") == "adjustment", F.col("last")).otherwise(F.col("first")).alias("value"))


def with_fallback(grid: DataFrame, layout: DataFrame, layout_years: DataFrame, segments: DataFrame, tables: DataFrame, dimension: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """The rows and total of the first strategy that yields any: granular, the layout as given, its year columns moved by 1, -1, 2, then detected ones.

    Strategies are branches of one plan.  A branch counts if it has segment rows (granular: any rows).
    """
    k = list(keys)
    years = cut(with_year_cols(grid, layout_years, *k))
    found = cut(C.year_cols(cells(grid, *k), *k))
    branches = [granular(grid, layout, years, segments, tables, dimension, *k)]
    moved = [years] + [layout_years.withColumn("col", F.col("col") + s).unionByName(years.join(layout_years.select(*k).distinct(), k, "left_anti")) for s in (1, -1, 2)]
    branches += [unified(grid, layout, y, segments, *k) for y in moved]
    branches.append(unified(grid, layout.withColumn("item_col", F.lit(0)).withColumn("segment_col", F.lit(None).cast("int")), found, segments, *k))
    shape = (*k, "row_idx", "segment", "item", "value", "row_type", "year")
    rows, totals = None, None
    for n, (r, t) in enumerate(branches):
        if "dimension" not in r.columns:
            r = r.join(tables.select(*k, "dimension"), k)
        r, t = r.select(*shape, "dimension", F.lit(n).alias("strategy")), t.select(*k, "table_total", F.lit(n).alias("strategy"))
        rows, totals = (r, t) if rows is None else (rows.unionByName(r), totals.unionByName(t))
    rows, totals = cut(rows), cut(totals)
    counts = rows.where((F.col("strategy") == 0) | ((F.col("row_type") == "segment") & (F.col("segment") != "")))
    best = counts.groupBy(*k).agg(F.min("strategy").alias("strategy"))
    return rows.join(best, [*k, "strategy"]), totals.join(best, [*k, "strategy"])


def by_pattern(rows: DataFrame, total: str, exclude: str) -> DataFrame:
    """Rows (cells, …) marked by regular expressions that travel as columns: is_total and is_excluded over any cell."""
    blob = F.array_join(F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit("")))), " ")
    mark = lambda c: F.coalesce((F.col(c) != "") & F.regexp_like(blob, F.concat(F.lit("(?i)"), F.col(c))), F.lit(False))
    return rows.withColumn("is_total", mark(total)).withColumn("is_excluded", mark(exclude))


def disaggregated(grid: DataFrame, layout: DataFrame, years: DataFrame, segments: DataFrame, *keys: str) -> DataFrame:
    """Layout-driven rows (keys, row_idx, segment, item, value, is_total): excluded rows go, and segments outside the business lines but `corporate`.

    The layout carries total_row_regex and exclude_row_regex.
    """
    k = list(keys)
    rows = laid_out(grid, layout, years, *k).join(layout.select(*k, "total_row_regex", "exclude_row_regex"), k)
    rows = W.fill_down(rows, "seg_label", ("row_idx",), *k)
    rows = by_pattern(rows, "total_row_regex", "exclude_row_regex").where("NOT is_excluded AND val IS NOT NULL AND item_label <> ''")
    lines = segments.select(*k, F.lower("segment").alias("_s")).distinct()
    seg = F.coalesce("seg_label", F.lit(""))
    inside = rows.withColumn("_s", F.lower(seg)).join(lines.withColumn("_known", F.lit(True)), [*k, "_s"], "left")
    kept = inside.where((F.col("_s") == "") | F.col("_known") | F.contains("_s", F.lit("corporate")) | F.col("is_total"))
    return kept.select(*k, "row_idx", seg.alias("segment"), F.col("item_label").alias("item"), F.col("val").alias("value"), "is_total")


def header_segments(grid: DataFrame, segments: DataFrame, *keys: str) -> DataFrame:
    """(keys, name, value, year): each segment's revenue under its header, unscaled; `Total` is a header too; the last wins."""
    k = list(keys)
    years = newest_year(C.year_cols(cells(grid, *k), *k, rows=15, low=2015, high=2100), *k)
    first = F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    names = segments.select(*k, F.lower("segment").alias("_low"), "segment").distinct()
    rows = grid.withColumn("_low", F.lower(first)).join(names, [*k, "_low"], "left").join(years, k)
    rows = W.under_headers(rows, F.when(F.col("_low") == "total", F.lit("Total")).otherwise(F.col("segment")), ("row_idx",), *k)
    values = rows.where("_low = 'revenue' AND current IS NOT NULL").withColumn("val", T.money_near(F.col("cells"), F.col("val_col"))).where("val IS NOT NULL")
    return values.groupBy(*k, F.col("current").alias("name"), "year").agg(F.max_by("val", "row_idx").alias("value"))


def first_match(grid: DataFrame, pattern: str, years: DataFrame, *keys: str) -> DataFrame:
    """(keys, label, value, year): the first row whose label matches and that has a value."""
    k = list(keys)
    label = F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    rows = grid.join(newest_year(years, *k), k).withColumn("label", label).where(F.col("label").rlike(T.any_of(pattern))).withColumn("value", T.money_near(F.col("cells"), F.col("val_col"))).where("value IS NOT NULL")
    return rows.groupBy(*k).agg(F.min_by(F.struct("label", "value", "year"), "row_idx").alias("r")).select(*k, "r.*")


def column_estimate(grid: DataFrame, *keys: str) -> DataFrame:
    """(keys, estimate): the greatest value of a column with two or more, in the newest year's column or beside it, else anywhere."""
    k = list(keys)
    values = cells(grid, *k).withColumn("v", T.money(F.col("text"))).where("v > 0").groupBy(*k, "col_idx").agg(F.max("v").alias("m"), F.count("*").alias("n")).where("n >= 2")
    newest = newest_year(C.year_cols(cells(grid, *k), *k, rows=5, low=2020, high=2030), *k)
    near = F.abs(F.col("col_idx") - F.col("val_col")) <= 1
    return values.join(newest, k, "left").groupBy(*k).agg(F.coalesce(F.max(F.when(near, F.col("m"))), F.max("m")).alias("estimate"))


def total_estimate(grid: DataFrame, *keys: str, units: int = 1_000_000) -> DataFrame:
    """(keys, estimate): the first total-like row's value, in millions."""
    from ..functions import fixed

    years = C.year_cols(cells(grid, *keys), *keys, rows=10)
    return first_match(grid, "|".join(f"(?:{p})" for p in fixed.ESTIMATE_ROW), years, *keys).select(*keys, (F.col("value") * units).alias("estimate"))


def label_values(grid: DataFrame, years: DataFrame, *keys: str) -> DataFrame:
    """(keys, values): a map of each labelled row's value in the newest year; the first of equal labels."""
    k = list(keys)
    label = F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    rows = grid.join(newest_year(years, *k), k).withColumn("label", label).withColumn("value", T.money_near(F.col("cells"), F.col("val_col"))).where("label <> '' AND value IS NOT NULL")
    once = rows.groupBy(*k, "label").agg(F.min_by("value", "row_idx").alias("value"))
    return once.groupBy(*k).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "value")))).alias("values"))
