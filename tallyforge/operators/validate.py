"""Validation, scaling, deduplication and reconciliation, each as expressions over one row per table or item."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from . import classify as C


def summed(values: DataFrame, *keys: str) -> DataFrame:
    """(keys, segment_sum, adjustment_sum, n_segments, lowest, names) from (keys, name, kind, value)."""
    seg = F.col("kind") == "segment"
    return values.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(seg, F.col("value"))), F.lit(0)).alias("segment_sum"),
        F.coalesce(F.sum(F.when(~seg, F.col("value"))), F.lit(0)).alias("adjustment_sum"),
        F.count(F.when(seg, 1)).alias("n_segments"),
        F.min(F.when(seg, F.col("value"))).alias("lowest"),
        F.array_sort(F.collect_set(F.when(seg, F.lower("name")))).alias("names"),
    )


def validate(df: DataFrame, tolerance: float = 0.02, min_segments: int = 2) -> DataFrame:
    """df(segment_sum, adjustment_sum, n_segments, lowest, names, table_total, external_total) with ok, delta_pct, rung, notes.

    The ladder, in this order: a positive table total decides at once; a positive external total accepts the
    sum, or the segments alone; else enough segments with a positive sum are accepted, unless they come to
    less than a tenth of the external total, a name is that of an income statement's line, or a value is negative.
    """
    t, e, s = F.col("table_total"), F.col("external_total"), F.col("segment_sum")
    both = s + F.col("adjustment_sum")
    off = lambda x, ref: F.abs(x - ref) / F.when(ref > 0, ref)
    pct = lambda x: F.format_string("%.2f", x * 100)
    has_t, has_e = F.coalesce(t > 0, F.lit(False)), F.coalesce(e > 0, F.lit(False))
    enough = (F.col("n_segments") >= min_segments) & (s > 0)
    odd = F.filter(F.col("names"), lambda n: T.contained(n, fixed.STATEMENT_NAMES) > 0)
    say = lambda rung, ok, delta, notes: F.struct(F.lit(rung).alias("rung"), F.lit(ok).alias("ok"), delta.cast("double").alias("delta_pct"), notes.alias("notes"))
    null = F.lit(None)
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    thousands = lambda c: F.format_number(c, 0)
    ladder = (
        F.when(has_t & (off(both, t) <= tolerance), say("table_total", True, off(both, t), text("OK: matches table total within ", pct(off(both, t)), "%")))
        .when(has_t, say("table_total", False, off(both, t), text("FAIL: sum mismatch: ", thousands(both), " against the table's total ", thousands(t), ", off by ", pct(off(both, t)), "%")))
        .when(has_e & (off(both, e) <= tolerance), say("external_total", True, off(both, e), text("OK: matches external total within ", pct(off(both, e)), "%")))
        .when(has_e & (s > 0) & (off(s, e) <= tolerance), say("external_segments", True, off(s, e), text("OK: segments match external total within ", pct(off(s, e)), "%, adjustments left out")))
        .when(enough & has_e & (s / F.when(has_e, e) < 0.1), say("too_small", False, null, text("FAIL: segments are ", pct(s / e), "% of the external total")))
        .when(enough & (F.size(odd) > 0), say("statement_names", False, null, text("FAIL: an income statement's line: ", F.coalesce(F.get(odd, F.lit(0)), F.lit("")))))
        .when(enough & (F.col("lowest") >= 0), say("fallback", True, null, text("ACCEPTED: ", F.col("n_segments").cast("string"), " segments, no reference")))
        .otherwise(say("none", False, F.when(has_t, off(both, t)).when(has_e, off(both, e)), text("FAIL: ", F.col("n_segments").cast("string"), " segments, sum ", s.cast("string"))))
    )
    return df.withColumn("_v", ladder).select(*df.columns, "_v.*")


def plain_check(total: Column, sum_: Column, tolerance: float) -> Column:
    """The older two-value check."""
    return F.abs(total - sum_) / F.greatest(F.lit(1), total) <= tolerance


def self_total(df: DataFrame) -> DataFrame:
    """A missing table total becomes the sum of two segments or more; reference_kind says so."""
    missing = F.coalesce(F.col("table_total"), F.lit(0)) == 0
    own = missing & (F.col("n_segments") >= 2)
    return df.withColumn("reference_kind", F.when(own, "self").when(missing, "none").otherwise("table")).withColumn("table_total", F.when(own, F.col("segment_sum")).otherwise(F.col("table_total")))


def scale_by_total(external: Column, total: Column) -> Column:
    """1e6 or 1e3 if the external total is about so many times the table's, else 1."""
    r = external / F.when(total > 0, total)
    return F.when((r > 5e5) & (r < 2e6), 1_000_000).when((r > 5e2) & (r < 2e3), 1_000).otherwise(1).cast("bigint")


def scale_by_sum(target: Column, positive_sum: Column) -> Column:
    """A wider kin: the target over the sum of the positive values."""
    r = target / F.when(positive_sum > 0, positive_sum)
    return F.when(r.between(0.3e6, 3e6), 1_000_000).when(r.between(0.3e3, 3e3), 1_000).when(r.between(0.3e9, 3e9), 1_000_000_000).otherwise(1).cast("bigint")


def external_gate(total: Column, external: Column, limit: float = 0.10) -> Column:
    """False if both totals are known and differ by more than the limit."""
    both = (F.coalesce(total, F.lit(0)) != 0) & (F.coalesce(external, F.lit(0)) != 0)
    return ~(both & (F.abs(total - external) / F.when(external != 0, external) > limit))


def has_negative(values: DataFrame, *keys: str) -> DataFrame:
    return values.groupBy(*keys).agg((F.min("value") < 0).alias("has_negative"), ((F.count("*") >= 2) & (F.sum("value") > 0)).alias("is_revenue_set"))


def mark_sum_subtotals(items: DataFrame, *keys: str, tolerance: float = 0.01) -> DataFrame:
    """`is_subtotal`: an item that equals the sum of all other positive ones in a set of three or more, granular words apart."""
    each = Window.partitionBy(*keys)
    others = F.sum(F.when(F.col("value") > 0, F.col("value")).otherwise(0)).over(each) - F.when(F.col("value") > 0, F.col("value")).otherwise(0)
    n_others = F.sum((F.col("value") > 0).cast("int")).over(each) - (F.col("value") > 0).cast("int")
    hit = (F.count("*").over(each) >= 3) & (n_others >= 2) & (others > 0) & (F.abs(F.col("value") - others) / F.when(others > 0, others) <= tolerance) & (T.contained(F.lower("name"), fixed.GRANULAR_WORDS) == 0)
    return items.withColumn("is_subtotal", F.coalesce(hit, F.lit(False)))


def _reaches(values: list[int], target: int, tolerance: float) -> bool:
    """Whether two or more of the values, but not all, sum to the target within the tolerance; by sums reached, not by subsets."""
    reached: dict[int, int] = {0: 1}  # sum to the sizes that reach it, as bits
    for v in values:
        new = dict(reached)
        for s, sizes in reached.items():
            new[s + v] = new.get(s + v, 0) | sizes << 1
        reached = new
    allowed = sum(1 << n for n in range(2, len(values)))
    return any(s > 0 and sizes & allowed and abs(target - s) / s <= tolerance for s, sizes in reached.items())


def without_subtotals(items: DataFrame, *keys: str, tolerance: float = 0.01, most: int = 20) -> DataFrame:
    """items(keys, pos, name, value) without subtotals, marked in the items' order; an item marked no longer counts for those after it.

    Known subtotal names also match the sum of some of the others, in sets of at most `most` items, beyond which only
    the sum of all others is tried.  A set is one table's items.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        names, values = pdf["name"].tolist(), [int(v) for v in pdf["value"]]
        gone = [False] * len(names)
        for i, name in enumerate(names):
            low = (name or "").lower()
            if len(names) < 3 or any(w in low for w in fixed.GRANULAR_WORDS):
                continue
            rest = [v for j, v in enumerate(values) if j != i and not gone[j] and v > 0]
            if len(rest) >= 2:
                total = sum(rest)
                known = any(w in low for w in fixed.SUBTOTAL_WORDS)
                gone[i] = abs(values[i] - total) / total <= tolerance or (known and len(rest) <= most and _reaches(rest, values[i], tolerance))
        return pdf[[not g for g in gone]]

    return items.groupBy(*keys).applyInPandas(run, items.schema)


def without_alternate_views(items: DataFrame, *keys: str) -> DataFrame:
    """items(keys, name, value, target): one view of a total that is listed by geography and otherwise as well; dates are no items."""
    each = Window.partitionBy(*keys)
    plain = items.withColumn("_n", F.count("*").over(each)).withColumn("_try", (F.col("_n") >= 3) & (F.coalesce(F.col("target"), F.lit(0)) > 0))
    plain = plain.where(~(F.col("_try") & T.found(F.col("name"), fixed.VIEW_DATE)))
    geo, pos = T.found(F.col("name"), fixed.VIEW_GEOGRAPHY), F.when(F.col("value") > 0, F.col("value")).otherwise(0)
    total = lambda c: F.sum(F.when(c, pos).otherwise(0)).over(each)
    marked = plain.withColumn("_geo", geo).withColumn("_g", total(geo)).withColumn("_o", total(~geo)).withColumn("_ng", F.sum(geo.cast("int")).over(each)).withColumn("_no", F.sum((~geo).cast("int")).over(each))
    t = F.col("target")
    near = lambda c: F.col(c).between(t * 0.8, t * 1.2)
    doubled = F.col("_try") & (F.col("_g") + F.col("_o")).between(t * 1.5, t * 3.0) & (F.col("_ng") > 0) & (F.col("_no") > 0)
    keep = F.when(doubled & near("_o"), ~F.col("_geo")).when(doubled & near("_g") & (F.col("_o") > t * 1.5), F.col("_geo")).otherwise(True)
    return marked.where(keep).drop("_n", "_try", "_geo", "_g", "_o", "_ng", "_no")


def reconcile(df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """df(income_total, net_total) with gap_amount, gap_percent, status and confidence; null without an income total."""
    gap = F.col("income_total") - F.col("net_total")
    g = F.when(F.col("income_total") != 0, gap / F.when(F.col("income_total") != 0, F.col("income_total"))).when(F.col("income_total") == 0, 0.0)
    a = F.abs(F.col("gap_percent"))
    status = F.when(a <= tolerance, "PASS").when(a <= 0.15, "WARNING").when(a > 0.15, "FAIL")
    confidence = F.when(a <= tolerance, 1 - a).when(a <= 0.15, F.greatest(F.lit(0.5), 1 - 2 * a)).when(a > 0.15, F.greatest(F.lit(0.1), 0.5 - a))
    return df.withColumn("gap_amount", gap).withColumn("gap_percent", g).withColumn("status", status).withColumn("confidence", confidence)


def likely_cause(gap_percent: Column) -> Column:
    return F.when(F.abs(gap_percent) > 0.9, "units_error").when(gap_percent > 0.05, "missing_segment").when(gap_percent < -0.05, "contra_revenue").otherwise("rounding")


def expected_but_missing(labels: DataFrame) -> DataFrame:
    """(ticker, missing): a company's expected segments that no label names; labels(ticker, label)."""
    spark = labels.sparkSession
    want = spark.createDataFrame([(t, k, p) for t, ps in fixed.EXPECTED_SEGMENTS.items() for k, p in enumerate(ps)], "ticker string, k int, pattern string")
    have = labels.select(F.upper("ticker").alias("ticker"), "label").join(F.broadcast(want), "ticker").where(F.regexp_like("label", F.concat(F.lit("(?i)"), "pattern"))).select("ticker", "pattern").distinct()
    companies = labels.select(F.upper("ticker").alias("ticker")).distinct()
    lost = companies.join(want, "ticker").join(have, ["ticker", "pattern"], "left_anti")
    return lost.groupBy("ticker").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "pattern"))), lambda x: x["pattern"]).alias("missing"))


def is_contra_revenue(label: Column) -> Column:
    return T.found(label, fixed.CONTRA_REVENUE)


def narrative_amounts(documents: DataFrame, *keys: str) -> DataFrame:
    """(keys, k, amount, mention): every `$n million` or `$n billion` of a text."""
    mention = F.explode(F.arrays_zip(F.regexp_extract_all("text", F.lit(r"(?i)\$?([\d,]+(?:\.\d+)?)\s*(?:million|billion)"), F.lit(0)).alias("mention"), F.regexp_extract_all("text", F.lit(r"(?i)\$?([\d,]+(?:\.\d+)?)\s*(?:million|billion)"), F.lit(1)).alias("n")))
    rows = documents.select(*keys, mention.alias("m")).select(*keys, "m.mention", F.regexp_replace("m.n", ",", "").try_cast("double").alias("n"))
    unit = F.when(F.contains(F.lower("mention"), F.lit("billion")), F.lit(1e9)).otherwise(F.lit(1e6))
    return rows.where("n IS NOT NULL").select(*keys, (F.col("n") * unit).alias("amount"), "mention")


def mentions_in_context(documents: DataFrame, around: int = 100, *keys: str) -> DataFrame:
    """(keys, context): the first mention of an amount with the characters around it."""
    pattern = r"(?i)\$?[\d,]+(?:\.\d+)?\s*(?:million|billion)"
    at = F.regexp_instr("text", F.lit(pattern))
    return documents.where(at > 0).select(*keys, F.substring("text", F.greatest(F.lit(1), at - around), F.length(F.regexp_extract("text", pattern, 0)) + 2 * around).alias("context"))


def fills_gap(amounts: DataFrame, gaps: DataFrame, share: float, *keys: str) -> DataFrame:
    """amounts(keys, amount) near a positive gap(keys, gap)."""
    return amounts.join(gaps, list(keys)).where((F.col("gap") > 0) & (F.abs(F.col("amount") - F.col("gap")) / F.when(F.col("gap") > 0, F.col("gap")) < share))


def regression(baseline: DataFrame, current: DataFrame, *keys: str) -> DataFrame:
    """(keys, change) of two coverage runs (keys, covered): new_missing, new_covered or same."""
    both = baseline.select(*keys, F.col("covered").alias("was")).join(current.select(*keys, F.col("covered").alias("now")), list(keys), "full_outer")
    was, now = F.coalesce("was", F.lit(False)), F.coalesce("now", F.lit(False))
    return both.select(*keys, F.when(was & ~now, "new_missing").when(~was & now, "new_covered").otherwise("same").alias("change"))


def anchors(statements: DataFrame, grid: DataFrame, *keys: str) -> DataFrame:
    """(keys, total_revenue, label, year, table_idx, confidence): the revenue of the likeliest income statement that states it in money.

    statements(keys, table_idx, confidence, units); grid(keys, table_idx, row_idx, cells).  The first row whose label is a
    total's and whose value is over 200 counts: lower values are percentages.
    """
    from .extract import cells, newest_year

    tables = [*keys, "table_idx"]
    likely = statements.where("confidence > 0")
    some = grid.join(likely, tables)
    years = newest_year(C.year_cols(cells(some, *tables), *tables, rows=10), *tables)
    label = F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    rows = some.join(years, tables).withColumn("label", label).where(T.found(label, fixed.ANCHOR_ROW)).withColumn("v", T.money_near(F.col("cells"), F.col("val_col"))).where("v > 200")
    best = rows.groupBy(*keys).agg(F.min_by(F.struct((F.col("v") * F.col("units")).alias("total_revenue"), "label", "year", "table_idx", "confidence"), F.struct(-F.col("confidence"), "table_idx", "row_idx")).alias("r"))
    return best.select(*keys, "r.*")


def coverage(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, n_lines, n_covered, coverage_pct, missing) from (keys, line, description)."""
    has = F.trim(F.coalesce("description", F.lit(""))) != ""
    return lines.groupBy(*keys).agg(F.count("*").alias("n_lines"), F.count_if(has).alias("n_covered"), F.bround(100 * F.avg(has.cast("int")), 1).alias("coverage_pct"), F.array_sort(F.collect_list(F.when(~has, F.col("line")))).alias("missing"))


def grand_total(per_key: DataFrame) -> DataFrame:
    return per_key.agg(F.sum("n_lines").alias("n_lines"), F.sum("n_covered").alias("n_covered"), F.bround(100 * F.sum("n_covered") / F.sum("n_lines"), 1).alias("coverage_pct"))


def pass_rate(results: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, n_passed, pass_rate) from (keys, ok)."""
    ok = F.coalesce(F.col("ok"), F.lit(False)).cast("int")
    return results.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(ok).alias("n_passed"), F.avg(ok).alias("pass_rate"))


def iterate(extract: Callable[[DataFrame | None], DataFrame], most: int = 3, tolerance: float = 0.05) -> DataFrame:
    """Reconcile again, at most `most` times, while a pass still finds filings whose gap it can narrow.

    extract(gaps) gives (filing_id, income_total, net_total); it gets the filings that failed, null at first.
    """
    done = reconcile(extract(None), tolerance)
    for _ in range(most - 1):
        open_ = done.where("status <> 'PASS'").select("filing_id", "gap_amount")
        if open_.isEmpty():
            break
        again = reconcile(extract(open_), tolerance)
        better = again.join(done.select("filing_id", F.abs("gap_percent").alias("_was")), "filing_id").where(F.abs("gap_percent") < F.col("_was")).drop("_was")
        if better.isEmpty():
            break
        done = done.join(better.select("filing_id"), "filing_id", "left_anti").unionByName(better)
    return done
