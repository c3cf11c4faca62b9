"""Order-dependent operators: fill-down, latest per key, islands, ranks, budgets and first successes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text as T


def fill_down(df: DataFrame, value: str, order: tuple[str, ...], *keys: str) -> DataFrame:
    """`value` with blanks replaced by the last value above."""
    above = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(F.nullif(F.trim(value), F.lit("")), ignorenulls=True).over(above))


def under_headers(df: DataFrame, header: Column, order: tuple[str, ...], *keys: str) -> DataFrame:
    """`current`: the header that stands last above each row; header is null for other rows."""
    above = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("current", F.last(header, ignorenulls=True).over(above))


def latest(df: DataFrame, order: tuple[str, ...], *keys: str) -> DataFrame:
    """The row of each key that is greatest by the order columns; equal rows are one.  Reduced on the map side, so a hot key is no burden."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return top.select(*keys, "_r.*").select(*df.columns)


def first_filing(submissions: DataFrame, forms: tuple[str, ...]) -> DataFrame:
    """The first entry, as listed, whose form is allowed, from (ticker, form[], accessionNumber[], filingDate[], primaryDocument[])."""
    arrays = ("form", "accessionNumber", "filingDate", "primaryDocument")
    even = F.assert_true((F.size("form") == F.size("accessionNumber")) & (F.size("form") == F.size("filingDate")) & (F.size("form") == F.size("primaryDocument")), "submission arrays differ in length")
    rows = submissions.where(even.isNull()).select("ticker", F.posexplode(F.arrays_zip(*arrays)).alias("pos", "f")).select("ticker", "pos", "f.*")
    return rows.where(F.col("form").isin(*forms)).groupBy("ticker").agg(F.min_by(F.struct(*arrays), "pos").alias("f")).select("ticker", "f.*")


def nearest_preceding(df: DataFrame, is_target: Column, value: Column, order: tuple[str, ...], *keys: str) -> DataFrame:
    """`nearest`: the value of the last target row before each row."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("nearest", F.last(F.when(is_target, value), ignorenulls=True).over(before))


def share_of_max(df: DataFrame, value: str, *keys: str) -> DataFrame:
    return df.withColumn("share_of_max", F.col(value) / F.max(value).over(Window.partitionBy(*keys)))


def merge_intervals(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end): intervals that overlap or touch become one."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(*keys, "start", "end").withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    marked = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def run_end(count: int, span: int, *keys: str) -> Column:
    """Where the run of `count` matches that begins with a row of matches(keys, start, end) ends, if within `span` characters, else null."""
    last = F.lead("end", count - 1).over(Window.partitionBy(*keys).orderBy("start"))
    return F.when(last - F.col("start") < span, last)


def dense_runs(matches: DataFrame, count: int, span: int, margin: int, *keys: str) -> DataFrame:
    """(keys, start, end): where `count` matches in a row lie within `span` characters, `margin` wider on both sides, merged.

    matches(keys, start, end, length); length is the text's.
    """
    runs = matches.withColumn("_end", run_end(count, span, *keys)).where("_end IS NOT NULL")
    wide = runs.select(*keys, F.greatest(F.col("start") - margin, F.lit(0)).alias("start"), F.least(F.col("_end") + margin, F.col("length")).alias("end"))
    return merge_intervals(wide, *keys)


def ranked(df: DataFrame, order: list[Column], *keys: str, most: int | None = None) -> DataFrame:
    """`rank` from 1 in the order given, the first `most` only."""
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return out.where(F.col("rank") <= most) if most else out


def financial_rank(candidates: DataFrame, *keys: str, most: int | None = None) -> DataFrame:
    """Candidate tables by seven signals, all descending, then by place."""
    signals = ("has_year_header", "has_units_marker", "money_cell_ratio", "numeric_cell_ratio", "n_keyword_hits", "n_years", "n_rows")
    return ranked(candidates, [*[F.col(s).desc() for s in signals], F.col("table_idx")], *keys, most=most)


def hint_rank(candidates: DataFrame, hints: DataFrame, *keys: str, most: int = 15) -> DataFrame:
    """By the number of a company's hints that a table's text contains; candidates(ticker, keys, table_idx, blob), hints(ticker, hint)."""
    per = hints.groupBy(F.upper("ticker").alias("_t")).agg(F.collect_set("hint").alias("_h"))
    scored = candidates.join(per, F.upper(candidates["ticker"]) == F.col("_t"), "left")
    scored = scored.withColumn("hint_score", F.size(F.filter(F.coalesce("_h", F.array().cast("array<string>")), lambda h: F.contains(F.lower("blob"), h)))).drop("_t", "_h")
    return ranked(scored, [F.col("hint_score").desc(), F.col("table_idx")], *keys, most=most)


def dimension_rank(df: DataFrame, *keys: str, pool: int = 80) -> DataFrame:
    """The first `pool` by rank again, products first, then segments, unknown, geography; equal ones keep their rank."""
    order = F.when(F.col("dimension") == "product_service", 0).when(F.col("dimension") == "segment", 1).when(F.col("dimension") == "geography", 3).otherwise(2)
    return df.where(F.col("rank") <= pool).withColumn("pick", F.row_number().over(Window.partitionBy(*keys).orderBy(order, "rank")))


def attempt_order(preferred: DataFrame, breakdowns: DataFrame, hinted: DataFrame, *keys: str) -> DataFrame:
    """(keys, table_idx, attempt): the preferred table, breakdown tables (geography last), then the hinted, each once."""
    rows = preferred.select(*keys, "table_idx", F.struct(F.lit(0).alias("s"), F.lit(0).alias("g"), F.lit(0).alias("p")).alias("o"))
    rows = rows.unionByName(breakdowns.select(*keys, "table_idx", F.struct(F.lit(1).alias("s"), F.col("is_geography").cast("int").alias("g"), F.col("table_idx").cast("int").alias("p")).alias("o")))
    rows = rows.unionByName(hinted.select(*keys, "table_idx", F.struct(F.lit(2).alias("s"), F.lit(0).alias("g"), F.col("rank").cast("int").alias("p")).alias("o")))
    once = rows.groupBy(*keys, "table_idx").agg(F.min("o").alias("o"))
    return once.select(*keys, "table_idx", F.row_number().over(Window.partitionBy(*keys).orderBy("o")).alias("attempt"))


def first_success(attempts: DataFrame, ok: Column, order: str, *keys: str) -> DataFrame:
    """Of each key the accepted attempt that comes first; all are evaluated, so none waits for another."""
    rest = [c for c in attempts.columns if c not in keys]
    return attempts.where(ok).groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def closeness_rank(tables: DataFrame, *keys: str, most: int = 5, few: int = 3) -> DataFrame:
    """(keys, table_idx, place): tables whose estimate, as it is or in thousands or millions, comes near the target.

    tables(keys, table_idx, pos, estimate, target).  The first unit whose ratio lies in [0.1, 10] decides.
    Tables without an estimate fill up to `most`; without a target or any estimate the first `few` stay.
    """
    ratio = lambda m: F.col("estimate") * F.lit(float(m)) / F.col("target")
    score = F.when(~(F.col("estimate") > 0), F.lit(float("inf")))
    for m in (1, 1_000, 1_000_000):
        r = ratio(m)
        score = score.when(r.between(0.5, 2.0), F.abs(1 - r)).when(r.between(0.1, 10), F.abs(1 - r) + 1)
    scored = tables.withColumn("score", F.when(F.col("estimate").isNotNull(), score.otherwise(F.lit(float("inf")))))
    each = Window.partitionBy(*keys)
    scored = scored.withColumn("_usable", (F.max(F.coalesce(F.col("target"), F.lit(0.0)) > 0).over(each)) & (F.count("estimate").over(each) > 0))
    by_score = each.orderBy(F.col("score").isNull(), F.col("score"), "pos")
    placed = scored.withColumn("place", F.when(F.col("_usable"), F.row_number().over(by_score)).otherwise(F.row_number().over(each.orderBy("pos"))))
    return placed.where(F.col("place") <= F.when(F.col("_usable"), most).otherwise(few)).select(*keys, "table_idx", "place")


def budgeted_pick(tables: DataFrame, *keys: str, most: int = 3, cover: float = 0.95) -> DataFrame:
    """(keys, table_idx, place): tables by priority until the target is covered.

    tables(keys, table_idx, priority A|B|C, is_geography, confidence, estimate, target).  Within a priority
    geography stands in only for want of others.  B is taken if A covers less than `cover` of the target, C if
    both do; if nothing is taken, the first of any.
    """
    by = [*keys, "priority"]
    rows = tables.withColumn("_plain", F.max((~F.col("is_geography")).cast("int")).over(Window.partitionBy(*by))).where((F.col("_plain") == 0) | ~F.col("is_geography")).drop("_plain")
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("confidence").desc(), "table_idx")))
    each = Window.partitionBy(*keys)
    taken = lambda p, room: F.coalesce(F.sum(F.when((F.col("priority") == p) & (F.col("_k") <= room), F.coalesce("estimate", F.lit(0)))).over(each), F.lit(0))
    n = lambda p: F.sum((F.col("priority") == p).cast("int")).over(each)
    rows = rows.withColumn("_na", F.least(n("A"), F.lit(most))).withColumn("_nb_all", n("B"))
    known = F.coalesce(F.col("target"), F.lit(0)) > 0
    rows = rows.withColumn("_b", known & (taken("A", F.col("_na")) < F.col("target") * cover))
    rows = rows.withColumn("_nb", F.when(F.col("_b"), F.least("_nb_all", F.lit(most) - F.col("_na"))).otherwise(0))
    rows = rows.withColumn("_c", known & (taken("A", F.col("_na")) + taken("B", F.col("_nb")) < F.col("target") * cover))
    rows = rows.withColumn("_nc", F.when(F.col("_c"), F.lit(most) - F.col("_na") - F.col("_nb")).otherwise(0))
    order = each.orderBy("priority", "_k")
    rows = rows.withColumn("_any", F.row_number().over(order))
    room = F.when(F.col("priority") == "A", F.col("_na")).when(F.col("priority") == "B", F.col("_nb")).otherwise(F.col("_nc"))
    rows = rows.withColumn("_in", F.col("_k") <= room)
    rows = rows.withColumn("_none", ~F.max(F.col("_in")).over(each)).where(F.col("_in") | (F.col("_none") & (F.col("_any") <= most)))
    return rows.withColumn("place", F.row_number().over(order)).select(*keys, "table_idx", "place")


def by_priority(tables: DataFrame, *keys: str) -> DataFrame:
    """`place` by priority, then confidence descending, then the tables' order."""
    return tables.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("priority", F.col("confidence").desc(), "table_idx")))


def best_of_kind(tables: DataFrame, kind: str, *keys: str) -> DataFrame:
    """The table of a kind with the greatest confidence, then the greatest id."""
    return latest(tables.where(F.col("kind") == kind), ("confidence", "table_id"), *keys)


def output_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.abs("value").desc(), "item")


def primary_dimension(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, dimension): the first by priority that a table's rows have, else `segment`."""
    place = F.array_position(F.array(*[F.lit(d) for d in fixed.DIMENSION_PRIORITY]), F.col("dimension"))
    return rows.groupBy(*keys).agg(F.coalesce(F.min_by("dimension", F.when(place > 0, place)), F.lit("segment")).alias("dimension"))


def without_near_copies(items: Column, text: str, limit: float = 0.85) -> Column:
    """A sorted array of structs without those whose text's beginning is like that of one kept before."""
    alike = lambda a, b: T.jaccard_of_beginnings(a[text], b[text])
    empty = F.slice(items, 1, 0)
    return F.aggregate(items, empty, lambda kept, x: F.when(F.exists(kept, lambda k: alike(k, x) > limit), kept).otherwise(F.array_append(kept, x)))
