"""Joins to dimension tables, best matches, intervals and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text as T


def fixed_rows(spark: SparkSession, rows: tuple[tuple[str, ...], ...], *names: str) -> DataFrame:
    """A table of fixed strings as literals of the plan, so its size is known and joins with it need no shuffle."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])))


def item_segments(spark: SparkSession) -> DataFrame:
    return F.broadcast(fixed_rows(spark, fixed.ITEM_SEGMENT, "ticker", "item", "segment"))


def subtotals(spark: SparkSession) -> DataFrame:
    return F.broadcast(fixed_rows(spark, fixed.SUBTOTALS, "ticker", "item"))


def adjustments(spark: SparkSession) -> DataFrame:
    return F.broadcast(fixed_rows(spark, fixed.ADJUSTMENTS, "ticker", "item"))


def with_segment(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """rows(ticker, item) with `mapped`: the dimension's segment for the item as written, else whatever its case."""
    exact = dimension.select(F.upper("ticker").alias("_t"), F.col("item").alias("_i"), F.col("segment").alias("_exact"))
    loose = dimension.groupBy(F.upper("ticker").alias("_t2"), F.lower("item").alias("_i2")).agg(F.min("segment").alias("_loose"))
    who, what = F.upper(rows["ticker"]), F.trim(rows["item"])
    out = rows.join(exact, (who == F.col("_t")) & (what == F.col("_i")), "left").join(loose, (who == F.col("_t2")) & (F.lower(what) == F.col("_i2")), "left")
    return out.withColumn("mapped", F.coalesce("_exact", "_loose")).drop("_t", "_i", "_exact", "_t2", "_i2", "_loose")


def best_segment(labels: DataFrame, segments: DataFrame, threshold: float, *table: str) -> DataFrame:
    """(table, label, segment, score): of the segments that share words with a label, the best at the threshold or above.

    labels(table, label), segments(table, segment, pos).  Equal scores prefer the longer name, then the earlier.
    Words meet in an equi-join, so labels and segments without a common word are never paired.
    """
    keys = list(table)
    a = labels.select(*keys, "label").distinct().withColumn("a", T.tokens(F.col("label")))
    b = segments.select(*keys, "segment", "pos").distinct().withColumn("b", T.tokens(F.col("segment")))
    words = a.select(*keys, "label", "a", F.explode("a").alias("w")).join(b.select(*keys, "segment", "pos", "b", F.explode("b").alias("w")), [*keys, "w"])
    scored = words.drop("w").distinct().withColumn("score", T.overlap(F.col("a"), F.col("b"))).where(F.col("score") >= threshold)
    best = scored.groupBy(*keys, "label").agg(F.min_by(F.struct("segment", "score"), F.struct(-F.col("score"), -F.length("segment"), "pos")).alias("m"))
    return best.select(*keys, "label", "m.segment", "m.score")


def segment_keys(segments: DataFrame) -> DataFrame:
    """(key, segment): lower-cased names, names without a parenthesis, and sorted words; a later segment overwrites an earlier. segments(segment, pos)."""
    bare = F.lower(F.trim(F.regexp_replace("segment", r"\s*\([^)]*\)\s*$", "")))
    words = F.when(F.size(T.tokens(F.col("segment"))) > 0, F.array_join(F.array_sort(T.tokens(F.col("segment"))), " "))
    keys = segments.select(F.posexplode(F.array(F.lower("segment"), bare, words)).alias("k", "key"), "segment", "pos").where("key is not null")
    return keys.groupBy("key").agg(F.max_by("segment", F.struct("pos", "k")).alias("segment"))


def with_description(rows: DataFrame, descriptions: DataFrame) -> DataFrame:
    """rows(item) with their description, '' without one."""
    return rows.join(descriptions.select("item", F.col("description").alias("_d")), "item", "left").withColumn("description", F.coalesce("_d", F.lit(""))).drop("_d")


def last_table_attributes(labels: DataFrame, rows: DataFrame) -> DataFrame:
    """labels(label) with the attributes of their row in the last table that has one; rows(item, table_pos, row_idx, segment, dimension)."""
    key = lambda c: F.lower(T.clean_line(c))
    last = rows.groupBy(key(F.col("item")).alias("_k")).agg(F.max_by(F.struct("segment", "dimension"), F.struct("table_pos", -F.col("row_idx"))).alias("_a"))
    return labels.join(last, key(F.col("label")) == F.col("_k"), "left").select("label", "_a.segment", "_a.dimension")


def in_intervals(points: DataFrame, ranges: DataFrame, width: int, *keys: str) -> DataFrame:
    """points(keys, pos) with each range(keys, start, end, name) that holds them, start included.

    Ranges are cut into cells of `width`, so points and ranges meet in an equi-join whatever their number.
    """
    cells = ranges.where("end > start").withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    return points.withColumn("_cell", F.floor(F.col("pos") / width)).join(cells, [*keys, "_cell"]).where("pos >= start AND pos < end").drop("_cell")


def footnotes_of(labels: DataFrame, notes: DataFrame) -> DataFrame:
    """(label, footnote): the definition of the first of a label's footnotes that has one; labels(label, ids), notes(id, definition)."""
    ids = labels.select("label", F.posexplode("ids").alias("k", "id"))
    return ids.join(notes, "id").groupBy("label").agg(F.min_by("definition", "k").alias("footnote"))


def containing(labels: DataFrame, words: DataFrame, most: int = 1000) -> DataFrame:
    """(label, word) where either contains the other, whatever their case.

    Up to `most` words become literals of the plan and each label is held against them in place; more are dealt to
    blocks that meet all labels in an equi-join, so neither side is broadcast.
    """
    either = lambda a, b: F.contains(F.lower(a), F.lower(b)) | F.contains(F.lower(b), F.lower(a))
    some = [r[0] for r in words.where("word IS NOT NULL").select("word").limit(most + 1).collect()]
    if len(some) <= most:
        known = F.array(*[F.lit(w) for w in some]).cast("array<string>")
        return labels.select("label", F.explode(F.filter(known, lambda w: either(F.col("label"), w))).alias("word"))
    blocks = -(-words.count() // most)
    dealt = words.withColumn("_block", F.pmod(F.xxhash64("word"), F.lit(blocks)))
    everywhere = labels.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return everywhere.join(dealt, "_block").where(either(F.col("label"), F.col("word"))).drop("_block")


def within_tolerance(amounts: DataFrame, targets: DataFrame, share: float, *keys: str) -> DataFrame:
    """amounts(keys, amount) with the targets(keys, target) that they miss by less than share of the target."""
    return amounts.join(targets, list(keys)).where(F.abs(F.col("amount") - F.col("target")) < F.abs("target") * share)


def missing(wanted: DataFrame, have: DataFrame, *keys: str) -> DataFrame:
    return wanted.join(have, list(keys), "left_anti")
