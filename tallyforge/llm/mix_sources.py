"""Mixing sources to target weights by capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_RE, columns, documents

#: Each source's share of hash space is cut into so many cells; only the cell in which its fraction ends is ordered row by row.
CELLS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], total_ratio: float, max_epochs: float) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    The fixed point of "stop at max_epochs times the size, reshare the excess by weight" is
    least(cap, level * weight) with one level for all.  Sources sorted by cap / weight reach their caps
    in this order, so the level follows from running sums: it is the first whose remaining sources,
    sharing what the capped ones left, all stay below their caps.  Levels only fall from there on, so it is the greatest of those.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source, not for each document
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", max_epochs * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = ranked.withColumn("budget", total_ratio * F.sum("source_size").over(every))
    levels = levels.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    levels = levels.withColumn("water", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every))
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight")))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), total_ratio: float = 1.5, max_epochs: float = 2.0, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, reps, taken) of each row.

    Sizes are numbers of words (null or empty text: 0).  Weights go to the sources by code point, null
    last, repeating.  A row is taken floor(target / source_size) times, and once more if it is among the
    source's first rows in the order of md5(seed:doc_id), as many as bring the running sum of sizes
    nearest to the rest, so a source misses its target by half a document at most.  Equal doc_ids are ordered by their
    text's md5, and rows equal in both are taken alike; sources without words have target 0 and take nothing.  An empty table
    mixes to an empty one.  Reruns agree.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    rows = columns(docs, "doc_id", "source", "text").select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"))
    rows = rows.withColumn("cell", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = source_targets(sizes, weights, total_ratio, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("upto", F.sum("words").over(running))  # at most CELLS rows for each source
    plan = cells.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), F.col("cell").alias("c"), "upto", "words", "source_size", "target", "whole", "extra")
    dealt = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    edge = (F.col("upto") > F.col("extra")) & (F.col("upto") - F.col("words") < F.col("extra"))
    # only rows of the cell in which the fraction ends need an order; others get keys of their own
    within = Window.partitionBy("source", F.when(edge, F.lit(0)).otherwise(F.col("cell") + 1), F.when(edge, F.lit("")).otherwise(F.col("key"))).orderBy("key", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.withColumn("sum", F.sum("size").over(within))
    more = F.when(F.col("upto") <= F.col("extra"), 1).when(edge & (F.col("upto") - F.col("words") + F.col("sum") - F.col("size") / 2 <= F.col("extra")), 1).otherwise(0)
    reps = (F.col("whole") + more).cast("long")
    return dealt.select("doc_id", "source", "tie", "size", "source_size", "target", reps.alias("reps"), (F.col("size") * reps).alias("taken"))


def mixed(docs: DataFrame, **kwargs) -> DataFrame:
    """The rows, with all their columns, each as many times as the mix takes it."""
    plan = mix(docs, **kwargs).where("reps > 0").select("doc_id", "source", "tie", "reps").distinct()
    plan = plan.select(F.struct("doc_id", "source", "tie").alias("of"), "reps")
    rows = docs.select(F.struct("*").alias("row"), F.struct("doc_id", "source", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie")).alias("of"))
    repeated = rows.join(plan, rows["of"].eqNullSafe(plan["of"])).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "reps")).alias("k"))
    return repeated.select("row.*")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH rows AS (
  SELECT doc_id, source, md5('0:' || CAST(doc_id AS VARCHAR)) AS key,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
    2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget FROM sizes),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT max(level) FROM levels WHERE level * weight <= cap)) AS target FROM levels),
plan AS (
  SELECT *, CAST(floor(target / source_size) AS BIGINT) AS whole, target - floor(target / source_size) * source_size AS extra FROM targets),
summed AS (
  SELECT r.*, source_size, target, whole, extra, sum(size) OVER (PARTITION BY r.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN upto - size / 2.0::DOUBLE <= extra THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM summed
"""
