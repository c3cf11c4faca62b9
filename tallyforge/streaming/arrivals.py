"""An extension beyond the batch flows: filings and events as streams, with watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def filing_arrivals(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New filings as they are written to a folder of JSON files."""
    return spark.readStream.schema(schema).option("multiLine", True).json(folder)


def each_once(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Without repeats of a key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, time: str, size: str, slide: str | None, *keys: str, late: str = "1 hour") -> DataFrame:
    """(start, end, keys, n): tumbling or sliding windows; batch tables work as well."""
    timed = stream.withWatermark(time, late) if stream.isStreaming else stream
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return timed.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(stream: DataFrame, time: str, gap: str, *keys: str, late: str = "1 hour") -> DataFrame:
    """(start, end, keys, n): events of a key with less than `gap` between them."""
    timed = stream.withWatermark(time, late) if stream.isStreaming else stream
    return timed.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def run_flow(stream: DataFrame, flow: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str):
    """Each batch of new filings through a batch flow, appended to a Parquet sink; the batch number makes a rewrite visible."""

    def batch(df: DataFrame, number: int) -> None:
        flow(df).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
