"""Cutting long plans: a stage's rows are written to the shared checkpoint folder, so neither planning nor recovery repeats what made them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The same rows with a short plan.

    The folder is the session's spark.checkpoint.dir.  Without one, a session on one machine gets its own; on a
    cluster that would be lost with an executor, so it is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)
