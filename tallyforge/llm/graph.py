"""Connected components of an edge table by label propagation with pointer jumping; all state is in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """`nodes(v)` and `edges(a, b)` to `(v, label)`, the smallest node that each node reaches.

    A round takes the least label among a node and its neighbours.  Groups of near copies are nearly stars and
    settle in two or three rounds; from the third on, all nodes of a label take the least label next to any of
    them, which at least halves the number of unsettled groups.  The rows that a hot node or label receives are
    reduced on the map side, and its join partition is split by adaptive execution.  Each round is checkpointed
    once, as lost executors would otherwise replay all of them.
    """
    both = checkpoint(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), narrow=True)
    state = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low")).select("v", F.least("v", "low").alias("label"))
    for k in range(max_rounds):
        near = both.join(state.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("low"))
        seen = checkpoint(state.join(near, "v").select("v", "label", F.least("label", "low").alias("low")), narrow=True)
        if seen.where("low < label").isEmpty():
            break
        state = seen.select("v", F.col("low").alias("label"))
        if k > 0:
            least = seen.groupBy("label").agg(F.min("low").alias("to"))
            state = seen.join(least, "label").select("v", F.col("to").alias("label"))
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(state, "v", "left").select("v", F.coalesce("label", "v").alias("label"))
