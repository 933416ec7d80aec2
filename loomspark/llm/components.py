"""Connected components over an edge table, by min labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import Stored


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", name: str = "component") -> DataFrame:
    """(id, component) for each id in edges; component is the smallest id reachable.

    Each round takes the least label among a vertex and its neighbours, then the label of that label, so
    labels travel twice as far each time. Labels are written to the shared folder between rounds. Edges
    with a null end are left out; repeated edges and loops do no harm; no edges give an empty table.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    both = Stored(pairs.union(pairs.select("b", "a")).distinct(), f"{name}-edges")
    labels = Stored(both.df().groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), f"{name}-labels")
    while True:
        now = labels.df()
        near = both.df().join(now, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("least"))
        lower = now.join(near, F.col("id") == F.col("a")).select("id", F.least("label", "least").alias("mid"), F.col("label").alias("was"))
        jump = now.select(F.col("id").alias("via"), F.col("label").alias("far"))
        following = Stored(lower.join(jump, F.col("mid") == F.col("via")).select("id", F.least("mid", "far").alias("label"), "was"), f"{name}-labels")
        changed = not following.df().where("label <> was").isEmpty()
        labels.drop()
        labels = following
        if not changed:
            both.drop()
            return labels.df().select("id", F.col("label").alias("component"))
