"""Connected components of a graph given as edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the component's least node.

    Each round hooks every vertex to the least of its neighbours and itself,
    follows those hooks until they end, and contracts the edges; rounds grow
    with the logarithm of the longest path. What is iterated over is written to
    the shared folder each time. Hot vertices: hooks are a pre-aggregated
    minimum, and the joins are plain ones that adaptive execution can split.
    """
    spark = edges.sparkSession
    left = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mapping = spark.createDataFrame([], "node long, label long")
    first = True
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(both.groupBy("a").agg(F.min("b").alias("b"))
                        .select(F.col("a").alias("vertex"), F.least("a", "b").alias("up")), "hooks")
        while True:
            upper = hooks.select(F.col("vertex").alias("_v"), F.col("up").alias("_up"))
            hooks = written(hooks.join(upper, F.col("up") == F.col("_v"))
                            .select("vertex", F.col("_up").alias("up"), (F.col("_up") != F.col("up")).alias("moved")),
                            "hooks")
            if hooks.filter("moved").isEmpty():
                break
        to = hooks.select("vertex", "up")
        if first:
            mapping, first = to.select(F.col("vertex").alias("node"), F.col("up").alias("label")), False
        else:
            mapping = written(mapping.join(to, F.col("label") == F.col("vertex"), "left")
                              .select("node", F.coalesce("up", "label").alias("label")), "labels")
        left = written(left.join(to, F.col("a") == F.col("vertex")).select(F.col("up").alias("a"), "b")
                       .join(to, F.col("b") == F.col("vertex")).select("a", F.col("up").alias("b"))
                       .filter("a <> b").distinct(), "edges")
    return mapping
