"""Connected components of an edge list by randomised min-hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import saved


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, any orderable type).

    Round: each node hooks onto the lowest-ranked node among itself and its neighbours
    (rank = a hash salted with the round, so a long chain shrinks by a constant share and
    the number of rounds is logarithmic), then every edge is replaced by the edge between
    the two hooks and loops and repeats go. It ends when no edge is left; no cap on rounds.
    The hook of a hub is a minimum, computed map-side first; nothing is collected.
    Loops and repeated edges are allowed, edges with a null end are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    node_type = edges.schema["a"].dataType
    live = saved(edges.select("a", "b").filter("a <> b").distinct(), name)
    hooks: list[DataFrame] = []
    while not live.isEmpty():
        salt = F.lit(len(hooks))

        def ranked(c):
            return F.struct(F.xxhash64(F.col(c), salt).alias("rank"), F.col(c).alias("to"))

        ends = live.select(F.col("a").alias("node"), ranked("b").alias("near")).unionByName(
            live.select(F.col("b").alias("node"), ranked("a").alias("near")))
        low = ends.groupBy("node").agg(F.min("near").alias("near"))
        own = F.struct(F.xxhash64("node", salt).alias("rank"), F.col("node").alias("to"))
        hook = saved(low.select("node", F.least("near", own)["to"].alias("to")), name)
        hooks.append(hook)
        at_a = hook.select(F.col("node").alias("a"), F.col("to").alias("x"))
        at_b = hook.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = live.join(at_a, "a").join(at_b, "b").filter("x <> y")
        live = saved(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)
    if not hooks:
        return spark.createDataFrame([], f"node {node_type.simpleString()}, root {node_type.simpleString()}")
    roots = hooks[-1].withColumnRenamed("to", "root")
    for hook in reversed(hooks[:-1]):
        later = roots.withColumnRenamed("node", "to")
        roots = hook.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return saved(roots, name) if len(hooks) > 1 else roots
