"""Connected components by alternating stars, on Spark, with each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storelens.operators.staging import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Points neighbours of each node at the smallest of them.

    Large star: neighbours above the node; small star: neighbours below it and
    the node itself. Both keep the components.
    """
    if large:
        seen = edges.union(edges.select("v", "u")).toDF("node", "other")
    else:
        seen = edges.toDF("node", "other")
    least = seen.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root"))
    # a written table gets an exchange of its own in the join, so a node with very many neighbours can be split
    linked = seen.join(stage(least), "node")
    if large:
        made = linked.filter("other > node").select(F.col("other").alias("u"), F.col("root").alias("v"))
    else:
        made = linked.select(
            F.explode(
                F.array(
                    F.struct(F.col("other").alias("u"), F.col("root").alias("v")),
                    F.struct(F.col("node").alias("u"), F.col("root").alias("v")),
                )
            ).alias("e")
        ).select("e.u", "e.v")
    return made.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(u, v)``, the root itself included.

    ``u`` and ``v`` are longs without nulls; the root is the smallest node that is
    reachable. Loops and repeated edges do no harm; no edges give no rows. The
    rounds grow with the logarithm of the size; the driver sees two sums per round.
    """
    now = stage(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        got = now.agg(
            F.count("*").alias("n"),
            F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)).cast("decimal(38,0)")).alias("s"),
        ).first()
        if (got.n, got.s) == mark or not got.n:
            break
        mark = (got.n, got.s)
        now = stage(_star(_star(now, large=True), large=False))
    # in the end each node that is not a root points at its root
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
