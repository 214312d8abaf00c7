"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours (small: only its smaller ones) are tied to the smallest of them.

    Minima are aggregated before the shuffle; the join back is one that Spark can split under skew.
    """
    near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) if small else _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = near.join(least, "a")
    if small:
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    else:
        tied = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def _summary(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def component_roots(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge and is not its component's smallest node.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. Rounds go on until nothing changes;
    each writes its edges to the shared folder, so lineage stays short and lost executors cost one round.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ordered.distinct(), label)
    seen = _summary(edges)
    while seen[0]:
        edges = written(_stars(_stars(edges, small=False), small=True), label)
        now = _summary(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
