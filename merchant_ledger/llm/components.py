"""Connected components by alternating large and small stars, all in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import materialize, remove


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _not_in_stars(edges: DataFrame) -> int:
    """How many nodes have two lesser neighbours, or a lesser and a greater one; of distinct edges (greater, lesser)."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("lesser"), F.lit(0).alias("greater")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("node").agg(F.sum("lesser").alias("lesser"), F.max("greater").alias("greater"))
    return counts.where("lesser + greater > 1 and lesser > 0").count()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node it reaches.

    Each round writes its edges to the shared folder, so lineage stays short; when each component
    is a star around its least node, no other round could change it. Minima are
    combined before the shuffle and a node of very many edges is split by the skew join, so
    no neighbourhood is ever held in one place. Loops, repeated and reversed edges are fine;
    edges with a null end are ignored; no edges give no rows.
    """
    edges = edges.select("u", "v").where("u <> v")
    edges = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    for _ in range(most_rounds):
        if not _not_in_stars(edges):
            break
        before, edges = edges, materialize(_small_star(_large_star(edges)), "edges")
        remove(before)
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
