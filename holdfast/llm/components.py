"""Connected components of a link table by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``v, c``: the smallest vertex that each linked vertex of ``links`` (``a, b``) reaches.

    Alternates two steps until nothing changes: every vertex links its larger neighbours,
    then its smaller ones, to its smallest neighbour. A chain shrinks by half each time and
    a star is finished at once. Each round is written to the shared folder, so its lineage
    is short and a lost executor costs one round; only two numbers per round reach the
    driver. A vertex with a third of all links sends its minimum through combined
    aggregates, and its join is split by adaptive execution.
    """
    edges = stored(_canonical(links), "links")
    before = None
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("b").alias("v"), F.col("a").alias("c")).union(
                edges.select(F.col("a").alias("v"), F.col("a").alias("c")).distinct()
            )
        before = now
    raise RuntimeError("components did not settle")


def _canonical(links: DataFrame) -> DataFrame:
    """Links from the smaller to the larger end, once each."""
    pair = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.where("a < b").distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("x")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("x"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its larger neighbours to the smallest of its neighbours and itself."""
    around = _both(edges)
    least = around.groupBy("u").agg(F.min("x").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
    return _canonical(
        around.where("x > u").join(least, F.col("u") == F.col("w")).select(F.col("m").alias("a"), F.col("x").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("w"), "m")
    joined = edges.join(least, F.col("b") == F.col("w"))
    return _canonical(
        joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(joined.select(F.col("m").alias("a"), "b"))
    )
