"""Connected components of a links table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polysift.scratch import discard, materialise

MAX_ROUNDS = 60


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """One step over undirected edges (a, b), a != b: neighbours are rehung on the smallest one. Edges may repeat.

    The smallest neighbour comes from a partially aggregated ``min``; the join back splits hot nodes like any skewed join.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("top"))
    joined = both.join(least, "a")
    hung = joined.filter("b > a") if large else joined
    out = hung.select(F.col("b").alias("a"), F.col("top").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("top").alias("b")))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another: the component is its smallest node.

    Links are undirected and may repeat; null ends and loops are ignored. Each round is written to the shared folder, in place
    of the one before.
    """
    a, b = F.col(left), F.col(right)
    edges = links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    written = before = None
    for _ in range(MAX_ROUNDS):
        done = materialise(_star(_star(edges, large=True), large=False).distinct(), "edges")
        if written is not None:
            discard(written)
        edges = written = done
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
