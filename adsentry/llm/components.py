"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = edges.select(F.inline(ways))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Only stars are left: no node has two neighbours below it, or one below and one above.

    Edges run from larger to smaller, so a star's centre is its smallest node.
    """
    end = lambda x, below: F.struct(F.col(x).alias("x"), F.lit(below).alias("below"), F.lit(1 - below).alias("above"))
    ends = edges.select(F.inline(F.array(end("u", 1), end("v", 0))))
    per = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per.where("below > 1 or below > 0 and above > 0").isEmpty()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, label`` of every node that is not its component's smallest.

    ``edges`` has ``a, b`` (BIGINT) in any direction; loops and repeats do not
    matter. A node's neighbours are never gathered: both stars are a
    pre-aggregated minimum joined back to the edges. Each star is written
    out, as the next step reads its edges several times; the rounds grow with
    the logarithm of the components' diameter.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges"
    )
    for _ in range(max_rounds):
        if _settled(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        large = staged(_large_star(now), "cc-large")
        now = staged(_small_star(large), "cc-edges")
    raise RuntimeError("components did not settle")
