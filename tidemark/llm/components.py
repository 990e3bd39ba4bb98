"""Connected components by alternating stars, with DataFrame operations only.

Each round points every node's larger neighbours at the smallest node it knows, then every
node's smaller neighbours at the smallest of those. Edges never grow in number, and in a
logarithmic number of rounds every component is a star around its smallest node. That they
are stars is seen from the edges, without a round that changes nothing. A node with very many
edges is no hot spot: the smallest neighbour is a pre-aggregated minimum, and the joins back
are plain equi-joins that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """May repeat edges; the small star takes minima and drops repeats at its end."""
    both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF(
        "node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (both.join(least, "node").filter(F.col("other") > F.col("node"))
            .select(F.col("other").alias("hi"), F.col("least").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    """``extra`` is 1 for edges that are not their upper end's only one."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    rows = edges.join(least, "hi").select(F.inline(F.array(
        F.struct("hi", F.col("least").alias("lo"), F.lit(0).alias("extra")),
        F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo"), F.lit(1).alias("extra")))))
    return (rows.filter(F.col("hi") != F.col("lo")).groupBy("hi", "lo")
            .agg(F.min("extra").alias("extra")))


def _kept(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """The written edges, and, taken while writing, their number and that of extra ones."""
    seen = Observation()
    written = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                   F.sum("extra").alias("extra")), "edges")
    return written.drop("extra"), seen.get.get("n") or 0, seen.get.get("extra") or 0


def _flat(edges: DataFrame) -> bool:
    """Whether no node is an upper and a lower end; one shuffle instead of a round's six."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("hi").alias("node"), F.lit(True).alias("up"), F.lit(False).alias("down")),
        F.struct(F.col("lo").alias("node"), F.lit(False).alias("up"), F.lit(True).alias("down")))))
    both = ends.groupBy("node").agg(F.max("up").alias("up"), F.max("down").alias("down"))
    return not both.agg(F.count_if(F.col("up") & F.col("down")).alias("n")).first()["n"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another one; root is the smallest
    node of its component and a row of its own. Null ends and loops are left out. Nodes are
    of any type with an order; 64-bit numbers are the cheapest."""
    x, y = F.col(a), F.col(b)
    # the comparison leaves out nulls and loops
    now, n, extra = _kept(edges.filter(x != y).select(
        F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct()
        .withColumn("extra", F.lit(1)))
    # stars: every upper end has one edge, to a node that is no upper end itself
    while n and (extra or not _flat(now)):
        now, n, extra = _kept(_small_star(_large_star(now)))
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
