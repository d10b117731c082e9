"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import release, stored


def _lows(edges: DataFrame) -> DataFrame:
    """The smallest vertex around every `src`, itself included; a written table,
    so that joins with it shuffle plain rows on both sides, which Spark splits
    where a vertex has very many edges."""
    return stored(edges.groupBy("src").agg(F.least("src", F.min("dst")).alias("low")), "lows")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex moves to the smallest vertex around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = _lows(both)
    moved = stored(both.join(low, "src").filter(F.col("dst") > F.col("src"))
                   .select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct(), "edges")
    release(low)
    return moved


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex (src > dst) and its smaller neighbours move to the smallest."""
    low = _lows(edges)
    moved = stored(edges.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
                   .unionByName(low.select("src", F.col("low").alias("dst")))
                   .filter(F.col("src") != F.col("dst")).distinct(), "edges")
    release(low)
    return moved


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (src, dst); the
    component is named by its smallest vertex.

    Each round is two aggregations and joins on a vertex; no group is gathered
    in a task (the aggregates combine on the map side, a vertex with very many
    edges is a skewed join that Spark splits) and every round is a written
    table.  Rounds go on until the edge set is a set of stars and no longer
    changes.  Null vertices and self-loops make no edge; no edges: no rows.
    """
    current = stored(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(), "edges")
    state = None
    while True:
        large = _large_star(current)
        following = _small_star(large)
        release(large)
        seen = following.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        release(current)
        current = following
        if state == seen:
            break
        state = seen
    roots = current.select(F.col("dst").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return current.select(F.col("src").alias("vertex"), F.col("dst").alias("component")).unionByName(roots)
