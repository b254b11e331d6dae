"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import stage_table


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step. Minima are merged map-side before the shuffle; adaptive execution splits the join of a hot node."""
    if large:
        both = edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        both = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    joined = both.join(least, "src")
    if large:
        return joined.filter("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
    moved = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    own = least.select("src", F.col("low").alias("dst"))
    return moved.unionAll(own).filter("src <> dst").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for each node of ``edges`` (``src``, ``dst``), the component being its smallest node.

    Loops and repeated edges are harmless, null ends are ignored, no edges give no rows. Every round is a written
    table, so lost executors cost a re-read at most. The driver sees one checksum per round, no nodes."""
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    edges = stage_table(edges.filter("src is not null and dst is not null and src <> dst").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        edges = stage_table(_stars(_stars(edges, large=True), large=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(roots)
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
