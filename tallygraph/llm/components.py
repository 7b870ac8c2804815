"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.session import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for nodes of ``links`` (u, v) other than smallest ones.

    Every round is written to the shared folder and read again, so lineage stays short.
    Minima are taken in each task before the shuffle, and are written before they are joined
    so that a node with very many links can be split over tasks.  Links of a node to itself
    and repeated links do no harm.
    """
    tidy = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(tidy)
    before = _state(edges)
    while before[0]:
        edges = materialize(_small(materialize(_large(edges))))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
