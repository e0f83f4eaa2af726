"""Connected components: union-find on what a task holds, star contraction across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.session import materialize


def roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Union-find over nodes 0..n-1 and links (a, b): the smallest node of each node's component.

    Whole arrays of links are hooked at once: the larger root of each link points to the smallest root it meets, and
    paths are halved until no link joins two roots. ``parent`` continues an earlier result.
    """
    parent = np.arange(n) if parent is None else parent
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            shorter = parent[parent]
            if np.array_equal(shorter, parent):
                break
            parent = shorter
    return parent


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a", "b").agg(F.lit(1).alias("x")).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Large-star and small-star rounds (Kiveris et al., 2014): every node tells its larger, then its smaller neighbours
    the smallest one it knows, until each component is a star around its smallest node. Each round is written to the
    shared folder. Smallest neighbours come from a partial aggregate; the joins read written tables on both sides, so
    that a node with very many links can be split at run time.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    stars = materialize(_distinct(edges.filter("a <> b").select(larger.alias("a"), smaller.alias("b"))), name)
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-least"
        )
        # Large star: larger neighbours of a point to the least of a's neighbourhood.
        wide = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        wide = materialize(wide, f"{name}-large")
        least = materialize(wide.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
        # Small star: so do a's smaller neighbours and a itself.
        narrow = wide.join(least, "a")
        narrow = (
            narrow.filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        )
        stars = materialize(_distinct(narrow.filter("a <> b")), name)
    return _labels(stars)


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two links down, and none that is pointed at points on."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    per_node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_node.filter("down + up > 1").isEmpty()


def _labels(stars: DataFrame) -> DataFrame:
    roots_ = stars.groupBy("b").agg(F.lit(1).alias("x")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots_)
