"""Connected components of a graph that is larger than any machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import keep


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that is not itself the smallest.

    ``edges`` has two columns of whole numbers. Returns ``node``, ``component``;
    nodes that are not in it are their own component. Loops and repeated edges do
    no harm, a null end makes an edge void.

    Large-star and small-star steps alternate: every node hands its larger, then
    its smaller neighbours to the smallest one. The minimum of a node's
    neighbours is aggregated on the map side and written before it is joined, so
    the rows of a node with very many neighbours can be split.
    """
    links = keep(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .distinct(),
        "links",
    )
    while not links.isEmpty():
        links = _small_star(_large_star(links))
        if _is_star(links):
            break
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
        links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    low = keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("lo")), "star-low")
    return keep(
        both.join(low, "u")
        .where((F.col("v") > F.col("u")) & (F.col("v") > F.col("lo")))
        .select("lo", F.col("v").alias("hi"))
        .distinct(),
        "large-star",
    )


def _small_star(links: DataFrame) -> DataFrame:
    low = keep(links.groupBy("hi").agg(F.min("lo").alias("low")), "star-low")
    moved = links.join(low, "hi").where(F.col("lo") != F.col("low"))
    return keep(
        moved.select(F.col("low").alias("lo"), F.col("lo").alias("hi"))
        .union(low.select(F.col("low").alias("lo"), "hi"))
        .distinct(),
        "small-star",
    )


def _is_star(links: DataFrame) -> bool:
    """True if every upper end has one lower end, which is no upper end itself."""
    ends = links.select(F.col("hi").alias("n"), F.lit(1).alias("up")).union(
        links.select(F.col("lo").alias("n"), F.lit(0).alias("up"))
    )
    seen = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    bad = (F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("least") == 0))
    return seen.where(bad).isEmpty()


class Forest:
    """Links among a bounded number of items, kept as one label an item."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            a, b = label[i], label[j]
            np.minimum.at(label, a, b)
            np.minimum.at(label, b, a)
            while True:
                higher = label[label]
                if np.array_equal(higher, label):
                    break
                label[:] = higher
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """As many edges as join what is linked: each item and its label."""
        node = np.flatnonzero(self.label != np.arange(len(self.label)))
        return node, self.label[node]
