"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.sources.scans import Staged, materialise


class Forest:
    """Union-find over the members of one block, which yields at most one link for each member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        parent = self.parent
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> Iterable[tuple[int, int]]:
        """Each member with the smallest member of its tree."""
        return [(node, self.find(node)) for node in self.parent if self.find(node) != node]


def _both_ways(links: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return links.select(ends.alias("l")).select("l.a", "l.b")


def components(links: DataFrame) -> Staged:
    """The smallest node that each linked node reaches: rows (node, root), stored.

    ``links`` has the columns a and b; direction and repeats don't matter, links of a node to itself
    are ignored. Every round replaces a link by links to the smallest neighbour of its larger end
    (large star) and then of its smaller neighbours (small star), until nothing changes; the number
    of rounds grows with the logarithm of the longest path. A round takes two reducing aggregations
    and two joins against them, in which Spark splits the rows of a node with very many links.
    """
    now = materialise(links.filter("a <> b").select("a", "b").distinct(), "links")
    while True:
        with_now = _star(now, larger=True)
        now.discard()
        after = _star(with_now, larger=False)
        # A forest of stars is what both steps leave as it is: every node links to one root only, which has no links of its own.
        inner = after.rows.select(F.col("b").alias("a")).distinct()
        settled = after.rows.join(inner, "a", "left_semi").isEmpty() and after.rows.groupBy("a").count().filter("count > 1").isEmpty()
        with_now.discard()
        now = after
        if settled:
            break
    result = materialise(now.rows.select(F.col("a").alias("node"), F.col("b").alias("root")), "components")
    now.discard()
    return result


def _star(links: Staged, larger: bool) -> Staged:
    """One step: connect neighbours of each node to the smallest node among it and them."""
    if larger:
        around = _both_ways(links.rows)
    else:
        around = links.rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = materialise(around.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    low = F.least("a", "low")
    with lowest:
        beside = around.join(lowest.rows, "a").select("a", "b", low.alias("low"))
        if larger:
            new = beside.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            new = beside.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        return materialise(new.filter("a <> b").distinct(), "star")
