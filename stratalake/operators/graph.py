"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.lineage import materialize


def _batch_forests(links: DataFrame) -> DataFrame:
    """The links of every Arrow batch replaced by links to the least node reached within it: never more, mostly fewer
    and shorter ways.  Nodes may be plain values or structs without NULLs."""

    def order(node):
        return tuple(node.values()) if isinstance(node, dict) else node

    def run(batches):
        for batch in batches:
            parent, node = {}, {}

            def root(n):
                while parent[n] != n:
                    parent[n] = parent[parent[n]]
                    n = parent[n]
                return n

            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                ends = []
                for n in (a, b):
                    node.setdefault(order(n), n)
                    parent.setdefault(order(n), order(n))
                    ends.append(root(order(n)))
                parent[max(ends)] = min(ends)
            kept = [(node[n], node[root(n)]) for n in parent if root(n) != n]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], batch.column(i).type) for i in (0, 1)], names=["a", "b"])

    return links.mapInArrow(run, links.schema)


def _are_stars(links: DataFrame) -> bool:
    """Every node has one link down, and those it leads to have none."""
    return (links.groupBy("a").count().filter("count > 1").isEmpty()
            and links.join(links.select(F.col("b").alias("a")), "a", "left_semi").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of the links ``a, b`` (any orderable type): the least node reachable.

    Links are shortened within batches first.  Every round then points the larger neighbours of a node, and after them
    the node and its smaller ones, to the least of them, so long chains shrink by a factor a round.  Rounds are
    checkpointed.  The other side of each join holds a node once, so adaptive execution divides a node of many links.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = materialize(_batch_forests(links).distinct())
    while not _are_stars(links):
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        up = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        up = materialize(up.filter("a <> b").distinct())
        below = up.groupBy("a").agg(F.min("b").alias("_m"))
        down = up.join(below, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("_m").alias("b"))
        links = materialize(down.filter("a <> b").distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
