"""Connected components of a distributed edge list by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import forget, no_broadcast, saved


def _roots(links: DataFrame) -> DataFrame:
    """Each node points to its smallest neighbour or itself; pointers are doubled until they rest."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    ptr = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")), "cc-ptr")
    old = ptr
    while True:
        up = ptr.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        new = saved(
            ptr.join(no_broadcast(up), "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-ptr"
        )
        forget(old)
        ptr = old = new
        if ptr.filter("moved").isEmpty():
            return ptr.select("u", "p")
        ptr = ptr.select("u", "p")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v of one orderable type, no nulls).

    Every round contracts each component at least by half, so the number of rounds is logarithmic.
    The root is some node of the component, the same for all its nodes. Only a yes/no per round
    reaches the driver: no join broadcasts a side. Joins read saved tables on both sides, so that adaptive
    execution can split a root which holds a large share of the nodes. An empty edge list gives no rows.
    """
    nodes = None
    links = saved(links.select("u", "v").filter("u != v").distinct(), "cc-links")
    while True:
        if links.isEmpty():
            if nodes is None:
                return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes
        root = _roots(links)
        if nodes is None:
            nodes = root.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            step = root.select(F.col("u").alias("root"), F.col("p").alias("next"))
            nodes = saved(
                nodes.join(no_broadcast(step), "root", "left").select("node", F.coalesce("next", "root").alias("root")), "cc-nodes"
            )
        a, b = root.select("u", F.col("p").alias("pu")), root.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        fewer = saved(
            links.join(no_broadcast(a), "u").join(no_broadcast(b), "v").filter("pu != pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(),
            "cc-links",
        )
        forget(links)
        links = fewer
