"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


#: Links of one node from which on it counts as a hub, at least; beyond, a share of all links, so that
#: there are at most HUBS * 2 of them.
HUB, HUBS = 1_000, 100_000


def _to_least(edges: DataFrame, n: int) -> DataFrame:
    """edges (a, b), n of them, with _m, the least of a's neighbours and a itself.

    Hubs, of which there are few, are joined by a broadcast, so that the links of one are not sent to
    one task; groups combine before they are sent.
    """
    most = max(HUB, n // HUBS)
    least = cut(edges.groupBy("a").agg(F.min("b").alias("_m"), F.count(F.lit(1)).alias("_d")).select("a", F.least("a", "_m").alias("_m"), (F.col("_d") > most).alias("_hub")))
    if not least.filter("_hub").take(1):
        return edges.join(least.select("a", "_m"), "a")
    hubs = F.broadcast(least.filter("_hub").select("a", F.col("_m").alias("_h")))  # HUBS * 2 rows at most
    told = cut(edges.join(hubs, "a", "left"))
    rest = told.filter("_h is null").drop("_h").join(least.filter("not _hub").select("a", "_m"), "a")
    return told.filter("_h is not null").withColumnRenamed("_h", "_m").unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """node, component of all nodes in links (columns a and b, of one type): the least node reachable.

    Alternates two steps, each a grouping and a join, until nothing changes: every node's larger
    neighbours are linked to its least one, then its smaller neighbours are. That takes few rounds
    (of the order of the squared logarithm of the longest path at most), and the number of links
    never grows. No node's links are held in one place.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = cut(edges), None
    n = edges.count()
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut(_to_least(both, 2 * n).filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct())
        small = _to_least(large, n)
        edges = small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("_m").alias("b")), F.struct("a", F.col("_m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = cut(edges)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select("b", "b").toDF("node", "component")).distinct()
