"""Connected components of an undirected link table, as Spark joins.

Alternating large-star / small-star rounds: every node points to the smallest
node it has seen, so long chains shorten by a constant factor each round.  A
round is one pre-aggregated minimum per node and one equi-join; the links of a
round are written to the shared folder and read again, so that the lineage
stays short and a lost executor costs one round at most.  Only two numbers per
round (count and hash sum of the links) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import counted, stored


def _star(links: DataFrame, rows: int) -> DataFrame:
    """links(u, v), about as many as the rows, each node u with all v it is to be joined with: (v, smallest of u's neighbourhood)."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(counted(least, rows), "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link to another one; component is the smallest node reachable.

    Null ends and links of a node to itself are ignored; repeated links count once."""
    now = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    seen, rows = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, rows).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        s = _star(large, rows)
        small = s.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v")))
        now = stored(small.where("u != v").distinct(), "links")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, rows = mark, mark[0]
    # every link now leads from a node to its component's smallest node
    return counted(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), rows)
