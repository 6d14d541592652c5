"""Connected components of a table of links, by alternating stars.

Each round points the neighbours of a node at the smallest of them (large star), then the
smaller neighbours of a node and itself at the smallest (small star).  Links and labels stay
in tables; the minimum of a node with very many links is a partial aggregate, and the join
that spreads it is one whose skewed partitions adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.session import written


def _toward_least(links: DataFrame) -> DataFrame:
    """(u, v, m) of links u-v with m the least of u and its v's."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return links.join(least, links["u"] == least["_u"]).drop("_u")


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, the root being the least of its component.

    ``links`` has two columns of one orderable type; loops, nulls and repeats are ignored.
    """
    a, b = links.columns
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = written(links, "links")
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.where(F.col("u") != F.col("v")), "links")
        small = _toward_least(large)
        pairs = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        links = written(pairs.where(F.col("u") != F.col("v")).distinct(), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())
