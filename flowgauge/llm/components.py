"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.session import settle


def _stars(links: DataFrame) -> DataFrame:
    """One round: every node hands its larger neighbours to its smallest one, then the rest likewise.

    The smallest neighbour is a ``min`` that is combined before the shuffle, so
    a node with very many links costs no more than its rows.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()  # here always a > b

    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of one ordered type -> (node, root) for every node but the roots.

    The root is the smallest node that can be reached. Rounds of large and
    small stars, each written to the shared folder, until a round changes
    nothing; their number grows with the logarithm of the longest chain.
    Links with a NULL end and links of a node to itself are left out.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settle(links.filter("a > b").distinct())
    state = None
    while True:
        mark = links.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")
        ).first()
        if mark["n"] == 0 or state == tuple(mark):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(mark)
        links = settle(_stars(links))
