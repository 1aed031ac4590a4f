"""Connected components of a link table, by alternating star contraction.

Every round replaces links by links to smaller nodes: first each node's larger
neighbours are hung on its smallest neighbour, then each node and its smaller
neighbours are. A round is two grouped minima and two joins. A node with very many links
costs one row per task in the minimum; in the join its links are dealt to ``SALTS`` groups by
their other end, and the minimum is handed to the groups that have links, so a table of them
is never larger than the links. The number of rounds grows with the logarithm of the longest
chain. Nothing but two numbers per round reaches the driver; each round is written to the
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import shared_dir

#: Groups that the links of one node are dealt to in a join.
SALTS = 64


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
        ).first()
    )


def _told(links: DataFrame, at: str, other: str, low: DataFrame) -> DataFrame:
    """``links`` with the ``low`` of their end ``at``, null where ``low`` has none for it."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    groups = salted.select(at, "salt").distinct()
    return salted.join(groups.join(low, at), [at, "salt"], "left")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` for every node with a link; the root is the smallest node reachable.

    Links of a node with itself or with null are ignored. Repeated links and
    either direction are fine. No links: no rows.
    """
    shared_dir(links.sparkSession)
    stars = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
        .distinct()
        .checkpoint()
    )
    before = _state(stars)
    while before[0]:
        # a node's smallest neighbour is below it only where links lead down from it
        lowest = stars.groupBy(F.col("node").alias("root")).agg(F.min("root").alias("low"))
        large = _told(stars, "root", "node", lowest).select("node", F.coalesce("low", "root").alias("root"))
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = _told(large, "node", "root", low).select(
            F.col("root").alias("node"), F.col("low").alias("root")
        )
        stars = (
            small.where(F.col("node") != F.col("root"))
            .union(low.select("node", F.col("low").alias("root")))
            .distinct()
            .checkpoint()
        )
        after = _state(stars)
        if after == before:
            break
        before = after
    own = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.union(own)
