"""Which objects a table comes from, and which ones a change would reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.session import fresh_path, shared_dir


def lineage(edges: DataFrame, start: str, direction: str = "upstream", depth: int = 5) -> DataFrame:
    """Objects within ``depth`` steps of ``start`` and their shortest distance.

    ``edges`` has ``src`` (feeds) and ``dst``. The edges are written once, as a table of
    their own, however much work they are to derive. Each step joins the new
    nodes only and drops those already seen, so cycles end and paths do not
    multiply. A step's nodes are checkpointed: without it every step would
    recompute all steps before it.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    here, there = ("dst", "src") if direction == "upstream" else ("src", "dst")
    path = fresh_path(spark, "edges")
    edges.select(F.col(here).alias("node"), F.col(there).alias("next")).distinct().write.parquet(path)
    steps = spark.read.parquet(path)
    frontier = spark.createDataFrame([(start, 0)], "node string, distance int")
    seen = frontier
    for distance in range(1, depth + 1):
        reached = (
            steps.join(frontier.select("node"), "node", "left_semi")
            .select(F.col("next").alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
            .withColumn("distance", F.lit(distance))
        )
        frontier = reached.checkpoint()
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.filter("distance > 0")
