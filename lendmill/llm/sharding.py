"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

Shards stand in racks, racks in regions. A key draws, for every shard, an exponential
waiting time whose rate is the shard's weight, from a hash of key and shard. A rack's draw
is the least of its shards', a region's the least of its racks'; so a rack or region
draws with the sum of the weights below it. A key descends to the region with the
least draw, in it to the least rack, in that to the least shard.

Because the draw of a subtree depends only on what is below it, a change of weights moves
keys only into or out of the subtrees whose weights change: one more shard takes keys
only into itself, whatever its rack, and a shard taken away gives up only its own. (Draws
made anew per level from the sums alone would not do: a key won by a grown region could
land on an old shard of it.)

Law: ``key``. The key's value and the shards decide, nothing else.

How it runs: one pass places every row. Slots number the rows of a shard without gaps:
rows are ranked within 1/``SPREAD`` of a shard by hash, and each such slice starts
where the ones before it end, so no task ever holds a whole shard.

Defined results: null keys share one shard, by the law. Equal keys too. Null text
has no bytes. Repeated rows get a slot each. Empty table: empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import columns as C

RACK_SHARDS = 5
REGION_RACKS = 2
SEED = "shard-1"

#: Slices of a shard for numbering.
SPREAD = 1024

Topology = Sequence[Sequence[Sequence[tuple[int, float]]]]


def topology(
    shards: int, weights: Sequence[float] | None = None, rack: int = RACK_SHARDS, region: int = REGION_RACKS
) -> Topology:
    """Regions of racks of (shard, weight); further shards are added at the end."""
    every = [(i, float(weights[i]) if weights else 1.0) for i in range(shards)]
    racks = [every[i : i + rack] for i in range(0, shards, rack)]
    return [racks[i : i + region] for i in range(0, len(racks), region)]


def tree_shard(key: Column, tree: Topology, seed: str = SEED) -> Column:
    """Struct of ``draw``, ``region``, ``rack`` and ``shard`` for a key; shards of weight 0 get nothing."""
    regions = F.array(
        *[
            F.array(
                *[
                    F.array(
                        *[
                            F.struct(F.lit(shard).alias("shard"), F.lit(weight).alias("weight"))
                            for shard, weight in rack
                        ]
                    )
                    for rack in region
                ]
            )
            for region in tree
        ]
    )

    def shard_draw(leaf: Column) -> Column:
        hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), leaf["shard"], key), 11)
        uniform = (hashed.cast("double") + 0.5) * F.lit(2.0**-53)
        return F.struct(
            F.when(leaf["weight"] > 0, -F.ln(uniform) / leaf["weight"])
            .otherwise(F.lit(float("inf")))
            .alias("draw"),
            leaf["shard"].alias("shard"),
        )

    def rack_draw(rack: Column, number: Column) -> Column:
        least = F.array_min(F.transform(rack, shard_draw))
        return F.struct(least["draw"].alias("draw"), number.alias("rack"), least["shard"].alias("shard"))

    def region_draw(region: Column, number: Column) -> Column:
        least = F.array_min(F.transform(region, rack_draw))
        return F.struct(
            least["draw"].alias("draw"),
            number.alias("region"),
            least["rack"].alias("rack"),
            least["shard"].alias("shard"),
        )

    return F.array_min(F.transform(regions, region_draw))


def place(
    docs: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] | None = None,
    keep_text: bool = True,
    seed: str = SEED,
) -> DataFrame:
    """Input columns (``text`` only with ``keep_text``), then ``size`` (UTF-8 bytes plus 16),
    ``text_crc32``, ``region``, ``rack``, ``shard``, ``grown_shard`` (with one more shard, of
    weight 1) and ``slot``."""
    names = [n for n in docs.columns if keep_text or n != text]
    inner = C.hidden(docs)
    k, t = C.position(docs, key), C.position(docs, text)
    content = F.coalesce(F.col(t), F.lit(""))
    grown = topology(shards + 1, [*weights, 1.0] if weights else None)
    rows = inner.select(
        *[F.col(c) for c in inner.columns if keep_text or c != t],
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
        tree_shard(F.col(k), topology(shards, weights), seed).alias("now"),
        tree_shard(F.col(k), grown, seed)["shard"].alias("grown"),
    )
    part = F.pmod(F.xxhash64(F.lit("slot"), F.col(k), "size", "crc"), F.lit(SPREAD)).cast("int")
    rows = rows.withColumn("shard", F.col("now.shard")).withColumn("part", part)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("shard").alias("s_shard"),
            F.col("part").alias("s_part"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        )
    )
    order = Window.partitionBy("shard", "part").orderBy(k, "size", "crc")
    numbered = rows.withColumn("rank", F.row_number().over(order) - 1)
    numbered = numbered.join(
        starts, (F.col("shard") == F.col("s_shard")) & (F.col("part") == F.col("s_part"))
    ).withColumn("slot", F.col("start") + F.col("rank"))
    kept = [c for c in inner.columns if keep_text or c != t]
    numbered = numbered.select(
        *[F.col(c).alias(f"in_{i}") for i, c in enumerate(kept)],
        "size",
        "crc",
        F.col("now.region").alias("region"),
        F.col("now.rack").alias("rack"),
        "shard",
        "grown",
        "slot",
    )
    results = {"size": "size", "text_crc32": "crc", "region": "region", "rack": "rack"}
    return C.shown(numbered, names, results | {"shard": "shard", "grown_shard": "grown", "slot": "slot"})


def write_shards(docs: DataFrame, path: str, shards: int, files_per_shard: int = 1, **settings) -> None:
    """The placed rows as Parquet under ``path/region=/rack=/shard=``, a shard dealt over that many
    files by its rows' slots."""
    placed = place(docs, shards, **settings).withColumn("file", F.col("slot") % files_per_shard)
    (
        placed.repartition("shard", "file")
        .drop("file")
        .write.partitionBy("region", "rack", "shard")
        .parquet(path)
    )
