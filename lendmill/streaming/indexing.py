"""Keep a search index close behind its documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendmill.operators.history import latest_per_key
from lendmill.operators.retrieval import build_index
from lendmill.sources.buckets import BUCKETS
from lendmill.sources.search_index import KeptIndex
from lendmill.streaming.landing import NO_AGE


def kept_index(
    spark: SparkSession,
    schema: T.StructType,
    key: str,
    attributes: list[str],
    out: str,
    buckets: int = BUCKETS,
) -> KeptIndex:
    """The index that a stream of documents of a schema keeps under ``out``."""
    return KeptIndex(spark, out, key, T.StructType([schema[c] for c in (key, *attributes)]), buckets)


def start_indexing(
    spark: SparkSession,
    docs_path: str,
    schema: T.StructType,
    text: str,
    key: str,
    attributes: list[str],
    out: str,
    state: str,
    lag: str | None = "1 hour",
    deleted: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Index new documents every ``lag``; with ``lag=None`` index what is there and stop.

    A document delivered again replaces what was known of it, and one whose ``deleted``
    column is true is removed. A batch is a part of the kept index (``kept_index`` reads it),
    and parts are merged as they add up; a batch that runs again after a failure is made
    once. Within a batch the newest file wins.
    """

    def add_part(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, key, "_modified", "_file")
        kept = kept_index(batch.sparkSession, schema, key, attributes, out, buckets)
        kept.add(build_index(newest, text, key, attributes, deleted), batch_id + 1)

    file = [
        F.col("_metadata.file_modification_time").alias("_modified"),
        F.col("_metadata.file_path").alias("_file"),
    ]
    writer = (
        spark.readStream.schema(schema)
        .option("maxFileAge", NO_AGE)
        .parquet(docs_path)
        .select("*", *file)
        .writeStream.foreachBatch(add_part)
        .option("checkpointLocation", state)
    )
    if lag is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=lag).start()
