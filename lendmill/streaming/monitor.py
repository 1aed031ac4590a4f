"""Measure a table's metrics again whenever its data changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendmill.operators.increments import SIGN, signed
from lendmill.operators.quality import Metric, run_metrics
from lendmill.operators.relations import union_all
from lendmill.sources.buckets import BUCKETS, BucketTable
from lendmill.streaming.landing import NO_AGE

def _surplus(counts: DataFrame) -> DataFrame:
    """One row: how many rows share their key with an earlier one."""
    return counts.agg(F.coalesce(F.sum(F.greatest(F.col("n_rows") - 1, F.lit(0))), F.lit(0)).alias("value"))


def _moved_surplus(batch: DataFrame, column: str, path: str, number: int, buckets: int) -> int:
    """By how much the surplus rows of a key change with a batch; keys are kept with the number
    of their rows, and only the buckets of the batch's keys are read and rewritten."""
    keys = batch.select(F.col(column).alias("key"), SIGN).filter("key IS NOT NULL")
    changes = keys.groupBy("key").agg(F.sum(SIGN).alias("n_rows"))
    table = BucketTable(batch.sparkSession, path, "key", changes.schema, buckets)
    table.add(changes, number, "key")
    touched = table.changes(number).select("key")
    only = table.touched(touched)
    now = _surplus(table.read(only).join(touched, "key", "left_semi"))
    was = _surplus(table.read(only, before=number).join(touched, "key", "left_semi"))
    return now.first()["value"] - was.first()["value"]


def start_metrics(
    spark: SparkSession,
    table_path: str,
    table: str,
    metrics: list[Metric],
    out: str,
    state: str,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """After every batch of new files, the metrics of the table as it then is.

    A batch reads its own rows only. Rows may be signed (``increments.signed``): a row that was
    replaced or removed comes again with -1, and metrics go down with it. Counts of rows
    add up over batches; keys are kept with their number of rows, which tells the surplus ones.
    What a batch adds goes to folders named after it, so a repeated batch replaces its
    own results.
    """
    schema = spark.read.parquet(table_path).schema
    by_key = [m for m in metrics if m.kind == "duplicate_count"]
    plain = [m for m in metrics if m not in by_key]

    def measure(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        now = session.sql("select cast(current_timestamp() as timestamp_ntz)").first()[0]
        batch = batch if SIGN in batch.columns else signed(batch)
        parts = []
        if plain:
            came = run_metrics(batch.filter(F.col(SIGN) > 0), table, plain, now)
            gone = run_metrics(batch.filter(F.col(SIGN) < 0), table, plain, now)
            parts += [came, gone.withColumn("value", -F.col("value"))]
        for m in by_key:
            moved = _moved_surplus(batch, m.column, f"{out}/_keys/{m.name}", batch_id + 1, buckets)
            surplus = session.range(1).select(
                F.lit(now).alias("measurement_time"),
                F.lit(m.name).alias("metric_name"),
                F.lit(table).alias("table_name"),
                F.lit(moved).cast("long").alias("value"),
            )
            parts.append(surplus)
        union_all(parts).write.mode("overwrite").parquet(f"{out}/_added/batch={batch_id}")
        added = session.read.parquet(f"{out}/_added").filter(F.col("batch") <= batch_id)
        total = added.groupBy("metric_name", "table_name").agg(F.sum("value").alias("value"))
        total.select(
            F.lit(now).alias("measurement_time"), "metric_name", "table_name", "value"
        ).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        spark.readStream.schema(schema)
        .option("maxFileAge", NO_AGE)
        .parquet(table_path)
        .writeStream.foreachBatch(measure)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def read_metrics(spark: SparkSession, out: str) -> DataFrame:
    """All measurements, newest first."""
    found = spark.read.parquet(out).drop("batch")
    return found.orderBy("measurement_time", "metric_name", ascending=[False, True])
