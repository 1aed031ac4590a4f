"""Where tables live and how a run publishes them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def target_path(root: str, name: str, layer: str | None = None, default: str = "silver") -> str:
    """The layer is used as given, trimmed; without one the default applies."""
    chosen = default if layer is None else layer.strip()
    return f"{root.rstrip('/')}/{chosen}/{name}"


def register_view(df: DataFrame, name: str) -> None:
    """A view is an unexecuted plan under a name."""
    df.createOrReplaceTempView(name)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Publish this result as the table's next run and read it back.

    Readers keep the run before until the new one is written whole; a job that dies
    half-way leaves it in force, and the next try overwrites the half-written run.
    """
    spark = df.sparkSession
    run = current_run(spark, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/runs/run={run}")
    _record_run(spark, path, run)
    return read_table(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last published run."""
    return spark.read.parquet(f"{path}/runs/run={current_run(spark, path)}")


def _record_run(spark: SparkSession, path: str, run: int) -> None:
    spark.range(run, run + 1).select(F.col("id").alias("run")).write.mode("append").parquet(
        f"{path}/published"
    )


def current_run(spark: SparkSession, path: str) -> int:
    """Number of the last published run; 0 before the first."""
    try:
        runs = spark.read.schema("run bigint").parquet(f"{path}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return runs.agg(F.max("run")).first()[0] or 0


def publish_versions(versions: DataFrame, path: str, flag: str = "is_current") -> int:
    """Store what a snapshot made of the open versions, as the next run.

    Open and closed versions go to different folders of the run, so a closed
    version is written once and never copied again. A run counts only once
    its number is recorded: a job that dies before leaves the old state in
    force, and the next try overwrites the half-written run.
    """
    spark = versions.sparkSession
    run = current_run(spark, path) + 1
    versions.write.mode("overwrite").partitionBy(flag).parquet(f"{path}/versions/run={run}")
    _record_run(spark, path, run)
    return run


def read_versions(
    spark: SparkSession, path: str, flag: str = "is_current", closed: bool = True
) -> DataFrame | None:
    """The open versions of the last run and, with ``closed``, those closed by any run.

    None before the first run. Other folders are pruned by their names.
    """
    run = current_run(spark, path)
    if not run:
        return None
    stored = spark.read.parquet(f"{path}/versions")
    is_open = F.col(flag).cast("boolean")
    wanted = is_open & (F.col("run") == run)
    if closed:
        wanted = wanted | (~is_open & (F.col("run") <= run))
    return stored.filter(wanted).withColumn(flag, is_open).drop("run")
