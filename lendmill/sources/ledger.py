"""Which landed files a raw table was loaded from, and which of those were replaced since."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.operators.history import latest_per_key

#: A row's column that names the landed file it came from.
FILE = "_file"

#: Beside a raw table's rows: per load, the files it read.
LEDGER = "_ledger"

#: Loads of replaced files; they count once their files are in the ledger.
REPLACED = "replaced-"

_ENTRY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("load", T.StringType()),
    ]
)

_LISTED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def listing(reader, landed: str) -> DataFrame:
    """Name, path, size and time of landed files, by ``spark.read`` or ``spark.readStream``; contents are not read."""
    return (
        reader.format("binaryFile")
        .schema(_LISTED)
        .load(landed)
        .select(
            F.col("_metadata.file_path").alias("file"),
            "path",
            "length",
            F.col("modificationTime").alias("modified_at"),
        )
    )


def note_files(files: DataFrame, out: str, load: str) -> None:
    """Enter the files (file, length, modified_at) that a load read; the same load replaces its entry."""
    entry = files.select("file", "length", "modified_at", F.current_timestamp().alias("recorded_at"))
    entry.write.mode("overwrite").parquet(f"{out}/{LEDGER}/load={load}")


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """All entries; none before the first load."""
    try:
        return spark.read.schema(_ENTRY).parquet(f"{out}/{LEDGER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def newest_entries(ledger: DataFrame) -> DataFrame:
    """Of each file the entry recorded last; an older time of the file itself does not matter."""
    return latest_per_key(ledger, "file", "recorded_at", "load")


def superseded(ledger: DataFrame) -> DataFrame:
    """``load`` and ``file`` of all entries whose file was loaded again since."""
    newest = newest_entries(ledger).select("load", "file")
    return ledger.select("load", "file").join(newest, ["load", "file"], "left_anti")


def changed_files(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that were loaded with another size or time."""
    known = newest_entries(ledger).select(
        "file", F.col("length").alias("_length"), F.col("modified_at").alias("_modified")
    )
    other = (F.col("length") != F.col("_length")) | (F.col("modified_at") != F.col("_modified"))
    return listed.join(known, "file").filter(other).drop("_length", "_modified")
