"""Scans of landed files: CSV by position or by header name, Parquet, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.schemas import as_text

# One header line, fields optionally in double quotes, blanks around a field
# dropped, short rows padded with NULL and extra fields ignored.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


# The line a row was read from, where lines are looked at; bad rows keep it.
LINE = "_line"


def read_csv_positional(
    spark: SparkSession, path, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """File columns take the schema's names in order; all values are still text.

    Quoted fields may hold line breaks with ``multi_line``; a file is then read by
    one task. Without it large files are split by lines, and a column ``_line``
    carries every line with a torn quote, for the load to set aside.
    """
    text = as_text(schema)
    if multi_line:
        return spark.read.schema(text).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)
    # Spark hands out the line of a row of another width than asked for, so one more is asked for
    asked = T.StructType([*text, T.StructField("_more", T.StringType()), T.StructField(LINE, T.StringType())])
    read = (
        spark.read.schema(asked)
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", "false")  # else the width of a line is never looked at
        .csv(path)
    )
    torn = F.length(F.regexp_replace(LINE, '[^"]', "")) % 2 == 1
    return read.withColumn(LINE, F.when(torn, F.col(LINE))).drop("_more")


def read_csv_by_name(
    spark: SparkSession,
    path,
    schema: T.StructType,
    evolve: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Match file columns to the schema by header name, whatever the case.

    Columns the file lacks are NULL. Columns the schema lacks are dropped, or
    kept at the end when ``evolve`` is set. All values are still text. Files that
    are read together must share one header: another one is an error, never a
    swap. ``streaming.landing.read_delivered`` groups files by their headers.
    """
    strict = CSV_OPTIONS | {"enforceSchema": "false", "multiLine": str(multi_line).lower()}
    raw = spark.read.options(**strict).option("inferSchema", "false").csv(path)
    if not multi_line:
        raw = read_csv_positional(spark, path, raw.schema, multi_line=False)
    in_file = {c.strip().lower(): c for c in raw.columns if c != LINE}
    known = [
        F.col(f"`{in_file[f.name.lower()]}`").alias(f.name)
        if f.name.lower() in in_file
        else F.lit(None).cast("string").alias(f.name)
        for f in schema
    ]
    names = {f.name.lower() for f in schema}
    extra = [F.col(f"`{c}`").alias(low) for low, c in in_file.items() if low not in names]
    line = [] if multi_line else [LINE]
    return raw.select(*known, *(extra if evolve else []), *line)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def read_ndjson(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """One JSON object per line; a line that holds an array is one malformed row."""
    return spark.read.schema(schema).option("multiLine", "false").json(path)


def read_ndjson_variant(spark: SparkSession, path) -> DataFrame:
    """One JSON value per line, of any shape, as it is: ``value`` keeps all fields, known or not.

    A line that is no JSON has no value and keeps its text in ``_line``; empty lines are none.
    The value can be stored as it is; ``variant_fields`` takes fields out of it whenever they are asked for.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.try_parse_json("value").alias("parsed"), F.col("value").alias("_text"))
    return parsed.select(
        F.col("parsed").alias("value"), F.when(F.col("parsed").isNull(), F.col("_text")).alias(LINE)
    )


def variant_fields(rows: DataFrame, fields: dict[str, tuple[str, str]], value: str = "value") -> DataFrame:
    """The rows with typed columns taken out of a variant: result name -> (path, type).

    A path that a row lacks, or that holds JSON's null, gives NULL. One that holds something which does not convert
    gives NULL too, and its name stands in ``_bad_columns``, so that nothing is lost unseen.
    """
    found = {n: F.try_variant_get(value, path, kind) for n, (path, kind) in fields.items()}
    bad = [
        F.when(F.try_variant_get(value, path, "variant").isNotNull()
               & ~F.is_variant_null(F.try_variant_get(value, path, "variant")) & found[n].isNull(), F.lit(n))
        for n, (path, _) in fields.items()
    ]
    kept = [c for c in rows.columns if c not in found]
    return rows.select(
        *kept, *[c.alias(n) for n, c in found.items()], F.array_compact(F.array(*bad)).alias("_bad_columns")
    )


def list_files(spark: SparkSession, path) -> DataFrame:
    """Manifest of the files under a path: name, size and time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified_at"))
    )


def unseen_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not loaded before: new names, or known names with new content."""
    return manifest.join(
        ledger.select("path", "length", "modified_at"),
        ["path", "length", "modified_at"],
        "left_anti",
    )


def from_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Inline literal rows."""
    return spark.createDataFrame(rows, schema)
