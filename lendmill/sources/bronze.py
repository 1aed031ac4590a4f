"""From text columns to typed raw tables, with bad rows set aside, not lost."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.fixed_values import NULL_TOKENS
from lendmill.sources.files import LINE
from lendmill.sources.ledger import FILE, REPLACED, read_ledger, superseded

# Columns the load adds beside the schema's own.
QUARANTINED = "_quarantined"
BAD_COLUMNS = "_bad_columns"
RAW_TOKENS = "_raw"
LOADED_AT = "_loaded_at"
_TYPED = "_typed_"
KEEP_NULLS = {"ignoreNullFields": "false"}
LOAD_DATE = "_load_date"

# Folders of a raw table: one per load; in it rejects apart from good rows, and load days.
LOAD = "_load"
PARTITIONS = (QUARANTINED, LOAD_DATE)

# The forms a whole date and a whole time may have.
DATE_FORM = r"^\d{4}-\d{1,2}-\d{1,2}$"
TIME_FORM = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"


def clean_token(c: Column) -> Column:
    """NULL for the tokens that mean no value, else the text as read."""
    return F.when(~F.trim(c).isin(list(NULL_TOKENS)), c)


def clean_tokens(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: clean_token(F.col(c)) for c in text})


def convert_token(c: Column, to: T.DataType) -> Column:
    """Typed value, or NULL where the token does not convert. Whole numbers round."""
    if isinstance(to, T.StringType):
        return c
    c = F.trim(c)
    if isinstance(to, (T.LongType, T.DecimalType)):
        digits = to.scale if isinstance(to, T.DecimalType) else 0
        exact = c.try_cast("decimal(38,0)") if not digits else None
        rounded = F.round(c.try_cast("decimal(38,10)"), digits).try_cast(to)
        rounded = rounded if exact is None else F.coalesce(rounded, exact.try_cast(to))
        if digits:
            # With no more digits behind the point than are kept, the usual case, there is nothing to round.
            short = F.length(F.substring_index(c, ".", -1)) <= digits
            plain = short & F.lit(to.precision - digits <= 28)
            return F.when(plain, c.try_cast(to)).otherwise(rounded)
        # Plain digits, the usual case, convert without going through a decimal.
        return F.coalesce(c.try_cast("bigint").try_cast(to), rounded)
    if isinstance(to, T.DateType):
        return F.when(c.rlike(DATE_FORM), c).try_cast(to)
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        return F.when(c.rlike(TIME_FORM), c).try_cast(to)
    return c.try_cast(to)


def land_rows(df: DataFrame, schema: T.StructType, loaded_at: Column | None = None) -> DataFrame:
    """Typed rows and rejected rows of one scan, told apart by ``_quarantined``.

    A row is rejected when a token that carries a value does not convert, or its
    line's quotes do not match; it keeps its tokens as read and the names of the
    offending columns. Columns of ``df`` beyond the schema (schema drift) stay text.
    """
    kinds = {f.name: f.dataType for f in schema}
    torn = F.col(LINE).isNotNull() if LINE in df.columns else F.lit(False)
    columns = [c for c in df.columns if c not in (LINE, FILE)]
    tokens = F.struct(*[c for c in df.columns if c != FILE])
    file = F.col(FILE) if FILE in df.columns else F.lit(None).cast("string")
    # tokens as read are written out for rejects only, and each token is converted once
    typed = df.withColumn(FILE, file).select(
        "*",
        *[
            convert_token(clean_token(F.col(c)), kinds.get(c, T.StringType())).alias(_TYPED + c)
            for c in columns
        ],
    )
    offending = [
        F.when(F.col(_TYPED + c).isNull() & clean_token(F.col(c)).isNotNull(), F.lit(c))
        for c in columns
        if c in kinds and not isinstance(kinds[c], T.StringType)
    ]
    offending.append(F.when(torn, F.lit(LINE)))
    marked = typed.withColumn(BAD_COLUMNS, F.array_compact(F.array(*offending)))
    is_bad = F.size(BAD_COLUMNS) > 0
    stamp = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else loaded_at
    return marked.select(
        *[F.col(_TYPED + c).alias(c) for c in columns],
        stamp.alias(LOADED_AT),
        stamp.cast("date").alias(LOAD_DATE),
        is_bad.cast("int").alias(QUARANTINED),
        F.when(is_bad, F.col(BAD_COLUMNS)).alias(BAD_COLUMNS),
        F.when(is_bad, F.to_json(tokens, KEEP_NULLS)).alias(RAW_TOKENS),
        FILE,
    )


def good_rows(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(QUARANTINED) == 0).drop(*PARTITIONS, BAD_COLUMNS, RAW_TOKENS, FILE)


def rejected_rows(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(QUARANTINED) == 1).select(BAD_COLUMNS, RAW_TOKENS, LOADED_AT)


def split_bad_rows(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of a text frame."""
    landed = land_rows(df, schema)
    return good_rows(landed).drop(LOADED_AT), rejected_rows(landed).drop(LOADED_AT)


def to_bronze(landed: DataFrame, path: str, load: str | None = None) -> None:
    """Write one load, the only way into a raw table for streams and batches alike.

    A load of the same name is replaced. Rejects share the write but not the folder,
    so that a file is parsed once and readers of good rows never open the others.
    The load's columns are noted beside it, so readers open no file for them.
    """
    load = load or uuid.uuid4().hex
    landed.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{path}/{LOAD}={load}")
    spark = landed.sparkSession
    note = spark.range(1).select(F.lit(landed.schema.json()).alias("value"))
    note.write.mode("overwrite").text(f"{path}/_columns/{load}")


def _notes(spark: SparkSession, path: str) -> DataFrame:
    """``load`` and the schema it was written with."""
    name = F.regexp_extract("_metadata.file_path", "/_columns/([^/]+)/", 1).alias("load")
    return spark.read.text(f"{path}/_columns/*").select(name, "value").distinct()


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Rows of all load folders with the columns of all, known ones first; and the loads."""
    noted = _notes(spark, path).collect()  # a row per load
    schemas = sorted((T.StructType.fromJson(json.loads(s)) for s in {r["value"] for r in noted}), key=len)
    fields = {}
    for field in (f for s in schemas for f in s):
        fields.setdefault(field.name, field)
    fields.setdefault(FILE, T.StructField(FILE, T.StringType()))
    schema = T.StructType([*fields.values(), T.StructField(LOAD, T.StringType())])
    return spark.read.schema(schema).parquet(path), [r["load"] for r in noted]


def _entered(ledger: DataFrame) -> set[str]:
    """Loads of replaced files that count."""
    loads = ledger.filter(F.col("load").startswith(REPLACED)).select("load").distinct()
    return {r["load"] for r in loads.collect()}


def _waiting(load: str, entered: set[str]) -> bool:
    return load.startswith(REPLACED) and load not in entered


def _read_loads(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame:
    """Rows that count, of all loads or of some; folders of other loads are not opened.

    Rows of a file that was replaced since do not count, nor does a load of replaced files
    before its entry in the ledger. Only loads that read such a file are looked at row by row.
    """
    rows, every = _stored(spark, path)
    if loads is not None:
        rows = rows.filter(F.col(LOAD).isin(loads))
    ledger = read_ledger(spark, path)
    entered = _entered(ledger)
    waiting = [x for x in every if _waiting(x, entered)]
    if waiting:
        rows = rows.filter(~F.col(LOAD).isin(waiting))
    if entered:
        old = superseded(ledger)
        touched = [r["load"] for r in old.select("load").distinct().collect()]  # a row per load
        same = (F.col(LOAD) == F.col("load")) & (F.col(FILE) == F.col("file"))
        left = rows.filter(F.col(LOAD).isin(touched)).join(old, same, "left_anti")
        rows = rows.filter(~F.col(LOAD).isin(touched)).unionByName(left)
    return rows.drop(LOAD)


def read_retracted(spark: SparkSession, path: str, pairs: DataFrame) -> DataFrame:
    """Good rows, no longer counted, of (load, file) ``pairs``."""
    loads = [r["load"] for r in pairs.select("load").distinct().collect()]  # a row per load
    same = (F.col(LOAD) == F.col("load")) & (F.col(FILE) == F.col("file"))
    rows = _stored(spark, path)[0].filter(F.col(LOAD).isin(loads)).join(pairs, same, "left_semi")
    return good_rows(rows.drop(LOAD))


def replaced_pairs(spark: SparkSession, path: str) -> DataFrame | None:
    """(load, file) of all files that were replaced since their load; None where none was."""
    ledger = read_ledger(spark, path)
    return superseded(ledger) if _entered(ledger) else None


def read_without(
    spark: SparkSession, path: str, loads: list[str], pairs: DataFrame | None = None
) -> DataFrame:
    """Good rows of some loads but for those of (load, file) ``pairs``, whatever was replaced since."""
    rows = _stored(spark, path)[0].filter(F.col(LOAD).isin(loads))
    if pairs is not None:
        same = (F.col(LOAD) == F.col("load")) & (F.col(FILE) == F.col("file"))
        rows = rows.join(pairs, same, "left_anti")
    return good_rows(rows.drop(LOAD))


def load_names(spark: SparkSession, path: str) -> list[str]:
    """The loads of a raw table that count, in order of name."""
    entered = _entered(read_ledger(spark, path))
    noted = _notes(spark, path).select("load").distinct().collect()  # a row per load
    return sorted(r["load"] for r in noted if not _waiting(r["load"], entered))


def read_bronze(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame:
    """Good rows of all loads, or of some; columns added by later loads are NULL in older rows."""
    return good_rows(_read_loads(spark, path, loads))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return rejected_rows(_read_loads(spark, path))


def append_evolving(base: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; columns match whatever the case and keep the base spelling."""
    spelling = {c.lower(): c for c in base.columns}
    renamed = new.withColumnsRenamed({c: spelling.get(c.lower(), c) for c in new.columns})
    return base.unionByName(renamed, allowMissingColumns=True)
