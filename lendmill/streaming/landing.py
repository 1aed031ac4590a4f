"""Load landed files exactly once, in small batches."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendmill.schemas import DRIFT_DELIVERIES, RAW_TABLES
from lendmill.sources.bronze import append_evolving, land_rows, to_bronze
from lendmill.sources.files import CSV_OPTIONS, read_csv_by_name, read_csv_positional
from lendmill.sources.ledger import FILE, REPLACED, changed_files, listing, note_files, read_ledger

#: A file counts however old it is: what was loaded is remembered by name.
NO_AGE = "1000000d"


@dataclass(frozen=True)
class Delivery:
    """Files of one table: by position, or by header name with new columns kept."""

    files: str
    schema: T.StructType
    by_name: bool = False


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path).columns)


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def read_delivered(
    spark: SparkSession, paths: list[str], delivery: Delivery, multi_line: bool = True
) -> DataFrame:
    """Text rows of some files, each with the file it came from. By name, files are read per
    header, so that each file's columns go where its own header says."""
    if not delivery.by_name:
        return _with_file(read_csv_positional(spark, paths, delivery.schema, multi_line))
    with ThreadPoolExecutor(16) as pool:  # a header is the first line of its file
        headers = list(pool.map(lambda p: header_of(spark, p), paths))
    groups = defaultdict(list)
    for header, path in zip(headers, paths, strict=True):
        groups[header].append(path)
    read = [
        _with_file(read_csv_by_name(spark, own, delivery.schema, evolve=True, multi_line=multi_line))
        for _, own in sorted(groups.items())
    ]
    return reduce(append_evolving, read)


def start_load(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    out: str,
    state: str,
    files_per_batch: int = 1000,
    by_name: bool = False,
    multi_line: bool = True,
) -> StreamingQuery:
    """Start loading the files not loaded before, then stop by itself.

    The stream only lists files; its checkpoint remembers them, however old a
    file is when it arrives. A batch of files is read and written as one load of
    ``out``, named after stream and batch, so a batch that runs again after a
    failure replaces its own load: no row is skipped or repeated. A file is parsed
    once; its good and its rejected rows go to different folders of the load.
    """
    delivery = Delivery(landed, schema, by_name)
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", NO_AGE)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = batch.collect()  # files_per_batch at most
        if files:
            stream = json.loads(session.read.text(f"{state}/metadata").first()[0])["id"]
            _load_files(session, files, batch.schema, delivery, out, f"{stream}-{batch_id}", multi_line)

    return (
        listing(reader, landed)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def _load_files(
    spark: SparkSession,
    files: list,
    kind: T.StructType,
    delivery: Delivery,
    out: str,
    load: str,
    multi_line: bool,
) -> None:
    """Some listed files as one load of ``out``, and their entry in its ledger."""
    rows = read_delivered(spark, sorted(f["path"] for f in files), delivery, multi_line)
    to_bronze(land_rows(rows, delivery.schema), out, load)
    note_files(spark.createDataFrame(files, kind), out, load)


def reload_replaced(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    out: str,
    files_per_batch: int = 1000,
    by_name: bool = False,
    multi_line: bool = True,
) -> int:
    """Load the files again that changed under their names since they were loaded; how many did.

    The ledger of the raw table knows the size and time each file was loaded with. What
    an earlier load read from a file that is loaded again no longer counts, in the moment
    the new load's files are entered; a file with nothing but its header leaves no rows.
    Spark does not list files of no bytes: those count as not there, and the old rows stay.
    """
    delivery, reloaded = Delivery(landed, schema, by_name), 0
    while True:
        try:
            listed = listing(spark.read, landed)
        except AnalysisException as error:  # nothing landed under these names yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return reloaded
        changed = changed_files(listed, read_ledger(spark, out))
        files = changed.orderBy("file").limit(files_per_batch).collect()
        if not files:
            return reloaded
        named = "\n".join(f"{f['file']} {f['length']} {f['modified_at']}" for f in files)
        load = REPLACED + hashlib.sha256(named.encode()).hexdigest()[:32]
        _load_files(spark, files, changed.schema, delivery, out, load, multi_line)
        reloaded += len(files)


def load_landed(
    spark: SparkSession, landed: str, schema: T.StructType, out: str, state: str, **how
) -> int:
    """New files once, then those replaced under their names; waits, and returns how many those were."""
    start_load(spark, landed, schema, out, state, **how).awaitTermination()
    return reload_replaced(spark, landed, schema, out, **how)


def ingest_bronze(
    spark: SparkSession,
    landing: str,
    out: str,
    tables: dict[str, tuple[str, T.StructType]] | None = None,
    drift: dict[str, tuple[str, ...]] | None = None,
) -> None:
    """Load all raw tables; the loads run side by side and the call waits for all.

    A landed name is a file, a folder of files, or a prefix of both: deliveries
    such as ``loans.csv`` and ``loans.csv.2026-06-02`` are told apart by name. A file
    replaced under its name is loaded again, and its old rows no longer count.
    ``drift`` names further deliveries per table, read by header name: columns in
    any order, missing ones NULL, new ones kept.
    """
    drift = DRIFT_DELIVERIES if drift is None and tables is None else drift or {}
    loads = []
    for name, (file, schema) in (tables or RAW_TABLES).items():
        path, state = f"{out}/{name}", f"{out}/_state/{name}"
        loads.append(((spark, f"{landing}/{file}*", schema, path), state, {}))
        for extra in drift.get(name, ()):
            more = f"{state}-{extra.split('.')[0]}"
            loads.append(((spark, f"{landing}/{extra}*", schema, path), more, {"by_name": True}))
    for query in [start_load(*where, state, **how) for where, state, how in loads]:
        query.awaitTermination()
    with ThreadPoolExecutor(len(loads)) as pool:
        list(pool.map(lambda load: reload_replaced(*load[0], **load[2]), loads))
