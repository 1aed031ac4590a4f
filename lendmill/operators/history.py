"""Slowly changing dimensions and latest-row operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.session import fresh_path, shared_dir

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"

# Rows of one key that a task sorts; the history of a key with more is cut into
# time slices of about this size.
SLICE_ROWS = 1_000_000


def latest_per_key(df: DataFrame, key: str | list[str], *newest: str) -> DataFrame:
    """One row per key: the one with the largest ``newest`` columns, NULLs smallest.

    Spark keeps the first row of each key before the shuffle already, so a key
    that holds a large share of the rows sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in newest]
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", first).filter("_place = 1").drop("_place")


def upsert_latest(base: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Base and batch merged: per key the newest row wins, the batch on a tie.

    Arrival order does not matter, so late and backdated rows are safe.
    """
    both = base.withColumn("_from_batch", F.lit(0)).unionByName(
        batch.withColumn("_from_batch", F.lit(1))
    )
    return latest_per_key(both, key, ts, "_from_batch").drop("_from_batch")


def _same(left: str, right: str, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def first_snapshot(source: DataFrame, at) -> DataFrame:
    return source.withColumns(
        {
            VALID_FROM: F.lit(at).cast("timestamp_ntz"),
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
            IS_CURRENT: F.lit(True),
        }
    )


def detect_changes(
    dim: DataFrame, source: DataFrame, key: str, check_cols: list[str]
) -> DataFrame:
    """Open versions against the source: ``old``, ``new`` and what became of the key."""
    old = dim.filter(IS_CURRENT).select(F.col(key).alias("_old_key"), F.struct("*").alias("old"))
    new = source.select(F.col(key).alias("_new_key"), F.struct("*").alias("new"))
    joined = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    state = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "gone")
        .when(_same("old", "new", check_cols), "same")
        .otherwise("changed")
    )
    return joined.select("old", "new", state.alias("change"))


def scd2_step(
    dim: DataFrame | None, source: DataFrame, key: str, check_cols: list[str], at
) -> DataFrame:
    """What one snapshot makes of the open versions: kept, closed and opened ones.

    A version closes and the next opens only when a checked column differs,
    NULL-safe; other columns keep the value they had when the version opened.
    Keys gone from the source stay open. ``source`` has one row per key. One
    full join on the key emits one or two versions per key.
    """
    if dim is None:
        return first_snapshot(source, at)
    now = F.lit(at).cast("timestamp_ntz")
    columns = source.columns
    names = [*columns, VALID_FROM, VALID_TO, IS_CURRENT]

    def version(side: str, start: Column, end: Column, current: Column) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(
            *values,
            start.alias(VALID_FROM),
            end.cast("timestamp_ntz").alias(VALID_TO),
            current.alias(IS_CURRENT),
        )

    changes = detect_changes(dim.select(*names), source, key, check_cols)
    changed, is_new = F.col("change") == "changed", F.col("change") == "new"
    kept = version(
        "old", F.col("old.valid_from"), F.when(changed, now), ~changed
    )
    opened = version("new", now, F.lit(None), F.lit(True))
    versions = F.array_compact(F.array(F.when(~is_new, kept), F.when(changed | is_new, opened)))
    return changes.select(F.inline(versions))


def scd2_apply(
    dim: DataFrame | None, source: DataFrame, key: str, check_cols: list[str], at
) -> DataFrame:
    """The whole dimension after one snapshot; closed history passes through untouched."""
    after = scd2_step(dim, source, key, check_cols, at)
    if dim is None:
        return after
    return dim.filter(~F.col(IS_CURRENT)).select(*after.columns).unionByName(after)


def _sliced(rows: DataFrame, heavy: DataFrame, key: str, ts: str, most: int) -> DataFrame:
    """Rows of heavy keys, with ``_slice`` numbering runs of about ``most`` rows in
    order of key and time. Ranges are dealt by key and time, so a key of any size is spread."""
    spark = rows.sparkSession
    slices = max(1, -(-heavy.agg(F.sum("_n")).first()[0] // most))
    path = fresh_path(spark, "slices")
    own = rows.join(heavy, F.col(key).eqNullSafe(F.col("_heavy")), "left_semi")
    dealt = own.repartitionByRange(slices, F.col(key), F.col(ts))
    dealt.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _versions(rows: DataFrame, key: str, ts: str, sliced: bool) -> DataFrame:
    """Rows whose ``_state`` differs from the one before, with ``_until``, the next one's time."""
    in_slice = W.partitionBy(key, "_slice").orderBy(ts)
    per_key = W.partitionBy(key).orderBy("_slice")

    def beside(edge: DataFrame, column: str) -> tuple[DataFrame, Column]:
        """``edge``, one row per key and slice, and how it joins the rows; NULL keys too."""
        edge = edge.withColumnsRenamed({key: "_key", "_slice": "_at"})
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_at"))
        return edge.select("_key", "_at", column), same

    rows = rows.withColumn("_before", F.lag("_state").over(in_slice))
    rows = rows.withColumn("_first_here", F.lag(F.lit(1)).over(in_slice).isNull())
    if sliced:
        last = rows.groupBy(key, "_slice").agg(F.max_by("_state", ts).alias("_last"))
        last = last.withColumn("_carried", F.lag("_last").over(per_key))
        last = last.withColumn("_first_ever", F.lag(F.lit(1)).over(per_key).isNull())
        edge, same = beside(last.withColumn("_edge", F.struct("_carried", "_first_ever")), "_edge")
        rows = rows.join(edge, same).withColumns(
            {
                "_before": F.when(F.col("_first_here"), F.col("_edge._carried")).otherwise(F.col("_before")),
                "_first_here": F.col("_first_here") & F.col("_edge._first_ever"),
            }
        )
        rows = rows.drop("_key", "_at", "_edge")
    changes = rows.filter(F.col("_first_here") | ~F.col("_state").eqNullSafe(F.col("_before")))
    changes = changes.withColumn("_until", F.lead(ts).over(in_slice))
    if sliced:
        first = changes.groupBy(key, "_slice").agg(F.min(ts).alias("_first"))
        edge, same = beside(first.withColumn("_next", F.lead("_first").over(per_key)), "_next")
        changes = changes.join(edge, same).withColumn("_until", F.coalesce("_until", "_next"))
    return changes


def scd2_from_history(
    df: DataFrame,
    key: str,
    check_cols: list[str],
    ts: str,
    tiebreak: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The dimension rebuilt from every past row: key, checked columns, validity.

    Rows that repeat the previous state of their key are dropped. With
    ``tiebreak``, the largest one wins among rows of one key and instant;
    without it, key and instant must be unique. Rows are counted per key first:
    the history of a key with more than ``slice_rows`` rows, the missing key
    included, is cut into time slices; the state at each cut is passed to the
    next slice, so the result is the same as over the whole history.
    """
    rows = df.select(key, *check_cols, ts, *([tiebreak] if tiebreak else []))
    if tiebreak:
        rows = latest_per_key(rows, [key, ts], tiebreak)
    rows = rows.withColumn("_state", F.struct(*check_cols))
    counted = df.groupBy(F.col(key).alias("_heavy")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counted.filter(F.col("_n") > slice_rows)
    usual = rows
    parts = []
    if not heavy.isEmpty():
        shared_dir(df.sparkSession)
        heavy = heavy.checkpoint()
        usual = rows.join(heavy, F.col(key).eqNullSafe(F.col("_heavy")), "left_anti")
        parts.append(_versions(_sliced(rows, heavy, key, ts, slice_rows), key, ts, True))
    parts.append(_versions(usual.withColumn("_slice", F.lit(0)), key, ts, False))

    def final(changes: DataFrame) -> DataFrame:
        return changes.select(
            key,
            *check_cols,
            F.col(ts).alias(VALID_FROM),
            F.col("_until").alias(VALID_TO),
            F.col("_until").isNull().alias(IS_CURRENT),
        )

    out = final(parts[0])
    for part in parts[1:]:
        out = out.unionByName(final(part))
    return out


def scd2_insert(
    versions: DataFrame, seen: DataFrame, delivered: DataFrame, key: str, check_cols: list[str], ts: str
) -> DataFrame:
    """Stored versions after a delivery of past or new rows, in whatever order they come.

    ``seen`` holds every row so far, the delivered ones included, one per key and instant:
    a row that once repeated the state before it opens a version when another state is
    put between. Per key of the delivery, versions are made again from the one in force
    before its first instant up to the second that starts after its last; there the stored
    state no longer depends on what came. All other versions, and other keys, stay as they are.
    """
    same = F.col(key).eqNullSafe(F.col("_key"))
    span = delivered.groupBy(F.col(key).alias("_key")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    beside = versions.join(span, same)
    before = F.max(F.when(F.col(VALID_FROM) < F.col("_first"), F.col(VALID_FROM)))
    after = F.min(F.when(F.col(VALID_FROM) > F.col("_last"), F.col(VALID_TO)))
    edges = beside.groupBy(F.col("_key").alias("_edge_key")).agg(
        before.alias("_start"), after.alias("_stop")
    )
    window = span.join(edges, F.col("_key").eqNullSafe(F.col("_edge_key")), "left").select(
        "_key", "_start", "_stop"
    )
    began = F.col("_start").isNull() | (F.col(ts) >= F.col("_start"))
    again = seen.join(window, same).filter(
        began & (F.col("_stop").isNull() | (F.col(ts) < F.col("_stop")))
    )
    made = scd2_from_history(again.select(key, *check_cols, ts), key, check_cols, ts)
    stops = window.select(F.col("_key"), "_stop")
    made = made.join(stops, same).withColumn(VALID_TO, F.coalesce(VALID_TO, "_stop"))
    made = made.withColumn(IS_CURRENT, F.col(VALID_TO).isNull()).drop("_key", "_stop")
    inside = F.col("_start").isNull() | (F.col(VALID_FROM) >= F.col("_start"))
    inside = inside & (F.col("_stop").isNull() | (F.col(VALID_FROM) < F.col("_stop")))
    kept = versions.join(window, same & inside, "left_anti")
    return kept.unionByName(made.select(*kept.columns))
