"""A stored search index that follows its documents: parts, what of them is superseded, totals, live documents."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.operators.retrieval import DOCUMENT, GONE, SearchIndex
from lendmill.sources.buckets import BUCKETS, BucketTable

#: So many parts of about one size are merged into one, which is about that much larger.
FANOUT = 4

#: So many dead documents go whole to every executor when parts are merged; more are shuffled.
FEW_DEAD = 500_000

_ORIGIN = "_origin"
_ENTRY = "kind string, folder string, n_rows long, origins array<long>"
_POSTINGS, _DEAD, _TOTALS = "postings", "dead", "totals"


class KeptIndex:
    """Term postings under ``path``, a part per batch, merged by size tiers as they add up.

    A batch knows from the live documents, kept in buckets of their key, which of its documents
    earlier batches brought: those (document, batch) pairs are listed as dead, and the
    totals move by the difference. A search reads the postings of its terms, drops the dead
    ones by the short list, takes totals from a few rows, and opens the buckets of the
    documents it returns; no search and no batch reads all documents.

    A batch's documents stand in front of its postings in the same files, so that texts are gone
    through and written once. Of a tier of ``FANOUT`` parts one is made, a term in one file or few,
    sorted by term and without the dead, which then leave the list; a part whose documents are all
    dead is dropped unread. Parts in force are listed, and a list is published whole: a
    job that dies before leaves the list before in force, and a batch that comes again is
    made again or, if it was published, not at all.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, like: T.StructType, buckets: int = BUCKETS
    ):
        """``like`` has the key and the attributes of the documents."""
        self.spark, self.path, self.key = spark, path, key
        self.attributes = [c for c in like.names if c != key]
        fields = [*like, T.StructField("doc_len", T.LongType()), T.StructField(_ORIGIN, T.LongType())]
        self.live = BucketTable(spark, f"{path}/live", key, T.StructType(fields), buckets)
        term = [T.StructField("term", T.StringType()), like[key], T.StructField("doc_len", T.LongType())]
        self._schemas = {
            _POSTINGS: T.StructType([*term, T.StructField("tf", T.LongType()), T.StructField(_ORIGIN, T.LongType())]),
            _DEAD: T.StructType([like[key], T.StructField(_ORIGIN, T.LongType())]),
            _TOTALS: T.StructType.fromDDL("n_docs long, total_len long"),
        }
        document = [like[c] for c in self.attributes] + [T.StructField(GONE, T.BooleanType())]
        self._batch = T.StructType([*self._schemas[_POSTINGS], T.StructField(DOCUMENT, T.StructType(document))])

    # ---- the list of parts ------------------------------------------------------

    def _last(self) -> tuple[int, int]:
        """(run, batch) of the last published list."""
        try:
            runs = self.spark.read.schema("run long, batch long").parquet(f"{self.path}/published")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, 0
        last = runs.agg(F.max(F.struct("run", "batch")).alias("last")).first()["last"]
        return (last["run"], last["batch"]) if last else (0, 0)

    def entries(self) -> list[dict]:
        """The folders in force; their number grows with the logarithm of the batches."""
        run, _ = self._last()
        if not run:
            return []
        listed = self.spark.read.schema(_ENTRY).parquet(f"{self.path}/lists/run={run}")
        return [r.asDict() for r in listed.collect()]

    def _publish(self, entries: list[dict], batch: int) -> None:
        run = self._last()[0] + 1
        names = T.StructType.fromDDL(_ENTRY).names
        rows = self.spark.createDataFrame([tuple(e[n] for n in names) for e in entries], _ENTRY)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists/run={run}")
        done = self.spark.range(run, run + 1, 1, 1).select(
            F.col("id").alias("run"), F.lit(batch).cast("long").alias("batch")
        )
        done.write.mode("append").parquet(f"{self.path}/published")

    def _read(self, kind: str, entries: list[dict]) -> DataFrame:
        folders = [f"{self.path}/{e['folder']}" for e in entries if e["kind"] == kind]
        if not folders:
            return self.spark.createDataFrame([], self._schemas[kind])
        stored = self.spark.read.schema(self._schemas[kind]).parquet(*folders)
        return stored.filter(F.col("term").isNotNull()) if kind == _POSTINGS else stored

    def _came(self, folders: list[str]) -> DataFrame:
        """The documents of batches, as they came, from the files of their postings."""
        stored = self.spark.read.schema(self._batch).parquet(*[f"{self.path}/{f}" for f in folders])
        return stored.filter(F.col("term").isNull()).select(self.key, "doc_len", f"{DOCUMENT}.*", _ORIGIN)

    def _store(
        self, kind: str, rows: DataFrame, name: str, origins: list[int], schema: T.StructType | None = None
    ) -> dict:
        entry = {"kind": kind, "folder": f"{kind}/{name}", "origins": origins}
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema or self._schemas[kind]]
        rows.select(columns).write.mode("overwrite").parquet(f"{self.path}/{entry['folder']}")
        return entry | {"n_rows": self._read(kind, [entry]).count()}

    # ---- batches ----------------------------------------------------------------

    def add(self, index: SearchIndex, batch: int) -> None:
        """Take in a numbered batch of documents, one row each; numbers rise from 1."""
        if self._last()[1] >= batch:
            return
        name = f"batch={batch}"
        rows = index.together.withColumn(_ORIGIN, F.lit(batch)).sortWithinPartitions("term")
        part = self._store(_POSTINGS, rows, name, [batch], self._batch)
        came = self._came([part["folder"]])
        kept = came.filter(~F.col(GONE))
        keys = came.select(self.key)
        was = self.live.read(self.live.touched(keys), before=batch).join(keys, self.key, "left_semi")

        def sums(rows: DataFrame, sign: int) -> DataFrame:
            length = F.coalesce(F.sum("doc_len"), F.lit(0))
            return rows.agg((F.count(F.lit(1)) * sign).alias("n_docs"), (length * sign).alias("total_len"))

        totals = sums(kept, 1).unionByName(sums(was, -1)).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len")
        )
        made = [
            part,
            self._store(_DEAD, was.select(self.key, _ORIGIN), name, []),
            self._store(_TOTALS, totals, name, []),
        ]
        entries = self.entries()
        self.live.rewrite(came, batch, self._alive)
        self._publish(entries + [e for e in made if e["n_rows"]], batch)
        while self._merge(batch):
            pass

    def _alive(self, rows: DataFrame, came: DataFrame) -> DataFrame:
        left = rows.join(came.select(self.key), self.key, "left_anti")
        return left.unionByName(came.filter(~F.col(GONE)).drop(GONE))

    def _merge(self, batch: int) -> bool:
        """Merge the first full tier; whether there was one."""
        entries = self.entries()
        tiers: dict[int, list[dict]] = {}
        for e in (e for e in entries if e["kind"] == _POSTINGS):
            tiers.setdefault(int(math.log(max(e["n_rows"], 1), FANOUT)), []).append(e)
        full = [tiers[t] for t in sorted(tiers) if len(tiers[t]) >= FANOUT]
        if not full:
            return False
        name = f"merge={self._last()[0] + 1}"
        origins = sorted({o for e in full[0] for o in e["origins"]})
        dead = self._read(_DEAD, entries)
        rows = self._without(dead, full[0]).hint("rebalance", "term").sortWithinPartitions("term")
        totals = self._read(_TOTALS, entries).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len")
        )
        made = [
            self._store(_POSTINGS, rows, name, origins),
            # a dead document's postings were in these parts and are gone with them
            self._store(_DEAD, dead.filter(~F.col(_ORIGIN).isin(origins)), name, []),
            self._store(_TOTALS, totals, name, []),
        ]
        kept = [e for e in entries if e["kind"] == _POSTINGS and e not in full[0]]
        self._publish(kept + [e for e in made if e["n_rows"]], batch)
        return True

    def _without(self, dead: DataFrame, parts: list[dict]) -> DataFrame:
        """The postings of parts without those of dead documents."""
        origin, single = F.col(_ORIGIN), [e for e in parts if e["folder"] == f"{_POSTINGS}/batch={e['origins'][0]}"]

        def per_origin(rows: DataFrame) -> dict[int, int]:
            return {r[_ORIGIN]: r["count"] for r in rows.groupBy(_ORIGIN).count().collect()}  # a row per batch

        n_dead = per_origin(dead.filter(origin.isin([o for e in parts for o in e["origins"]])))
        n_docs = per_origin(self._came([e["folder"] for e in single]).filter(~F.col(GONE))) if single else {}
        gone = [o for o, n in n_docs.items() if n_dead.get(o) == n]
        left = [e for e in parts if e["origins"] not in [[o] for o in gone]]
        origins = [o for e in left for o in e["origins"] if o in n_dead]
        rows, some = self._read(_POSTINGS, left), sum(n_dead[o] for o in origins)
        if not some:
            return rows
        # a posting is one of many of its document: where they must be shuffled, they need not be sorted too
        dead = dead.filter(origin.isin(origins)).hint("broadcast" if some <= FEW_DEAD else "shuffle_hash")
        return rows.join(dead, [self.key, _ORIGIN], "left_anti")

    # ---- searches ---------------------------------------------------------------

    def read(self) -> SearchIndex:
        """The index as it now is, for ``score_documents`` and ``search``."""
        entries = self.entries()
        dead = self._read(_DEAD, entries)
        live = self._read(_POSTINGS, entries).join(dead, [self.key, _ORIGIN], "left_anti")
        totals = self._read(_TOTALS, entries).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len")
        )
        docs = self.live.read().drop(_ORIGIN)
        return SearchIndex(live.drop(_ORIGIN), docs, self.key, None, totals, self._documents)

    def _documents(self, found: DataFrame) -> DataFrame:
        """The documents of a few keys, from their buckets."""
        keys = [r[self.key] for r in found.collect()]
        rows = self.live.read(self.live.touched(found)).filter(F.col(self.key).isin(keys))
        return rows.drop(_ORIGIN)

