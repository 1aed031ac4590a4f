"""What came to and went from raw tables since a consumer looked last, as numbered plans."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.sources.bronze import load_names, read_retracted, read_without, replaced_pairs

CAME, LEFT_OUT, GONE = "came", "left out", "gone"
_PLAN = "table string, load string, file string, kind string"


class Feed:
    """Changes of raw tables (name -> path) for one consumer, remembered under ``state``.

    A plan lists the loads that are new, the files of those that were replaced already
    and are left out, and the files replaced since of loads seen before. It is written before it is worked
    on, and names loads and files only: a consumer that dies half-way gets the same plan
    with the same rows again, whatever has landed meanwhile. ``done`` ends it.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, str], state: str):
        self.spark, self.tables, self.state = spark, tables, state

    def _numbers(self, what: str) -> int:
        try:
            found = self.spark.read.schema("id long").parquet(f"{self.state}/{what}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return found.agg(F.max("id")).first()[0] or 0

    def _record(self, what: str, number: int) -> None:
        self.spark.range(number, number + 1, 1, 1).write.mode("append").parquet(f"{self.state}/{what}")

    def _plans(self) -> DataFrame:
        return self.spark.read.schema(f"{_PLAN}, plan long").parquet(f"{self.state}/plans")

    def plan(self) -> tuple[int, dict[str, tuple[DataFrame, DataFrame | None]]]:
        """The number of the plan to work on, and per changed table the rows that came and that went."""
        done, planned = self._numbers("done"), self._numbers("planned")
        number = done + 1
        if planned <= done:
            self._write(number, self._plans() if done else None)
            self._record("planned", number)
        listed = self._plans().filter(F.col("plan") == number)
        came = listed.filter(F.col("kind") == CAME).collect()  # a row per load
        kinds = {(r["table"], r["kind"]) for r in listed.select("table", "kind").distinct().collect()}
        changes = {}
        for name, path in self.tables.items():

            def pairs(kind: str, name: str = name) -> DataFrame:
                mine = listed.filter((F.col("table") == name) & (F.col("kind") == kind))
                return mine.select("load", "file")

            loads = [r["load"] for r in came if r["table"] == name]
            gone = read_retracted(self.spark, path, pairs(GONE)) if (name, GONE) in kinds else None
            if loads or gone is not None:
                left_out = pairs(LEFT_OUT) if (name, LEFT_OUT) in kinds else None
                changes[name] = (read_without(self.spark, path, loads, left_out), gone)
        return number, changes

    def _write(self, number: int, seen: DataFrame | None) -> None:
        spark, loads, replaced = self.spark, [], []
        known = set()
        if seen is not None:  # a row per load
            known = {(r["table"], r["load"]) for r in seen.filter(F.col("kind") == CAME).collect()}

        def look(table: tuple[str, str]) -> tuple[str, list[str], DataFrame | None]:
            name, path = table
            every = load_names(spark, path)
            return name, every, replaced_pairs(spark, path)

        with ThreadPoolExecutor(len(self.tables)) as pool:
            for name, every, old in pool.map(look, self.tables.items()):
                new = [x for x in every if (name, x) not in known]
                loads += [(name, x, None, CAME) for x in new]
                if old is not None:
                    kind = F.when(F.col("load").isin(new), LEFT_OUT).otherwise(GONE).alias("kind")
                    old = old.select(F.lit(name).alias("table"), "load", "file", kind)
                    if seen is not None:
                        old = old.join(seen.select("table", "load", "file"), ["table", "load", "file"], "left_anti")
                    replaced.append(old)
        found = spark.createDataFrame(loads, _PLAN)
        for part in replaced:
            found = found.unionByName(part)
        found.coalesce(1).write.mode("overwrite").parquet(f"{self.state}/plans/plan={number}")

    def done(self, number: int) -> None:
        self._record("done", number)
