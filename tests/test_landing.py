"""Landed files: tolerance, rejects, drift, load-once; then a whole day, twice."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from lendmill import schemas
from lendmill.plans.daily_refresh import daily_refresh
from lendmill.sources import bronze, files
from lendmill.sources import warehouse as WH
from lendmill.sources import ledger as LG
from lendmill.streaming import landing as LD
from lendmill.streaming.landing import ingest_bronze, load_landed, start_load

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("amount", schemas.MONEY),
        T.StructField("born", T.DateType()),
        T.StructField("rate", T.DoubleType()),
    ]
)
LINES = '''Id,Score,Amount,Born,Rate
a,1,10,2024-01-31,1.5
b,not a number,10,2024-01-31,1.5
c,2,10,2024-13-01,1.5
d,3
e,4,10,2024-01-31,1.5,extra,fields
f,NULL,null,,
"g, h" , " 5 " , 10.5 ,2024-01-31,1.5
"say ""hi""",6,-3,2024-02-29,1e2
i,7,1,2023-02-29,x
'''


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text(LINES)
    return str(tmp_path / "in")


def test_bad_rows_are_set_aside(spark, landing):
    good, rejects = bronze.split_bad_rows(files.read_csv_positional(spark, landing, SCHEMA), SCHEMA)
    day = dt.date(2024, 1, 31)
    expected = [
        ("a", 1, Decimal(10), day, 1.5),
        ("d", 3, None, None, None),
        ("e", 4, Decimal(10), day, 1.5),
        ("f", None, None, None, None),
        ("g, h", 5, Decimal(11), day, 1.5),
        ('say "hi"', 6, Decimal(-3), dt.date(2024, 2, 29), 100.0),
    ]
    assert rows(good) == sorted(expected, key=repr)
    assert [f.dataType for f in good.schema] == [f.dataType for f in SCHEMA]
    found = {json.loads(r["_raw"])["id"]: r["_bad_columns"] for r in rejects.collect()}
    assert found == {"b": ["score"], "c": ["born"], "i": ["born", "rate"]}


def test_by_name_ignores_order_and_case(spark, tmp_path):
    path = str(tmp_path / "v2.csv")
    (tmp_path / "v2.csv").write_text("RATE,Tier,ID\n2.5,GOLD,x\n,,y\n")
    plain = files.read_csv_by_name(spark, path, SCHEMA)
    assert plain.columns == SCHEMA.names
    evolved = files.read_csv_by_name(spark, path, SCHEMA, evolve=True)
    good, _ = bronze.split_bad_rows(evolved, SCHEMA)
    assert rows(good) == [("x", None, None, None, 2.5, "GOLD"), ("y", None, None, None, None, None)]
    base = good.drop("tier").withColumnRenamed("id", "Id")
    both = bronze.append_evolving(base, good)
    assert both.columns == ["Id", "score", "amount", "born", "rate", "tier"]
    assert both.filter("tier is null").count() == 3


def test_raw_table_keeps_loads_and_rejects_apart(spark, landing, tmp_path):
    out = str(tmp_path / "bronze")
    text = files.read_csv_positional(spark, landing, SCHEMA)
    bronze.to_bronze(bronze.land_rows(text, SCHEMA), out)
    wider = T.StructType([*SCHEMA, T.StructField("tier", T.StringType())])
    (tmp_path / "w.csv").write_text("id,score,amount,born,rate,tier\nz,1,1,2024-01-01,1,GOLD\n")
    more = files.read_csv_positional(spark, str(tmp_path / "w.csv"), wider)
    bronze.to_bronze(bronze.land_rows(more, wider), out)
    good = bronze.read_bronze(spark, out)
    assert good.count() == 7 and good.filter("tier = 'GOLD'").count() == 1
    assert good.filter("_loaded_at is null").count() == 0
    assert bronze.read_rejects(spark, out).count() == 3
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_quarantined" in plan


def test_ndjson_and_manifest(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id": "a", "score": 1}\n{"id": "b", "rate": 2.0}\n')
    got = files.read_ndjson(spark, str(tmp_path / "s.json"), SCHEMA)
    assert rows(got.select("id", "score", "rate")) == [("a", 1, None), ("b", None, 2.0)]
    first = files.list_files(spark, str(tmp_path))
    ledger = spark.createDataFrame(first.collect(), first.schema)
    assert files.unseen_files(first, ledger).count() == 0
    (tmp_path / "t.json").write_text("{}")
    unseen = files.unseen_files(files.list_files(spark, str(tmp_path)), ledger).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in unseen] == ["t.json"]


def test_a_file_is_loaded_once(spark, landing, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def load():
        start_load(spark, landing, SCHEMA, out, state).awaitTermination()
        return bronze.read_bronze(spark, out).count(), bronze.read_rejects(spark, out).count()

    assert load() == (6, 3)
    assert load() == (6, 3)
    (tmp_path / "in" / "two.csv").write_text("id,score,amount,born,rate\nnew,1,1,2024-01-01,1\n")
    assert load() == (7, 3)


def test_a_late_file_is_loaded(spark, landing, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    start_load(spark, landing, SCHEMA, out, state).awaitTermination()
    late = tmp_path / "in" / "late.csv"
    late.write_text("id,score,amount,born,rate\nlate,1,1,2024-01-01,1\n")
    os.utime(late, (1e9, 1e9))
    start_load(spark, landing, SCHEMA, out, state).awaitTermination()
    assert bronze.read_bronze(spark, out).filter("id = 'late'").count() == 1


def test_streams_and_batches_write_one_table(spark, landing, tmp_path):
    """Rows of a batch load beside a stream's are read, and a repeated load replaces itself."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    start_load(spark, landing, SCHEMA, out, state).awaitTermination()
    (tmp_path / "b.csv").write_text("id,score,amount,born,rate\nbatch,1,1,2024-01-01,1\n")
    rows_ = bronze.land_rows(files.read_csv_positional(spark, str(tmp_path / "b.csv"), SCHEMA), SCHEMA)
    for _ in range(2):
        bronze.to_bronze(rows_, out, "by-hand")
    (tmp_path / "in" / "c.csv").write_text("id,score,amount,born,rate\nstream,1,1,2024-01-01,1\n")
    start_load(spark, landing, SCHEMA, out, state).awaitTermination()
    got = [r["id"] for r in bronze.read_bronze(spark, out).collect()]
    assert len(got) == 8 and got.count("batch") == got.count("stream") == 1
    assert bronze.read_rejects(spark, out).count() == 3


def test_files_of_other_headers_go_where_their_header_says(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,score\nX1,5\n")
    (tmp_path / "in" / "b.csv").write_text("score,ID,Tier\n6,X2,GOLD\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    two = T.StructType(SCHEMA.fields[:2])
    out = str(tmp_path / "out")
    start_load(spark, str(tmp_path / "in"), two, out, str(tmp_path / "s"), by_name=True).awaitTermination()
    got = bronze.read_bronze(spark, out).select("id", "score", "tier")
    assert rows(got) == [("X1", 5, None), ("X2", 6, "GOLD")]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_by_name(spark, str(tmp_path / "in" / "[ab].csv"), two).collect()


def test_drift_delivery_of_the_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "people.csv").write_text("id,score\na,1\n")
    (tmp_path / "in" / "people_v2.csv").write_text("score,tier,id\n2,GOLD,b\n")
    tables = {"raw": ("people.csv", T.StructType(SCHEMA.fields[:2]))}
    for _ in range(2):
        ingest_bronze(spark, str(tmp_path / "in"), str(tmp_path / "out"), tables, {"raw": ("people_v2.csv",)})
    got = bronze.read_bronze(spark, str(tmp_path / "out" / "raw"))
    assert rows(got.select("id", "score", "tier")) == [("a", 1, None), ("b", 2, "GOLD")]


def test_quoted_breaks_and_torn_lines(spark, tmp_path):
    path = str(tmp_path / "q.csv")
    text = 'id,score,amount,born,rate\nX1,5,1,2024-01-01,1\n"X2\nmore",6,1,2024-01-01,1\nX3,7,1,2024-01-01,"1\n"\n'
    (tmp_path / "q.csv").write_text(text)
    good, bad = bronze.split_bad_rows(files.read_csv_positional(spark, path, SCHEMA), SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == ["X1", "X2\nmore", "X3"] and not bad.collect()
    split = files.read_csv_positional(spark, path, SCHEMA, multi_line=False)
    good, bad = bronze.split_bad_rows(split, SCHEMA)
    assert [r["id"] for r in good.collect()] == ["X1"]
    assert all("_line" in r["_bad_columns"] for r in bad.collect()) and bad.count() == 4


def test_partial_dates_and_raw_tokens(spark, tmp_path):
    (tmp_path / "d.csv").write_text("id,score,amount,born,rate\na,NULL,12345678901234567890123,2024,1\n")
    landed = files.read_csv_positional(spark, str(tmp_path / "d.csv"), SCHEMA)
    (bad,) = bronze.split_bad_rows(landed, SCHEMA)[1].collect()
    assert bad["_bad_columns"] == ["amount", "born"]
    assert json.loads(bad["_raw"]) == {
        "id": "a", "score": "NULL", "amount": "12345678901234567890123", "born": "2024", "rate": "1"
    }
    wide = T.StructType([T.StructField("id", T.StringType()), *[
        T.StructField(f.name, T.DecimalType(38, 0) if f.name == "amount" else T.StringType()) for f in SCHEMA.fields[1:]
    ]])
    good, _ = bronze.split_bad_rows(landed, wide)
    assert good.first()["amount"] == Decimal("12345678901234567890123")


def _land_day(folder, score):
    folder.mkdir(exist_ok=True)
    stamp = "2026-01-01 00:00:00"
    content = {
        "customers": [f"C{i},{i:016d},,budi s,M,1990-01-01,Bali,Badung,SMB,{score},100,0812,a@b.co,{stamp},{stamp}" for i in range(5)],
        "loans": [f"L{i},C{i % 5},SMB x,100,12,18.5,2025-01-01,LANCAR,0,0,50,{stamp}" for i in range(8)],
        "repayments": [f"R{i},L{i % 8},2025-02-01,2025-02-02,10,10,0" for i in range(20)],
        "savings": [f"A{i},C{i % 5},TABUNGAN,10,1.0,2024-01-01,ACTIVE" for i in range(6)],
        "transactions": [f"T{i},A{i % 6},FEE,VA,5,{stamp}" for i in range(30)],
    }
    for name, lines in content.items():
        _, schema = schemas.RAW_TABLES[f"raw_{name}"]
        (folder / f"{name}.csv").write_text("\n".join([",".join(schema.names), *lines]) + "\n")


def test_a_day_and_its_rerun(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "house")
    _land_day(landing, 700)

    def run(at):
        return {(r["step"], r["object"]): (r["n_rows"], r["status"]) for r in daily_refresh(spark, str(landing), root, at).collect()}

    first = run("2026-01-02")
    assert first[("ingest", "raw_transactions")] == (30, "done")
    assert first[("build", "mart_loan_performance")] == (8, "done")
    assert first[("test", "test_results")] == (23, "pass")
    assert first[("gate", "dq_verdict")] == (0, "pass")
    assert run("2026-01-02") == first
    history = WH.read_versions(spark, f"{root}/silver/dim_customers_scd2")
    assert history.count() == 5 and history.filter("is_current").count() == 5


def test_the_next_day_reads_new_loads_only(spark, tmp_path, monkeypatch):
    from lendmill.sources import changes as CH

    landing, root = tmp_path / "landing", str(tmp_path / "house")
    _land_day(landing, 700)
    daily_refresh(spark, str(landing), root, "2026-01-02", buckets=4).collect()
    asked = []
    whole = CH.read_without
    monkeypatch.setattr(CH, "read_without", lambda s, p, loads, *more: asked.append((p, loads)) or whole(s, p, loads, *more))
    customers = (landing / "customers.csv").read_text().splitlines()
    later = [customers[0]] + [x.replace(",700,", ",650,").replace("2026-01-01", "2026-01-05") for x in customers[1:3]]
    stale = customers[3].replace(",700,", ",300,").replace("2026-01-01", "2025-01-01")
    (landing / "customers.csv.2").write_text("\n".join([*later, stale]) + "\n")
    daily_refresh(spark, str(landing), root, "2026-01-06", buckets=4).collect()
    assert [(p.rsplit("/", 1)[1], len(loads)) for p, loads in asked] == [("raw_customers", 1)]
    history = WH.read_versions(spark, f"{root}/silver/dim_customers_scd2")
    assert history.filter("is_current").count() == 5 and history.count() == 7


def test_a_day_with_replaced_files_equals_a_rebuild(spark, tmp_path):
    """A loan twice in one delivery, then replaced files, then a file replaced before it was ever read."""
    from lendmill.sources.warehouse import read_table
    from test_upkeep import rebuilt

    landing, root = tmp_path / "landing", str(tmp_path / "house")
    _land_day(landing, 700)

    def edit(name, fn):
        lines = (landing / name).read_text().splitlines()
        (landing / name).write_text("\n".join([lines[0], *fn(lines[1:])]) + "\n")

    def run(at):
        daily_refresh(spark, str(landing), root, at, buckets=4).collect()
        raw = {n: bronze.read_bronze(spark, f"{root}/bronze/{n}") for n in schemas.RAW_TABLES}
        wanted = rebuilt(raw)
        mine = [spark.table("mart_loan_performance"), spark.table("mart_customer_360")]
        assert [rows(m) for m in mine] == [rows(w.select(m.columns)) for m, w in zip(mine, wanted, strict=True)]
        tests = read_table(spark, f"{root}/gold/test_results")
        found = {r["test_name"]: (r["failures"], r["status"]) for r in tests.collect()}
        return found["unique_stg_loans_loan_id"], raw

    edit("loans.csv", lambda old: [*old, old[2].replace(",LANCAR,", ",LUNAS,").replace("2026-01-01", "2026-01-02")])
    failed, _ = run("2026-01-02")
    assert failed == (1, "fail")
    edit("loans.csv", lambda old: [x.replace(",C1,", ",C2,") for x in old[:6]])
    edit("repayments.csv", lambda old: [x.replace("2025-02-02", "2025-03-02") for x in old[3:]])
    edit("customers.csv", lambda old: [x.replace(",700,", ",500,").replace("2026-01-01", "2026-01-03") for x in old[:4]])
    (landing / "savings.csv.2").write_text((landing / "savings.csv").read_text().replace("\nA", "\nB"))
    failed, raw = run("2026-01-04")
    assert failed == (0, "pass") and raw["raw_loans"].count() == 6 and raw["raw_savings"].count() == 12
    history = WH.read_versions(spark, f"{root}/silver/dim_customers_scd2")
    current = {r["customer_id"]: r["credit_score"] for r in history.filter("is_current").collect()}
    assert current == {"C0": 500, "C1": 500, "C2": 500, "C3": 500, "C4": 700}
    # loaded and replaced between two days
    (landing / "transactions.csv.2").write_text((landing / "transactions.csv").read_text().replace("\nT", "\nU"))
    ingest_bronze(spark, str(landing), f"{root}/bronze")
    edit("transactions.csv.2", lambda old: old[:3])
    edit("savings.csv", lambda old: old[1:])
    _, raw = run("2026-01-05")
    assert raw["raw_transactions"].count() == 33 and raw["raw_savings"].count() == 11


HEAD = "id,score,amount,born,rate\n"


def test_a_replaced_file_is_loaded_once_and_its_old_rows_go(spark, landing, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    other = tmp_path / "in" / "two.csv"
    other.write_text(HEAD + "k,1,1,2024-01-01,1\n")

    def load():
        again = load_landed(spark, landing, SCHEMA, out, state)
        good = sorted(r["id"] for r in bronze.read_bronze(spark, out).collect())
        return again, good, bronze.read_rejects(spark, out).count()

    first = ["a", "d", "e", "f", "g, h", "k", 'say "hi"']
    assert load() == (0, first, 3)
    (tmp_path / "in" / "one.csv").write_text(HEAD + "a,5,1,2024-01-01,1\nz,x,1,2024-01-01,1\n")
    assert load() == (1, ["a", "k"], 1)
    assert load() == (0, ["a", "k"], 1)
    # replaced again, beside a new file
    (tmp_path / "in" / "one.csv").write_text(HEAD + "b,6,1,2024-01-01,1\nc,7,1,2024-01-01,1\n")
    (tmp_path / "in" / "three.csv").write_text(HEAD + "n,1,1,2024-01-01,1\n")
    assert load() == (1, ["b", "c", "k", "n"], 0)
    # emptied, then filled
    other.write_text(HEAD)
    assert load() == (1, ["b", "c", "n"], 0)
    other.write_text(HEAD + "k2,1,1,2024-01-01,1\n")
    assert load() == (1, ["b", "c", "k2", "n"], 0)
    assert bronze.read_bronze(spark, out).columns == [*SCHEMA.names, "_loaded_at"]


def test_a_restored_older_file_counts_and_names_may_be_odd(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    (tmp_path / "in").mkdir()
    file = tmp_path / "in" / "a b %20é=1.csv"
    file.write_text(HEAD + "new,1,1,2024-01-01,1\n")
    load_landed(spark, str(tmp_path / "in"), SCHEMA, out, state)
    file.write_text(HEAD + "old,1,1,2024-01-01,1\n")
    os.utime(file, (1_000_000_000, 1_000_000_000))
    assert load_landed(spark, str(tmp_path / "in"), SCHEMA, out, state, by_name=True) == 1
    assert [r["id"] for r in bronze.read_bronze(spark, out).collect()] == ["old"]


def test_a_reload_that_died_does_not_count(spark, landing, tmp_path, monkeypatch):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    load_landed(spark, landing, SCHEMA, out, state)
    (tmp_path / "in" / "one.csv").write_text(HEAD + "z,1,1,2024-01-01,1\n")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(LD, "note_files", dies)
        with pytest.raises(RuntimeError, match="lost"):
            load_landed(spark, landing, SCHEMA, out, state)
    assert bronze.read_bronze(spark, out).count() == 6 and len(bronze.load_names(spark, out)) == 1
    assert load_landed(spark, landing, SCHEMA, out, state) == 1
    assert [r["id"] for r in bronze.read_bronze(spark, out).collect()] == ["z"]
    assert len(bronze.load_names(spark, out)) == 2
    pairs = LG.superseded(LG.read_ledger(spark, out))
    assert bronze.read_retracted(spark, out, pairs).count() == 6


def test_rows_of_unknown_shape(spark, tmp_path):
    lines = ['{"id": 1, "a": {"b": "7"}, "new": [1, 2]}', '{"id": "x", "a": null}', "[1, 2]", "5", "torn {", "", '{"id": 9.5, "id2": 1}']
    (tmp_path / "v.json").write_text("\n".join(lines) + "\n")
    files.read_ndjson_variant(spark, f"{tmp_path}/v.json").write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    fields = {"id": ("$.id", "bigint"), "b": ("$.a.b", "int"), "second": ("$.new[1]", "int"), "a": ("$.a", "string")}
    got = files.variant_fields(kept, fields).select("id", "b", "second", "a", "_line", "_bad_columns")
    assert rows(got) == sorted(
        [
            (1, 7, 2, '{"b":"7"}', None, []),
            (None, None, None, None, None, ["id"]),
            (None, None, None, None, None, []),
            (None, None, None, None, None, []),
            (None, None, None, None, "torn {", []),
            (9, None, None, None, None, []),
        ],
        key=repr,
    )
    assert files.variant_fields(kept.filter("false"), fields).count() == 0
