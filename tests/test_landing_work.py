"""What landing does per row and per file."""

import os
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.plans.registered import _write_csv
from lendmill.sources.bronze import RAW_TOKENS, convert_token, land_rows


def test_tokens_are_written_out_for_rejects_only(spark):
    schema = T.StructType.fromDDL("id long, amount decimal(18,2)")
    text = spark.createDataFrame([("1", "2.50"), ("x", " 3 "), ("4", "NULL")], "id string, amount string")
    landed = land_rows(text, schema)
    got = [(r["id"], r["amount"], r[RAW_TOKENS]) for r in landed.collect()]
    assert got == [(1, Decimal("2.50"), None), (None, Decimal(3), '{"id":"x","amount":" 3 "}'), (4, None, None)]
    plan = landed._jdf.queryExecution().analyzed().toString()
    assert "THEN to_json(" in plan  # inside the choice, so that good rows never get there


def test_short_decimals_convert_as_long_ones_do(spark):
    tokens = ["1", "1.5", "1.25", "1.255", "0.00499999999999", "-2.345", "1e2", "1.e2", "1.5e1", ".5", "5.", "x", "1.x",
              "1..2", "", " 7.10 ", "+3.1", "9999999999999999.99", "10000000000000000", "1.2.3"]
    text = spark.createDataFrame([(t,) for t in tokens], "t string")
    to = T.DecimalType(18, 2)
    slow = F.round(F.trim("t").try_cast("decimal(38,10)"), 2).try_cast(to)
    for r in text.select("t", convert_token(F.col("t"), to).alias("fast"), slow.alias("slow")).collect():
        assert r["fast"] == r["slow"], r


def test_a_landed_table_is_many_files(spark, tmp_path):
    _write_csv(spark.range(0, 600_000, 1, 1), str(tmp_path / "t"))
    assert len([f for f in os.listdir(tmp_path / "t") if f.endswith(".csv")]) == 3
