"""Schemas, typed files and deterministic sinks."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.quality import gate
from millrace.sources import files, schema

DDL = """
-- two tables
CREATE TABLE accounts (
    id INTEGER NOT NULL PRIMARY KEY, name VARCHAR(8) NOT NULL UNIQUE, share DECIMAL(5,4) CHECK (share >= 0 AND share <= 1),
    since DATE, seen TIMESTAMP, active BOOLEAN DEFAULT true
);
CREATE TABLE lines (id INTEGER NOT NULL, n INTEGER NOT NULL, account INTEGER REFERENCES accounts(id), code CHAR(3), PRIMARY KEY (id, n), CONSTRAINT pos CHECK (n > 0));
"""


def test_ddl():
    t = schema.parse_ddl(DDL)
    assert list(t) == ["accounts", "lines"]
    assert t["accounts"].schema.simpleString() == "struct<id:int,name:string,share:decimal(5,4),since:date,seen:timestamp_ntz,active:boolean>"
    assert t["accounts"].primary_key == ("id",) and t["accounts"].lengths == {"name": 8} and t["accounts"].checks == ["share >= 0 AND share <= 1"]
    assert t["lines"].primary_key == ("id", "n") and t["lines"].foreign == [("account", "accounts", "id")]
    with pytest.raises(ValueError):
        schema.column_type("BLOB")


def test_constraints_are_rules(spark):
    t = schema.parse_ddl(DDL)
    accounts = spark.createDataFrame([(1, "a", Decimal("0.5")), (2, "too long a name", Decimal("1.5"))], "id int, name string, share decimal(5,4)").withColumns({"since": F.lit(None).cast("date"), "seen": F.lit(None).cast("timestamp_ntz"), "active": F.lit(True)})
    lines = spark.createDataFrame([(1, 1, 1, "x"), (1, 1, 9, "y"), (2, 0, None, "z")], "id int, n int, account int, code string")
    failed = {r.check_name for r in gate([*t["accounts"].rules(accounts, {}), *t["lines"].rules(lines, {"accounts": accounts})]).where("not passed").collect()}
    assert failed == {"accounts: check share >= 0 AND share <= 1", "accounts.name: at most 8 characters", "lines: primary key", "lines.account: references accounts", "lines: check n > 0"}


def test_csv_round_trip_is_deterministic(spark, tmp_path):
    kinds = schema.parse_ddl(DDL)["accounts"].schema
    rows = [(2, 'say "hi",\nthere', Decimal("0.2500"), datetime.date(2026, 1, 2), datetime.datetime(2026, 1, 2, 3, 4, 5), True), (1, "b", None, None, None, None)]
    df = spark.createDataFrame(rows, kinds)
    files.write_csv(df, str(tmp_path / "a.csv"), ["id"])
    files.write_csv(df.repartition(3), str(tmp_path / "b.csv"), ["id"])
    assert files.file_hash(str(tmp_path / "a.csv")) == files.file_hash(str(tmp_path / "b.csv"))
    assert (tmp_path / "a.csv").read_text().splitlines()[1] == "1,b,,,,"
    assert sorted(map(tuple, files.read_typed(spark, str(tmp_path / "a.csv"), kinds).collect()), key=str) == sorted(rows, key=str)
    assert files.csv_rows(spark, str(tmp_path / "a.csv")) == 2


def test_a_bad_row_is_an_error_or_a_violation(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n\n1,2\nx,3\n")
    kinds = spark.createDataFrame([], "id int, n int").schema
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_typed(spark, str(tmp_path / "t.csv"), kinds).collect()
    assert files.bad_rows(spark, str(tmp_path / "t.csv"), kinds, "fits").first().violations == 1


def test_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n1,1.5,x,\n2,,3,\n")
    df = files.read_inferred(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes)["a"] == "bigint" and dict(df.dtypes)["b"] == "double" and dict(df.dtypes)["c"] == "string"
    assert df.where("a = 2").first().b is None


def test_pairs_take_domain_and_tier_from_the_name(spark, tmp_path):
    (tmp_path / "crm_t3_pairs.csv").write_text("question_id,question,tier\n1,how many?,\n")
    row = files.read_pairs(spark, str(tmp_path / "crm_t3_pairs.csv"), {"scoring_mode": "scalar_exact"}).first()
    assert (row.domain, row.tier, row.scoring_mode) == ("crm", "T3", "scalar_exact")


def test_runs_are_exploded(spark, tmp_path):
    (tmp_path / "results.json").write_text('{"run_id": "r1", "rows": [{"q": 1}, {"q": 2}]}')
    assert {(r.run_id, r.row.q) for r in files.read_runs(spark, str(tmp_path / "results.json")).collect()} == {("r1", 1), ("r1", 2)}


def test_batches_keep_both_bounds(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 50, 500).otherwise(10)).alias("t"))
    out = files.batches(df, 7, 200).collect()
    assert sum(r.n for r in out) == 100 and all(r.n <= 7 and (r.bytes <= 200 or r.n == 1) for r in out)


def test_write_once_and_publish(tmp_path):
    files.write_manifest(str(tmp_path / "m.json"), {"b": 1})
    with pytest.raises(FileExistsError):
        files.write_manifest(str(tmp_path / "m.json"), {"b": 1})
    target = str(tmp_path / "out")
    files.publish(lambda d: open(f"{d}/x", "w").close(), target)
    with pytest.raises(ZeroDivisionError):
        files.publish(lambda d: 1 / 0, target)
    assert (tmp_path / "out" / "x").exists() and not list(tmp_path.glob(".staging-*"))


def test_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert files.distinct_values(df, "v") == ["a", "b"]
    with pytest.raises(ValueError):
        files.distinct_values(df, "v", most=1)
