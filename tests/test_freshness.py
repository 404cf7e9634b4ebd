"""Digests of key ranges, the descent to what differs, and the guard of the driver."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.answers import table_digest
from millrace.operators import freshness
from millrace.operators.freshness import Stamp, changed_ranges, digest_tree
from millrace.operators.shared import cut
from millrace.plans import driver


@pytest.fixture(scope="module")
def rows(spark):
    # 40 % of the rows have one key, some have none
    key = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 5 < 2, 77).otherwise(F.col("id") - 500)
    return spark.range(5000).select(key.alias("k"), F.col("id").cast("string").alias("v"), F.col("id").alias("rows")).cache()


def test_the_root_is_the_table(spark, rows):
    tree = digest_tree(rows.repartition(7), "k", 10, 4, 3).cache()
    root = tree.where("level = 3").collect()
    whole = table_digest(rows).first()
    assert [(r.node, r.rows, r.digest) for r in root] == [(None, whole.rows, whole.digest)]
    assert {r.s for r in tree.groupBy("level").agg(F.sum("rows").alias("s")).collect()} == {5000}
    assert tree.where("level = 0 AND node IS NULL").first().rows == 100
    assert tree.where("level = 0 AND node < 0").count() == 50
    empty = digest_tree(rows.limit(0), "k", 10, 4, 3).collect()
    assert [(r.level, r.node, r.rows, r.digest) for r in empty] == [(3, None, 0, table_digest(rows.limit(0)).first().digest)]


@pytest.mark.parametrize(
    "change, wanted",
    [
        (lambda t: t, {}),
        (lambda t: t.withColumn("v", F.when(F.col("rows") == 1234, "x").otherwise(F.col("v"))), {73: (6, 6)}),
        (lambda t: t.where("rows <> 1234"), {73: (6, 5)}),
        (lambda t: t.withColumn("v", F.when(F.col("rows") == 100, "x").otherwise(F.col("v"))), {None: (100, 100)}),
        (lambda t: t.unionByName(t.where("rows = 1234")), {73: (6, 7)}),
        (lambda t: t.withColumn("k", F.when(F.col("rows") == 1234, 90_000).otherwise(F.col("k"))), {73: (6, 5), 9000: (0, 1)}),
    ],
)
def test_descent_names_the_ranges(rows, change, wanted):
    trees = [cut(digest_tree(t, "k", 10, 4, 3)) for t in (rows, change(rows))]
    found = {r.node: (r.built_rows, r.rows) for r in changed_ranges(*trees, 4, 3).collect()}
    assert found == wanted


def test_other_keys(spark):
    some = spark.createDataFrame([("a", datetime.date(1969, 12, 31)), ("b", datetime.date(2024, 1, 1)), (None, None)], "s string, d date")
    assert digest_tree(some, "s").where("level = 0").count() == 3
    assert {r.node for r in digest_tree(some, "d", 1).where("level = 0").collect()} == {-1, 19723, None}


def test_guard(spark, rows, tmp_path):
    stamp = Stamp(str(tmp_path / "stamp"), {"t": "k"}, {"version": "1", "schema": "abc"})
    made = freshness.write_stamp({"t": rows}, stamp)
    assert len(made) == 64
    freshness.require_fresh_tables({"t": rows.repartition(3)}, stamp)
    assert driver.build({"t": rows}, [], {}, {}, {}, stamp=stamp) == []
    edited = rows.withColumn("v", F.when(F.col("rows") == 4999, "x").otherwise(F.col("v")))
    with pytest.raises(RuntimeError, match=r"t: 4096 to 8191 \(\d+ rows, now \d+\)$"):
        driver.build({"t": edited}, [], {}, {}, {}, stamp=stamp)
    with pytest.raises(RuntimeError, match="version: '1' is now '2'"):
        freshness.require_fresh_tables({"t": rows}, Stamp(stamp.path, stamp.keys, {"version": "2", "schema": "abc"}))
    with pytest.raises(RuntimeError, match="u: the stamp has no such table"):
        freshness.require_fresh_tables({"t": rows}, Stamp(stamp.path, {"t": "k", "u": "k"}, stamp.parts))
    with pytest.raises(RuntimeError, match="t: the table is missing"):
        freshness.require_fresh_tables({"other": rows}, stamp)
    with pytest.raises(Exception, match="(?i)exist"):
        freshness.write_stamp({"t": rows}, stamp)
