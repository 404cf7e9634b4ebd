"""Batches with bounds over a whole table, against one pass over its rows in order."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import batching


def one_pass(costs, rows, most):
    out, n, b, batch = [], 0, 0, -1
    for c in costs:
        if batch < 0 or n >= rows or b + c > most:
            batch, n, b = batch + 1, 0, 0
        out.append(batch)
        n, b = n + 1, b + c
    return out


def blocks_of(costs, cuts):
    edges = [0, *sorted(c % (len(costs) + 1) for c in cuts), len(costs)]
    return [np.array(costs[a:b], dtype=np.int64) for a, b in zip(edges, edges[1:], strict=False) if b > a]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.lists(st.integers(0, 60), max_size=6), st.integers(1, 8), st.integers(1, 60), st.integers(1, 4))
def test_functions_compose(costs, cuts, rows, most, fan):
    bounds, parts = batching.Bounds(rows, most), blocks_of(costs, cuts)
    leaves = [batching.leaf(p, bounds) for p in parts]
    groups = [batching.composed(leaves[i : i + fan], bounds) for i in range(0, len(leaves), fan)]
    found, state = [], (0, 0, 0)
    for p in parts:
        some, *state = batching.numbered(p, bounds, *state)
        found += some.tolist()
    wanted = one_pass(costs, rows, most)
    assert found == wanted
    for level in (leaves, groups):
        n = b = begun = 0
        for block in level:
            n, b, more = block.after(bounds, n, b)
            begun += int(more)
        last = [c for c, w in zip(costs, wanted, strict=True) if w == wanted[-1]]
        assert (int(n), int(b), begun) == (len(last), sum(last), wanted[-1] + 1)


@pytest.fixture(scope="module")
def rows(spark):
    text = F.repeat(F.lit("x"), (F.col("id") * 7919 % 97).cast("int"))
    some = spark.range(3000).select((F.col("id") % 500).alias("k"), F.when(F.col("id") % 11 != 0, text).alias("text"), F.when(F.col("id") == 700, F.repeat(F.lit("é"), 5000)).alias("long"), (F.col("id") % 3).alias("batch"))
    # repeated rows and ties, and columns with the names of the result's
    return some.withColumn("line", F.lit("l")).cache()


@pytest.mark.parametrize("partitions, fan", [(1, 64), (40, 64), (40, 3)])
def test_batches_do_not_depend_on_partitions(spark, rows, partitions, fan):
    found = batching.batch_rows(rows, ["k"], 20, 1_200, partitions, fan).select("row.k", "line", "bytes", "batch").collect()
    ordered = sorted(found, key=lambda r: r.batch)
    lines = rows.select("k", F.to_json(F.struct("*")).alias("line")).orderBy("k", F.md5("line")).collect()
    wanted = one_pass([len(r.line.encode()) + 2 for r in lines], 20, 1_200)
    assert [r.batch for r in ordered] == wanted
    assert sorted((r.line, w) for r, w in zip(lines, wanted, strict=True)) == sorted((r.line, r.batch) for r in found)


def test_whole_batches(spark, rows):
    made = batching.ordered_batches(rows, ["k"], 20, 1_200, 7).orderBy("batch").collect()
    assert [r.batch for r in made] == list(range(len(made))) and sum(r.n for r in made) == 3000
    assert all(r.n <= 20 and (r.bytes <= 1_200 or r.n == 1) and len(r.lines.split("\n")) == r.n for r in made)
    assert any(r.bytes > 1_200 for r in made)
    lines = [r.line for r in rows.select("k", F.to_json(F.struct("*")).alias("line")).orderBy("k", F.md5("line")).collect()]
    assert "\n".join(r.lines for r in made).split("\n") == lines


def test_empty_and_wrong(spark, rows):
    assert batching.ordered_batches(rows.limit(0), ["k"], 5, 100).count() == 0
    with pytest.raises(ValueError):
        batching.batch_rows(rows, ["k"], 0, 100)
