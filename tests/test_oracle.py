"""Every registered query against its SQL in another engine, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def alike(x, y):
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12)
    return x == y


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted([tuple(r[c] for c in columns) for r in df.collect()], key=str)
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    result = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted([tuple(r[names.index(c)] for c in columns) for r in result.fetchall()], key=str)
    assert len(rows) == len(wanted)
    assert all(alike(a, b) for x, y in zip(rows, wanted, strict=True) for a, b in zip(x, y, strict=True))


def test_all_question_families_are_there():
    assert len(registry.FAMILIES) + len(registry.SPECIAL) == 122
    counts = {d: sum(i.startswith(f"{d}:") for i in [*registry.FAMILIES, *registry.SPECIAL]) for d in registry.TABLES}
    assert counts == {"crm": 32, "sales": 23, "finance": 22, "project_management": 22, "logistics": 23}
