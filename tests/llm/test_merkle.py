"""Manifests against plain Python and SQL."""

import hashlib
import zlib

import duckdb
import pytest

from millrace.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(nodes, fan=3):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def siblings(levels, at, fan=3):
    out = []
    for nodes in levels[:-1]:
        run = at // fan * fan
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fan])))
        at //= fan
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    trees = {}
    for source, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = up([leaf_of(r) for r in own])
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = up([trees[s][-1][0] for s in names]) if names else []
    out = []
    for place, source in enumerate(names):
        for at, row in enumerate(by[source]):
            path = siblings(trees[source], at) + siblings(top, place)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf_of((*row[:4], text))
            for left, right in path:
                node = digest(left, node, right)
            root = top[-1][0]
            out.append((row[0], leaf_of(row), trees[source][-1][0], root, digest(*(a + b for a, b in path)), node, node == root))
    return out


def rows_of(n):
    out = [(i * 3, ["big", "big", "big", "s2", "é", None, "S", ""][i % 8], ["en", None][i % 2], i, f"line {i}\nmore" if i % 3 else f"flat {i}") for i in range(n)]
    out += [(5000, "lone", None, None, None), (None, "big", "en", 3, "no id\n"), (0, "big", "en", 0, "again\n"), (0, "big", "en", 0, "again\n"), (7000, "big", "en", 1, ""), (7001, "big", "x", 1, "a\n" * 30000)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, _node string, _group int").repartition(4)


@pytest.mark.parametrize("n", [0, 1, 30, 400])
def test_manifest(spark, n, monkeypatch):
    rows = rows_of(n)
    got = [tuple(r) for r in merkle.verified_manifest(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_blocks_of_any_size_give_the_same_tree(spark, levels):
    rows = rows_of(300)
    out = merkle.merkle_manifest(frame(spark, rows), levels=levels)
    got = sorted((r["doc_id"] or -1, r["leaf"], r["subroot"], r["root"], digest(*(s["left"] + s["right"] for s in r["path"]))) for r in out.collect())
    assert got == sorted((r[0] or -1, *r[1:5]) for r in brute(rows))


def test_empty_table_and_lone_row(spark):
    assert not merkle.verified_manifest(frame(spark, [])).collect()
    (row,) = merkle.verified_manifest(frame(spark, [(1, None, None, None, None)])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == digest("")


def test_sql(spark, tmp_path):
    rows = rows_of(60)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(con.execute(merkle.OP13_SQL).fetchall(), key=str) == sorted(brute(rows), key=str)
