"""Divergence of sources against plain Python and SQL."""

import collections
import re

import duckdb
import numpy as np
import pytest

from millrace.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, ranks=200):
    """rows: (text, lang, source)."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    terms = [(lang, s, [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(t)]) for t, lang, s in rows]
    out = []
    for lang in {r[1] for r in rows}:
        seen = collections.Counter(x for own, _, found in terms if own == lang for x in set(found))
        kept = [x for x, n in seen.items() if n >= least]
        counts = collections.defaultdict(collections.Counter)
        for own, s, found in terms:
            if own == lang:
                counts[s].update(x for x in found if seen[x] >= least)
                counts[None].update(x for x in found if seen[x] >= least)
        p = {s: {x: 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + len(kept)) for x in kept} for s, c in counts.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            if s is None:
                continue
            pairs = [(sum(f(p[s][x], p[o][x]) for x in kept), o) for o in counts if o not in (None, s)]
            own = [(f(p[s][x], p[None][x]), x) for x in kept if counts[s][x] and p[s][x] > p[None][x]]
            for part, found, most in (("pair", pairs, 10**9), ("term", own, ranks)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found) if k < most]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "abcdéфжz" for b in "QWxyzß"] + ["don't", "x9y", "中文", "_"]
    out = [(" ".join(rng.choice(words, rng.integers(0, 60), p=None)), ["en", "de", None][i % 3], ["hot", "hot", "s2", "s3", None, ""][i % 6]) for i in range(200)]
    out += [(None, "en", "silent"), ("", "en", "silent"), ("once only here", "xx", "a"), ("", "xx", "b"), (None, None, None), ("same same\x00same", "en", "s2"), ("word " * 20000, "de", "long")]
    return out + out[:3]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, id long, term string").repartition(5)


def test_divergence(spark, rows, monkeypatch):
    want = sorted(brute(rows))
    assert sorted(map(tuple, divergence.divergence(frame(spark, rows)).collect())) == want
    monkeypatch.setattr(divergence, "BLOCK_PAIRS", 3)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, divergence.divergence(frame(spark, rows)).collect())) == want


def test_ranks_end(spark, rows):
    assert sorted(map(tuple, divergence.divergence(frame(spark, rows), ranks=4, least_docs=1).collect())) == sorted(brute(rows, 1, 4))


def test_sources_without_kept_terms_and_empty_tables(spark):
    few = [("a b", "en", "x"), ("b", "en", "y"), (None, "en", None)]
    got = sorted(map(tuple, divergence.divergence(frame(spark, few)).collect()))
    assert got == sorted(brute(few)) and {r[4] for r in got} == {0}
    assert not divergence.divergence(frame(spark, [])).collect()


def test_sql(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(con.execute(divergence.OP11_SQL).fetchall()) == sorted(brute(rows))
