"""The stages of the pipeline, each held against what it should do with its own input."""

import collections
import re

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from millrace.llm.text import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of each stage."""
    from millrace.llm.scratch import Scratch

    scratch, docs, out = Scratch(spark, "test-pipeline"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.table(stage(spark, docs, SF), "stage")
        out.append((docs.toPandas(), after.toPandas()))
        docs = after
    return out


def test_all_but_the_last_return_documents(stages):
    for _, after in stages[:-1]:
        assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rules_keep_good_documents(stages):
    before, after = stages[0]
    labels = pd.read_parquet(f"{SF}/labels.parquet").merge(before, on="doc_id")
    good = labels[(labels.quality == 1) & (labels.text.map(lambda t: len(re.findall(WORD, t))) >= 10)]
    assert set(after.doc_id) < set(before.doc_id) and good.doc_id.isin(after.doc_id).mean() >= 0.97


def shingles(text):
    w = re.findall(WORD, text.lower())
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text, strict=True)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert set(after.doc_id) == {find(i) for i in ids} and after.doc_id.is_unique


def test_leaks_go(stages):
    before, after = stages[2]
    items = [" ".join(re.findall(WORD, t)) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    leaks = {i for i, t in zip(before.doc_id, before.text, strict=True) if any(x in " ".join(re.findall(WORD, t)) for x in items)}
    assert leaks and set(after.doc_id) == set(before.doc_id) - leaks


def test_the_mix_comes_near_its_targets(stages):
    before, after = stages[3]
    size = {i: len(re.findall(WORD, t)) for i, t in zip(before.doc_id, before.text, strict=True)}
    total, mixed = collections.Counter(), collections.Counter()
    for i, s in zip(before.doc_id, before.source, strict=True):
        total[s] += size[i]
    copies = collections.Counter(after.doc_id)
    for i, s in zip(after.doc_id, after.source, strict=True):
        mixed[s] += size[i]
    assert max(copies.values()) <= 2
    largest = max(size.values())
    assert abs(sum(mixed.values()) - 1.5 * sum(total.values())) <= largest * len(total)
    assert dict(zip(after.doc_id, after.text, strict=True)).items() <= dict(zip(before.doc_id, before.text, strict=True)).items()


def test_tokens_of_all_rows(stages):
    before, after = stages[4]
    after = after.sort_values("start")
    assert sorted(after.doc_id) == sorted(before.doc_id) and (np.diff(after.doc_id) >= 0).all()
    assert (after.start.to_numpy() == np.cumsum(after.n_tokens.to_numpy()) - after.n_tokens.to_numpy()).all()


def test_stages_decide_about_rows(spark):
    """Null and repeated ids, null texts, rows that agree in all columns, extra columns, and an empty table."""
    rng = np.random.default_rng(9)
    text = lambda n=60: " ".join(f"{a}{b}" for a, b in zip(rng.choice(list("klmnprst"), n), rng.integers(100, 999, n), strict=True))
    item = pd.read_parquet(f"{SF}/benchmark.parquet").text[0]
    a, b, c, d, leak = text(), text(), text(), text(), f"{text()} {item} {text()}"
    rows = [(None, a), (None, b), (5, c), (5, d), (5, d), (6, f"{c} more"), (7, leak), (7, text()), (8, "short"), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, _row string")
    out = lambda stage, df: collections.Counter((r.doc_id, r.text) for r in stage(spark, df, SF).collect())
    assert out(corpus_pipeline.rules, docs) == collections.Counter(rows[:8])
    assert out(corpus_pipeline.near_copies, docs) == collections.Counter(rows[:4] + rows[6:])
    assert out(corpus_pipeline.leaks, docs) == collections.Counter(rows[:6] + rows[7:])
    assert set(out(corpus_pipeline.mixing, docs)) <= set(rows)
    assert corpus_pipeline.token_ids(spark, docs, SF).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_entry_points():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert set(__spark_entry__.oracle_sql()) <= names
