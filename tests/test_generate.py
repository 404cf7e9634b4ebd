"""Generated tables: exact totals, contracts, gates, reproducibility, and redrawn dates."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import generate, synth
from millrace.plans import crm_tables, finance_tables
from millrace.plans.gates import BOUNDARY_DATES, POSTING_LAG, domain_gate


@pytest.fixture(scope="module")
def crm(spark):
    return {name: df.cache() for name, df in crm_tables.generate(spark, "dev").items()}


def test_tables_have_their_targets_and_pass_their_gate(crm):
    for name, rows in crm_tables.TARGETS["dev"].items():
        assert crm[name].count() == rows
    assert not [r for r in domain_gate(crm, "crm").collect() if not r.passed]


def test_contracts(crm):
    for name, key in (("accounts", "account_id"), ("contacts", "contact_id"), ("campaigns", "campaign_id"), ("interactions", "interaction_id"), ("support_cases", "case_id")):
        assert sorted(r[0] for r in crm[name].select(key).collect()) == list(range(1, crm_tables.TARGETS["dev"][name] + 1))
    accounts = {r.account_id: r for r in crm["accounts"].collect()}
    contacts = {r.contact_id: r for r in crm["contacts"].collect()}
    campaigns = {r.campaign_id: r for r in crm["campaigns"].collect()}
    assert all(c.account_id is None or c.created_at >= accounts[c.account_id].created_at for c in contacts.values())
    assert any(c.account_id is None for c in contacts.values()) and len({c.account_id for c in contacts.values()}) < len(accounts)
    assert {c.status for c in campaigns.values()} >= {"Completed", "Active", "Scheduled"}
    assert all(c.end_date is None or c.end_date >= c.start_date for c in campaigns.values())
    members = crm["contact_campaigns"].collect()
    assert len({(m.contact_id, m.campaign_id) for m in members}) == len(members) and {m.contact_id for m in members} == set(contacts) and {m.campaign_id for m in members} == set(campaigns)
    assert all(m.first_touch_at <= m.last_touch_at and m.first_touch_at.date() >= campaigns[m.campaign_id].start_date for m in members)
    assert sum(m.is_primary_attribution for m in members) == len(contacts)
    met = {(m.contact_id, m.campaign_id) for m in members}
    interactions = crm["interactions"].collect()
    assert all(i.campaign_id is None or (i.contact_id, i.campaign_id) in met for i in interactions)
    assert all(i.account_id in (None, contacts[i.contact_id].account_id) and i.interaction_at <= i.created_at for i in interactions)
    assert all(i.campaign_id is None or i.interaction_at.date() >= campaigns[i.campaign_id].start_date for i in interactions)
    assert len({i.interaction_at for i in interactions if i.campaign_id is None}) > 100
    assert any(i.campaign_id is None for i in interactions) and len({i.contact_id for i in interactions}) < len(contacts)


def test_cases_at_boundaries(spark, crm):
    plain = {r.case_id: r for r in crm_tables.Crm(crm_tables.TARGETS["dev"]).support_cases(spark).collect()}
    moved = [r for r in crm["support_cases"].collect() if r.opened_at != plain[r.case_id].opened_at]
    assert sorted(str(r.opened_at.date()) for r in moved) == sorted(crm_tables.BOUNDARIES)
    for r in moved:
        was = plain[r.case_id]
        assert r.sla_due_at - r.opened_at == datetime.timedelta(hours=crm_tables.SLA_HOURS[r.priority])
        assert r.created_at - r.opened_at == was.created_at - was.opened_at
        assert (r.resolved_at and r.resolved_at - r.opened_at) == (was.resolved_at and was.resolved_at - was.opened_at)


def test_same_rows_under_any_partitioning(spark, crm):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = crm_tables.generate(spark, "dev")
        for name, df in crm.items():
            assert sorted(map(str, df.collect())) == sorted(map(str, again[name].collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    other = crm_tables.generate(spark, "dev", seed=7)["contacts"]
    assert other.exceptAll(crm["contacts"]).count() > 250


def test_targets_that_cannot_be_met():
    good = crm_tables.TARGETS["dev"]
    for bad in ({"contact_campaigns": 100}, {"contact_campaigns": 300 * 50 + 1}, {"accounts": 0}):
        with pytest.raises(ValueError):
            crm_tables.Crm(good | bad)


@pytest.mark.parametrize("total,least,most", [(0, 0, None), (17, 0, None), (1000, 3, 200), (300, 3, 3)])
def test_fan_out_is_exact(spark, total, least, most, monkeypatch):
    monkeypatch.setattr(generate, "BUCKET_KEYS", 7)
    rng = random.Random(3)
    weights = [rng.choice([0, 1, 1, 2, 9]) for _ in range(100)]
    parents = spark.createDataFrame(list(enumerate(weights, 5)), "k long, w long").repartition(6)
    shared = sorted(map(tuple, generate.fan_out(parents, "k", "w", total, least, most).collect()))
    at, up, rest = 0, 0, total - 100 * least
    for (key, units, first), w in zip(shared, weights, strict=True):
        assert first == at and units == rest * (up + w) // sum(weights) - rest * up // sum(weights) + least
        at, up = at + units, up + w
    assert at == total
    rows = generate.children(generate.fan_out(parents, "k", "w", total, least, most), "child")
    assert sorted(r.child for r in rows.collect()) == list(range(1, total + 1))


def test_fan_out_refuses(spark):
    parents = spark.createDataFrame([(1, 0), (2, 0)], "k long, w long")
    for total, least, most in ((1, 1, None), (5, 0, None)):
        with pytest.raises(ValueError):
            generate.fan_out(parents, "k", "w", total, least, most)
    with pytest.raises(ValueError):
        generate.fan_out(parents.withColumn("w", F.col("k")), "k", "w", 9, 0, 4)
    assert [r.units for r in generate.fan_out(parents, "k", "w", 2, 1).collect()] == [1, 1]


@pytest.mark.parametrize("n", [1, 2, 7, 50, 4096])
def test_turned_is_a_permutation(spark, n):
    assert sorted(r[0] for r in spark.range(n).select(generate.turned(F.col("id"), n, 42)).collect()) == list(range(n))


def test_redrawn_dates_keep_the_tree_in_order(spark):
    rng = random.Random(5)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    # fixed dates are in order along every path; free ones are anything
    roots = [(i, day(rng.randrange(100)), i % 3 == 0) for i in range(40)]
    middle = [(i, i % 40, day(rng.randrange(100, 200)), rng.random() < 0.5) for i in range(150)] + [(900, 77, day(0), True), (901, None, day(0), True)]
    leaves = [(i, i % 150, day(rng.randrange(200, 300)), rng.random() < 0.4) for i in range(500)] + [(999, 3, None, False)]
    make = lambda rows, names: spark.createDataFrame(rows, names)
    levels = [
        generate.Level(make(roots, "k long, d date, free boolean"), "k", None, "d", F.col("free")),
        generate.Level(make(middle, "k long, p long, d date, free boolean"), "k", "p", "d", F.col("free")),
        generate.Level(make(leaves, "k long, p long, d date, free boolean"), "k", "p", "d", F.col("free")),
    ]
    top, mid, low = ({r.k: r for r in df.collect()} for df in generate.redrawn_dates(levels, "2023-06-01", "2025-06-01"))
    assert len(top) == 40 and len(mid) == 152 and len(low) == 501
    assert all(top[i].d == d for i, d, free in roots if not free) and all(low[i].d == d for i, _, d, free in leaves if not free)
    assert all(m.p not in top or top[m.p].d <= m.d for m in mid.values())
    assert all(r.d is None or mid[r.p].d <= r.d for r in low.values())
    assert sum(top[i].d != d for i, d, free in roots if free) > 5


def test_boundaries_need_rows(spark):
    with pytest.raises(ValueError):
        generate.at_boundaries(spark.range(1).select("id", F.lit("2020-01-01").cast("date").alias("d")), "id", "d", ["2020-01-01", "2021-01-01"], {})


def test_draws_are_within_bounds(spark):
    d, k = generate.Draws(1, "t"), F.col("id")
    rows = spark.range(2000).select(d.whole("a", 3, 5, k).alias("a"), d.moment("m", F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-02").cast("timestamp"), k).alias("m"), d.moment("n", F.lit("2024-01-02").cast("timestamp"), F.lit("2024-01-01").cast("timestamp"), k).alias("n")).collect()
    assert {r.a for r in rows} == {3, 4, 5} and all(datetime.datetime(2024, 1, 1) <= r.m <= datetime.datetime(2024, 1, 2) for r in rows)
    assert {r.n for r in rows} == {datetime.datetime(2024, 1, 2)}
    assert synth.count_of(10, 1) == 1


@pytest.fixture(scope="module")
def finance(spark):
    return {name: df.cache() for name, df in finance_tables.generate(spark, "dev", boundaries=BOUNDARY_DATES, lag=POSTING_LAG).items()}


def test_finance_tables_pass_their_gate(finance):
    for name, rows in finance_tables.TARGETS["dev"].items():
        assert finance[name].count() == rows
    # five percent of the transactions have no lines, and nothing else is amiss
    assert {r.check_name: r.violations for r in domain_gate(finance, "finance").collect() if not r.passed} == {"transactions.without_ledger": 50}


def test_finance_contracts(finance):
    accounts = {r.account_id: r for r in finance["accounts"].collect()}
    transactions = {r.transaction_id: r for r in finance["transactions"].collect()}
    lines, budgets, rates = (finance[t].collect() for t in ("ledger_entries", "budgets", "fx_rates"))
    assert sorted(accounts) == list(range(1, 51)) and {a.account_type for a in accounts.values()} == set(finance_tables.TYPES)
    assert {a.parent_account_id is None for a in accounts.values()} == {True, False}
    assert sorted(e.entry_id for e in lines) == list(range(1, 2001))
    by = {}
    for e in lines:
        by.setdefault(e.transaction_id, []).append(e)
    for t, own in by.items():
        assert sorted(e.line_number for e in own) == list(range(1, len(own) + 1))
        for side in ("debit_amount", "credit_amount"):
            assert sum(e[side] or 0 for e in own) == transactions[t].total_amount
        odd = {e.line_number: e.account_id for e in own}
        assert all(odd[n] != odd[n + 1] for n in range(1, len(own), 2))
        assert all((e.posting_type == "Reversal") == transactions[t].reversed and e.currency_code == transactions[t].source_currency for e in own)
    assert any(t.reversed for t in transactions.values()) and len({len(v) for v in by.values()}) > 1
    assert all(b.period_start < b.period_end and b.fiscal_year == b.period_start.year for b in budgets)
    assert sum(r.rate is None for r in rates) == 10 and len({(r.from_currency, r.rate_date) for r in rates}) == 370
    series = {}
    for r in sorted(rates, key=lambda r: r.rate_date):
        series.setdefault(r.from_currency, []).append(r.rate)
    assert set(series["USD"]) == {1}
    for name, own in series.items():
        anchor = float(finance_tables.ANCHORS[name])
        assert all(x is None or y is None or abs(x - y) <= anchor * 0.0076 + 2e-6 for x, y in zip(map(lambda v: None if v is None else float(v), own), map(lambda v: None if v is None else float(v), own[1:]), strict=False))


def test_finance_targets_that_cannot_be_met():
    good = finance_tables.TARGETS["dev"]
    for bad in ({"accounts": 3}, {"ledger_entries": 2001}, {"ledger_entries": 1000}, {"budgets": 101}, {"fx_rates": 371}, {"fx_rates": 40}):
        with pytest.raises(ValueError):
            finance_tables.Finance(good | bad)
