"""Queries over generated tables, whose row targets are the star schema's counts, and the same draws as SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.generate import Level, fan_out, redrawn_dates
from millrace.operators.shared import cut

from . import crm_tables as crm
from . import finance_tables as finance
from .gates import BOUNDARY_DATES, GATES, POSTING_LAG, domain_gate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _made(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, made once for all that reads them."""
    return {name: cut(df) for name, df in tables.items()}


def _targets(spark: SparkSession, sf: str) -> dict[str, int]:
    customers, suppliers, orders = (_table(spark, sf, t).count() for t in ("customer", "supplier", "orders"))
    return {"accounts": customers, "contacts": 2 * customers, "campaigns": suppliers, "contact_campaigns": 4 * customers + suppliers, "interactions": orders, "support_cases": orders}


_COUNTS = "c AS (SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM customer) AS accounts, 2 * (SELECT COUNT(*) FROM customer) AS contacts, (SELECT CAST(COUNT(*) AS BIGINT) FROM supplier) AS campaigns, (SELECT COUNT(*) FROM customer) * 4 + (SELECT COUNT(*) FROM supplier) AS members, (SELECT CAST(COUNT(*) AS BIGINT) FROM orders) AS n)"


def _u(stream: str, key: str) -> str:
    return f"(CAST(CAST('0x' || substr(md5('42:{stream}:' || CAST({key} AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496)"


def _whole(stream: str, least: int, most: str, key: str) -> str:
    return f"least(CAST(floor({_u(stream, key)} * ({most} - {least} + 1)) AS BIGINT) + {least}, {most})"


def _one(stream: str, values: tuple[str, ...], key: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_whole(stream, 1, str(len(values)), key)}]"


def _weighted(stream: str, weights: dict[str, float], key: str) -> str:
    at, cases = 0.0, []
    for value, weight in weights.items():
        at += weight
        cases.append(f"WHEN {_u(stream, key)} < {at!r} THEN '{value}'")
    return f"CASE {' '.join(cases)} ELSE '{list(weights)[-1]}' END"


def _moment(stream: str, start: str, end: str, key: str) -> str:
    """Seconds since 1970."""
    seconds = f"greatest(0, {end} - {start})"
    return f"({start} + least({seconds}, CAST(floor({_u(stream, key)} * ({seconds} + 1)) AS BIGINT)))"


def _seconds(day: str) -> str:
    return f"CAST(epoch(TIMESTAMP '{day} 00:00:00') AS BIGINT)"


def _poisson_bounds(rate: float, most: int = 60) -> list[float]:
    """The distribution function, term by term."""
    term, total, out = math.exp(-rate), 0.0, []
    for k in range(most):
        total += term
        out.append(total)
        term *= rate / (k + 1)
    return out


_ACCOUNT = f"CASE WHEN NOT {_u('crm.contacts.unassigned', '{k}')} < 0.05 AND {{k}} <> contacts THEN {_whole('crm.contacts.account_id', 1, 'greatest(1, accounts * 9 // 10)', '{k}')} END"


@query(
    "generated_crm_contacts",
    f"""WITH {_COUNTS}, k AS (SELECT unnest(range(1, contacts + 1)) AS contact_id, accounts, contacts FROM c),
a AS (SELECT contact_id, {_ACCOUNT.format(k='contact_id')} AS account_id FROM k),
s AS (SELECT *, CASE WHEN account_id IS NULL THEN {_seconds(crm.EARLIEST)} ELSE {_moment('crm.accounts.created_at', _seconds(crm.EARLIEST), _seconds(crm.TODAY), 'account_id')} END AS since FROM a)
SELECT contact_id, account_id, {_one('crm.contacts.title', crm.TITLES, 'contact_id')} AS title, {_u('crm.contacts.is_active', 'contact_id')} < 0.9 AS is_active, {_moment('crm.contacts.created_at', 'since', _seconds(crm.TODAY), 'contact_id')} AS created FROM s""",
)
def generated_crm_contacts(spark, sf):
    rows = crm.Crm(_targets(spark, sf)).contacts(spark)
    return rows.select("contact_id", "account_id", "title", "is_active", F.unix_timestamp("created_at").alias("created"))


@query(
    "generated_crm_memberships",
    f"""WITH RECURSIVE {_COUNTS}, g AS (SELECT campaigns, greatest(1, CAST(floor(campaigns * 0.6180339887) AS BIGINT)) AS step FROM c UNION ALL SELECT campaigns, step + 1 FROM g WHERE gcd(step, campaigns) > 1),
k AS (SELECT unnest(range(1, contacts + 1)) AS contact_id, members - contacts AS rest, contacts, campaigns FROM c),
w AS (SELECT *, {_whole('crm.contact_campaigns.weight', 1, '8', 'contact_id')} AS w FROM k),
p AS (SELECT contact_id, rest, CAST(SUM(w) OVER (ORDER BY contact_id) AS HUGEINT) AS upto, w, CAST(SUM(w) OVER () AS HUGEINT) AS every FROM w),
f AS (SELECT contact_id, rest * (upto - w) // every + contact_id - 1 AS first, rest * upto // every - rest * (upto - w) // every + 1 AS units FROM p),
m AS (SELECT contact_id, units, unnest(range(0, CAST(units AS BIGINT))) AS position, first FROM f)
SELECT contact_id, CAST((first + position) * step + 42 AS BIGINT) % campaigns + 1 AS campaign_id, CAST((10000 // units + CASE WHEN position < 10000 % units THEN 1 ELSE 0 END) AS BIGINT) AS weight_units, position = 0 AS is_primary_attribution
FROM m, (SELECT MAX(step) AS step, MAX(campaigns) AS campaigns FROM g) AS s""",
)
def generated_crm_memberships(spark, sf):
    rows = crm.Crm(_targets(spark, sf)).contact_campaigns(spark)
    return rows.select("contact_id", "campaign_id", (F.col("attribution_weight") * crm.UNITS).cast("long").alias("weight_units"), "is_primary_attribution")


_HOURS = "CASE priority " + " ".join(f"WHEN '{p}' THEN {h}" for p, h in crm.SLA_HOURS.items()) + " END"
_RANK = "row_number() OVER (ORDER BY md5('42:boundary:opened_at:' || CAST(case_id AS VARCHAR)), case_id)"
_BOUNDARY = "CASE drawn " + " ".join(f"WHEN {i} THEN {_seconds(d)}" for i, d in enumerate(crm.BOUNDARIES, 1)) + " END"


@query(
    "generated_crm_cases",
    f"""WITH {_COUNTS}, k AS (SELECT unnest(range(1, n + 1)) AS case_id, accounts, contacts FROM c),
a AS (SELECT *, CASE WHEN {_u('crm.support_cases.contact', 'case_id')} < 0.75 THEN {_whole('crm.support_cases.contact_id', 1, 'greatest(1, contacts * 7 // 10)', 'case_id')} END AS asked FROM k),
o AS (SELECT case_id, asked, accounts, CASE WHEN asked IS NOT NULL THEN {_ACCOUNT.format(k='asked')} END AS own, CASE case_id WHEN 1 THEN 'Resolved' WHEN 2 THEN 'New' ELSE {_weighted('crm.support_cases.status', crm.CASE_STATUSES, 'case_id')} END AS status, {_weighted('crm.support_cases.priority', crm.PRIORITIES, 'case_id')} AS priority FROM a),
t AS (SELECT *, status IN ('Resolved', 'Closed') AS over, {_HOURS} AS hours, {_moment('crm.support_cases.opened_at', _seconds(crm.ACTIVITY), f"CASE WHEN status IN ('Resolved', 'Closed') THEN {_seconds(crm.TODAY)} - 604800 ELSE {_seconds(crm.TODAY)} END", 'case_id')} AS opened FROM o),
r AS (SELECT *, CASE WHEN over THEN least(opened + 3600 * {_whole('crm.support_cases.resolution', 1, '2 * hours', 'case_id')}, {_seconds(crm.TODAY)}) END AS resolved, least(opened + 3600 * {_whole('crm.support_cases.lag', 0, '2', 'case_id')}, {_seconds(crm.TODAY)}) AS created, {_RANK} AS drawn FROM t),
b AS (SELECT *, coalesce({_BOUNDARY}, opened) AS opens FROM r)
SELECT case_id, coalesce(own, {_whole('crm.support_cases.account_id', 1, 'accounts', 'case_id')}) AS account_id, CASE WHEN own IS NOT NULL THEN asked END AS contact_id, status, priority, opens AS opened, opens + 3600 * hours AS due, resolved - opened + opens AS resolved, created - opened + opens AS created FROM b""",
)
def generated_crm_cases(spark, sf):
    rows = crm.with_boundaries(crm.Crm(_targets(spark, sf)).support_cases(spark))
    return rows.select("case_id", "account_id", "contact_id", "status", "priority", *(F.unix_timestamp(c).alias(n) for c, n in (("opened_at", "opened"), ("sla_due_at", "due"), ("resolved_at", "resolved"), ("created_at", "created"))))


@query("generated_crm_gate", " UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(0 AS BIGINT) AS violations, true AS passed" for name, _, _ in GATES["crm"]))
def generated_crm_gate(spark, sf):
    """That all rules of the domain hold on the generated tables."""
    return domain_gate(_made(crm.generate(spark, _targets(spark, sf))), "crm")


@query(
    "fan_out_orders",
    "WITH w AS (SELECT c_custkey, CAST(greatest(0, floor(c_acctbal)) AS HUGEINT) AS w FROM customer), p AS (SELECT c_custkey, w, SUM(w) OVER (ORDER BY c_custkey) AS upto, SUM(w) OVER () AS every, row_number() OVER (ORDER BY c_custkey) - 1 AS place, (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM customer) AS rest FROM w) SELECT c_custkey, CAST(rest * upto // every - rest * (upto - w) // every + 1 AS BIGINT) AS units, CAST(rest * (upto - w) // every + place AS BIGINT) AS first FROM p",
)
def fan_out_orders(spark, sf):
    """As many children as there are order lines, over customers by their balances."""
    parents = _table(spark, sf, "customer").select("c_custkey", F.greatest(F.lit(0), F.floor("c_acctbal")).cast("long").alias("w"))
    return fan_out(parents, "c_custkey", "w", _table(spark, sf, "lineitem").count(), least=1)


@query(
    "redrawn_dates",
    f"""WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS line, l_orderkey, CAST(l_shipdate AS DATE) AS d, l_linenumber % 2 = 0 AS free FROM lineitem),
f AS (SELECT l_orderkey, MIN(d) AS lim FROM l WHERE NOT free GROUP BY l_orderkey),
o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN DATE '1990-01-01' + CAST(floor({_u('redrawn:0:d', 'o_orderkey')} * (greatest(0, coalesce(f.lim, DATE '2000-01-01') - DATE '1990-01-01') + 1)) AS INTEGER) ELSE CAST(o_orderdate AS DATE) END AS d FROM orders LEFT JOIN f ON l_orderkey = o_orderkey),
x AS (SELECT line, l_orderkey, CASE WHEN free THEN coalesce(o.d, DATE '1990-01-01') + CAST(floor({_u('redrawn:1:d', 'line')} * (greatest(0, DATE '2000-01-01' - coalesce(o.d, DATE '1990-01-01')) + 1)) AS INTEGER) ELSE l.d END AS d FROM l LEFT JOIN o ON o_orderkey = l_orderkey)
SELECT x.line, x.l_orderkey AS o_orderkey, CAST(x.d AS VARCHAR) AS line_date, CAST(o.d AS VARCHAR) AS order_date FROM x LEFT JOIN o ON o.o_orderkey = x.l_orderkey""",
)
def redrawn(spark, sf):
    """Every third order's date, and the shipping dates of even lines, drawn anew between what is fixed above and below them."""
    orders = _table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    lines = _table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("date").alias("d"), "l_linenumber")
    top, low = redrawn_dates([Level(orders, "o_orderkey", None, "d", F.col("o_orderkey") % 3 == 0), Level(lines, "line", "o_orderkey", "d", F.col("l_linenumber") % 2 == 0)], "1990-01-01", "2000-01-01")
    top = top.withColumnRenamed("d", "order_date")
    return low.join(top, "o_orderkey", "left").select("line", "o_orderkey", F.col("d").cast("string").alias("line_date"), F.col("order_date").cast("string").alias("order_date"))


def _finance(spark: SparkSession, sf: str) -> finance.Finance:
    """As many accounts as suppliers, a transaction for every order and two lines for each, more or less."""
    suppliers, orders = (_table(spark, sf, t).count() for t in ("supplier", "orders"))
    targets = {"accounts": suppliers, "transactions": orders, "ledger_entries": 3 * orders // 2 * 2, "budgets": 4 * suppliers, "fx_rates": 3650}
    return finance.Finance(targets, boundaries=BOUNDARY_DATES, lag=POSTING_LAG)


_UNPOSTED = "CAST(ceil((SELECT COUNT(*) FROM orders) * 5 / 100.0) AS BIGINT)"


@query("generated_finance_gate", " UNION ALL ".join(f"SELECT '{name}' AS check_name, {_UNPOSTED if name == 'transactions.without_ledger' else 'CAST(0 AS BIGINT)'} AS violations, {str(name != 'transactions.without_ledger').lower()} AS passed" for name, _, _ in GATES["finance"]))
def generated_finance_gate(spark, sf):
    """That all rules of the domain hold on the generated tables, but that exactly the unposted transactions have no lines."""
    return domain_gate(_made(_finance(spark, sf).tables(spark)), "finance")


def _type(key: str) -> str:
    first = " ".join(f"WHEN {key} = {i} THEN '{t}'" for i, t in enumerate(finance.TYPES, 1))
    return f"CASE {first} ELSE {_weighted('finance.accounts.type', finance.TYPES, key)} END"


_PARENT = f"CASE WHEN {{k}} > roots AND {{k}} <= middle THEN {_whole('finance.accounts.parent', 1, 'roots', '{k}')} WHEN {{k}} > middle THEN least(CAST(floor({_u('finance.accounts.parent', '{k}')} * (middle - (roots + 1) + 1)) AS BIGINT) + roots + 1, middle) END"


@query(
    "generated_finance_accounts",
    f"""WITH c AS (SELECT CAST(COUNT(*) AS BIGINT) AS n, greatest(5, CAST(COUNT(*) AS BIGINT) * 15 // 100) AS roots FROM supplier), m AS (SELECT n, roots, roots + greatest(1, (n - roots) // 2) AS middle FROM c),
k AS (SELECT unnest(range(1, n + 1)) AS account_id, roots, middle FROM m), p AS (SELECT *, {_PARENT.format(k='account_id')} AS parent FROM k),
t AS (SELECT *, coalesce(parent, account_id) AS above FROM p), r AS (SELECT *, coalesce({_PARENT.format(k='above')}, above) AS root FROM t)
SELECT account_id, parent AS parent_account_id, {_type('root')} AS account_type FROM r""",
)
def generated_finance_accounts(spark, sf):
    return _finance(spark, sf).accounts(spark).select("account_id", "parent_account_id", "account_type")


_POISSON = "CASE " + " ".join(f"WHEN {_u('finance.ledger_entries.frequency', 'transaction_id')} < {b!r} THEN {k}" for k, b in enumerate(_poisson_bounds(3.2))) + " ELSE 60 END"


@query(
    "generated_finance_lines",
    f"""WITH c AS (SELECT CAST(COUNT(*) AS BIGINT) AS n, 3 * COUNT(*) // 2 AS pairs, {_UNPOSTED} AS unposted FROM orders), k AS (SELECT unnest(range(1, n + 1)) AS transaction_id, pairs, unposted, n FROM c),
d AS (SELECT *, row_number() OVER (ORDER BY md5('42:unposted:' || CAST(transaction_id AS VARCHAR)), transaction_id) AS drawn FROM k),
w AS (SELECT transaction_id, pairs - (n - unposted) AS rest, {_POISSON} AS w FROM d WHERE drawn > unposted),
p AS (SELECT transaction_id, rest, w, CAST(SUM(w) OVER (ORDER BY transaction_id) AS HUGEINT) AS upto, CAST(SUM(w) OVER () AS HUGEINT) AS every, row_number() OVER (ORDER BY transaction_id) - 1 AS place FROM w),
f AS (SELECT transaction_id, CAST(rest * upto // every - rest * (upto - w) // every + 1 AS BIGINT) AS units, CAST(rest * (upto - w) // every + place AS BIGINT) AS first, (SELECT COUNT(*) FROM supplier) AS n FROM p),
l AS (SELECT transaction_id, n, unnest(range(0, units)) AS position, first FROM f),
a AS (SELECT transaction_id, n, position, first + position + 1 AS pair, {_whole('finance.ledger_entries.debit', 1, 'n', 'first + position + 1')} AS debit, {_whole('finance.ledger_entries.credit', 1, 'n - 1', 'first + position + 1')} AS step FROM l)
SELECT 2 * pair - 1 + side AS entry_id, transaction_id, CAST(2 * position + 1 + side AS INTEGER) AS line_number, CASE side WHEN 0 THEN debit ELSE (debit - 1 + step) % n + 1 END AS account_id FROM a, (SELECT 0 AS side UNION ALL SELECT 1) AS s""",
)
def generated_finance_lines(spark, sf):
    tables = _finance(spark, sf)
    return tables.ledger_entries(tables.transactions(spark)).select("entry_id", "transaction_id", "line_number", "account_id")
