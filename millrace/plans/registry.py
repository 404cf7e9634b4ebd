"""Every registered query over the star schema's tables, with its SQL where SQL can express it."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import answers, money, ownership, scoring, texts, verdicts
from millrace.operators import batching, capacity, freshness, joins, paths, quality, runs, scorecard, shared, summary, synth, windows
from millrace.sources import files
from millrace.sources.feasibility import subsets
from millrace.sources.schema import parse_ddl

from . import driver, generated
from .catalog import FAMILIES
from .demo import TABLES, demo_sql, demo_tables
from .gates import GATES, domain_gate, gate_sql
from .metrics import METRICS, metric, metric_sql
from .special import SPECIAL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def _name(family: str) -> str:
    return family.lower().replace(":", "_").replace("-", "_")


for _id, _f in FAMILIES.items():
    _domain = _id.split(":")[0]
    query(_name(_id), demo_sql(_domain, _f.sql()))(lambda spark, sf, f=_f, d=_domain: f.frame(demo_tables(spark, sf, d)))
for _id, (_build, _sql) in SPECIAL.items():
    _domain = _id.split(":")[0]
    query(_name(_id), demo_sql(_domain, _sql))(lambda spark, sf, b=_build, d=_domain: b(demo_tables(spark, sf, d)))
for _domain, _metric in METRICS:
    query(f"metric_{_domain}_{_metric}", demo_sql(_domain, metric_sql(_domain, _metric)))(lambda spark, sf, d=_domain, m=_metric: metric(spark, demo_tables(spark, sf, d), d, m))


for _domain in GATES:
    query(f"gate_{_domain}", demo_sql(_domain, gate_sql(_domain)))(lambda spark, sf, d=_domain: domain_gate(demo_tables(spark, sf, d), d))


# ---- star schema


@query(
    "net_revenue_top3",
    """SELECT p_brand AS entity, CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS net_revenue
    FROM lineitem INNER JOIN orders ON l_orderkey = o_orderkey INNER JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F' GROUP BY p_brand ORDER BY net_revenue DESC, entity LIMIT 3""",
)
def net_revenue_top3(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: brands with the most net revenue of finished orders."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    out = joined.groupBy(F.col("p_brand").alias("entity")).agg(F.round(F.sum(net), 2).cast("double").alias("net_revenue"))
    return out.orderBy(F.desc("net_revenue"), "entity").limit(3)


@query(
    "running_order_total",
    "SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance FROM orders",
)
def running_order_total(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.rolling_balance(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice").cast("decimal(18,2)"))
    return out.select("o_orderkey", F.col("balance").cast("double").alias("balance"))


@query("orders_without_lines", "SELECT CAST(COUNT(*) AS BIGINT) AS value FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").join(table(spark, sf, "lineitem").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count("*").alias("value"))


@query("latest_order", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) AS r WHERE n = 1")
def latest_order(spark: SparkSession, sf: str) -> DataFrame:
    return windows.latest(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("repeats_after_first", "SELECT CAST(COUNT(*) - COUNT(DISTINCT text) AS BIGINT) AS value FROM documents")
def repeats_after_first(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return windows.repeats_after_first(docs, ["h"], ["doc_id"]).agg(F.count("*").alias("value"))


@query("all_repeats", "SELECT doc_id FROM (SELECT doc_id, COUNT(*) OVER (PARTITION BY text) AS n FROM documents) AS d WHERE n > 1")
def all_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return windows.all_repeats(table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h")), ["h"]).select("doc_id")


@query(
    "allocate_units",
    """SELECT o_orderkey, CAST(f + CASE WHEN n <= 1000 - fs THEN 1 ELSE 0 END AS BIGINT) AS units FROM (SELECT o_orderkey, f, SUM(f) OVER (PARTITION BY o_custkey) AS fs, n FROM
    (SELECT o_orderkey, o_custkey, FLOOR(1000 * (o_orderkey % 7 + 1) / CAST(SUM(o_orderkey % 7 + 1) OVER (PARTITION BY o_custkey) AS DOUBLE)) AS f, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) AS a) AS b""",
)
def allocate_units(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("w", F.col("o_orderkey") % 7 + 1)
    return windows.allocate(orders, ["o_custkey"], ["o_orderkey"], "w", F.lit(1000)).select("o_orderkey", "units")


# ---- quality rules


def rule(name: str, count_sql: str, domain: str | None = None):
    """A rule's query; count_sql gives the number of violations."""
    sql = f"SELECT '{name}' AS check_name, CAST(v AS BIGINT) AS violations FROM ({count_sql}) AS q"
    return query(f"dq_{name}", demo_sql(domain, sql) if domain else sql)


@rule("primary_key", "SELECT COUNT(*) AS v FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) AS g")
def dq_primary_key(spark, sf):
    return quality.primary_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "primary_key")


@rule("unique", "SELECT COUNT(*) AS v FROM (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING COUNT(*) > 1) AS g")
def dq_unique(spark, sf):
    return quality.unique(table(spark, sf, "documents"), ["text"], "unique")


@rule("not_null", "SELECT COUNT(*) - COUNT(account_id) + COUNT(*) - COUNT(title) AS v FROM contacts", "crm")
def dq_not_null(spark, sf):
    return quality.not_null(demo_tables(spark, sf, "crm")["contacts"], ["account_id", "title"], "not_null")


@rule("foreign_key", "SELECT COUNT(*) AS v FROM orders WHERE warehouse_id IS NOT NULL AND warehouse_id NOT IN (SELECT warehouse_id FROM warehouses)", "logistics")
def dq_foreign_key(spark, sf):
    t = demo_tables(spark, sf, "logistics")
    return quality.foreign_key(t["orders"], "warehouse_id", t["warehouses"], "warehouse_id", "foreign_key")


@rule("in_domain", "SELECT COUNT(*) AS v FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def dq_in_domain(spark, sf):
    return quality.in_domain(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], "in_domain")


@query(
    "dq_reference_classes",
    demo_sql("logistics", "SELECT class, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT CASE WHEN orders.warehouse_id IS NULL THEN 'empty' WHEN w.warehouse_id IS NOT NULL THEN 'valid' WHEN orders.warehouse_id = 900000000 + orders.order_id THEN 'declared orphan' ELSE 'unexpected orphan' END AS class FROM orders LEFT JOIN (SELECT DISTINCT warehouse_id FROM warehouses) AS w ON w.warehouse_id = orders.warehouse_id) AS c GROUP BY class"),
)
def dq_reference_classes(spark, sf):
    t = demo_tables(spark, sf, "logistics")
    return quality.reference_classes(t["orders"], "warehouse_id", t["warehouses"], "warehouse_id", F.col("warehouse_id") == 900000000 + F.col("order_id"))


@rule("join_path", "SELECT CASE WHEN EXISTS (SELECT 1 FROM accounts INNER JOIN contacts ON contacts.account_id = accounts.account_id) THEN 0 ELSE 1 END + CASE WHEN EXISTS (SELECT 1 FROM accounts LEFT JOIN contacts ON contacts.account_id = accounts.account_id WHERE contacts.contact_id IS NULL) THEN 0 ELSE 1 END AS v", "crm")
def dq_join_path(spark, sf):
    t = demo_tables(spark, sf, "crm")
    return quality.join_path(t["accounts"].alias("a"), t["contacts"].alias("c"), F.col("a.account_id") == F.col("c.account_id"), "both", "join_path")


@rule("complete_unique_lookup", "SELECT (SELECT COUNT(*) FROM transactions LEFT JOIN fx_rates ON fx_rates.from_currency = source_currency AND rate_date = transaction_date WHERE rate_id IS NULL) + (SELECT COUNT(*) FROM (SELECT from_currency, rate_date FROM fx_rates GROUP BY from_currency, rate_date HAVING COUNT(*) > 1) AS g) AS v", "finance")
def dq_complete_unique_lookup(spark, sf):
    t = demo_tables(spark, sf, "finance")
    used = t["transactions"].select(F.col("source_currency").alias("from_currency"), F.col("transaction_date").alias("rate_date"))
    return quality.complete_unique_lookup(used, t["fx_rates"], ["from_currency", "rate_date"], "complete_unique_lookup")


@rule("many_to_many", "SELECT CASE WHEN EXISTS (SELECT contact_id FROM contact_campaigns GROUP BY contact_id HAVING COUNT(DISTINCT campaign_id) > 1) THEN 0 ELSE 1 END + CASE WHEN EXISTS (SELECT campaign_id FROM contact_campaigns GROUP BY campaign_id HAVING COUNT(DISTINCT contact_id) > 1) THEN 0 ELSE 1 END AS v", "crm")
def dq_many_to_many(spark, sf):
    return quality.many_to_many(demo_tables(spark, sf, "crm")["contact_campaigns"], "contact_id", "campaign_id", "many_to_many")


@rule("row_cap", "SELECT SUM(CASE WHEN n > 1000 THEN 1 ELSE 0 END) AS v FROM (SELECT COUNT(*) AS n FROM orders UNION ALL SELECT COUNT(*) FROM lineitem UNION ALL SELECT COUNT(*) FROM nation) AS c")
def dq_row_cap(spark, sf):
    return quality.row_cap([table(spark, sf, t) for t in ("orders", "lineitem", "nation")], 1000, "row_cap")


@rule("sums_to", "SELECT COUNT(*) AS v FROM (SELECT task_id, SUM(allocation_pct) AS s FROM task_resources GROUP BY task_id) AS g WHERE s <> 100", "project_management")
def dq_sums_to(spark, sf):
    return quality.sums_to(demo_tables(spark, sf, "project_management")["task_resources"], ["task_id"], "allocation_pct", F.lit(100).cast("decimal(5,2)"), "sums_to")


@rule("balanced", "SELECT COUNT(*) AS v FROM transactions INNER JOIN (SELECT transaction_id, COALESCE(SUM(debit_amount), 0) AS d, COALESCE(SUM(credit_amount), 0) AS c FROM ledger_entries GROUP BY transaction_id) AS s ON s.transaction_id = transactions.transaction_id WHERE d <> c OR d <> total_amount", "finance")
def dq_balanced(spark, sf):
    t = demo_tables(spark, sf, "finance")
    return quality.balanced(t["transactions"], t["ledger_entries"], "transaction_id", "total_amount", "debit_amount", "credit_amount", "balanced")


@rule("exclusive", "SELECT COUNT(*) AS v FROM ledger_entries WHERE (debit_amount IS NULL) = (credit_amount IS NULL)", "finance")
def dq_exclusive(spark, sf):
    return quality.exclusive(demo_tables(spark, sf, "finance")["ledger_entries"], "debit_amount", "credit_amount", "exclusive")


@rule("chronology", "SELECT COUNT(*) AS v FROM tasks WHERE completed_date < due_date", "project_management")
def dq_chronology(spark, sf):
    return quality.chronology(demo_tables(spark, sf, "project_management")["tasks"], "due_date", "completed_date", "chronology")


@rule("contained", "SELECT COUNT(*) AS v FROM time_entries INNER JOIN tasks ON tasks.task_id = time_entries.task_id WHERE entry_date < start_date OR entry_date > completed_date", "project_management")
def dq_contained(spark, sf):
    t = demo_tables(spark, sf, "project_management")
    return quality.contained(t["time_entries"], t["tasks"], "task_id", "entry_date", "start_date", "completed_date", "contained")


@rule("no_overlap", "SELECT COUNT(*) AS v FROM (SELECT start_date, MAX(COALESCE(completed_date, DATE '9999-12-31')) OVER (PARTITION BY project_id ORDER BY start_date, completed_date NULLS FIRST, task_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM tasks) AS w WHERE start_date < reached", "project_management")
def dq_no_overlap(spark, sf):
    return quality.no_overlap(demo_tables(spark, sf, "project_management")["tasks"], ["project_id"], "start_date", "completed_date", "no_overlap", ["task_id"])


@rule("sequence", "SELECT COUNT(*) AS v FROM (SELECT l_orderkey, COUNT(*) AS n, COUNT(DISTINCT l_linenumber) AS d, MIN(l_linenumber) AS lo, MAX(l_linenumber) AS hi FROM lineitem GROUP BY l_orderkey) AS g WHERE lo <> 1 OR hi <> n OR d <> n")
def dq_sequence(spark, sf):
    return quality.sequence(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "sequence")


@rule("grid", "SELECT COUNT(*) AS v FROM (SELECT DISTINCT from_currency FROM fx_rates) AS a CROSS JOIN (SELECT DISTINCT rate_date FROM fx_rates) AS b LEFT JOIN (SELECT DISTINCT from_currency, rate_date FROM fx_rates) AS p ON p.from_currency = a.from_currency AND p.rate_date = b.rate_date WHERE p.rate_date IS NULL", "finance")
def dq_grid(spark, sf):
    return quality.grid(demo_tables(spark, sf, "finance")["fx_rates"], "from_currency", "rate_date", "grid")


#: Customers in chains of parents, one in seven chains closed to a cycle.
_TREE = "SELECT c_custkey AS k, CASE WHEN c_custkey % 9 > 0 THEN c_custkey - 1 WHEN c_custkey % 7 = 0 THEN c_custkey + 4 END AS p FROM "


@rule("acyclic", f"SELECT COUNT(DISTINCT k) AS v FROM (WITH RECURSIVE t AS ({_TREE} customer), r AS (SELECT k, p FROM t WHERE p IS NOT NULL UNION SELECT r.k, t.p FROM r INNER JOIN t ON r.p = t.k WHERE t.p IS NOT NULL) SELECT k FROM r WHERE p IN (SELECT k FROM r WHERE k = p)) AS c")
def dq_acyclic(spark, sf):
    return quality.acyclic(spark.sql(_TREE + "{customer}", customer=table(spark, sf, "customer")), "k", "p", "acyclic")


@rule("fixed_scale", "SELECT COUNT(*) AS v FROM orders WHERE NOT regexp_full_match(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '-?[0-9]{1,5}[.][0-9]{2}')")
def dq_fixed_scale(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"))
    return quality.fixed_scale(orders, "amount", 7, 2, "fixed_scale")


@rule("appears_once", "SELECT 3 - COALESCE(SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END), 0) AS v FROM (SELECT n_regionkey, COUNT(*) AS n FROM nation WHERE n_regionkey IN (0, 1, 99) GROUP BY n_regionkey) AS g")
def dq_appears_once(spark, sf):
    return quality.appears_once(table(spark, sf, "nation"), "n_regionkey", [0, 1, 99], "appears_once")


@rule("exact_count", "SELECT ABS(COALESCE(SUM(CASE WHEN rate IS NULL THEN 1 ELSE 0 END), 0) - 10) AS v FROM fx_rates", "finance")
def dq_exact_count(spark, sf):
    return quality.exact_count(demo_tables(spark, sf, "finance")["fx_rates"], F.col("rate").isNull(), 10, "exact_count")


@rule("status_date", "SELECT COUNT(*) AS v FROM milestones WHERE (status IN ('Completed')) <> (actual_date IS NOT NULL)", "project_management")
def dq_status_date(spark, sf):
    return quality.status_date(demo_tables(spark, sf, "project_management")["milestones"], "status", ["Completed"], "actual_date", "status_date")


@query(
    "dq_duplicate_groups",
    "SELECT CAST(COUNT(*) AS BIGINT) AS groups, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, CAST(COALESCE(SUM(CASE WHEN s > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS changed, CAST(COALESCE(SUM(CASE WHEN v = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS exact FROM (SELECT text, COUNT(*) AS n, COUNT(DISTINCT n_chars) AS s, COUNT(DISTINCT source) AS v FROM documents GROUP BY text HAVING COUNT(*) > 1) AS g",
)
def dq_duplicate_groups(spark, sf):
    return quality.duplicate_groups(table(spark, sf, "documents"), ["text"], ["n_chars"], ["source"])


# ---- synthesis and defects

_DRAWN = "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY md5('42:{stream}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rank FROM orders"


_ROOM = {"missing priority": capacity.Wanted(12.5, "o_orderstatus = 'F'"), "outlier": capacity.Wanted(45, "o_totalprice > 300000"), "late date": capacity.Wanted(30, "o_orderstatus = 'F' AND o_totalprice > 200000")}
_WANTS = {n: f"GREATEST(1, CAST(ceil(COUNT(*) * CAST({d.percent} AS DOUBLE) / 100) AS BIGINT))" for n, d in _ROOM.items()}
_SHORT = {s: " + ".join(_WANTS[n] for n in s) + f" - COUNT(*) FILTER (WHERE {' OR '.join(f'({_ROOM[n].eligible})' for n in s)})" for s in subsets(list(_ROOM))}


@query("defect_capacity", "SELECT defect, eligible, wanted, lacking, lacking = 0 AS feasible FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS defect, CAST(COUNT(*) FILTER (WHERE {d.eligible}) AS BIGINT) AS eligible, CAST({_WANTS[n]} AS BIGINT) AS wanted, CAST(GREATEST(0, {', '.join(v for s, v in _SHORT.items() if n in s)}) AS BIGINT) AS lacking FROM orders" for n, d in _ROOM.items()) + ") AS r")
def defect_capacity(spark, sf):
    """Whether three defects find rows of their own among the orders."""
    return capacity.defect_capacity(table(spark, sf, "orders"), _ROOM)


@query("inject_nulls", f"SELECT o_orderkey, CASE WHEN rank > 25 THEN o_custkey END AS o_custkey FROM orders INNER JOIN ({_DRAWN.format(stream='null:o_custkey')}) AS d USING (o_orderkey)")
def inject_nulls(spark, sf):
    return synth.inject_nulls(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 25)


@query("inject_boundaries", f"SELECT o_orderkey, CASE rank WHEN 1 THEN 1900 WHEN 2 THEN 2038 WHEN 3 THEN 2099 ELSE o_custkey END AS o_custkey FROM orders INNER JOIN ({_DRAWN.format(stream='boundary:o_custkey')}) AS d USING (o_orderkey)")
def inject_boundaries(spark, sf):
    return synth.inject_boundaries(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", [1900, 2038, 2099])


@query("orphan_keys", f"SELECT o_orderkey, CASE WHEN rank <= 10 THEN 900000000 + o_orderkey ELSE o_custkey END AS o_custkey FROM orders INNER JOIN ({_DRAWN.format(stream='orphan:o_custkey')}) AS d USING (o_orderkey)")
def orphan_keys(spark, sf):
    return synth.orphan_keys(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 10)


@query("disjoint_groups", f"SELECT o_orderkey, CASE WHEN rank <= 30 THEN 'duplicate' ELSE 'outlier' END AS \"group\" FROM ({_DRAWN.format(stream='groups')}) AS d WHERE rank <= 45")
def disjoint_groups(spark, sf):
    return synth.disjoint_groups(table(spark, sf, "orders"), "o_orderkey", {"duplicate": 30, "outlier": 15}, 42, "groups")


@query("near_duplicates", f"SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT (SELECT MAX(o_orderkey) FROM orders) + rank, o_custkey + 1 FROM orders INNER JOIN ({_DRAWN.format(stream='duplicate')}) AS d USING (o_orderkey) WHERE rank <= 20")
def near_duplicates(spark, sf):
    return synth.near_duplicates(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 20, {"o_custkey": F.col("o_custkey") + 1})


def _uniform_sql(stream: str, key: str = "o_orderkey", more: str = "") -> str:
    return f"(CAST(CAST('0x' || substr(md5('42:{stream}:' || CAST({key} AS VARCHAR){more}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496)"


def _whole_sql(n: int, stream: str, key: str = "o_orderkey", more: str = "") -> str:
    return f"(CAST('0x' || substr(md5('42:{stream}:' || CAST({key} AS VARCHAR){more}), 1, 13) AS BIGINT) % {n})"


@query("inject_outliers", f"SELECT o_orderkey, CASE WHEN rank <= 12 THEN ROUND(9e6 + (9.9e6 - 9e6) * {_uniform_sql('outlier value:o_totalprice')}, 2) ELSE o_totalprice END AS o_totalprice FROM orders INNER JOIN ({_DRAWN.format(stream='outlier:o_totalprice')}) AS d USING (o_orderkey)")
def inject_outliers(spark, sf):
    return synth.inject_outliers(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 12, 9e6, 9.9e6)


def _poisson_sql(u: str, rate: float, most: int = 60) -> str:
    """Values by the sums of the distribution's terms; each is the one before times rate / k."""
    terms = [math.exp(-rate)]
    for k in range(1, most):
        terms.append(terms[-1] * rate / k)
    return "CASE " + " ".join(f"WHEN {u} < {sum(terms[: k + 1])!r} THEN {k}" for k in range(most)) + f" ELSE {most} END"


_MIX = f"""SELECT o_orderkey, {_uniform_sql('amount')} AS m, {_uniform_sql('c')} AS c, {_uniform_sql('a')} AS a, {_uniform_sql('b')} AS b, {_uniform_sql('kind')} AS k, {_uniform_sql('n')} AS u FROM orders"""


@query(
    "synthetic_amounts",
    f"""SELECT o_orderkey, ROUND(least(1e6, 50.0 * pow(1 - m, CAST(-1.0 AS DOUBLE) / 1.6)), 2) AS amount,
    CAST(greatest(0, least(364, round_even(CASE WHEN c < 0.7 THEN 0.3 * 365 ELSE 0.8 * 365 END + CASE WHEN c < 0.7 THEN 0.1 * 365 ELSE 0.05 * 365 END * sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b), 0))) AS INTEGER) AS day,
    CASE WHEN k < 0.5 THEN 'a' WHEN k < 0.8 THEN 'b' ELSE 'c' END AS kind, {_poisson_sql('u', 2.5)} AS n FROM ({_MIX}) AS d""",
)
def synthetic_amounts(spark, sf):
    """Heavy-tailed amounts, mixture dates, weighted choices and Poisson counts, by key."""
    key = F.col("o_orderkey")
    u = lambda stream: synth.uniform(42, stream, key)
    return table(spark, sf, "orders").select("o_orderkey", synth.pareto(u("amount"), 1.6, 50, 1e6).alias("amount"), synth.mixture_offset(u("c"), u("a"), u("b"), 365, [(0.7, 0.3, 0.1), (0.3, 0.8, 0.05)]).alias("day"), synth.choose(u("kind"), {"a": 0.5, "b": 0.3, "c": 0.2}).alias("kind"), synth.poisson(u("n"), 2.5).alias("n"))


_FIRST, _OTHER = (_whole_sql(n, stream, more=" || ':' || CAST(p AS VARCHAR)") for n, stream in ((50, "debit account"), (49, "credit account")))


@query(
    "double_entry",
    f"""SELECT o_orderkey, line_number, CASE WHEN line_number % 2 = 1 THEN f ELSE (f + 1 + g) % 50 END AS account_id, CASE WHEN (line_number % 2 = 1) <> undone THEN part END AS debit_amount, CASE WHEN (line_number % 2 = 1) = undone THEN part END AS credit_amount, CASE WHEN undone THEN 'Reversal' ELSE 'Standard' END AS posting_type
    FROM (SELECT o_orderkey, p * 2 - l AS line_number, undone, {_FIRST} AS f, {_OTHER} AS g, CAST((CASE WHEN p = 1 THEN units - units // 2 ELSE units // 2 END) / CAST(10000 AS DECIMAL(10,0)) AS DECIMAL(19,4)) AS part
    FROM (SELECT o_orderkey, o_orderkey % 50 = 0 AS undone, CAST(CAST(o_totalprice AS DECIMAL(19,4)) * 10000 AS BIGINT) AS units FROM orders INNER JOIN ({_DRAWN.format(stream='unposted')}) AS d USING (o_orderkey) WHERE rank > 75) AS t CROSS JOIN (SELECT UNNEST([1, 2]) AS p) AS p CROSS JOIN (SELECT UNNEST([0, 1]) AS l) AS l) AS e""",
)
def double_entry(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(19,4)").alias("amount"), (F.col("o_orderkey") % 50 == 0).alias("undone"))
    return synth.double_entry(orders, "o_orderkey", "amount", 50, pairs=2, reversal="undone", unposted=75)


@query("unique_pairs", "SELECT CAST(200 AS BIGINT) AS pairs, CAST((SELECT COUNT(*) FROM nation) AS BIGINT) AS nations, CAST((SELECT least(200, COUNT(*)) FROM supplier) AS BIGINT) AS suppliers")
def unique_pairs(spark, sf):
    """How many pairs, and that they cover both sides."""
    pairs = synth.unique_pairs(table(spark, sf, "nation"), table(spark, sf, "supplier"), "n_nationkey", "s_suppkey", 200)
    return pairs.distinct().agg(F.count("*").alias("pairs"), F.count_distinct("n_nationkey").alias("nations"), F.count_distinct("s_suppkey").alias("suppliers"))


@query("preferred_then_rest", f"SELECT rate_id FROM (SELECT rate_id, ROW_NUMBER() OVER (ORDER BY CASE WHEN used THEN 0 ELSE 1 END, md5('42:preferred:' || CAST(rate_id AS VARCHAR)), rate_id) AS rank FROM (SELECT rate_id, EXISTS (SELECT 1 FROM transactions WHERE source_currency = from_currency AND transaction_date = rate_date AND source_system = 'Manual') AS used FROM fx_rates WHERE from_currency <> 'USD') AS u) AS r WHERE rank <= 500".replace("SELECT rate_id FROM", "SELECT rate_id FROM", 1))
def preferred_then_rest(spark, sf):
    """Rates to be lost: those that manual transactions use first, never the reporting currency's."""
    t = demo_tables(spark, sf, "finance")
    used = t["transactions"].where("source_system = 'Manual'").select(F.col("source_currency").alias("c"), F.col("transaction_date").alias("d")).distinct().withColumn("used", F.lit(True))
    rates = t["fx_rates"].join(used, (F.col("from_currency") == F.col("c")) & (F.col("rate_date") == F.col("d")), "left")
    return synth.preferred_then_rest(rates, "rate_id", 500, F.col("used"), protected=F.col("from_currency") == "USD")


ORACLE_SQL["preferred_then_rest"] = demo_sql("finance", ORACLE_SQL["preferred_then_rest"])


@query("rebalance", """SELECT l_orderkey, l_linenumber, CAST(CAST(fl + CASE WHEN n <= 100000 - fs THEN 1 ELSE 0 END AS DECIMAL(18,0)) / CAST(100 AS DECIMAL(18,0)) AS DECIMAL(18,2)) AS amount FROM (SELECT *, SUM(fl) OVER (PARTITION BY l_orderkey) AS fs, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, w) AS n FROM
    (SELECT l_orderkey, l_linenumber, w, CAST(CAST(w AS HUGEINT) * 100000 // CAST(SUM(w) OVER (PARTITION BY l_orderkey) AS HUGEINT) AS BIGINT) AS fl FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS w FROM lineitem) AS a) AS b) AS c WHERE l_orderkey % 7 = 0
    UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem WHERE l_orderkey % 7 <> 0""")
def rebalance(spark, sf):
    """Orders whose total became 1,000 get their lines changed in proportion."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    totals = table(spark, sf, "orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1000).cast("decimal(18,2)").alias("total"))
    return synth.rebalance(lines, ["l_orderkey"], ["l_linenumber", "amount"], "amount", totals, "total")


@query("numbered_runs", "SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS groups, 1 AS least, 0 AS gaps, 0 AS over FROM orders")
def numbered_runs(spark, sf):
    """Quote numbers within runs of one to four, and that none is missing, too high or repeated."""
    placed = synth.number_in_groups(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 1, 4)
    runs = placed.groupBy("o_custkey", "run").agg(F.count("*").alias("n"), F.min("number").alias("lo"), F.max("number").alias("hi"), F.count_distinct("number").alias("d"))
    return runs.agg(F.sum("n").alias("rows"), F.count_distinct("o_custkey").alias("groups"), F.min("lo").alias("least"), F.sum(((F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).cast("int")).cast("int").alias("gaps"), F.sum((F.col("hi") > 4).cast("int")).cast("int").alias("over"))


@query("campaign_moments", f"SELECT p_partkey, CAST(start + CAST(FLOOR({_uniform_sql('moment', 'p_partkey')} * (p_size + 1)) AS INT) AS DATE) AS day FROM (SELECT p_partkey, p_size, DATE '2026-01-01' + CAST(p_size AS INT) AS start FROM part) AS p")
def campaign_moments(spark, sf):
    start = F.date_add(F.lit("2026-01-01").cast("date"), F.col("p_size").cast("int"))
    return table(spark, sf, "part").select("p_partkey", synth.windowed_moment(F.col("p_partkey"), start, F.date_add(start, F.col("p_size").cast("int"))).alias("day"))


@query("date_grid", "SELECT n_nationkey, CAST(d AS DATE) AS day FROM nation CROSS JOIN generate_series(DATE '2026-01-01', DATE '2026-01-31', INTERVAL 1 DAY) AS g(d)")
def date_grid(spark, sf):
    return synth.date_grid(table(spark, sf, "nation").select("n_nationkey"), "2026-01-01", "2026-01-31")


def _typo_sql(text: str) -> str:
    """The last place at which neighbours differ decides."""
    at = f"list_max(list_filter(range(1, CAST(length({text}) AS BIGINT)), lambda i: substr({text}, i, 1) <> substr({text}, i + 1, 1)))"
    return f"CASE WHEN length({text}) = 0 THEN {text} ELSE COALESCE(substr({text}, 1, {at} - 1) || substr({text}, {at} + 1, 1) || substr({text}, {at}, 1) || substr({text}, {at} + 2), {text} || right({text}, 1)) END"


@query("transpose_typo", f"SELECT p_partkey, {_typo_sql('p_name')} AS typo FROM part")
def transpose_typo(spark, sf):
    return table(spark, sf, "part").select("p_partkey", synth.transpose_typo(F.col("p_name")).alias("typo"))


@query("email_typo", f"SELECT c_custkey, {_typo_sql('l')} || '@x.org' AS typo FROM (SELECT c_custkey, replace(lower(c_name), '#', '.') AS l FROM customer) AS c")
def email_typo(spark, sf):
    address = F.concat(F.translate(F.lower("c_name"), "#", "."), F.lit("@x.org"))
    return table(spark, sf, "customer").select("c_custkey", synth.email_typo(address).alias("typo"))


@query(
    "mean_reverting_rates",
    demo_sql("finance", f"""SELECT rate_id, from_currency, rate_date, anchor, shock, rate FROM (WITH RECURSIVE s AS (SELECT rate_id, from_currency, rate_date, rate AS anchor, CAST(ROUND(({_uniform_sql('shock', 'rate_id')} - 0.5) / 100, 6) AS DECIMAL(19,6)) AS shock, ROW_NUMBER() OVER (PARTITION BY from_currency ORDER BY rate_date) AS n FROM fx_rates WHERE rate IS NOT NULL),
    r AS (SELECT *, CAST(anchor + shock AS DECIMAL(19,6)) AS rate FROM s WHERE n = 1 UNION ALL SELECT s.*, CAST(ROUND(r.rate - (r.rate - s.anchor) * CAST(0.05 AS DECIMAL(3,2)) + s.shock, 6) AS DECIMAL(19,6)) FROM r INNER JOIN s ON s.from_currency = r.from_currency AND s.n = r.n + 1) SELECT * FROM r) AS x"""),
)
def mean_reverting_rates(spark, sf):
    """A decimal recurrence over each currency's days."""
    rates = demo_tables(spark, sf, "finance")["fx_rates"].where("rate IS NOT NULL")
    shock = F.round((synth.uniform(42, "shock", F.col("rate_id")) - 0.5) / 100, 6).cast("decimal(19,6)")
    return windows.mean_reverting(rates.select("rate_id", "from_currency", "rate_date", F.col("rate").alias("anchor"), shock.alias("shock")), ["from_currency"], "rate_date", "shock", "anchor")


# ---- answers, scoring, scorecards


@query("answer_lines", "SELECT CAST(n_nationkey AS VARCHAR) || ' | ' || n_name || ' | ' || CAST(n_regionkey AS VARCHAR) AS line FROM nation")
def answer_lines(spark, sf):
    return answers.answer_lines(table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"))


_DIGEST = "md5(COALESCE(CAST(o_custkey AS VARCHAR), '\\N') || '|' || COALESCE(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '\\N') || '|' || COALESCE(CAST(o_orderkey AS VARCHAR), '\\N') || '|' || COALESCE(o_orderpriority, '\\N') || '|' || COALESCE(o_orderstatus, '\\N'))"


@query("table_digest", f"SELECT CAST(COUNT(*) AS BIGINT) AS rows, sha256(COUNT(*) || ':' || SUM(CAST(CAST('0x' || substr(h, 1, 15) AS BIGINT) AS DECIMAL(38,0))) || ':' || SUM(CAST(CAST('0x' || substr(h, 16, 15) AS BIGINT) AS DECIMAL(38,0)))) AS digest FROM (SELECT {_DIGEST} AS h FROM orders) AS d")
def table_digest(spark, sf):
    return answers.table_digest(table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority", "o_orderstatus"))


def _hash_sum(at: int) -> str:
    return f"SUM(CAST(CAST('0x' || substr(h, {at}, 15) AS BIGINT) AS DECIMAL(38,0)))"


def _nodes(level: int) -> str:
    node = f"CAST(floor(o_orderkey / {64 * 8**level}) AS BIGINT)" if level < 4 else "CAST(NULL AS BIGINT)"
    return f"SELECT {level} AS level, {node} AS node, CAST(COUNT(*) AS BIGINT) AS rows, sha256(COUNT(*) || ':' || {_hash_sum(1)} || ':' || {_hash_sum(16)}) AS digest FROM (SELECT o_orderkey, {_DIGEST} AS h FROM orders) AS d GROUP BY 2"


def _digested(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority", "o_orderstatus", "o_totalprice")


@query("digest_tree", " UNION ALL ".join(map(_nodes, range(5))))
def digest_tree(spark, sf):
    """Digests of orders by ranges of 64 keys and all levels above."""
    return freshness.digest_tree(_digested(spark, sf).drop("o_totalprice"), "o_orderkey", 64, 8, 4)


_CHANGED = "SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_totalprice = (SELECT MAX(o_totalprice) FROM {orders}) THEN 'changed' ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM {orders} WHERE o_totalprice > (SELECT MIN(o_totalprice) FROM {orders})"


@query(
    "changed_ranges",
    "SELECT CAST(floor(o_orderkey / 64) AS BIGINT) AS node, CAST(COUNT(*) AS BIGINT) AS built_rows, CAST(COUNT(*) FILTER (WHERE o_totalprice > lo) AS BIGINT) AS rows FROM orders, (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders) AS b GROUP BY 1 HAVING bool_or(o_totalprice IN (lo, hi))",
)
def changed_ranges(spark, sf):
    """Which ranges differ where the dearest order got another priority and the cheapest is gone."""
    orders = _digested(spark, sf)
    now = spark.sql(_CHANGED, orders=orders)
    return freshness.changed_ranges(*(shared.cut(freshness.digest_tree(t, "o_orderkey", 64, 8, 4)) for t in (orders.drop("o_totalprice"), now)), 8, 4)


_GOLDEN = "concat(o_orderstatus, ' | ', CAST(o_custkey AS STRING))"
_ANSWER = "CASE o_orderkey % 4 WHEN 0 THEN concat(o_orderstatus, ' | ', CAST(o_custkey + 1 AS STRING)) WHEN 1 THEN concat(lower(o_orderstatus), ' |  ', CAST(o_custkey AS STRING), ' units') WHEN 2 THEN CAST(o_custkey AS STRING) ELSE concat(o_orderstatus, ' | $', CAST(o_custkey AS STRING), '.00') END"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.expr(_GOLDEN).alias("golden"), F.expr(_ANSWER).alias("answer"))


#: The same texts and rules for the other engine: numbers are read from the texts, rows and cells are compared one by one.
_NUM = r"list_transform(regexp_extract_all(replace(replace({0}, ',', ''), '$', ''), '-?[0-9]+(?:[.][0-9]+)?'), lambda x: CAST(x AS DECIMAL(38,10)))"
_NORM = r"lower(trim(regexp_replace({0}, '\s+', ' ', 'g')))"
_FIRST_NUM = "(CASE WHEN len({g}) = 0 THEN {ng} = {na} ELSE COALESCE({a}[1] = {g}[1], false) END)"
_CELL = "(CASE WHEN len({g}) = 1 AND len({a}) >= 1 THEN {a}[1] = {g}[1] ELSE {ng} = {na} END)"


def _both(form: str, golden: str, answer: str) -> str:
    return form.format(g=_NUM.format(golden), a=_NUM.format(answer), ng=_NORM.format(golden), na=_NORM.format(answer))


_CELLS = "len(string_split(golden, '|')) = len(string_split(answer, '|')) AND " + " AND ".join(_both(_CELL, f"string_split(golden, '|')[{k}]", f"COALESCE(string_split(answer, '|')[{k}], '')") for k in (1, 2))
_TEXTS = f"SELECT o_orderkey, {_GOLDEN.replace('STRING', 'VARCHAR')} AS golden, {_ANSWER.replace('STRING', 'VARCHAR')} AS answer FROM orders"


@query("score_modes", f"SELECT o_orderkey, {_both(_FIRST_NUM, 'golden', 'answer')} AS scalar, {_CELLS} AS tabular, list_contains({_NUM.format('answer')}, {_NUM.format('golden')}[1]) AS ordered FROM ({_TEXTS}) AS t")
def score_modes(spark, sf):
    g, a = F.col("golden"), F.col("answer")
    return _scored(spark, sf).select("o_orderkey", scoring.scalar_exact(g, a).alias("scalar"), scoring.table_exact(g, a).alias("tabular"), scoring.judge_plus_exact(g, a, F.lit(None).cast("boolean")).alias("ordered"))


_PATHS = {
    "customer>orders": ("non_empty_with_unmatched_parent_rows", "customer LEFT JOIN orders ON o_custkey = c_custkey", "customer", "c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)"),
    "customer>orders>lineitem": ("non_empty", "customer INNER JOIN orders ON o_custkey = c_custkey INNER JOIN lineitem ON l_orderkey = o_orderkey", "customer", "c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)"),
    "nation>supplier>lineitem>part": ("non_empty", "nation INNER JOIN supplier ON s_nationkey = n_nationkey INNER JOIN lineitem ON l_suppkey = s_suppkey INNER JOIN part ON p_partkey = l_partkey", "nation", "n_nationkey NOT IN (SELECT s_nationkey FROM supplier)"),
    "region>nation>customer>orders>lineitem": ("non_empty", "region INNER JOIN nation ON n_regionkey = r_regionkey INNER JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey", "region", "r_regionkey NOT IN (SELECT n_regionkey FROM nation)"),
}
_PATH_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS path, CAST((SELECT COUNT(*) FROM {joins}) AS BIGINT) AS joined_rows, CAST((SELECT COUNT(*) FROM {first} WHERE {free}) AS BIGINT) AS unmatched_rows" for n, (_, joins, first, free) in _PATHS.items())


def _path_counts(spark, sf):
    t = lambda name: table(spark, sf, name)
    hop = lambda name, left, right, keep=False: paths.Hop(t(name), (left,), (right,), keep)
    lines = hop("lineitem", "o_orderkey", "l_orderkey")
    found = {
        "customer>orders": (t("customer"), [hop("orders", "c_custkey", "o_custkey", True)]),
        "customer>orders>lineitem": (t("customer"), [hop("orders", "c_custkey", "o_custkey"), lines]),
        "nation>supplier>lineitem>part": (t("nation"), [hop("supplier", "n_nationkey", "s_nationkey"), hop("lineitem", "s_suppkey", "l_suppkey"), hop("part", "l_partkey", "p_partkey")]),
        "region>nation>customer>orders>lineitem": (t("region"), [hop("nation", "r_regionkey", "n_regionkey"), hop("customer", "n_nationkey", "c_nationkey"), hop("orders", "c_custkey", "o_custkey", True), paths.Hop(lines.df, lines.left, lines.right, True)]),
    }
    return {name: paths.path_counts(first, hops, name) for name, (first, hops) in found.items()}


@query("join_path_counts", _PATH_COUNTS)
def join_path_counts(spark, sf):
    return reduce(DataFrame.unionAll, _path_counts(spark, sf).values())


@query(
    "join_path_rules",
    f"SELECT path || '.joined_rows' AS check_name, CASE WHEN joined_rows = 0 THEN CAST(1 AS BIGINT) ELSE 0 END AS violations, joined_rows > 0 AS passed FROM ({_PATH_COUNTS}) AS p UNION ALL SELECT path || '.unmatched_parent_rows', CASE WHEN unmatched_rows = 0 THEN CAST(1 AS BIGINT) ELSE 0 END, unmatched_rows > 0 FROM ({_PATH_COUNTS}) AS q WHERE path = 'customer>orders'",
)
def join_path_rules(spark, sf):
    return quality.gate(paths.path_rules(counts, _PATHS[name][0]) for name, counts in _path_counts(spark, sf).items())


_AUDITED = ("o_custkey", "o_orderstatus", "o_orderpriority", "day")
_COPIES = f"SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders UNION ALL SELECT o_custkey + 1, o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders INNER JOIN ({_DRAWN.format(stream='duplicate')}) AS d USING (o_orderkey) WHERE rank <= 20"


def _audit_sql(column: str) -> str:
    others = ", ".join(c for c in _AUDITED if c != column)
    return f"SELECT '{column}' AS \"column\", CAST(COUNT(*) AS BIGINT) AS groups, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows, {str(column == 'o_custkey').lower()} AS permitted FROM (SELECT COUNT(*) AS n FROM c GROUP BY {others} HAVING COUNT(DISTINCT {column}) + MAX(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) > 1) AS g"


@query("near_duplicate_audit", f"WITH c AS ({_COPIES}) {' UNION ALL '.join(map(_audit_sql, _AUDITED))}")
def near_duplicate_audit(spark, sf):
    """Orders and twenty copies with another customer: which columns differ alone."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("day"))
    copied = synth.near_duplicates(rows, "o_orderkey", 20, {"o_custkey": F.col("o_custkey") + 1})
    return paths.near_duplicate_audit(copied, _AUDITED, ["o_custkey"])


#: A status and a number; a label that is there stands near enough in these answers, whatever number is beside it.
_HELD = f"SELECT o_orderkey, {_NUM.format('answer')} AS found, {_NUM.format('golden')}[1] AS wanted, contains(lower(answer), lower(string_split(golden, ' | ')[1])) AS named FROM ({_TEXTS}) AS t"


@query("score_owned_labels", f"SELECT o_orderkey, CASE WHEN list_contains(found, wanted) AND named THEN 'pass' ELSE 'fail' END AS result, CAST(CASE WHEN list_contains(found, wanted) THEN 1 ELSE 0 END + CASE WHEN named THEN 1 ELSE 0 END AS INTEGER) AS satisfied FROM ({_HELD}) AS h")
def score_owned_labels(spark, sf):
    return ownership.match_owned(_scored(spark, sf), "golden", "answer").select("o_orderkey", F.col("match.result").alias("result"), F.size("match.satisfied").alias("satisfied"))


#: Two nations' records (names without digits) and an answer that names both, rightly, crosswise, in the other order, or one of them only.
_PAIRED = """SELECT a.n_nationkey AS k, concat(a.n_name, ' | ', CAST(a.n_nationkey * 7 + 100 AS {0}), '; ', b.n_name, ' | ', CAST(b.n_nationkey * 7 + 100 AS {0})) AS golden,
CASE a.n_nationkey % 4 WHEN 0 THEN concat(a.n_name, ' has ', CAST(a.n_nationkey * 7 + 100 AS {0}), ' and ', b.n_name, ' has ', CAST(b.n_nationkey * 7 + 100 AS {0})) WHEN 1 THEN concat(a.n_name, ' has ', CAST(b.n_nationkey * 7 + 100 AS {0}), ' and ', b.n_name, ' has ', CAST(a.n_nationkey * 7 + 100 AS {0}))
WHEN 2 THEN concat(b.n_name, ': ', CAST(b.n_nationkey * 7 + 100 AS {0}), '.00, ', a.n_name, ': $', CAST(a.n_nationkey * 7 + 100 AS {0})) ELSE concat(lower(b.n_name), ' ', CAST(b.n_nationkey * 7 + 100 AS {0})) END AS answer FROM (SELECT n_nationkey, translate(n_name, '0123456789_', 'abcdefghij ') AS n_name FROM nation) AS a INNER JOIN (SELECT n_nationkey, translate(n_name, '0123456789_', 'abcdefghij ') AS n_name FROM nation) AS b ON b.n_nationkey = (a.n_nationkey + 1) % 25"""
#: Distances in the answers' own texts: of each number that is there to the end of each name before it, and twice that to a name after it.
_DISTANCE = "CASE WHEN {name} = 0 OR {value} = 0 THEN NULL WHEN {name} + length({label}) <= {value} THEN {value} - {name} - length({label}) ELSE 2 * ({name} - {value}) END"
_OWNERS = f"""WITH p AS ({_PAIRED.format('VARCHAR')}), t AS (SELECT k, string_split(golden, '; ') AS r, lower(answer) AS answer FROM p),
f AS (SELECT k, answer, string_split(r[1], ' | ')[1] AS la, string_split(r[1], ' | ')[2] AS va, string_split(r[2], ' | ')[1] AS lb, string_split(r[2], ' | ')[2] AS vb FROM t),
i AS (SELECT *, instr(answer, lower(la)) AS na, instr(answer, lower(lb)) AS nb, instr(answer, va) AS pa, instr(answer, vb) AS pb FROM f),
d AS (SELECT *, {_DISTANCE.format(name='na', value='pa', label='la')} AS aa, {_DISTANCE.format(name='nb', value='pa', label='lb')} AS ba, {_DISTANCE.format(name='na', value='pb', label='la')} AS ab, {_DISTANCE.format(name='nb', value='pb', label='lb')} AS bb FROM i),
m AS (SELECT k, pa > 0 AS a_value, pb > 0 AS b_value, na > 0 AND (pa = 0 OR (aa <= 120 AND aa <= coalesce(ba, aa))) AS a_label, nb > 0 AND (pb = 0 OR (bb <= 120 AND bb <= coalesce(ab, bb))) AS b_label FROM d)
SELECT k, CASE WHEN a_value AND b_value AND a_label AND b_label THEN 'pass' ELSE 'fail' END AS result, CAST(a_value AS INTEGER) + CAST(b_value AS INTEGER) + CAST(a_label AS INTEGER) + CAST(b_label AS INTEGER) AS satisfied FROM m"""


@query("score_label_owners", _OWNERS)
def score_label_owners(spark, sf):
    """Values that are all there, by the wrong labels."""
    pairs = spark.sql(_PAIRED.format("STRING").replace("FROM nation)", "FROM {nation})"), nation=table(spark, sf, "nation"))
    return ownership.match_owned(pairs, "golden", "answer").select("k", F.col("match.result").alias("result"), F.size("match.satisfied").alias("satisfied"))


_ASKED = "CASE k WHEN 3 THEN 'T1' ELSE 't3 ' END AS tier, CASE k WHEN 0 THEN 'SELECT 1 FROM a LEFT JOIN b ON a.x = b.x' WHEN 1 THEN 'SELECT 1 FROM a JOIN b ON a.x = b.x' WHEN 3 THEN 'SELECT 1' WHEN 4 THEN 'select 1 from a where not  exists (select 1 from b)' WHEN 5 THEN 'select count(*) from a' END AS sql"


@query(
    "null_handling",
    rf"""SELECT o_orderkey, CASE WHEN upper(trim(tier)) <> 'T3' THEN 'not_applicable' WHEN COALESCE(trim(sql), '') = '' THEN 'unknown'
    WHEN regexp_matches(sql, '(?i)\b(left|right|full)\s+(outer\s+)?join\b|\bnot\s+exists\b|\bnot\s+in\s*\(|\bis\s+null\b|\bexcept\b|\bcoalesce\s*\(') THEN 'pass' WHEN regexp_matches(sql, '(?i)\bjoin\b') THEN 'fail' ELSE 'unknown' END AS status FROM (SELECT o_orderkey, {_ASKED} FROM (SELECT o_orderkey, o_orderkey % 6 AS k FROM orders) AS o) AS t""",
)
def null_handling(spark, sf):
    asked = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("k")).selectExpr("o_orderkey", *_ASKED.split(" AS tier, ")[0:1]).toDF("o_orderkey", "tier")
    sql = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("k")).selectExpr("o_orderkey", _ASKED.split(" AS tier, ")[1])
    both = asked.join(sql, "o_orderkey")
    return both.select("o_orderkey", scoring.null_handling(F.col("tier"), F.lit("SELECT 1 FROM a"), F.col("sql")).alias("status"))


@query(
    "rephrase_agreement",
    "SELECT o_custkey AS rephrase_group_id, CAST(COUNT(*) AS BIGINT) AS members, CASE WHEN COUNT(DISTINCT o_orderstatus) > 1 THEN 'dataset' WHEN COUNT(DISTINCT o_orderpriority) > 1 THEN 'platform' ELSE 'agree' END AS finding FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING COUNT(*) >= 2",
)
def rephrase_agreement(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("rephrase_group_id"), F.col("o_orderstatus").alias("expected"), F.array("o_orderpriority").alias("satisfied"))
    return scoring.rephrase_agreement(rows)


#: Outcomes of questions made from orders: every result, with judged, failed and unjudged rows.
_RUN = """SELECT o_orderkey AS question_id, CASE o_custkey % 3 WHEN 0 THEN 'crm' WHEN 1 THEN 'sales' ELSE 'finance' END AS domain, CASE o_orderkey % 2 WHEN 0 THEN 'T1' ELSE 'T3' END AS tier,
CASE WHEN o_orderkey % 23 = 0 THEN 'error' WHEN o_orderkey % 19 = 0 THEN 'clarification' WHEN o_orderkey % 17 = 0 THEN 'not_applicable' WHEN (o_orderkey + o_custkey) % 5 = 0 THEN 'fail' ELSE 'pass' END AS result,
o_orderkey % 11 = 0 AS off_contract, CASE WHEN o_orderkey % 2 = 0 THEN 'not_applicable' WHEN o_custkey % 4 = 0 THEN 'fail' ELSE 'pass' END AS null_handling,
CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 29 <> 0 THEN CAST(1 + o_orderkey % 5 AS INT) END AS factual, CAST(1 + o_custkey % 5 AS INT) AS completeness, CAST(1 + (o_orderkey + o_custkey) % 5 AS INT) AS format, CAST(1 + (o_orderkey * 3) % 5 AS INT) AS sql_quality,
o_orderkey % 29 = 0 AS judge_failed FROM """


def _run(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_RUN + "{orders}", orders=table(spark, sf, "orders"))


_MEAN = "CAST(ROUND(AVG(CASE WHEN result <> 'error' AND factual IS NOT NULL THEN CAST({0} AS DOUBLE) END), 4) AS DOUBLE) AS judge_{0}"
_CARD = f"""SELECT domain, CASE WHEN GROUPING(tier) = 1 THEN 'ALL' ELSE tier END AS tier, CAST(COUNT(*) AS BIGINT) AS questions_total, CAST(SUM(CASE WHEN result = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS exact_match_pass,
CAST(SUM(CASE WHEN result IN ('pass', 'fail') THEN 1 ELSE 0 END) AS BIGINT) AS exact_match_eligible, ROUND(CAST(SUM(CASE WHEN result = 'pass' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / NULLIF(SUM(CASE WHEN result IN ('pass', 'fail') THEN 1 ELSE 0 END), 0), 4) AS exact_match_pct,
CAST(SUM(CASE WHEN result = 'not_applicable' THEN 1 ELSE 0 END) AS BIGINT) AS exact_match_not_applicable, CAST(SUM(CASE WHEN result = 'clarification' THEN 1 ELSE 0 END) AS BIGINT) AS exact_match_clarification,
CAST(SUM(CASE WHEN off_contract THEN 1 ELSE 0 END) AS BIGINT) AS expected_answer_off_contract, CAST(SUM(CASE WHEN null_handling <> 'not_applicable' THEN 1 ELSE 0 END) AS BIGINT) AS null_handling_applicable, CAST(SUM(CASE WHEN null_handling = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS null_handling_fail,
{", ".join(_MEAN.format(d) for d in scorecard.DIMENSIONS)}, CAST(ROUND(AVG(CASE WHEN result = 'error' THEN NULL WHEN factual IS NOT NULL THEN (factual + completeness + format + sql_quality) / CAST(4 AS DOUBLE) WHEN result = 'clarification' THEN 2.5 END), 4) AS DOUBLE) AS judge_overall,
CAST(SUM(CASE WHEN result <> 'error' AND judge_failed THEN 1 ELSE 0 END) AS BIGINT) AS judge_errors, CAST(SUM(CASE WHEN result = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS platform_errors FROM ({_RUN} orders) AS r GROUP BY GROUPING SETS ((domain), (domain, tier))"""


@query("scorecard", _CARD)
def scorecard_rollup(spark, sf):
    return scorecard.roll_up(_run(spark, sf))


@query("regressions", f"SELECT domain, tier, exact_match_pct, CAST(CASE domain WHEN 'crm' THEN 99.0 WHEN 'sales' THEN 80.5 END AS DOUBLE) AS baseline_exact_match_pct, ROUND(exact_match_pct - CAST(CASE domain WHEN 'crm' THEN 99.0 WHEN 'sales' THEN 80.5 END AS DOUBLE), 4) AS delta_pct, COALESCE(ROUND(exact_match_pct - CAST(CASE domain WHEN 'crm' THEN 99.0 WHEN 'sales' THEN 80.5 END AS DOUBLE), 4) <= -5, false) AS regression_flag FROM ({_CARD}) AS c")
def regressions(spark, sf):
    base = spark.createDataFrame([("crm", 99.0), ("sales", 80.5)], "domain string, pct double")
    return scorecard.regressions(scorecard.roll_up(_run(spark, sf)).select("domain", "tier", "exact_match_pct"), base)


@query("gate_checklist", f"SELECT domain, exact_match_pct, COALESCE(exact_match_pct >= 95, false) AS passed FROM ({_CARD}) AS c WHERE tier = 'ALL'")
def gate_checklist(spark, sf):
    return scorecard.gate_checklist(scorecard.roll_up(_run(spark, sf)))


_LATER = "CASE WHEN question_id % 6 = 0 THEN 'pass' WHEN question_id % 7 = 0 THEN 'fail' ELSE result END"


@query(
    "compare_runs",
    f"SELECT question_id, b.result AS before, a.result AS after, CASE WHEN b.result IS NULL THEN 'added' WHEN a.result IS NULL THEN 'removed' WHEN b.result <> 'pass' AND a.result = 'pass' THEN 'cleared' WHEN b.result = 'pass' AND a.result <> 'pass' THEN 'regressed' WHEN a.result = 'pass' THEN 'still passing' ELSE 'still failing' END AS change FROM (SELECT * FROM ({_RUN} orders) AS x WHERE question_id % 10 <> 0) AS b FULL JOIN (SELECT question_id, {_LATER} AS result FROM ({_RUN} orders) AS y WHERE question_id % 10 <> 1) AS a USING (question_id)",
)
def compare_runs(spark, sf):
    run = _run(spark, sf)
    return scorecard.compare_runs(run.where("question_id % 10 <> 0"), run.where("question_id % 10 <> 1").withColumn("result", F.expr(_LATER)))


@query("merge_runs", f"SELECT question_id, CASE WHEN question_id % 3 = 0 THEN {_LATER} ELSE result END AS result FROM ({_RUN} orders) AS r")
def merge_runs(spark, sf):
    run = _run(spark, sf).select("question_id", "result")
    return scorecard.merge_runs(run, run.where("question_id % 3 = 0").withColumn("result", F.expr(_LATER)))


@query("tier_quota", f"SELECT q.domain, q.tier, q.quota, CAST(COUNT(r.question_id) AS BIGINT) AS n, CASE WHEN COUNT(r.question_id) < q.quota THEN 'SHORT' WHEN COUNT(r.question_id) > q.quota THEN 'over' ELSE 'ok' END AS verdict FROM (SELECT 'crm' AS domain, 'T1' AS tier, 100000000 AS quota UNION ALL SELECT 'sales', 'T3', 1 UNION ALL SELECT 'logistics', 'T2', 0) AS q LEFT JOIN ({_RUN} orders) AS r ON r.domain = q.domain AND r.tier = q.tier GROUP BY q.domain, q.tier, q.quota")
def tier_quota(spark, sf):
    return scorecard.tier_quota(_run(spark, sf), spark.createDataFrame([("crm", "T1", 100000000), ("sales", "T3", 1), ("logistics", "T2", 0)], "domain string, tier string, quota int"))


@query("failure_histogram", f"SELECT CASE question_id % 3 WHEN 0 THEN 'value ''..'' not present' WHEN 1 THEN 'label ''..'' present but # chars away' ELSE 'row count # != expected #' END AS kind, CAST(COUNT(*) AS BIGINT) AS n FROM ({_RUN} orders) AS r WHERE result = 'fail' GROUP BY 1 ORDER BY n DESC, kind LIMIT 6")
def failure_histogram(spark, sf):
    k = F.col("question_id")
    detail = F.when(k % 3 == 0, F.concat(F.lit("value '"), k, F.lit("' not present; more"))).when(k % 3 == 1, F.concat(F.lit("label 'x' present but "), k, F.lit(" chars away"))).otherwise(F.concat(F.lit("row count "), k, F.lit(" != expected 3.5")))
    return scorecard.failure_histogram(_run(spark, sf).withColumn("detail", detail))


_ANCHORS = "SELECT doc_id AS anchor_id, CAST(CASE quality WHEN 1 THEN 5 ELSE 1 END AS INT) AS human, CAST(CASE WHEN quality = 1 THEN 5 - doc_id % 2 ELSE 1 + doc_id % 2 END AS INT) AS judge FROM "


@query(
    "calibration",
    f"SELECT anchors, within_one, flips, constant_ok, anchors >= 10 AND within_one >= 0.9 AND flips = 0 AND NOT constant_ok AS passed FROM (SELECT CAST(COUNT(DISTINCT anchor_id) AS BIGINT) AS anchors, ROUND(AVG(CASE WHEN ABS(human - judge) <= 1 THEN 1.0 ELSE 0.0 END), 4) AS within_one, CAST(SUM(CASE WHEN (human = 5 AND judge <= 2) OR (judge = 5 AND human <= 2) THEN 1 ELSE 0 END) AS BIGINT) AS flips FROM ({_ANCHORS} labels) AS a) AS o CROSS JOIN (SELECT COALESCE(bool_or(w >= 0.9 AND f = 0), false) AS constant_ok FROM (SELECT c, AVG(CASE WHEN ABS(human - c) <= 1 THEN 1.0 ELSE 0.0 END) AS w, SUM(CASE WHEN (human = 5 AND c <= 2) OR (c = 5 AND human <= 2) THEN 1 ELSE 0 END) AS f FROM ({_ANCHORS} labels) AS a CROSS JOIN (SELECT UNNEST([1, 2, 3, 4, 5]) AS c) AS k GROUP BY c) AS g) AS l",
)
def calibration(spark, sf):
    return scorecard.calibration(spark.sql(_ANCHORS + "{labels}", labels=table(spark, sf, "labels")))


@query("latest_runs", "SELECT domain, run_id, pass FROM (SELECT domain, run_id, pass, ROW_NUMBER() OVER (PARTITION BY domain ORDER BY run_id DESC) AS n FROM (SELECT o_orderpriority AS domain, o_orderkey AS run_id, o_custkey AS pass FROM orders) AS r) AS x WHERE n = 1")
def latest_runs(spark, sf):
    return scorecard.latest_runs(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("domain"), F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("pass")))


_BLOCKERS = {"not a release run": "n_nationkey % 4 = 0", "judge not calibrated": "n_nationkey % 2 <> 0", "comparison policy relaxed": "n_nationkey % 3 = 0", "temperature not enforced": "n_nationkey % 5 = 0", "platform errors": "n_nationkey % 7 > 0"}


@query("release_blockers", " UNION ALL ".join(f"SELECT n_name AS domain, n_nationkey AS run_id, '{name}' AS blocker FROM nation WHERE {when}" for name, when in _BLOCKERS.items()))
def release_blockers(spark, sf):
    k = F.col("n_nationkey")
    flags = {"calibrated": k % 2 == 0, "default_policy": k % 3 != 0, "temperature_enforced": k % 5 != 0, "seed_enforced": F.lit(True)}
    runs = table(spark, sf, "nation").select(F.col("n_name").alias("domain"), k.alias("run_id"), F.when(k % 4 == 0, "PREVIEW").otherwise("RELEASE").alias("mode"), *(c.alias(n) for n, c in flags.items()), (k % 7).alias("platform_errors"), F.lit(0).alias("judge_errors"), F.lit("d1").alias("dataset_version"), F.lit("p1").alias("platform_version"))
    return scorecard.release_blockers(runs)


_SUMMARY = "SELECT '{c}' AS \"column\", COUNT({c}) AS known, COUNT(*) - COUNT({c}) AS missing, CAST(MIN({c}) AS DOUBLE) AS least, CAST(MAX({c}) AS DOUBLE) AS most, CAST(ROUND(AVG({c}), 2) AS DOUBLE) AS mean, COUNT(DISTINCT {c}) AS \"distinct\" FROM support_points"


@query("column_summaries", "WITH support_points AS (SELECT CASE WHEN o_orderkey % 9 > 0 THEN o_custkey END AS custkey, o_orderkey % 100 AS points FROM orders) " + " UNION ALL ".join(_SUMMARY.format(c=c) for c in ("custkey", "points")))
def column_summaries(spark, sf):
    points = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 9 > 0, F.col("o_custkey")).alias("custkey"), (F.col("o_orderkey") % 100).alias("points"))
    return summary.summarise(points, ["custkey", "points"])


_PHRASES = {"_note": "not a token", "1-URGENT": "urgent", "5-LOW": "of low priority"}


@query("names_and_labels", r"SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'of low priority' ELSE o_orderpriority END AS label, trim(regexp_replace(lower(o_orderpriority || ' / ' || o_orderstatus), '[^a-z0-9]+', '.', 'g'), '.') AS slug, 'ORD-' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 5 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 5, '0') END AS code, lower(regexp_replace('SELECT  SUM( x )' || chr(10) || 'FROM ' || o_orderstatus, '[\s()]', '', 'g')) AS compact FROM orders")
def names_and_labels(spark, sf):
    text = F.concat(F.lit("SELECT  SUM( x )\nFROM "), "o_orderstatus")
    return table(spark, sf, "orders").select("o_orderkey", texts.label(F.col("o_orderpriority"), _PHRASES).alias("label"), texts.slug(F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")).alias("slug"), texts.padded("ORD-", F.col("o_orderkey")).alias("code"), texts.compact_sql(text).alias("compact"))


@query("rephrase_integrity", "SELECT o_custkey AS rephrase_group_id, COUNT(*) AS members, CAST(SUM(CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS bases, COUNT(DISTINCT o_orderstatus) AS hashes, SUM(CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END) = 1 AND COUNT(DISTINCT o_orderstatus) = 1 AS sound FROM orders GROUP BY o_custkey")
def rephrase_integrity(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("rephrase_group_id"), F.col("o_orderstatus").alias("result_hash"), (F.col("o_orderkey") % 4 == 1).alias("is_base"))
    return runs.rephrase_integrity(rows)


_SQLS = "CASE question_id % 4 WHEN 0 THEN 'select sum(x), count(*) from contacts' WHEN 1 THEN 'SELECT AVG (x) FROM a' ELSE 'select x from contacts join b' END"
_GIVEN = "CASE question_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'select count(*), sum(y) from contacts' WHEN 2 THEN 'select avg(x) from a' WHEN 3 THEN 'select x from b' END"
_LACKS = " OR ".join(f"(regexp_matches(reference_sql, '(?i)\\b{f}\\s*\\(') AND NOT regexp_matches(answer_sql, '(?i)\\b{f}\\s*\\('))" for f in ("sum", "count", "avg", "min", "max"))


@query("rerun_selection", f"SELECT question_id, reference_sql FROM (SELECT question_id, result, {_SQLS} AS reference_sql, {_GIVEN} AS answer_sql FROM ({_RUN} orders) AS r) AS p WHERE result <> 'pass' AND NOT (COALESCE(trim(answer_sql), '') <> '' AND ({_LACKS} OR (regexp_matches(reference_sql, '(?i)\\bcontacts\\b') AND NOT regexp_matches(answer_sql, '(?i)\\bcontacts\\b'))))")
def rerun_selection(spark, sf):
    rows = _run(spark, sf).select("question_id", "result", F.expr(_GIVEN).alias("answer_sql"))
    pairs = _run(spark, sf).select("question_id", F.expr(_SQLS).alias("reference_sql"))
    return scorecard.rerun_selection(rows, pairs, runs.ambiguous(F.col("reference_sql"), F.col("answer_sql")))


_REGIONS, _PRIORITIES = ("Central", "North", "West"), ("Critical", "Medium")


@query(
    "family_build",
    demo_sql("crm", " UNION ALL ".join([*(f"SELECT 'QA-crm:T1-06-{i:02d}' AS question_id, 'region={r}' AS param_values, CAST(COUNT(*) AS VARCHAR) AS expected_answer, sha256(CAST(COUNT(*) AS VARCHAR)) AS result_hash FROM accounts WHERE region = '{r}'" for i, r in enumerate(_REGIONS, 3)), *(f"SELECT 'QA-crm:T1-03-{i:02d}', 'priority={p}', CAST(COUNT(*) AS VARCHAR), sha256(CAST(COUNT(*) AS VARCHAR)) FROM support_cases WHERE priority = '{p}'" for i, p in enumerate(_PRIORITIES, 1))])),
)
def family_build(spark, sf):
    """Two families of the driver: three of five regions, and two of four priorities, at even ranks."""
    t = demo_tables(spark, sf, "crm")
    values = driver.catalog(t, {"_note": "-", "region": "accounts.region", "priority": "support_cases.priority"})
    made = driver.build(t, [FAMILIES["crm:T1-03"], FAMILIES["crm:T1-06"]], {"crm:T1-03": 2, "crm:T1-06": 3}, {"T1": 5}, values)
    return spark.createDataFrame([(x.question_id, x.param_values, x.expected_answer, x.result_hash) for x in made], "question_id string, param_values string, expected_answer string, result_hash string")


# ---- sources: files are written first, into the shared folder, and read back


def _written(spark: SparkSession, df: DataFrame, name: str, form: str = "csv") -> str:
    path = shared.shared_folder(spark, name)
    writer = df.write.option("header", True).option("escape", '"').option("emptyValue", "") if form == "csv" else df.write
    getattr(writer, form)(path)
    return path


_PARTS = """SELECT p_partkey AS part_id, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_size END AS size, concat(p_name, ', "', p_brand, '"') AS name, CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price, DATE '2026-01-01' AS made FROM """
_PARTS_DDL = "CREATE TABLE parts (part_id INTEGER PRIMARY KEY, size INTEGER, name VARCHAR(200), price DECIMAL(12,2), made DATE);"


def _parts(spark: SparkSession, sf: str) -> str:
    return _written(spark, spark.sql(_PARTS + "{part}", part=table(spark, sf, "part")), "parts")


@query("csv_typed_scan", f"SELECT CAST(part_id AS INTEGER) AS part_id, CAST(size AS INTEGER) AS size, name, CAST(price AS DOUBLE) AS price, made FROM ({_PARTS} part) AS p")
def csv_typed_scan(spark, sf):
    schema = parse_ddl(_PARTS_DDL)["parts"].schema
    return files.read_typed(spark, _parts(spark, sf), schema).withColumn("price", F.col("price").cast("double"))


@query("csv_text_scan", f"SELECT CAST(part_id AS VARCHAR) AS part_id, COALESCE(CAST(size AS VARCHAR), '') AS size, name, COALESCE(CAST(price AS VARCHAR), '') AS price, '2026-01-01' AS made FROM ({_PARTS} part) AS p")
def csv_text_scan(spark, sf):
    return files.read_text(spark, _parts(spark, sf))


@query("csv_inferred_scan", f"SELECT part_id, CAST(size AS BIGINT) AS size, name, CAST(price AS DOUBLE) AS price, '2026-01-01' AS made FROM ({_PARTS} part) AS p")
def csv_inferred_scan(spark, sf):
    return files.read_inferred(spark, _parts(spark, sf))


@query("csv_bad_rows", f"SELECT 'sizes are dates' AS check_name, CAST(COUNT(size) AS BIGINT) AS violations FROM ({_PARTS} part) AS p")
def csv_bad_rows(spark, sf):
    schema = parse_ddl(_PARTS_DDL.replace("size INTEGER", "size DATE"))["parts"].schema
    return files.bad_rows(spark, _parts(spark, sf), schema, "sizes are dates")


@query("csv_row_count", "SELECT CAST(COUNT(*) AS BIGINT) AS value FROM part")
def csv_row_count(spark, sf):
    lines = table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit("\n"), "p_brand").alias("two_lines"))
    return spark.range(1).select(F.lit(files.csv_rows(spark, _written(spark, lines, "rows"))).cast("long").alias("value"))


@query("pair_scan", "SELECT CAST(o_orderkey AS VARCHAR) AS question_id, CASE WHEN o_orderkey % 2 = 0 THEN 'T2' ELSE 'T9' END AS tier, 'strict' AS mode FROM orders")
def pair_scan(spark, sf):
    pairs = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("question_id"), F.when(F.col("o_orderkey") % 2 == 0, "T2").otherwise("").alias("tier"))
    return files.read_pairs(spark, _written(spark, pairs, "pairs"), {"tier": "T9", "mode": "strict"}).select("question_id", "tier", "mode")


@query("run_scan", "SELECT o_custkey AS run_id, o_orderkey AS question_id, o_orderstatus AS result FROM orders")
def run_scan(spark, sf):
    run = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("question_id"), F.col("o_orderstatus").alias("result"))).alias("rows"))
    # the reader takes a document a file, or an array of documents
    path = _written(spark, run, "runs", "json")
    return files.read_runs(spark, path, lines=True).select("run_id", "row.question_id", "row.result")


@query("bounded_batches", "SELECT CAST(COUNT(*) AS BIGINT) AS rows, 0 AS over_rows, 0 AS over_bytes, CAST(COUNT(*) AS BIGINT) AS lines FROM orders")
def bounded_batches(spark, sf):
    """That batches keep both bounds and hold every row once."""
    made = files.batches(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 50, 1_500)
    return made.agg(F.sum("n").alias("rows"), F.sum((F.col("n") > 50).cast("int")).cast("int").alias("over_rows"), F.sum(((F.col("bytes") > 1_500) & (F.col("n") > 1)).cast("int")).cast("int").alias("over_bytes"), F.sum(F.size(F.split("lines", "\n"))).alias("lines"))


_ORDER_LINE = """'{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}'"""


@query(
    "ordered_batches",
    f"""WITH RECURSIVE w AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, CAST(strlen({_ORDER_LINE}) + 2 AS BIGINT) AS c FROM orders),
    p AS MATERIALIZED (SELECT r, c, CAST(SUM(c) OVER (ORDER BY r) AS BIGINT) AS p, COUNT(*) OVER () AS every FROM w),
    fits AS MATERIALIZED (SELECT a.r, a.every, GREATEST(LEAST(COALESCE(b.r, 0) - a.r + 1, 60), 1) AS n FROM p AS a ASOF LEFT JOIN (SELECT r, p FROM p) AS b ON a.p - a.c + 5200 >= b.p),
    first_rows AS (SELECT CAST(1 AS BIGINT) AS r, CAST(0 AS BIGINT) AS batch UNION ALL SELECT s.r + f.n, s.batch + 1 FROM first_rows AS s INNER JOIN fits AS f ON f.r = s.r WHERE s.r + f.n <= f.every)
    SELECT batch, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(c) AS BIGINT) AS bytes, arg_min(o_orderkey, r) AS first_key, arg_max(o_orderkey, r) AS last_key
    FROM (SELECT w.*, s.batch FROM w ASOF JOIN first_rows AS s ON w.r >= s.r) AS b GROUP BY batch""",
)
def ordered_batches(spark, sf):
    """Orders by date in batches of at most 60 rows and 5,200 bytes over the whole table."""
    columns = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"]
    named = batching.batch_rows(table(spark, sf, "orders").select(*columns, "o_orderdate"), ["o_orderdate", "o_orderkey"], 60, 5_200, columns=columns)
    at = F.struct("row.o_orderdate", "row.o_orderkey")
    return named.groupBy("batch").agg(F.count("*").alias("n"), F.sum(F.col("bytes") + batching.AROUND).alias("bytes"), F.min(at)["o_orderkey"].alias("first_key"), F.max(at)["o_orderkey"].alias("last_key"))


# ---- functions over columns


@query("dates_and_scores", """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + CASE o_orderkey % 4 WHEN 0 THEN 72 WHEN 1 THEN 48 WHEN 2 THEN 24 ELSE 4 END * INTERVAL 1 HOUR AS due, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS DATE) AS quarter_end, (o_orderkey % 5) / CAST(4 AS DOUBLE) AS normalised, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM orders""")
def dates_and_scores(spark, sf):
    k = F.col("o_orderkey")
    start, end = money.quarter_bounds(F.col("o_orderdate"))
    priority = F.element_at(F.array(*map(F.lit, ("Low", "Medium", "High", "Critical"))), (k % 4 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", money.due_at(F.col("o_orderdate"), priority).alias("due"), start.alias("quarter_start"), end.alias("quarter_end"), scorecard.normalised_score(k % 5 + 1).cast("double").alias("normalised"), money.minor_units(F.col("o_totalprice").cast("decimal(18,2)")).alias("cents"))


_VERDICT = """CASE o_orderkey % 5 WHEN 0 THEN concat('{"factual": ', CAST(1 + o_custkey % 5 AS STRING), ', "rationale": "fits"}') WHEN 1 THEN '{"factual": "5", "rationale": "fits"}' WHEN 2 THEN '{"factual": 9, "rationale": "fits"}' WHEN 3 THEN '{"factual": 4, "rationale": " "}' ELSE 'no json' END"""
_PAYLOADS = tuple(json.dumps({"response": {"response": r}}) for r in ({"clarify": True}, json.dumps({"clarify": True}), {"clarify": False}, {"clarify": "true"}, "no json"))
_ASKED_BACK = "json_extract(p, '$.response.response.clarify') = 'true' OR json_extract(i, '$.clarify') = 'true'"


@query("strict_verdicts", f"SELECT o_orderkey, CASE WHEN json_type(v, '$.factual') = 'UBIGINT' AND CAST(json_extract(v, '$.factual') AS INTEGER) BETWEEN 1 AND 5 AND length(trim(json_extract_string(v, '$.rationale'))) > 0 THEN CAST(json_extract(v, '$.factual') AS INTEGER) END AS score, COALESCE({_ASKED_BACK}, false) AS asked_back FROM (SELECT o_orderkey, CASE WHEN json_valid(v) THEN v END AS v, p, CASE WHEN json_valid(json_extract_string(p, '$.response.response')) THEN json_extract_string(p, '$.response.response') END AS i FROM (SELECT o_orderkey, {_VERDICT.replace('STRING', 'VARCHAR')} AS v, CASE o_orderkey % 5 {' '.join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PAYLOADS))} END AS p FROM orders) AS t) AS u")
def strict_verdicts(spark, sf):
    payload = F.element_at(F.array(*map(F.lit, _PAYLOADS)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(_VERDICT).alias("verdict"), payload.alias("payload"))
    return rows.select("o_orderkey", verdicts.parse_dimension(F.col("verdict"), "factual").getField("score").alias("score"), verdicts.asked_back(F.col("payload")).alias("asked_back"))


_RULED = "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || ' of ' || o_orderstatus AS expected, 'customers by status ' || o_orderstatus AS reference, CASE o_orderkey % 4 WHEN 0 THEN 'customers: ' || CAST(o_custkey AS VARCHAR) WHEN 1 THEN 'customers by status ' || o_orderstatus || ' are ' || CAST(o_custkey + 1 AS VARCHAR) WHEN 2 THEN '' ELSE CAST(o_custkey AS VARCHAR) || repeat(' and so on', 60) END AS answer, CASE o_orderkey % 3 WHEN 0 THEN 'select (1)' WHEN 1 THEN 'drop' ELSE 'with a as (select 1' END AS sql FROM "
_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9]+'))"
_COVERED = f"len(list_intersect({_WORDS.format('reference')}, {_WORDS.format('answer')})) / CAST(len({_WORDS.format('reference')}) AS DOUBLE)"


@query("rule_based_scores", f"SELECT o_orderkey, CASE WHEN list_contains(regexp_extract_all(answer, '-?[0-9]+(?:[.][0-9]+)?'), regexp_extract(expected, '-?[0-9]+(?:[.][0-9]+)?')) THEN 5 ELSE 1 END AS factual, CASE WHEN {_COVERED} >= 0.6 THEN 5 WHEN {_COVERED} >= 0.4 THEN 4 WHEN {_COVERED} >= 0.2 THEN 3 ELSE 1 END AS completeness, CASE WHEN length(trim(answer)) = 0 THEN 1 WHEN length(trim(answer)) > greatest(400, 6 * length(reference)) THEN 3 ELSE 5 END AS format, CASE WHEN NOT regexp_matches(lower(sql), '^(select|with)') THEN 2 WHEN length(replace(sql, ')', '')) = length(replace(sql, '(', '')) THEN 5 ELSE 3 END AS sql_quality FROM ({_RULED} orders) AS r")
def rule_based_scores(spark, sf):
    rows = spark.sql(_RULED.replace("VARCHAR", "STRING") + "{orders}", orders=table(spark, sf, "orders"))
    return rows.select("o_orderkey", verdicts.rule_based_scores(*map(F.col, ("expected", "reference", "answer", "sql"))).alias("s")).select("o_orderkey", "s.*")


@query("one_to_one", "SELECT check_name, violations, violations = 0 AS passed FROM (SELECT 'left rows with the same k' AS check_name, CAST((SELECT COUNT(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1) AS g) AS BIGINT) AS violations UNION ALL SELECT 'right rows with the same k', 0 UNION ALL SELECT 'left rows without a partner', (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) UNION ALL SELECT 'right rows without a partner', (SELECT COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))) AS r")
def one_to_one(spark, sf):
    orders, customers = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey"), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return joins.one_to_one(orders, customers, ["k"])[1]


@query("budget_actuals", demo_sql("finance", "SELECT b.budget_id, CAST(COALESCE(SUM(d.amount), 0) AS DOUBLE) AS actual FROM budgets AS b LEFT JOIN (SELECT e.account_id, t.transaction_date AS day, SUM(COALESCE(e.debit_amount, 0)) AS amount FROM ledger_entries AS e INNER JOIN transactions AS t ON t.transaction_id = e.transaction_id GROUP BY e.account_id, t.transaction_date) AS d ON d.account_id = b.account_id AND d.day >= b.period_start AND d.day < b.period_end GROUP BY b.budget_id"))
def budget_actuals(spark, sf):
    t = demo_tables(spark, sf, "finance")
    lines = t["ledger_entries"].join(t["transactions"], "transaction_id")
    daily = lines.groupBy("account_id", F.col("transaction_date").alias("day")).agg(F.sum(F.coalesce("debit_amount", F.lit(0))).alias("amount"))
    return joins.budget_actuals(t["budgets"], daily).select("budget_id", F.col("actual").cast("double").alias("actual"))


@query("ordinal_groups", "SELECT o_orderstatus, o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority")
def ordinal_groups(spark, sf):
    return spark.sql("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM {orders} GROUP BY 1, 2", orders=table(spark, sf, "orders"))


assert set(TABLES) == {i.split(":")[0] for i in FAMILIES}


QUERIES |= generated.QUERIES
ORACLE_SQL |= generated.ORACLE_SQL
