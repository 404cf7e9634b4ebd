"""The five domains' tables as views over a star schema, in SQL that several engines read alike.

They give every question family rows to answer from, with nulls, orphans, unmatched
parents and ties, wherever only the star schema's tables exist.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

#: The columns' domains.
INDUSTRIES = ("Technology", "Healthcare", "FinancialServices", "Retail", "Manufacturing", "Education", "Energy")
REGIONS = ("North", "South", "East", "West", "Central")
TIERS = ("Standard", "Preferred", "Strategic")
TITLES = ("Customer Success Manager", "Operations Director", "Procurement Manager", "IT Director", "Business Analyst", "Service Delivery Manager", "Program Manager")
CAMPAIGN_TYPES = ("Awareness", "Nurture", "Retention", "Reengagement", "CustomerEducation")
CAMPAIGN_STATUSES = ("Draft", "Scheduled", "Active", "Completed", "Cancelled")
CHANNELS = ("Email", "Phone", "Web", "Webinar", "Event", "Social")
ENGAGEMENTS = ("EmailOpen", "LinkClick", "FormSubmission", "PhoneCall", "Meeting", "WebinarAttendance", "EventAttendance")
CASE_CATEGORIES = ("ProductIssue", "Billing", "Access", "Integration", "ServiceRequest", "GeneralInquiry")
CASE_STATUSES = ("New", "InProgress", "PendingCustomer", "Resolved", "Closed")
PRIORITIES = ("Low", "Medium", "High", "Critical")
LEAD_SOURCES = ("WebForm", "Referral", "EventBooth", "ColdCall", "Inbound")
LEAD_STATUSES = ("New", "Contacted", "Qualified", "Disqualified", "Converted")
STAGES = ("Prospecting", "Negotiation", "Won", "Lost")
SALES_CATEGORIES = ("Software", "Hardware", "Services", "Subscription")
QUOTE_STATUSES = ("Draft", "Sent", "Accepted", "Rejected", "Expired")
ACCOUNT_TYPES = ("Asset", "Liability", "Equity", "Revenue", "Expense")
CURRENCIES = ("USD", "EUR", "GBP", "INR", "JPY", "CAD", "AUD", "CHF", "SGD", "AED")
SYSTEMS = ("ERP", "Billing", "Payroll", "Expense", "Manual")
POSTINGS = ("Standard", "Adjustment", "Accrual", "Reversal")
SCENARIOS = ("Approved", "Forecast", "Stretch")
RATE_SOURCES = ("SyntheticDaily", "SyntheticEstimated")
PROJECT_STATUSES = ("Planning", "Active", "OnHold", "Completed", "Cancelled")
ROLES = ("Developer", "Designer", "PM", "QA", "Analyst")
DEPARTMENTS = ("Engineering", "Design", "Product", "Quality", "Delivery", "Operations")
TASK_STATUSES = ("NotStarted", "InProgress", "Blocked", "Completed")
TASK_TYPES = ("Feature", "Bug", "Documentation", "Testing", "Deployment")
MILESTONE_STATUSES = ("Planned", "AtRisk", "Completed", "Missed")
WORK_TYPES = ("Delivery", "Review", "Meeting", "Rework", "Support")
SERVICE_LEVELS = ("Standard", "Express", "Overnight")
CARRIER_TYPES = ("Parcel", "Freight", "Air", "Ocean", "Rail")
HOUSE_REGIONS = ("NA", "EU", "APAC", "LATAM")
ORDER_STATUSES = ("Pending", "Shipped", "Delivered", "Cancelled", "Returned")
ORDER_PRIORITIES = ("Low", "Medium", "High", "Urgent")
SHIPMENT_STATUSES = ("Booked", "InTransit", "Delivered", "Failed", "Lost")
STOCK_CATEGORIES = ("Software", "Hardware", "Supplies", "FinishedGoods", "RawMaterials")


def pick(number: str, values: tuple[str, ...], missing: bool = False) -> str:
    """One of the values by number modulo their count; with missing one more case, which is null."""
    n = len(values) + missing
    return f"CASE ({number}) % {n} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def day(number: str, span: int, first: str = "2025-10-01") -> str:
    return f"(DATE '{first}' + CAST(({number}) % {span} AS INT))"


def stamp(date: str) -> str:
    return f"CAST({date} AS TIMESTAMP)"


def money(value: str, kind: str = "15,2") -> str:
    return f"CAST({value} AS DECIMAL({kind}))"


def _rep(number: str) -> str:
    return f"CONCAT('Rep ', CAST(({number}) % 12 AS STRING))"


def _beside(number: str, n: int) -> str:
    """A key, or the one before it where it is a multiple of n: those parents stay without children."""
    return f"({number} - CASE WHEN {number} % {n} = 0 THEN 1 ELSE 0 END)"


_opened = day("o_orderkey * 3 + o_custkey", 300)
_sent = day("l_orderkey * 5 + l_partkey", 280)

TABLES: dict[str, dict[str, str]] = {
    "crm": {
        "accounts": f"SELECT c_custkey AS account_id, CASE WHEN c_custkey % 50 = 0 THEN 'Shared Name' ELSE c_name END AS account_name, CAST(c_custkey % 1000 AS INT) AS account_size, {pick('c_custkey', INDUSTRIES)} AS industry, {pick('c_nationkey', REGIONS)} AS region, {pick('c_custkey + c_nationkey', TIERS)} AS customer_tier, c_custkey % 10 <> 0 AS is_active FROM customer",
        "contacts": f"SELECT o_orderkey AS contact_id, CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE {_beside('o_custkey', 6)} END AS account_id, {pick('o_orderkey', TITLES)} AS title, o_orderkey % 4 <> 0 AS is_active FROM orders",
        "campaigns": f"SELECT p_partkey AS campaign_id, {pick('p_partkey', CAMPAIGN_TYPES)} AS campaign_type, {pick('p_size', CAMPAIGN_STATUSES)} AS status, {pick('p_partkey + p_size', CHANNELS)} AS primary_channel, {money('p_retailprice')} AS budget_amount FROM part",
        "contact_campaigns": f"SELECT DISTINCT contact_id, l_partkey AS campaign_id, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE {money('((contact_id + l_partkey) % 10001) * 0.0001', '5,4')} END AS attribution_weight FROM (SELECT {_beside('l_orderkey', 4)} AS contact_id, l_partkey FROM lineitem) AS s",
        "interactions": f"SELECT l_orderkey * 8 + l_linenumber AS interaction_id, l_orderkey - l_orderkey % 3 AS contact_id, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_partkey % 150 END AS account_id, CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE {_beside('l_partkey', 7)} END AS campaign_id, {pick('l_orderkey + l_linenumber', ENGAGEMENTS)} AS engagement_type, {pick('l_partkey + l_linenumber', CHANNELS)} AS channel, {pick('l_partkey', ('Inbound', 'Outbound'))} AS direction, CAST(l_quantity AS INT) AS engagement_points, {stamp(day('l_orderkey * 7 + l_partkey', 320))} AS interaction_at FROM lineitem",
        "support_cases": f"SELECT case_id, account_id, contact_id, category, priority, status, {stamp('opened')} AS opened_at, {stamp('opened + CAST(1 + case_id % 4 AS INT)')} AS sla_due_at, CASE WHEN status IN ('Resolved', 'Closed') THEN {stamp('opened + CAST(case_id % 6 AS INT)')} END AS resolved_at FROM (SELECT o_orderkey AS case_id, o_custkey AS account_id, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 3 END AS contact_id, {pick('o_orderkey', CASE_CATEGORIES)} AS category, {pick('o_orderkey + o_custkey', PRIORITIES)} AS priority, {pick('o_custkey * 3 + o_orderkey', CASE_STATUSES)} AS status, {_opened} AS opened FROM orders) AS s",
    },
    "sales": {
        "leads": f"SELECT c_custkey AS lead_id, {pick('c_custkey', LEAD_SOURCES)} AS lead_source, {pick('c_custkey + c_nationkey', LEAD_STATUSES)} AS lead_status, {_rep('c_custkey')} AS rep_name, {pick('c_nationkey', REGIONS)} AS territory FROM customer",
        "deals": f"SELECT o_orderkey AS deal_id, {_beside('o_custkey', 5)} AS lead_id, {_rep('o_custkey')} AS rep_name, {pick('o_orderkey + o_custkey', STAGES)} AS stage, {money('o_totalprice')} AS deal_amount, CASE WHEN (o_orderkey + o_custkey) % 4 >= 2 THEN {_opened} END AS close_date FROM orders",
        "products": f"SELECT p_partkey AS product_id, {pick('p_partkey', SALES_CATEGORIES, True)} AS category, CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE {money('p_retailprice')} END AS list_price, p_size % 5 <> 0 AS is_active FROM part",
        "quotations": f"SELECT l_orderkey * 8 + l_linenumber AS quotation_id, l_orderkey AS deal_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity, {money('(l_partkey * 37 % 9000) * 0.25')} AS unit_price, {money('ROUND(l_discount * 100, 0)', '5,2')} AS discount_pct, {pick('l_orderkey + l_partkey', QUOTE_STATUSES)} AS quote_status FROM lineitem",
        "targets": f"SELECT n_nationkey * 4 + q AS target_id, CONCAT('Rep ', CAST(n_nationkey % 15 AS STRING)) AS rep_name, {pick('n_nationkey', REGIONS)} AS territory, CASE q WHEN 0 THEN DATE '2025-10-01' WHEN 1 THEN DATE '2026-01-01' WHEN 2 THEN DATE '2026-04-01' ELSE DATE '2026-07-01' END AS period_start, CASE q WHEN 0 THEN DATE '2026-01-01' WHEN 1 THEN DATE '2026-04-01' WHEN 2 THEN DATE '2026-07-01' ELSE DATE '2026-10-01' END AS period_end, {money('100000 + 37 * n_nationkey')} AS quota_amount FROM nation CROSS JOIN (SELECT 0 AS q UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS quarters",
    },
    "finance": {
        "accounts": f"SELECT c_custkey AS account_id, {pick('c_custkey', ACCOUNT_TYPES)} AS account_type, CASE WHEN c_custkey % 10 < 5 THEN NULL ELSE c_custkey - 5 END AS parent_account_id, CASE WHEN c_custkey % 5 IN (0, 4) THEN 'Debit' ELSE 'Credit' END AS normal_balance FROM customer",
        "transactions": f"SELECT o_orderkey AS transaction_id, {_opened} AS transaction_date, {pick('o_orderkey', SYSTEMS)} AS source_system, {pick('o_custkey + o_orderkey', CURRENCIES)} AS source_currency, 'USD' AS target_currency, {money('o_totalprice', '19,4')} AS total_amount, o_orderkey % 50 = 0 AS reversed, {stamp(f'{_opened} + CAST(o_orderkey % 3 AS INT)')} AS posted_at FROM orders",
        "ledger_entries": f"SELECT l_orderkey * 8 + l_linenumber AS entry_id, l_orderkey AS transaction_id, l_partkey % 200 AS account_id, l_linenumber AS line_number, CASE WHEN l_linenumber % 2 = 0 THEN {money('l_extendedprice', '19,4')} END AS debit_amount, CASE WHEN l_linenumber % 2 = 1 THEN {money('l_extendedprice', '19,4')} END AS credit_amount, {pick('l_orderkey + l_partkey', POSTINGS)} AS posting_type, {pick('l_orderkey + l_suppkey', CURRENCIES)} AS currency_code FROM lineitem",
        "budgets": f"SELECT p_partkey AS budget_id, p_partkey % 200 AS account_id, CAST(2024 + p_partkey % 3 AS INT) AS fiscal_year, {day('(p_partkey % 12) * 30', 360)} AS period_start, {day('(p_partkey % 12) * 30', 360, '2025-10-31')} AS period_end, {money('p_retailprice * 10', '19,4')} AS budget_amount, {pick('p_partkey + p_size', SCENARIOS)} AS scenario FROM part",
        "fx_rates": f"SELECT k AS rate_id, currency AS from_currency, 'USD' AS to_currency, rate_date, CASE WHEN currency = 'USD' THEN {money('1', '19,6')} WHEN k % 41 = 0 THEN NULL ELSE {money('0.5 + (k % 997) * 0.000901', '19,6')} END AS rate, CASE WHEN k % 9 = 0 THEN 'SyntheticEstimated' ELSE 'SyntheticDaily' END AS rate_source FROM (SELECT s.n * 10 + d.n AS k, {pick('d.n', CURRENCIES)} AS currency, DATE '2025-10-01' + CAST(s.n AS INT) AS rate_date FROM (SELECT DISTINCT o_orderkey % 300 AS n FROM orders) AS s CROSS JOIN (SELECT DISTINCT o_orderkey % 10 AS n FROM orders) AS d WHERE (s.n + d.n) % 13 <> 0) AS g",
    },
    "project_management": {
        "projects": f"SELECT c_custkey AS project_id, {pick('c_custkey', PROJECT_STATUSES)} AS status, {pick('c_custkey + c_nationkey', PRIORITIES)} AS priority, {money('c_acctbal * 100')} AS budget_amount FROM customer",
        "resources": f"SELECT s_suppkey AS resource_id, {pick('s_suppkey', ROLES)} AS role, {pick('s_nationkey', DEPARTMENTS, True)} AS department, {money('20 + s_suppkey % 90', '10,2')} AS hourly_rate, s_suppkey % 6 <> 0 AS is_active FROM supplier",
        "tasks": f"SELECT o_orderkey AS task_id, {_beside('o_custkey', 4)} AS project_id, {pick('o_orderkey + o_custkey', TASK_STATUSES)} AS status, {pick('o_orderkey', TASK_TYPES, True)} AS task_type, {_opened} AS start_date, {_opened} + CAST(o_orderkey % 60 AS INT) AS due_date, CASE WHEN (o_orderkey + o_custkey) % 4 = 3 THEN {_opened} + CAST(o_orderkey % 70 AS INT) END AS completed_date, CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE {money('o_orderkey % 160 * 0.25', '8,2')} END AS estimate_hours FROM orders",
        "task_resources": f"SELECT DISTINCT task_id, resource_id, {money('(task_id + resource_id) % 4 * 25 + 25', '5,2')} AS allocation_pct FROM (SELECT l_orderkey AS task_id, l_suppkey + CASE WHEN l_linenumber < 4 THEN 0 ELSE 1 END AS resource_id FROM lineitem) AS s",
        "milestones": f"SELECT p_partkey AS milestone_id, p_partkey % 150 AS project_id, {pick('p_size', MILESTONE_STATUSES)} AS status, {day('p_partkey * 3', 300)} AS planned_date, CASE WHEN p_size % 4 = 2 THEN {day('p_partkey * 3 + 2', 302)} END AS actual_date FROM part",
        "time_entries": f"SELECT l_orderkey * 8 + l_linenumber AS entry_id, l_orderkey AS task_id, l_suppkey AS resource_id, {_sent} AS entry_date, {money('(1 + l_quantity % 16) * 0.5', '6,2')} AS hours, l_partkey % 3 <> 0 AS billable, {pick('l_partkey', WORK_TYPES)} AS work_type FROM lineitem",
    },
    "logistics": {
        "carriers": f"SELECT s_suppkey AS carrier_id, {pick('s_suppkey', SERVICE_LEVELS)} AS service_level, {pick('s_suppkey + s_nationkey', CARRIER_TYPES, True)} AS carrier_type FROM supplier",
        "warehouses": f"SELECT n_nationkey AS warehouse_id, {pick('n_nationkey', HOUSE_REGIONS)} AS region, CAST(1000 + n_nationkey * 10 AS INT) AS capacity_units FROM nation",
        "orders": f"SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 33 = 0 THEN 900000000 + o_orderkey ELSE o_custkey % 25 END AS warehouse_id, {_opened} AS order_date, {pick('o_orderkey + o_custkey', ORDER_STATUSES)} AS status, {pick('o_custkey', ORDER_PRIORITIES)} AS order_priority, {money('o_totalprice')} AS total_amount FROM orders",
        "shipments": f"SELECT l_orderkey * 8 + l_linenumber AS shipment_id, {_beside('l_orderkey', 6)} AS order_id, l_suppkey AS carrier_id, {_sent} AS ship_date, CASE WHEN l_partkey % 5 = 2 THEN {_sent} + CAST(l_partkey % 9 AS INT) END AS delivery_date, {pick('l_partkey', SHIPMENT_STATUSES)} AS status, CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE {money('l_tax * 100 + l_quantity')} END AS shipping_cost FROM lineitem",
        "inventory": f"SELECT p_partkey AS inventory_id, p_partkey % 25 AS warehouse_id, {pick('p_partkey + p_size', STOCK_CATEGORIES, True)} AS product_category, CAST(p_size * 10 AS INT) AS quantity_on_hand, CAST(p_size * 3 AS INT) AS reorder_point FROM part",
    },
}

SOURCES = ("customer", "orders", "lineitem", "part", "supplier", "nation")


class DemoTables(Mapping):
    """The domain's tables as plans over the star schema's Parquet files, each made when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, domain: str):
        self.spark, self.sf_dir, self.texts, self.made = spark, sf_dir, TABLES[domain], {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            # each source's name after FROM becomes a parameter of the statement
            text = re.sub(r"\bFROM (" + "|".join(SOURCES) + r")\b", r"FROM {\1}", self.texts[name])
            used = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet") for t in SOURCES if f"{{{t}}}" in text}
            self.made[name] = self.spark.sql(text, **used)
        return self.made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.texts)

    def __len__(self) -> int:
        return len(self.texts)


def demo_tables(spark: SparkSession, sf_dir: str, domain: str) -> DemoTables:
    return DemoTables(spark, sf_dir, domain)


def demo_sql(domain: str, query: str) -> str:
    """A query over a domain's tables as one statement over the star schema's tables."""
    from_star = [f"star_{t} AS (SELECT * FROM {t})" for t in SOURCES]
    views = []
    for name, text in TABLES[domain].items():
        views.append(f"{name}_ AS ({re.sub(r'FROM (' + '|'.join(SOURCES) + r')\b', r'FROM star_\1', text)})")
    names = "|".join(TABLES[domain])
    query = re.sub(rf"\b(FROM|JOIN) ({names})\b(?! AS)", r"\1 \2_ AS \2", query)
    query = re.sub(rf"\b(FROM|JOIN) ({names}) AS", r"\1 \2_ AS", query)
    return f"WITH {', '.join(from_star + views)} {query}"
