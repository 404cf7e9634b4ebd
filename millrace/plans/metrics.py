"""Derived business metrics, as SQL over a domain's tables; one text for every engine."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .families import TODAY

#: (domain, name) -> SQL
METRICS: dict[tuple[str, str], str] = {
    ("crm", "account_engagement"): "SELECT accounts.account_id, CAST(COUNT(interactions.interaction_id) AS BIGINT) AS interactions, CAST(COALESCE(SUM(interactions.engagement_points), 0) AS BIGINT) AS points FROM accounts LEFT JOIN contacts ON contacts.account_id = accounts.account_id LEFT JOIN interactions ON interactions.contact_id = contacts.contact_id GROUP BY accounts.account_id",
    ("crm", "contact_engagement"): "SELECT contacts.contact_id, CAST(COALESCE(SUM(interactions.engagement_points), 0) AS BIGINT) AS points FROM contacts LEFT JOIN interactions ON interactions.contact_id = contacts.contact_id GROUP BY contacts.contact_id",
    ("crm", "campaign_engagement"): "SELECT campaigns.campaign_id, CAST(COALESCE(SUM(interactions.engagement_points), 0) AS BIGINT) AS points FROM campaigns LEFT JOIN interactions ON interactions.campaign_id = campaigns.campaign_id GROUP BY campaigns.campaign_id",
    ("crm", "sla_breaches"): f"SELECT priority, CAST(SUM(CASE WHEN resolved_at IS NULL AND sla_due_at < CAST(DATE '{TODAY}' AS TIMESTAMP) THEN 1 ELSE 0 END) AS BIGINT) AS open_breaches, CAST(SUM(CASE WHEN resolved_at > sla_due_at THEN 1 ELSE 0 END) AS BIGINT) AS resolved_breaches FROM support_cases GROUP BY priority",
    ("crm", "resolution_days"): "SELECT category, CAST(COUNT(*) AS BIGINT) AS resolved, CAST(SUM(CAST(resolved_at AS DATE) - CAST(opened_at AS DATE) @DAYS) AS BIGINT) AS days FROM support_cases WHERE resolved_at IS NOT NULL GROUP BY category",
    ("sales", "quota_attainment"): "SELECT targets.target_id, CAST(ROUND(CAST(COALESCE(SUM(deals.deal_amount), 0) AS DOUBLE) * 100 / CAST(MAX(targets.quota_amount) AS DOUBLE), 2) AS DOUBLE) AS attained_pct FROM targets LEFT JOIN deals ON deals.rep_name = targets.rep_name AND deals.stage = 'Won' AND deals.close_date >= targets.period_start AND deals.close_date < targets.period_end GROUP BY targets.target_id",
    ("sales", "lead_conversion"): "SELECT lead_source, CAST(ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN lead_status = 'Converted' THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 2) AS DOUBLE) AS converted_pct FROM leads GROUP BY lead_source",
    ("sales", "logical_lines"): "SELECT quote_status, CAST(COUNT(*) AS BIGINT) AS lines FROM (SELECT deal_id, product_id, quote_status, MIN(quotation_id) AS first_line FROM quotations GROUP BY deal_id, product_id, quote_status) AS l GROUP BY quote_status",
    ("finance", "signed_amounts"): "SELECT accounts.account_id, CAST(ROUND(SUM(CASE WHEN accounts.normal_balance = 'Debit' THEN COALESCE(ledger_entries.debit_amount, 0) - COALESCE(ledger_entries.credit_amount, 0) ELSE COALESCE(ledger_entries.credit_amount, 0) - COALESCE(ledger_entries.debit_amount, 0) END), 2) AS DOUBLE) AS balance FROM accounts INNER JOIN ledger_entries ON ledger_entries.account_id = accounts.account_id GROUP BY accounts.account_id",
    ("finance", "budget_variance"): "SELECT b.budget_id, CAST(ROUND(b.budget_amount - COALESCE(SUM(d.amount), 0), 2) AS DOUBLE) AS variance FROM budgets AS b LEFT JOIN (SELECT e.account_id, t.transaction_date, SUM(ROUND(CAST(e.debit_amount AS DECIMAL(18,4)) * f.rate, 4)) AS amount FROM ledger_entries AS e INNER JOIN transactions AS t ON t.transaction_id = e.transaction_id INNER JOIN fx_rates AS f ON f.from_currency = t.source_currency AND f.to_currency = t.target_currency AND f.rate_date = t.transaction_date AND f.rate IS NOT NULL WHERE e.debit_amount IS NOT NULL GROUP BY e.account_id, t.transaction_date) AS d ON d.account_id = b.account_id AND d.transaction_date >= b.period_start AND d.transaction_date < b.period_end GROUP BY b.budget_id, b.budget_amount",
    ("finance", "rolling_balance"): "SELECT e.entry_id, e.line_number, CAST(ROUND(SUM(COALESCE(e.debit_amount, 0) - COALESCE(e.credit_amount, 0)) OVER (PARTITION BY e.account_id ORDER BY t.transaction_date, t.posted_at, e.transaction_id, e.line_number, e.entry_id, e.debit_amount NULLS FIRST, e.credit_amount NULLS FIRST ROWS UNBOUNDED PRECEDING), 2) AS DOUBLE) AS balance FROM ledger_entries AS e INNER JOIN transactions AS t ON t.transaction_id = e.transaction_id",
    ("project_management", "late_tasks"): f"SELECT project_id, CAST(SUM(CASE WHEN completed_date IS NULL AND due_date < DATE '{TODAY}' THEN 1 ELSE 0 END) AS BIGINT) AS overdue, CAST(SUM(CASE WHEN completed_date > due_date THEN 1 ELSE 0 END) AS BIGINT) AS completed_late FROM tasks GROUP BY project_id",
    ("project_management", "milestone_completion"): "SELECT project_id, CAST(ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN actual_date IS NOT NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 2) AS DOUBLE) AS completed_pct FROM milestones GROUP BY project_id",
    ("project_management", "allocation"): "SELECT task_id, CAST(SUM(allocation_pct) AS DOUBLE) AS allocated_pct, CAST(COUNT(*) AS BIGINT) AS resources FROM task_resources GROUP BY task_id",
    ("logistics", "transit_days"): "SELECT carriers.carrier_type, CAST(COUNT(*) AS BIGINT) AS delivered, CAST(SUM(shipments.delivery_date - shipments.ship_date @DAYS) AS BIGINT) AS days FROM shipments INNER JOIN carriers ON carriers.carrier_id = shipments.carrier_id WHERE shipments.delivery_date IS NOT NULL GROUP BY carriers.carrier_type",
    ("logistics", "below_reorder"): "SELECT warehouses.region, CAST(SUM(CASE WHEN inventory.quantity_on_hand < inventory.reorder_point * 4 THEN 1 ELSE 0 END) AS BIGINT) AS low_items FROM inventory INNER JOIN warehouses ON warehouses.warehouse_id = inventory.warehouse_id GROUP BY warehouses.region",
}

#: The difference of two dates is an interval in one engine and a number in the other.
_DIFFERENCE = re.compile(r"SUM\((.+?) - (.+?) @DAYS\)")


def metric(spark: SparkSession, tables: Mapping[str, DataFrame], domain: str, name: str) -> DataFrame:
    text = _DIFFERENCE.sub(r"SUM(DATEDIFF(\1, \2))", METRICS[domain, name])
    used = {t: tables[t] for t in tables if re.search(rf"\b(?:FROM|JOIN) {t}\b", text)}
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b(?! AS)", rf"\1 {{{t}}} AS {t}", text)
        text = re.sub(rf"\b(FROM|JOIN) {t} AS", rf"\1 {{{t}}} AS", text)
    return spark.sql(text, **used)


def metric_sql(domain: str, name: str) -> str:
    return _DIFFERENCE.sub(r"SUM(\1 - \2)", METRICS[domain, name])
