"""Question families with a shape of their own: several steps, existence by range, or shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import OPEN
from .families import TODAY, bind, literal


def accounts_at_risk(t: Mapping[str, DataFrame], *, industry: str = "Retail", least_open: int = 3, days: int = 60, top: int = 5) -> DataFrame:
    """Accounts of an industry with many open cases and no interaction lately (crm:T5-03)."""
    cases = t["support_cases"].where(f"status IN {OPEN}").groupBy("account_id").agg(F.count("*").alias("open_cases")).where(F.col("open_cases") >= least_open)
    since = F.date_sub(F.lit(TODAY).cast("date"), days)
    recent = t["interactions"].where(F.col("interaction_at") >= since).join(t["contacts"].select("contact_id", F.col("account_id").alias("of_account")), "contact_id").groupBy("of_account").agg(F.count("*").alias("n"))
    out = t["accounts"].where(F.col("industry") == industry).join(cases, "account_id").join(recent, F.col("account_id") == F.col("of_account"), "left").where(F.coalesce("n", F.lit(0)) == 0)
    return out.orderBy(F.desc("open_cases"), F.asc_nulls_last("account_name"), "account_id").limit(top).select(F.col("account_name").alias("entity"), F.col("open_cases").cast("long").alias("value"))


def accounts_at_risk_sql(industry: str = "Retail", least_open: int = 3, days: int = 60, top: int = 5) -> str:
    return bind(
        f"SELECT account_name AS entity, CAST(n AS BIGINT) AS value FROM (SELECT accounts.account_id, account_name, (SELECT COUNT(*) FROM support_cases WHERE support_cases.account_id = accounts.account_id AND status IN {OPEN}) AS n FROM accounts WHERE industry = :industry"
        f" AND NOT EXISTS (SELECT 1 FROM interactions INNER JOIN contacts ON contacts.contact_id = interactions.contact_id WHERE contacts.account_id = accounts.account_id AND interactions.interaction_at >= DATE '{TODAY}' - INTERVAL {days} DAY)) AS a WHERE n >= {least_open} ORDER BY n DESC, account_name ASC NULLS LAST, account_id LIMIT {top}",
        {"industry": industry},
    )


def quota_shortfall(t: Mapping[str, DataFrame], *, territory: str = "South") -> DataFrame:
    """Targets of the last completed period that won deals fell short of (sales:T5-02)."""
    targets = t["targets"].where((F.col("territory") == territory) & (F.col("period_end") <= F.lit(TODAY).cast("date")))
    last = targets.agg(F.max("period_end").alias("last_end"))
    # one row: the period that ended last
    current = targets.join(F.broadcast(last), F.col("period_end") == F.col("last_end")).alias("targets")
    won = current.join(t["deals"].alias("deals"), F.expr("deals.rep_name = targets.rep_name AND deals.stage = 'Won' AND deals.close_date >= targets.period_start AND deals.close_date < targets.period_end"), "left")
    short = won.groupBy("targets.rep_name", "targets.target_id", "quota_amount").agg((F.col("quota_amount") - F.coalesce(F.sum("deal_amount"), F.lit(0))).alias("short")).where("short > 0")
    return short.orderBy(F.desc("short"), F.asc_nulls_last("rep_name"), "target_id").select(F.col("rep_name").alias("entity"), F.round("short", 2).cast("double").alias("value"))


def quota_shortfall_sql(territory: str = "South") -> str:
    return bind(
        f"SELECT rep_name AS entity, CAST(ROUND(quota_amount - won, 2) AS DOUBLE) AS value FROM (SELECT targets.rep_name, targets.target_id, targets.quota_amount, (SELECT COALESCE(SUM(deals.deal_amount), 0) FROM deals WHERE deals.rep_name = targets.rep_name AND deals.stage = 'Won' AND deals.close_date >= targets.period_start AND deals.close_date < targets.period_end) AS won FROM targets"
        f" WHERE targets.territory = :territory AND targets.period_end = (SELECT MAX(period_end) FROM targets WHERE territory = :territory AND period_end <= DATE '{TODAY}')) AS s WHERE won < quota_amount ORDER BY quota_amount - won DESC, rep_name, target_id",
        {"territory": territory},
    )


def budgets_with_activity(t: Mapping[str, DataFrame], *, scenario: str | None = None, account_type: str | None = None) -> DataFrame:
    """Budget periods with and without ledger activity (finance:T4-02 by scenario, finance:T4-04 by account type).

    Ledger days are made distinct by account first, so a budget meets each day once.
    """
    budgets = t["budgets"]
    if scenario is not None:
        budgets = budgets.where(F.col("scenario") == scenario)
    if account_type is not None:
        budgets = budgets.join(t["accounts"].where(F.col("account_type") == account_type).select("account_id"), "account_id")
    days = t["ledger_entries"].select("transaction_id", F.col("account_id").alias("of_account")).join(t["transactions"].select("transaction_id", "transaction_date"), "transaction_id").select("of_account", "transaction_date").distinct()
    on = (F.col("account_id") == F.col("of_account")) & (F.col("transaction_date") >= F.col("period_start")) & (F.col("transaction_date") < F.col("period_end"))
    active = budgets.join(days, on, "left_semi").agg(F.count("*").alias("value")).select(F.lit("has actuals").alias("entity"), "value")
    idle = budgets.join(days, on, "left_anti").agg(F.count("*").alias("value")).select(F.lit("no actuals").alias("entity"), "value")
    return active.unionAll(idle).where("value > 0").select("entity", F.col("value").cast("long").alias("value"))


def budgets_with_activity_sql(scenario: str | None = None, account_type: str | None = None) -> str:
    where = f"budgets.scenario = {literal(scenario)}" if scenario is not None else f"budgets.account_id IN (SELECT account_id FROM accounts WHERE account_type = {literal(account_type)})"
    exists = "EXISTS (SELECT 1 FROM ledger_entries INNER JOIN transactions ON transactions.transaction_id = ledger_entries.transaction_id WHERE ledger_entries.account_id = budgets.account_id AND transactions.transaction_date >= budgets.period_start AND transactions.transaction_date < budgets.period_end)"
    return f"SELECT entity, CAST(COUNT(*) AS BIGINT) AS value FROM (SELECT CASE WHEN {exists} THEN 'has actuals' ELSE 'no actuals' END AS entity FROM budgets WHERE {where}) AS b GROUP BY entity"


def largest_share(t: Mapping[str, DataFrame]) -> DataFrame:
    """The region with the largest order value and its part of the whole (logistics:T5-03)."""
    by_region = t["orders"].join(t["warehouses"].select("warehouse_id", "region"), "warehouse_id").groupBy("region").agg(F.sum("total_amount").alias("total"))
    whole = by_region.agg(F.sum("total").alias("whole"))
    # both sides are aggregates: a row per region, and one row
    out = by_region.crossJoin(F.broadcast(whole))
    share = F.round(F.col("total").cast("double") * 100.0 / F.nullif(F.col("whole").cast("double"), F.lit(0.0)), 2)
    return out.orderBy(F.desc("total"), F.asc_nulls_last("region")).limit(1).select(F.col("region").alias("entity"), F.round("total", 2).cast("double").alias("value"), share.alias("share_pct"))


def largest_share_sql() -> str:
    return "SELECT region AS entity, CAST(ROUND(total, 2) AS DOUBLE) AS value, ROUND(CAST(total AS DOUBLE) * 100 / NULLIF(CAST(SUM(total) OVER () AS DOUBLE), 0), 2) AS share_pct FROM (SELECT warehouses.region, SUM(orders.total_amount) AS total FROM orders INNER JOIN warehouses ON warehouses.warehouse_id = orders.warehouse_id GROUP BY warehouses.region) AS g ORDER BY total DESC, region LIMIT 1"


#: id -> (builder over tables, SQL text)
SPECIAL = {
    "crm:T5-03": (accounts_at_risk, accounts_at_risk_sql()),
    "sales:T5-02": (quota_shortfall, quota_shortfall_sql()),
    "finance:T4-02": (lambda t: budgets_with_activity(t, scenario="Forecast"), budgets_with_activity_sql(scenario="Forecast")),
    "finance:T4-04": (lambda t: budgets_with_activity(t, account_type="Asset"), budgets_with_activity_sql(account_type="Asset")),
    "logistics:T5-03": (largest_share, largest_share_sql()),
}
