"""The five finance tables, generated from row targets and rules.

Accounts, transactions and budgets are functions of their keys. Ledger lines are shared out in pairs over the posted
transactions, so that every transaction balances and the lines have their target exactly; rates are a grid of currencies and days,
each currency one series of bounded, mean-reverting steps.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import synth, windows
from millrace.operators.generate import Draws, at_boundaries, children, fan_out, keys
from millrace.sources.feasibility import Defect, Grid, Plan, Relation, Window, require_feasible

#: The rows of each table by profile, and the rules of the finance contract.
TARGETS = {
    "dev": {"accounts": 50, "transactions": 1000, "ledger_entries": 2000, "budgets": 100, "fx_rates": 370},
    "full": {"accounts": 200, "transactions": 100000, "ledger_entries": 200000, "budgets": 800, "fx_rates": 3650},
}
CREATED, ACTIVITY, BUDGETS, TODAY = "2022-01-01", "2025-08-03", "2025-01-01", "2026-08-01"
BOUNDARIES = ("1900-01-01", "2038-01-19", "2099-12-31", "2026-08-01")
TYPES = {"Asset": 0.3, "Liability": 0.2, "Equity": 0.1, "Revenue": 0.15, "Expense": 0.25}
SUBTYPES = {"Asset": ("Cash", "AccountsReceivable", "Inventory", "PrepaidExpense", "FixedAsset"), "Liability": ("AccountsPayable", "AccruedLiability", "LongTermDebt"), "Equity": ("CommonEquity", "RetainedEarnings"), "Revenue": ("ProductRevenue", "ServiceRevenue", "OtherRevenue"), "Expense": ("PayrollExpense", "OperatingExpense", "DepreciationExpense", "TaxExpense")}
NORMAL = {"Asset": "Debit", "Liability": "Credit", "Equity": "Credit", "Revenue": "Credit", "Expense": "Debit"}
CURRENCIES = {"USD": 0.4, "EUR": 0.12, "GBP": 0.08, "INR": 0.1, "JPY": 0.08, "CAD": 0.06, "AUD": 0.05, "CHF": 0.04, "SGD": 0.04, "AED": 0.03}
ANCHORS = {"USD": "1.000000", "EUR": "1.080000", "GBP": "1.270000", "INR": "0.012000", "JPY": "0.006800", "CAD": "0.740000", "AUD": "0.660000", "CHF": "1.120000", "SGD": "0.750000", "AED": "0.272300"}
SYSTEMS = {"ERP": 0.35, "Billing": 0.25, "Payroll": 0.15, "Expense": 0.15, "Manual": 0.1}
SCENARIOS = {"Approved": 0.6, "Forecast": 0.3, "Stretch": 0.1}
#: Greatest daily change of a rate in parts of 10,000, percent of transactions without lines and of rates without a value, and months of a budget's period.
MOVE_BPS, UNPOSTED_PCT, MISSING_PCT, MONTHS = 75, 5, 2.5, 3
#: Money is counted in units of 1 / UNITS.
UNITS = 10_000


def _looked_up(value: Column, table: dict) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), value)


@dataclass(frozen=True)
class Finance:
    """Draws of the tables' columns by key; targets are checked before anything runs."""

    targets: dict[str, int]
    seed: int = 42
    boundaries: tuple[str, ...] = BOUNDARIES
    lag: tuple[int, int] = (0, 7)
    unposted_pct: float = UNPOSTED_PCT

    def __post_init__(self):
        t = self.targets
        if t["accounts"] < len(TYPES) + 2:
            raise ValueError("every account type needs an account, and two have to be below others")
        if t["ledger_entries"] % 2:
            raise ValueError("every posted transaction needs an even number of lines")
        if t["budgets"] % t["accounts"]:
            raise ValueError("every account needs as many budgets as any other")
        if t["fx_rates"] % len(CURRENCIES) or t["fx_rates"] // len(CURRENCIES) <= len(self.boundaries):
            raise ValueError("every currency needs a rate for every day, boundaries included")
        require_feasible(self.plan)

    @property
    def plan(self) -> Plan:
        """What the targets have to leave room for."""
        t, days = self.targets, self.targets["fx_rates"] // len(CURRENCIES)
        lines = Relation("ledger_entries", "transactions", 2, parents=100 - 100 * self.unposted / t["transactions"])
        grid = Grid("fx_rates", {"currencies": len(CURRENCIES), "days": days})
        windows = {"accounts": Window(CREATED, TODAY), "rates": Window(ACTIVITY, TODAY, days - len(self.boundaries), after="accounts")}
        defects = {"unposted": Defect("transactions", self.unposted_pct), "missing rates": Defect("fx_rates", MISSING_PCT, 100 - 100 / len(CURRENCIES))}
        return Plan(t, [lines, Relation("ledger_entries", "accounts"), Relation("budgets", "accounts", 1)], grids=[grid], windows=windows, defects=defects)

    def _of(self, table: str) -> Draws:
        return Draws(self.seed, f"finance.{table}")

    @property
    def unposted(self) -> int:
        return synth.count_of(self.targets["transactions"], self.unposted_pct) if self.unposted_pct else 0

    @property
    def days(self) -> list[str]:
        """The days that have rates: one after another from the first, without the boundaries among them, and the boundaries."""
        first, wanted, out = datetime.date.fromisoformat(ACTIVITY), self.targets["fx_rates"] // len(CURRENCIES) - len(self.boundaries), []
        while len(out) < wanted:
            out += [str(first)] * (str(first) not in self.boundaries)
            first += datetime.timedelta(days=1)
        return out

    # hierarchy: roots, accounts below roots, and accounts below these; an account's type is its root's

    @property
    def roots(self) -> int:
        return max(len(TYPES), self.targets["accounts"] * 15 // 100)

    @property
    def middle(self) -> int:
        """The last account that is a child of a root."""
        return self.roots + max(1, (self.targets["accounts"] - self.roots) // 2)

    def parent_of(self, account: Column) -> Column:
        d = self._of("accounts")
        upper = d.whole("parent", 1, self.roots, account)
        lower = d.whole("parent", self.roots + 1, self.middle, account)
        return F.when((account > self.roots) & (account <= self.middle), upper).when(account > self.middle, lower)

    def type_of(self, account: Column) -> Column:
        own = lambda k: F.coalesce(*(F.when(k == i, t) for i, t in enumerate(TYPES, 1)), self._of("accounts").weighted("type", TYPES, k))
        above = F.coalesce(self.parent_of(account), account)
        return own(F.coalesce(self.parent_of(above), above))

    # tables

    def accounts(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("accounts"), F.col("account_id")
        rows = keys(spark, self.targets["accounts"], "account_id").withColumn("account_type", self.type_of(k))
        subtype = F.coalesce(*(F.when(F.col("account_type") == t, d.one("subtype", names, k)) for t, names in SUBTYPES.items()))
        created = d.moment("created_at", F.lit(CREATED).cast("timestamp"), F.lit(ACTIVITY).cast("timestamp"), k)
        rows = rows.withColumn("account_subtype", subtype)
        return rows.select(k, F.format_string("ACC-%06d", k).alias("account_number"), F.concat_ws(" ", "account_subtype", k.cast("string")).alias("account_name"), "account_type", "account_subtype", d.weighted("currency", CURRENCIES, k).alias("currency_code"), self.parent_of(k).alias("parent_account_id"), _looked_up(F.col("account_type"), NORMAL).alias("normal_balance"), d.chance("is_active", 0.95, k).alias("is_active"), created.alias("created_at"))

    def transactions(self, spark: SparkSession) -> DataFrame:
        """Boundary dates occur once each, on drawn transactions; the others lie on days that have rates."""
        d, k, days = self._of("transactions"), F.col("transaction_id"), self.days
        # days are at most a few hundred: one for each rate of a currency
        day = F.element_at(F.array(*map(F.lit, days)), d.whole("date", 1, len(days), k).cast("int")).cast("date")
        amount = synth.pareto(d.u("amount", k), 1.16, 10, 10_000_000, 4).cast("decimal(19,4)")
        rows = keys(spark, self.targets["transactions"], "transaction_id").select(k, day.alias("transaction_date"), F.concat(F.lit("Transaction "), k.cast("string")).alias("description"), d.weighted("system", SYSTEMS, k).alias("source_system"), d.weighted("currency", CURRENCIES, k).alias("source_currency"), F.lit("USD").alias("target_currency"), amount.alias("total_amount"), d.chance("reversed", 0.03, k).alias("reversed"))
        rows = rows.withColumn("posted_at", F.timestamp_seconds(F.unix_timestamp(F.date_add("transaction_date", d.whole("lag", *self.lag, k).cast("int")).cast("timestamp")) + d.whole("second", 0, 86_399, k)))
        moved = F.timestamp_seconds(F.unix_timestamp(F.col("_to").cast("timestamp")) + F.unix_timestamp("posted_at") - F.unix_timestamp(F.col("_from").cast("timestamp")))
        return at_boundaries(rows, "transaction_id", "transaction_date", self.boundaries, {"posted_at": moved}, self.seed)

    def ledger_entries(self, transactions: DataFrame) -> DataFrame:
        """Lines in pairs of a debit and a credit that share the amount; of a reversed transaction the sides are swapped."""
        d, k, n = self._of("ledger_entries"), F.col("transaction_id"), self.targets["accounts"]
        posted = transactions
        if self.unposted:
            posted = posted.join(synth.chosen(transactions, "transaction_id", self.unposted, self.seed, "unposted").select("transaction_id"), "transaction_id", "left_anti")
        # an amount has a unit for each pair: the least amount is far above the most pairs that a draw of up to 60 gives
        weighed = posted.select(k, d.u("frequency", k).alias("u")).withColumn("w", synth.poisson(F.col("u"), 3.2).cast("long"))
        pairs = children(fan_out(weighed, "transaction_id", "w", self.targets["ledger_entries"] // 2, least=1), "pair").join(posted, "transaction_id")
        units = (F.col("total_amount") * UNITS).cast("long")
        share = F.floor(units / F.col("units")) + (F.col("position") < units % F.col("units")).cast("long")
        debit = d.whole("debit", 1, n, F.col("pair"))
        credit = (debit - 1 + d.whole("credit", 1, n - 1, F.col("pair"))) % n + 1
        lines = pairs.withColumn("share", (share / F.lit(UNITS)).cast("decimal(19,4)")).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        first = F.col("side") == 0
        is_debit = first != F.col("reversed")
        created = F.timestamp_seconds(F.unix_timestamp("posted_at") + 3600 * d.whole("lag", 0, 48, F.col("pair"), F.col("side")))
        kind = F.when(F.col("reversed"), "Reversal").otherwise(d.weighted("kind", {"Standard": 0.9, "Adjustment": 0.06, "Accrual": 0.04}, F.col("pair")))
        return lines.select((2 * F.col("pair") - 1 + F.col("side")).alias("entry_id"), k, F.when(first, debit).otherwise(credit).alias("account_id"), (2 * F.col("position") + 1 + F.col("side")).cast("int").alias("line_number"), F.when(is_debit, F.col("share")).alias("debit_amount"), F.when(~is_debit, F.col("share")).alias("credit_amount"), F.col("source_currency").alias("currency_code"), kind.alias("posting_type"), created.alias("created_at"))

    def budgets(self, spark: SparkSession) -> DataFrame:
        """Every account has periods of three months, spread over a year; more than four go on in the next."""
        d, k, each = self._of("budgets"), F.col("budget_id"), self.targets["budgets"] // self.targets["accounts"]
        period = F.floor((k - 1) % each * max(1, 4 // each)).cast("int")
        rows = keys(spark, self.targets["budgets"], "budget_id").select(k, (F.floor((k - 1) / each) + 1).alias("account_id"), F.add_months(F.lit(BUDGETS).cast("date"), period * MONTHS).alias("period_start"))
        amount = synth.pareto(d.u("amount", k), 1.35, 10_000, 25_000_000, 4).cast("decimal(19,4)")
        created = F.date_add("period_start", -d.whole("lead", 1, 60, k).cast("int")).cast("timestamp")
        return rows.select(k, "account_id", F.year("period_start").alias("fiscal_year"), "period_start", F.add_months("period_start", MONTHS).alias("period_end"), amount.alias("budget_amount"), F.lit("USD").alias("currency_code"), d.weighted("scenario", SCENARIOS, k).alias("scenario"), created.alias("created_at"))

    def fx_rates(self, spark: SparkSession) -> DataFrame:
        """A rate for every currency and day; steps are bounded by MOVE_BPS of the anchor before they are drawn back to it."""
        d, k, days = self._of("fx_rates"), F.col("rate_id"), [*self.days, *self.boundaries]
        names = list(CURRENCIES)
        place, day = F.floor((k - 1) / len(days)).cast("int"), ((k - 1) % len(days)).cast("int")
        rows = keys(spark, self.targets["fx_rates"], "rate_id").select(k, F.element_at(F.array(*map(F.lit, names)), place + 1).alias("from_currency"), F.lit("USD").alias("to_currency"), F.element_at(F.array(*map(F.lit, days)), day + 1).cast("date").alias("rate_date"))
        anchor = _looked_up(F.col("from_currency"), ANCHORS)
        shock = F.when(F.col("from_currency") == "USD", F.lit(0)).otherwise(d.whole("step", -MOVE_BPS * 6 // 10, MOVE_BPS * 6 // 10, k)).cast("decimal(19,0)") * anchor.cast("decimal(12,6)") / F.lit(10_000).cast("decimal(5,0)")
        rows = rows.withColumn("anchor", anchor).withColumn("shock", shock.cast("decimal(19,10)").cast("string"))
        # a currency is one series, as long as there are days
        rates = windows.mean_reverting(rows, ["from_currency"], "rate_date", "shock", "anchor", pull="0.1").drop("anchor", "shock")
        source = F.when(d.chance("estimated", 0.1, k), "SyntheticEstimated").otherwise("SyntheticDaily")
        return rates.select("rate_id", "from_currency", "to_currency", "rate_date", "rate", source.alias("rate_source"), F.col("rate_date").cast("timestamp").alias("created_at"))

    def missing_rates(self, rates: DataFrame, transactions: DataFrame) -> DataFrame:
        """Rates of which some lost their value, those that transactions ask for first; never an identity or a boundary's."""
        used = transactions.select(F.col("source_currency").alias("from_currency"), F.col("transaction_date").alias("rate_date")).distinct().withColumn("_used", F.lit(True))
        flagged = rates.join(used, ["from_currency", "rate_date"], "left")
        kept = (F.col("from_currency") == "USD") | F.col("rate_date").cast("string").isin(*self.boundaries)
        n = synth.count_of(self.targets["fx_rates"], MISSING_PCT)
        hit = synth.preferred_then_rest(flagged, "rate_id", n, F.col("_used"), self.seed, "missing", kept).withColumn("_hit", F.lit(True))
        return rates.join(hit, "rate_id", "left").withColumn("rate", F.when(F.col("_hit").isNull(), F.col("rate"))).select(*rates.columns)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        transactions = self.transactions(spark)
        return {"accounts": self.accounts(spark), "transactions": transactions, "ledger_entries": self.ledger_entries(transactions), "budgets": self.budgets(spark), "fx_rates": self.missing_rates(self.fx_rates(spark), transactions)}


def generate(spark: SparkSession, targets: dict[str, int] | str = "full", seed: int = 42, **more) -> dict[str, DataFrame]:
    """All tables of a profile or of given row targets."""
    return Finance(TARGETS[targets] if isinstance(targets, str) else targets, seed, **more).tables(spark)
