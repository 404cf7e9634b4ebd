"""The six CRM tables, generated from row targets and rules.

Each table is a function of its keys; memberships and interactions are shared out over contacts with exact totals.
`generate` gives all of them, `with_boundaries` the cases with their boundary dates.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import synth
from millrace.operators.generate import Draws, at_boundaries, children, fan_out, keys, turned
from millrace.sources.feasibility import Bridge, Plan, Relation, Window, require_feasible

#: The rows of each table by profile, and the rules of the CRM contract.
TARGETS = {
    "dev": {"accounts": 100, "contacts": 300, "campaigns": 50, "contact_campaigns": 750, "interactions": 1000, "support_cases": 800},
    "full": {"accounts": 24000, "contacts": 48000, "campaigns": 5000, "contact_campaigns": 180000, "interactions": 200000, "support_cases": 144000},
}
TODAY, EARLIEST, ACTIVITY = "2026-08-01", "2022-01-01", "2023-01-01"
BOUNDARIES = ("1900-01-01", "2038-01-19", "2099-12-31", "2026-08-01")
INDUSTRIES = ("Technology", "Healthcare", "FinancialServices", "Retail", "Manufacturing", "Education", "Energy")
REGIONS = ("North", "South", "East", "West", "Central")
TIERS = {"Standard": 0.62, "Preferred": 0.28, "Strategic": 0.1}
TITLES = ("Customer Success Manager", "Operations Director", "Procurement Manager", "IT Director", "Business Analyst", "Service Delivery Manager", "Program Manager")
CAMPAIGN_TYPES = ("Awareness", "Nurture", "Retention", "Reengagement", "CustomerEducation")
CHANNELS = ("Email", "Phone", "Web", "Webinar", "Event", "Social")
CAMPAIGN_STATUSES = {"Draft": 0.1, "Scheduled": 0.12, "Active": 0.24, "Completed": 0.44, "Cancelled": 0.1}
MEMBER_STATUSES = ("Targeted", "Sent", "Engaged", "Responded", "Converted", "OptedOut")
ENGAGEMENTS = {"EmailOpen": ("Email", 1), "LinkClick": ("Web", 3), "FormSubmission": ("Web", 8), "PhoneCall": ("Phone", 5), "Meeting": ("Phone", 10), "WebinarAttendance": ("Webinar", 7), "EventAttendance": ("Event", 8)}
CASE_STATUSES = {"New": 0.16, "InProgress": 0.24, "PendingCustomer": 0.14, "Resolved": 0.3, "Closed": 0.16}
PRIORITIES = {"Low": 0.28, "Medium": 0.42, "High": 0.23, "Critical": 0.07}
SLA_HOURS = {"Low": 72, "Medium": 48, "High": 24, "Critical": 4}
SUBJECTS = {"ProductIssue": "Product behavior requires investigation", "Billing": "Billing statement requires review", "Access": "User access requires assistance", "Integration": "Integration connection requires support", "ServiceRequest": "Customer service request", "GeneralInquiry": "General customer inquiry"}
#: Attribution weights are shared out in units of 1 / UNITS.
UNITS = 10_000
_SYLLABLES = ("ba", "cor", "del", "fen", "gal", "hol", "jor", "kel", "lan", "mor", "nev", "or", "pel", "rin", "sol", "tar")


def _looked_up(value: Column, table: dict) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), value)


def _required(key: Column, wanted: tuple[str, ...], otherwise: Column) -> Column:
    """The first rows have the values that must occur."""
    return F.coalesce(*(F.when(key == i, v) for i, v in enumerate(wanted, 1)), otherwise)


@dataclass(frozen=True)
class Crm:
    """Draws of the tables' columns by key; targets are checked before anything runs."""

    targets: dict[str, int]
    seed: int = 42
    today: str = TODAY

    def __post_init__(self):
        t = self.targets
        if min(t.values()) < 1:
            raise ValueError("every table needs a row")
        require_feasible(self.plan)

    @property
    def plan(self) -> Plan:
        """What the targets have to leave room for."""
        relations = [Relation("contacts", "accounts"), Relation("contact_campaigns", "contacts", 1), Relation("contact_campaigns", "campaigns", 1), Relation("interactions", "contacts"), Relation("support_cases", "accounts")]
        windows = {"accounts": Window(EARLIEST, self.today), "activity": Window(ACTIVITY, self.today, after="accounts")}
        return Plan(self.targets, relations, [Bridge("contact_campaigns", "contacts", "campaigns")], windows=windows)

    def _of(self, table: str) -> Draws:
        return Draws(self.seed, f"crm.{table}")

    @cached_property
    def reference(self) -> Column:
        return F.lit(self.today).cast("timestamp")

    # what other tables ask about a parent, by its key alone; nothing of one that is null

    def account_created(self, account: Column) -> Column:
        return F.when(account.isNotNull(), self._of("accounts").moment("created_at", F.lit(EARLIEST).cast("timestamp"), self.reference, account))

    def account_of(self, contact: Column) -> Column:
        d, n = self._of("contacts"), max(1, self.targets["accounts"] * 9 // 10)
        return F.when(~d.chance("unassigned", 0.05, contact) & (contact != self.targets["contacts"]), d.whole("account_id", 1, n, contact))

    def campaign_status(self, campaign: Column) -> Column:
        return _required(campaign, ("Completed", "Active", "Scheduled"), self._of("campaigns").weighted("status", CAMPAIGN_STATUSES, campaign))

    def campaign_start(self, campaign: Column) -> Column:
        d, today = self._of("campaigns"), F.lit(self.today).cast("date")
        past = F.date_add(F.lit(ACTIVITY).cast("date"), d.whole("start_date", 0, F.datediff(today, F.lit(ACTIVITY).cast("date")), campaign).cast("int"))
        start = F.when(self.campaign_status(campaign).isin("Draft", "Scheduled"), F.date_add(today, d.whole("start_date", 1, 180, campaign).cast("int"))).otherwise(past)
        return F.when(campaign.isNotNull(), start)

    def campaign_end(self, campaign: Column) -> Column:
        d, today, start, status = self._of("campaigns"), F.lit(self.today).cast("date"), self.campaign_start(campaign), self.campaign_status(campaign)
        days = F.when(status == "Scheduled", d.whole("end_date", 30, 120, campaign)).otherwise(d.whole("end_date", 7, 120, campaign))
        end = F.date_add(start, days.cast("int"))
        # what is over has ended by today
        return F.when(status == "Scheduled", end).when(status.isin("Completed", "Cancelled"), F.greatest(start, F.least(end, today)))

    def window(self, campaign: Column) -> tuple[Column, Column]:
        """When a campaign's members can be met: to its end; of those without one to today, or 90 days from a start that is to come."""
        start, end, today = self.campaign_start(campaign), self.campaign_end(campaign), F.lit(self.today).cast("date")
        last = F.coalesce(end, F.when(start > today, F.date_add(start, 90)).when(start.isNotNull(), today))
        return start.cast("timestamp"), last.cast("timestamp")

    # tables

    def accounts(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("accounts"), F.col("account_id")
        rows = keys(spark, self.targets["accounts"], "account_id")
        return rows.select(k, F.concat_ws(" ", d.word("name", _SYLLABLES, 3, k), d.one("form", ("Group", "Partners", "Works", "Systems"), k)).alias("account_name"), d.whole("account_size", 10, 5000, k).alias("account_size"), d.one("industry", INDUSTRIES, k).alias("industry"), d.one("region", REGIONS, k).alias("region"), d.weighted("customer_tier", TIERS, k).alias("customer_tier"), d.chance("is_active", 0.88, k).alias("is_active"), self.account_created(k).alias("created_at"))

    def contacts(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("contacts"), F.col("contact_id")
        first, last = d.word("first_name", _SYLLABLES, 2, k), d.word("last_name", _SYLLABLES, 3, k)
        account = self.account_of(k)
        since = F.coalesce(self.account_created(account), F.lit(EARLIEST).cast("timestamp"))
        rows = keys(spark, self.targets["contacts"], "contact_id")
        address = F.concat(d.whole("number", 1, 999, k).cast("string"), F.lit(" "), d.word("street", _SYLLABLES, 2, k), F.lit(" Street"))
        return rows.select(k, account.alias("account_id"), first.alias("first_name"), last.alias("last_name"), F.lower(F.concat(first, F.lit("."), last, k.cast("string"), F.lit("@example.com"))).alias("email"), address.alias("address"), d.one("title", TITLES, k).alias("title"), d.chance("is_active", 0.9, k).alias("is_active"), d.moment("created_at", since, self.reference, k).alias("created_at"))

    def campaigns(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("campaigns"), F.col("campaign_id")
        rows = keys(spark, self.targets["campaigns"], "campaign_id")
        budget = F.when(~d.chance("no budget", 0.1, k), synth.pareto(d.u("budget", k), 1.16, 5_000, 250_000)).cast("decimal(15,2)")
        kind, start = d.one("type", CAMPAIGN_TYPES, k), self.campaign_start(k)
        created = F.least(F.date_add(start, -d.whole("lead", 1, 120, k).cast("int")), F.lit(self.today).cast("date")).cast("timestamp")
        return rows.select(k, F.concat_ws(" ", kind, F.lit("Campaign"), k.cast("string")).alias("campaign_name"), kind.alias("campaign_type"), d.one("channel", CHANNELS, k).alias("primary_channel"), self.campaign_status(k).alias("status"), start.alias("start_date"), self.campaign_end(k).alias("end_date"), budget.alias("budget_amount"), F.lit("USD").alias("currency_code"), created.alias("created_at"))

    def shares(self, spark: SparkSession) -> DataFrame:
        """(contact_id, units, first) of memberships: every contact has one at least."""
        k, n = F.col("contact_id"), self.targets["campaigns"]
        weighed = keys(spark, self.targets["contacts"], "contact_id").withColumn("w", self._of("contact_campaigns").whole("weight", 1, 8, k))
        return fan_out(weighed, "contact_id", "w", self.targets["contact_campaigns"], least=1, most=n)

    def campaign_of(self, member: Column) -> Column:
        """The campaign of a membership by its number: numbers in a row, such as a contact's, have different ones, and all campaigns come up before any does again."""
        return turned(member - 1, self.targets["campaigns"], self.seed) + 1

    def contact_campaigns(self, spark: SparkSession) -> DataFrame:
        d, campaign = self._of("contact_campaigns"), self.campaign_of(F.col("member"))
        rows = children(self.shares(spark), "member").withColumn("campaign_id", campaign)
        start, end = self.window(F.col("campaign_id"))
        first = d.moment("first_touch_at", start, end, F.col("member"))
        units = F.floor(F.lit(UNITS) / F.col("units")) + (F.col("position") < F.lit(UNITS) % F.col("units")).cast("long")
        return rows.select("contact_id", "campaign_id", d.one("member_status", MEMBER_STATUSES, F.col("member")).alias("member_status"), first.alias("first_touch_at"), d.moment("last_touch_at", first, end, F.col("member")).alias("last_touch_at"), (units / F.lit(UNITS)).cast("decimal(5,4)").alias("attribution_weight"), (F.col("position") == 0).alias("is_primary_attribution"), first.alias("created_at"))

    def interactions(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("interactions"), F.col("interaction_id")
        pool, limit = max(1, self.targets["contacts"] * 85 // 100), max(1, self.targets["campaigns"] * 8 // 10)
        shares = self.shares(spark).where(F.col("contact_id") <= pool)
        # how many a contact has is a Poisson draw; a draw of 0 leaves it without
        weighed = shares.select("contact_id", F.col("units").alias("members"), F.col("first").alias("first_member"), d.u("frequency", F.col("contact_id")).alias("u"))
        weighed = weighed.withColumn("w", synth.poisson(F.col("u"), 3.2).cast("long")).drop("u")
        rows = children(fan_out(weighed, "contact_id", "w", self.targets["interactions"]), "interaction_id").drop("units", "position").join(weighed.drop("w"), "contact_id")
        member = F.col("first_member") + 1 + F.least(F.floor(d.u("membership", k) * F.col("members")).cast("long"), F.col("members") - 1)
        rows = rows.withColumn("asked", self.campaign_of(member))
        begun = self.campaign_start(F.col("asked")).cast("timestamp") <= self.reference
        organic = (k == 1) | d.chance("organic", 0.3, k) | (F.col("asked") > limit) | ~begun
        rows = rows.withColumn("campaign_id", F.when(~organic, F.col("asked")))
        start, end = self.window(F.col("campaign_id"))
        at = d.moment("interaction_at", F.coalesce(start, F.lit(ACTIVITY).cast("timestamp")), F.least(end, self.reference), k)
        rows = rows.withColumn("engagement_type", d.one("engagement_type", tuple(ENGAGEMENTS), k)).withColumn("interaction_at", at)
        created = F.least(F.timestamp_seconds(F.unix_timestamp("interaction_at") + 3600 * d.whole("lag", 0, 48, k)), self.reference)
        account = F.when(~d.chance("no account", 0.1, k), self.account_of(F.col("contact_id")))
        return rows.select(k, "contact_id", account.alias("account_id"), "campaign_id", "engagement_type", _looked_up(F.col("engagement_type"), {e: c for e, (c, _) in ENGAGEMENTS.items()}).alias("channel"), d.one("direction", ("Inbound", "Outbound"), k).alias("direction"), _looked_up(F.col("engagement_type"), {e: p for e, (_, p) in ENGAGEMENTS.items()}).alias("engagement_points"), "interaction_at", created.alias("created_at"))

    def support_cases(self, spark: SparkSession) -> DataFrame:
        d, k = self._of("support_cases"), F.col("case_id")
        contact = F.when(d.chance("contact", 0.75, k), d.whole("contact_id", 1, max(1, self.targets["contacts"] * 7 // 10), k))
        own = self.account_of(contact)
        rows = keys(spark, self.targets["support_cases"], "case_id").select(k, F.when(own.isNotNull(), contact).alias("contact_id"), F.coalesce(own, d.whole("account_id", 1, self.targets["accounts"], k)).alias("account_id"), _required(k, ("Resolved", "New"), d.weighted("status", CASE_STATUSES, k)).alias("status"), d.weighted("priority", PRIORITIES, k).alias("priority"), d.one("category", tuple(SUBJECTS), k).alias("category"))
        resolved = F.col("status").isin("Resolved", "Closed")
        latest = F.when(resolved, F.date_add(F.lit(self.today).cast("date"), -7).cast("timestamp")).otherwise(self.reference)
        rows = rows.withColumn("opened_at", d.moment("opened_at", F.lit(ACTIVITY).cast("timestamp"), latest, k)).withColumn("hours", _looked_up(F.col("priority"), SLA_HOURS))
        later = lambda hours: F.timestamp_seconds(F.unix_timestamp("opened_at") + 3600 * hours)
        done = F.when(resolved, F.least(later(d.whole("resolution", 1, 2 * F.col("hours"), k)), self.reference))
        return rows.select(k, "account_id", "contact_id", F.format_string("CASE-%08d", k).alias("case_number"), _looked_up(F.col("category"), SUBJECTS).alias("subject"), "category", "priority", "status", "opened_at", later(F.col("hours")).alias("sla_due_at"), done.alias("resolved_at"), F.least(later(d.whole("lag", 0, 2, k)), self.reference).alias("created_at"))

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: getattr(self, name)(spark) for name in TARGETS["full"]}


def with_boundaries(cases: DataFrame, values: tuple[str, ...] = BOUNDARIES, seed: int = 42) -> DataFrame:
    """Cases in which drawn rows open at each boundary once; the deadline follows from the priority, other moments keep their distance from the opening."""
    moved = lambda c: F.timestamp_seconds(F.unix_timestamp("_to") + F.unix_timestamp(c) - F.unix_timestamp("_from"))
    due = F.timestamp_seconds(F.unix_timestamp("_to") + 3600 * _looked_up(F.col("priority"), SLA_HOURS))
    return at_boundaries(cases, "case_id", "opened_at", values, {"sla_due_at": due, "resolved_at": moved("resolved_at"), "created_at": moved("created_at")}, seed)


def generate(spark: SparkSession, targets: dict[str, int] | str = "full", seed: int = 42) -> dict[str, DataFrame]:
    """All tables of a profile or of given row targets, with boundary cases."""
    tables = Crm(TARGETS[targets] if isinstance(targets, str) else targets, seed).tables(spark)
    return tables | {"support_cases": with_boundaries(tables["support_cases"], seed=seed)}
