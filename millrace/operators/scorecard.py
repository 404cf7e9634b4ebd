"""Outcomes of questions rolled up into scorecards, compared with earlier runs and with people's scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The judge's dimensions, the score of an answer that asks back, the gate, and the drop that counts as a regression, in points.
DIMENSIONS = ("factual", "completeness", "format", "sql_quality")
CLARIFICATION_SCORE, GATE_PCT, REGRESSION_POINTS = 2.5, 95.0, 5.0
#: Calibration needs so many anchors, and so large a part of scores within one.
LEAST_ANCHORS, WITHIN_ONE = 10, 0.9


def normalised_score(score: Column) -> Column:
    """1 .. 5 as 0 .. 1."""
    return (score - 1) / 4.0


def roll_up(rows: DataFrame) -> DataFrame:
    """A row per domain (tier ALL) and per domain and tier, from one pass.

    rows: domain, tier, result (pass, fail, not_applicable, error, clarification),
    off_contract, null_handling, the dimensions (null if not judged) and judge_failed. Errors of the platform
    count for nothing else; the percentage is over passes and failures; a
    clarification has an overall score but no dimensions.
    """
    r, error = F.col("result"), F.col("result") == "error"
    judged = ~error & F.col(DIMENSIONS[0]).isNotNull()
    overall = F.when(judged, sum(F.col(d) for d in DIMENSIONS) / len(DIMENSIONS)).when(r == "clarification", CLARIFICATION_SCORE)
    n = lambda c: F.count(F.when(c, 1))
    asked = F.coalesce("null_handling", F.lit("not_applicable")) != "not_applicable"
    passed, eligible = n(r == "pass"), n(r.isin("pass", "fail"))
    measures = [
        F.count("*").alias("questions_total"),
        passed.alias("exact_match_pass"),
        eligible.alias("exact_match_eligible"),
        F.round(passed.cast("double") * 100.0 / F.nullif(eligible, F.lit(0)), 4).alias("exact_match_pct"),
        n(r == "not_applicable").alias("exact_match_not_applicable"),
        n(r == "clarification").alias("exact_match_clarification"),
        n(F.col("off_contract")).alias("expected_answer_off_contract"),
        n(asked).alias("null_handling_applicable"),
        n(F.col("null_handling") == "fail").alias("null_handling_fail"),
        *(F.round(F.avg(F.when(judged, F.col(d))), 4).alias(f"judge_{d}") for d in DIMENSIONS),
        F.round(F.avg(F.when(~error, overall)), 4).alias("judge_overall"),
        n(~error & F.col("judge_failed")).alias("judge_errors"),
        n(error).alias("platform_errors"),
    ]
    both = rows.groupingSets([[F.col("domain")], [F.col("domain"), F.col("tier")]], "domain", "tier")
    out = both.agg(F.grouping("tier").alias("_all"), *measures)
    return out.withColumn("tier", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("tier"))).drop("_all")


def regressions(card: DataFrame, baseline: DataFrame) -> DataFrame:
    """card with baseline_exact_match_pct, delta_pct and regression_flag; a flag needs both sides. baseline: domain, pct."""
    base = baseline.select("domain", F.col("pct").alias("baseline_exact_match_pct"))
    delta = F.round(F.col("exact_match_pct") - F.col("baseline_exact_match_pct"), 4)
    return card.join(base, "domain", "left").withColumn("delta_pct", delta).withColumn("regression_flag", F.coalesce(F.col("delta_pct") <= -REGRESSION_POINTS, F.lit(False)))


def gate_checklist(card: DataFrame) -> DataFrame:
    """(domain, exact_match_pct, passed) of the domains' roll-ups."""
    return card.where("tier = 'ALL'").select("domain", "exact_match_pct", F.coalesce(F.col("exact_match_pct") >= GATE_PCT, F.lit(False)).alias("passed"))


def tier_quota(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """(domain, tier, quota, n, verdict) of quotas (domain, tier, quota): ok, SHORT or over."""
    counts = rows.groupBy("domain", "tier").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return quotas.join(counts, ["domain", "tier"], "left").select("domain", "tier", "quota", n.alias("n"), F.when(n < F.col("quota"), "SHORT").when(n > F.col("quota"), "over").otherwise("ok").alias("verdict"))


def merge_runs(base: DataFrame, rerun: DataFrame, key: str = "question_id") -> DataFrame:
    """base with the rows that a rerun has anew; questions that base lacks are left out."""
    new = rerun.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("_new"))
    joined = base.join(new, key, "left")
    return joined.select(*(F.col(c) if c == key else F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in base.columns))


def compare_runs(before: DataFrame, after: DataFrame, key: str = "question_id") -> DataFrame:
    """(key, before, after, change): cleared, regressed, still failing, still passing, added or removed."""
    a, b = (x.select(key, F.col("result").alias(n)) for x, n in ((before, "before"), (after, "after")))
    ok = lambda c: F.col(c) == "pass"
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(~ok("before") & ok("after"), "cleared").when(ok("before") & ~ok("after"), "regressed").when(ok("after"), "still passing").otherwise("still failing")
    return a.join(b, key, "full").withColumn("change", change)


def failure_histogram(rows: DataFrame, top: int = 6) -> DataFrame:
    """The most frequent first clauses of failures' details, with quoted texts and numbers made alike."""
    clause = F.trim(F.element_at(F.split("detail", ";"), 1))
    kind = F.regexp_replace(F.regexp_replace(clause, r"'[^']*'", "'..'"), r"\d+(?:\.\d+)?", "#")
    return rows.where("result = 'fail'").groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(top)


def calibration(anchors: DataFrame) -> DataFrame:
    """One row: anchors, within_one, flips and passed, from (anchor_id, dimension, human, judge) rows with scores of 1 to 5.

    A flip is a 5 against a 1 or 2. constant_ok: whether some judge that always gives the same score
    would pass as well, in which case the anchors prove nothing.
    """
    flip = lambda a, b: ((a == 5) & (b <= 2)) | ((b == 5) & (a <= 2))
    h, j = F.col("human"), F.col("judge")
    own = anchors.agg(F.count_distinct("anchor_id").alias("anchors"), F.round(F.avg((F.abs(h - j) <= 1).cast("double")), 4).alias("within_one"), F.coalesce(F.sum(flip(h, j).cast("long")), F.lit(0)).alias("flips"))
    # five fixed scores against every anchor
    fixed = anchors.select("human", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("c")).groupBy("c").agg(F.avg((F.abs(h - F.col("c")) <= 1).cast("double")).alias("w"), F.sum(flip(h, F.col("c")).cast("long")).alias("f"))
    lazy = fixed.agg(F.coalesce(F.max(((F.col("w") >= WITHIN_ONE) & (F.col("f") == 0)).cast("int")) == 1, F.lit(False)).alias("constant_ok"))
    out = own.crossJoin(F.broadcast(lazy))
    return out.withColumn("passed", (F.col("anchors") >= LEAST_ANCHORS) & (F.col("within_one") >= WITHIN_ONE) & (F.col("flips") == 0) & ~F.col("constant_ok"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """The run with the largest id of each domain."""
    rest = [c for c in runs.columns if c not in ("domain", "run_id")]
    return runs.groupBy("domain").agg(F.max_by(F.struct("run_id", *rest), "run_id").alias("_r")).select("domain", "_r.*")


def release_blockers(runs: DataFrame) -> DataFrame:
    """(domain, run_id, blocker) for each reason why a run cannot be released.

    runs: domain, run_id, mode, calibrated, default_policy, temperature_enforced,
    seed_enforced, platform_errors, judge_errors, dataset_version, platform_version.
    """
    versions = runs.agg(F.count_distinct("platform_version").alias("_versions"))
    rules = {
        "not a release run": F.col("mode") != "RELEASE",
        "judge not calibrated": ~F.col("calibrated"),
        "comparison policy relaxed": ~F.col("default_policy"),
        "temperature not enforced": ~F.col("temperature_enforced"),
        "seed not enforced": ~F.col("seed_enforced"),
        "platform errors": F.col("platform_errors") > 0,
        "judge errors": F.col("judge_errors") > 0,
        "several platform versions": F.col("_versions") > 1,
    }
    # one row: the number of versions
    found = runs.crossJoin(F.broadcast(versions)).withColumn("blocker", F.explode(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items())))))
    return found.select("domain", "run_id", "blocker")


def rerun_selection(rows: DataFrame, pairs: DataFrame, ambiguous: Column, key: str = "question_id") -> DataFrame:
    """The pairs to ask again: those whose row did not pass, without those whose wording allows another reading; rows without a pair are left out.

    ambiguous is over the joined row and pair, see runs.ambiguous.
    """
    open_ = rows.where(F.col("result") != "pass").join(pairs, key).where(~F.coalesce(ambiguous, F.lit(False))).select(key)
    return pairs.join(open_, key, "left_semi")


def aggregates_used(sql: Column) -> Column:
    """The set of aggregate functions that a SQL text calls."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.lower(F.coalesce(sql, F.lit(""))), F.lit(r"\b(count|sum|avg|min|max)\s*\("), F.lit(1)), lambda x: x)))
