"""Runs of questions over time: baselines, combined scorecards, judges' licences, rephrased groups, lost runs.

What is one document for each run or platform stays on the driver; rows of questions stay distributed.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.files import write_manifest

from .scorecard import DIMENSIONS, aggregates_used, latest_runs, regressions, release_blockers, roll_up


def baseline_path(folder: str, platform_version: str) -> str:
    return os.path.join(folder, "".join(c if c.isalnum() or c in "._-" else "_" for c in platform_version) + ".json")


def establish_baseline(folder: str, platform_version: str, percents: Mapping[str, float], *, run_id: str, dataset_version: str, provisional: bool = False) -> str:
    """Write a platform version's baseline, once and read-only; an existing one, or one without domains, is an error."""
    if not percents:
        raise ValueError("a baseline has the percentage of one domain at least")
    path = baseline_path(folder, platform_version)
    os.makedirs(folder, exist_ok=True)
    write_manifest(path, {"platform_version": platform_version, "dataset_version": dataset_version, "run_id": run_id, "provisional": provisional, "domains": {d: round(float(p), 4) for d, p in percents.items()}})
    os.chmod(path, 0o444)
    return path


def load_baseline(spark, folder: str, platform_version: str) -> DataFrame | None:
    """(domain, pct) of a platform version, or None before it has any."""
    path = Path(baseline_path(folder, platform_version))
    if not path.exists():
        return None
    return spark.createDataFrame(sorted(json.loads(path.read_text(encoding="utf-8"))["domains"].items()), "domain string, pct double")


def combine(rows: DataFrame, runs: DataFrame, baseline: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scorecard, blockers, the runs that are in it) of the latest run of each domain.

    rows: what roll_up takes, and run_id; runs: what release_blockers takes. A scorecard is a release
    if there is no blocker, and a preview otherwise. Rows of other runs are left out.
    """
    taken = latest_runs(runs)
    card = roll_up(rows.join(taken.select("domain", "run_id"), ["domain", "run_id"], "left_semi"))
    return (card if baseline is None else regressions(card, baseline)), release_blockers(taken), taken


#: What a judge is known by.
JUDGE_FIELDS = ("model_version", "prompt_version", "mode")


def licensed(marker: str, judge: Mapping[str, str] | None = None) -> tuple[bool, str]:
    """Whether a calibration marker on disk licenses a judge, and why not; without a judge, whether there is a marker that names one."""
    try:
        earned = json.loads(Path(marker).read_text(encoding="utf-8")).get("judge")
    except FileNotFoundError:
        return False, "no marker"
    except (ValueError, AttributeError, OSError) as error:
        return False, f"the marker cannot be read: {error}"
    if not isinstance(earned, Mapping):
        return False, "the marker names no judge"
    other = [f"{f}: {earned.get(f, '')!r}, not {judge.get(f, '')!r}" for f in JUDGE_FIELDS if str(earned.get(f, "")) != str(judge.get(f, ""))] if judge is not None else []
    return not other, "earned by another judge: " + "; ".join(other) if other else "licensed"


def rephrase_integrity(df: DataFrame, group: str = "rephrase_group_id", result: str = "result_hash", base: str = "is_base") -> DataFrame:
    """(group, members, bases, hashes, sound): a sound group has one base question, and all its variants give the base's result."""
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("members"), F.sum(F.col(base).cast("int")).alias("bases"), F.count_distinct(F.coalesce(result, F.lit(""))).alias("hashes"))
    return g.withColumn("sound", (F.col("bases") == 1) & (F.col("hashes") == 1))


def ambiguous(reference_sql: Column, answer_sql: Column, bridges: Sequence[str] = ("contacts",)) -> Column:
    """Whether a failure is the question's: the answer's SQL lacks an aggregate, or a bridge table, that the reference has; an answer without SQL is not."""
    names = lambda sql, table: F.coalesce(sql, F.lit("")).rlike(rf"(?i)\b{table}\b")
    path = F.lit(False)
    for table in bridges:
        path = path | (names(reference_sql, table) & ~names(answer_sql, table))
    metric = F.size(F.array_except(aggregates_used(reference_sql), aggregates_used(answer_sql))) > 0
    return (F.trim(F.coalesce(answer_sql, F.lit(""))) != "") & (metric | path)


def rebuilt_rows(questions: DataFrame) -> DataFrame:
    """The rows of a run from its written scorecard, all columns of which are texts.

    Empty texts are nulls again, but for the answer; scores are whole numbers if all four dimensions are
    there, and else null; the one rationale that was written stands for all dimensions.
    """
    text = lambda c: F.nullif(F.trim(c), F.lit("")) if c in questions.columns else F.lit(None).cast("string")
    scores = [text(f"judge_{d}").cast("double") for d in DIMENSIONS]
    judged = scores[0].isNotNull()
    for s in scores[1:]:
        judged = judged & s.isNotNull()
    flag = lambda c: F.coalesce(F.lower(text(c)).isin("true", "1", "yes"), F.lit(False))
    kept = [F.col(c) for c in ("question_id", "domain", "tier", "natural_language_question", "expected_answer")]
    return questions.select(
        *kept,
        F.coalesce(text("actual_answer"), F.lit("")).alias("actual_answer"),
        F.col("exact_match_result").alias("result"),
        F.coalesce(text("exact_match_detail"), F.lit("")).alias("detail"),
        flag("expected_answer_off_contract").alias("off_contract"),
        *(text(c).alias(c) for c in ("platform_generated_sql", "null_handling", "rephrase_group_id")),
        *(F.when(judged, s.cast("int")).alias(d) for d, s in zip(DIMENSIONS, scores, strict=True)),
        F.when(judged, F.coalesce(text("judge_rationale"), F.lit("recovered from the scorecard"))).alias("rationale"),
        (F.col("exact_match_result") == "clarification").alias("asked_back"),
        F.when(~judged, text("platform_error")).alias("platform_error"),
        F.when(~judged & text("platform_error").isNull(), text("judge_error")).alias("judge_error"),
        text("judge_error").isNotNull().alias("judge_failed"),
    )
