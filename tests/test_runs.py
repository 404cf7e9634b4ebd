"""Baselines, combined scorecards, licences, rebuilt runs, configurations and the family driver."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import runs, scorecard
from millrace.plans import driver
from millrace.plans.catalog import FAMILIES
from millrace.plans.demo import demo_tables
from millrace.sources import config
from millrace.sources.files import open_typed

SF = "/root/testdata/sf0.001"


def test_a_baseline_is_written_once(spark, tmp_path):
    folder = str(tmp_path / "b")
    assert runs.load_baseline(spark, folder, "v 1/2") is None
    path = runs.establish_baseline(folder, "v 1/2", {"sales": 80.123456, "crm": 99}, run_id="r", dataset_version="d")
    assert os.path.dirname(path) == folder and not os.stat(path).st_mode & 0o222
    assert [tuple(r) for r in runs.load_baseline(spark, folder, "v 1/2").collect()] == [("crm", 99.0), ("sales", 80.1235)]
    with pytest.raises(FileExistsError):
        runs.establish_baseline(folder, "v 1/2", {"crm": 1.0}, run_id="r", dataset_version="d")
    with pytest.raises(ValueError, match="one domain"):
        runs.establish_baseline(folder, "v2", {}, run_id="r", dataset_version="d")


def test_combining_takes_the_latest_run_of_each_domain(spark):
    rows = spark.createDataFrame([("crm", 1, "T1", "fail"), ("crm", 2, "T1", "pass"), ("crm", 2, "T2", "fail"), ("sales", 5, "T1", "pass")], "domain string, run_id int, tier string, result string")
    for d in (*scorecard.DIMENSIONS,):
        rows = rows.withColumn(d, F.lit(4))
    rows = rows.withColumns({"off_contract": F.lit(False), "null_handling": F.lit("not_applicable"), "judge_failed": F.lit(False)})
    fields = "domain string, run_id int, mode string, calibrated boolean, default_policy boolean, temperature_enforced boolean, seed_enforced boolean, platform_errors int, judge_errors int, dataset_version string, platform_version string"
    good = ("RELEASE", True, True, True, True, 0, 0, "d", "p")
    table = spark.createDataFrame([("crm", 1, "PREVIEW", *good[1:]), ("crm", 2, *good), ("sales", 5, *good)], fields)
    card, blockers, taken = runs.combine(rows, table, spark.createDataFrame([("crm", 60.0)], "domain string, pct double"))
    got = {(r.domain, r.tier): (r.exact_match_pct, r.regression_flag) for r in card.collect()}
    assert got["crm", "ALL"] == (50.0, True) and got["sales", "ALL"] == (100.0, False) and ("crm", "T2") in got
    assert blockers.count() == 0 and taken.count() == 2


def test_markers_license_the_judge_that_earned_them(tmp_path):
    judge = {"model_version": "m", "prompt_version": "p", "mode": "strict"}
    marker = tmp_path / "m.json"
    assert runs.licensed(str(marker)) == (False, "no marker")
    marker.write_text("not json")
    assert not runs.licensed(str(marker))[0]
    marker.write_text("{}")
    assert runs.licensed(str(marker)) == (False, "the marker names no judge")
    marker.write_text(json.dumps({"judge": judge}))
    assert runs.licensed(str(marker))[0] and runs.licensed(str(marker), judge) == (True, "licensed")
    assert runs.licensed(str(marker), {**judge, "mode": "lax"})[1] == "earned by another judge: mode: 'strict', not 'lax'"


def test_rows_are_rebuilt_from_texts(spark):
    names = "question_id domain tier natural_language_question expected_answer actual_answer exact_match_result expected_answer_off_contract judge_factual judge_completeness judge_format judge_sql_quality platform_error judge_error".split()
    written = spark.createDataFrame([("1", "crm", "T1", "q", "5", "5", "pass", "True", "5", "4.0", "3", "2", "", ""), ("2", "crm", "T1", "q", "5", "", "error", "", "", "4", "3", "2", "down", ""), ("3", "crm", "T1", "q", "5", "?", "clarification", "false", "", "", "", "", "", "timeout")], names)
    got = {r.question_id: r for r in runs.rebuilt_rows(written).collect()}
    assert (got["1"].factual, got["1"].sql_quality, got["1"].off_contract, got["1"].rationale) == (5, 2, True, "recovered from the scorecard")
    assert got["2"].factual is None and got["2"].completeness is None and got["2"].platform_error == "down" and got["2"].actual_answer == ""
    assert got["3"].asked_back and got["3"].judge_error == "timeout" and got["3"].platform_generated_sql is None
    assert scorecard.roll_up(runs.rebuilt_rows(written)).where("tier = 'ALL'").first().questions_total == 3


def test_presets_and_configurations_are_checked_as_a_whole():
    presets = {"amounts": {"name": "pareto", "alpha": 1.5, "least": 1, "most": 9}}
    assert config.resolve_presets(presets, {"deal": {"preset": "amounts", "most": 5}}) == {"deal": {"name": "pareto", "alpha": 1.5, "least": 1, "most": 5}}
    for bad, why in (({"preset": "x"}, "no preset 'x'"), ({"preset": "amounts", "beta": 1}, "pareto has no beta"), ({"preset": "amounts", "most": 0}, "least is above most"), ({"preset": "amounts", "alpha": 0}, "alpha is above 0")):
        with pytest.raises(ValueError, match=why):
            config.resolve_presets(presets, {"deal": bad})
    columns = {"a": ["id"], "b": ["id", "a_id"], "c": ["id"]}
    fine = {"row_targets": {"a": 1, "b": 2, "c": 3}, "weights": {"x": {"p": 0.5, "q": 0.5}}, "relationships": [("b", "a_id", "a", "id")], "percents": {"null": 2.5}, "join_paths": [["a", "b"]]}
    assert config.check_config(fine, columns) == []
    bad = {"row_targets": {"a": 0, "z": 1, "b": 300_000}, "weights": {"x": {"p": 0.6, "q": 0.5}}, "relationships": [("b", "a_id", "a", "key")], "percents": {"null": 101}, "join_paths": [["a", "b"]], "more": 1}
    assert len(config.check_config(bad, columns)) == 9
    assert config.resolve_path("out/{domain}", "/base", domain="crm") == "/base/out/crm"
    with pytest.raises(ValueError, match="out of /base"):
        config.resolve_path("../{x}", "/base", x="y")


def test_the_driver_makes_all_or_nothing(spark):
    t = demo_tables(spark, SF, "crm")
    values = driver.catalog(t, {"region": "accounts.region", "priority": ["High", "None of these", "Low"]})
    assert driver.combinations(["a", "b"], {"a": [1, 2], "b": [3, 4]}) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
    families = [FAMILIES["crm:T1-06"], FAMILIES["crm:T2-02"]]
    made = driver.build(t, families, {"crm:T1-06": 5, "crm:T2-02": 1}, {"T1": 5, "T2": 1}, values, phrases={"High": "of high priority"})
    assert [q.question_id for q in made] == [*(f"QA-crm:T1-06-{i:02d}" for i in range(1, 6)), "QA-crm:T2-02-01"]
    assert made[-1].question.endswith("(priority: of high priority)") and " | " in made[-1].expected_answer and "support_cases" in made[-1].reference_sql
    # a value that no row has gives no top tier: the tier is short, and nothing comes back
    with pytest.raises(driver.QuotaError, match="T2 2/3"):
        driver.build(t, families, {"crm:T1-06": 1, "crm:T2-02": 3}, {"T1": 1, "T2": 3}, values)
    with pytest.raises(driver.QuotaError, match="add up to 2, not 3"):
        driver.build(t, families, {"crm:T1-06": 2}, {"T1": 3}, values)
    with pytest.raises(driver.QuotaError, match="crm:T1-01: campaign_type"):
        driver.build(t, [FAMILIES["crm:T1-01"]], {"crm:T1-01": 1}, {"T1": 1}, values)


def test_missing_tables_are_not_opened(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no tables a"):
        open_typed(spark, str(tmp_path), {"a": None})
