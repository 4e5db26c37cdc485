from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.operators import quality
from fleetpulse.operators.constraints import constraint_violations, fk_orphans, key_violations
from fleetpulse.session import RunContext, stage

BAD = [
    {"record_id": 1},
    {"record_id": 2, "health_monitoring_score": 101},
    {"record_id": 3, "health_monitoring_score": None},
    {"record_id": 4, "cumulative_flight_hours": -1},
    {"record_id": 5, "component_serial_number": None},
    {"record_id": 6, "aircraft_tail_number": None},
    {"record_id": 7},
    {"record_id": 7, "health_monitoring_score": -1},
    {"record_id": 8, "flight_hours_since_last_overhaul": 9999},
    {"record_id": 9, "failure_within_30_days": 1},
    {"record_id": None},
    {"record_id": None},
]


def failed(results):
    return {r.rule_name: r.rows_failed for r in results.collect()}


def test_counts_per_rule(rows, ctx):
    results = quality.run_checks(rows(*BAD), quality.RULES, ctx)
    assert failed(results) == {
        "health_score_out_of_range": 2,
        "negative_usage_hours": 1,
        "missing_component_serial": 1,
        "missing_aircraft_tail": 1,
        "duplicate_record_id": 2,  # every copy, and NULL ids are no duplicates
        "inconsistent_overhaul_hours": 2,  # row 4 too, its lifetime hours are negative
        "failure_label_conflict": 1,
    }
    assert {r.rows_checked for r in results.collect()} == {12}
    assert float(results.filter("rule_name = 'negative_usage_hours'").first().pass_rate_pct) == 91.67


def test_rules_share_one_scan(rows, ctx, spark, tmp_path):
    rows(*BAD).write.parquet(str(tmp_path / "batch"))
    stored = spark.read.parquet(str(tmp_path / "batch"))
    plan = quality.run_checks(stored, quality.RULES, ctx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # all row rules, and the key column of the duplicate rule
    assert "ReadSchema: struct<record_id:bigint>" in plan


def test_empty_table_passes_with_rate_zero(rows, ctx):
    results = quality.run_checks(rows({}).limit(0), quality.RULES, ctx)
    assert {(r.rows_checked, r.rows_failed, float(r.pass_rate_pct), r.passed) for r in results.collect()} == {(0, 0, 0.0, True)}
    assert quality.gate_passed(results)


def test_gate_ignores_warnings_and_inactive_rules(rows, ctx):
    warning = rows({"flight_hours_since_last_overhaul": 9999})
    assert quality.gate_passed(quality.run_checks(warning, quality.RULES, ctx))
    assert not quality.gate_passed(quality.run_checks(rows(*BAD), quality.RULES, ctx))
    off = [quality.Rule("off", "Validity", "Critical", "true", active=False)]
    assert quality.run_checks(warning, off, ctx).count() == 0


def test_split_is_disjoint_and_complete(rows, ctx):
    batch = rows(*BAD)
    tagged = quality.tag_failures(batch, quality.RULES)
    good, bad = quality.split(tagged, quality.quarantining(quality.RULES), ctx)
    assert good.count() + bad.count() == batch.count()
    assert values(good, "record_id") == [(1,), (3,), (8,), (None,), (None,)]
    reasons = {(r.record_id, r.quarantine_reason) for r in bad.collect()}
    assert (7, "health_score_out_of_range,duplicate_record_id") in reasons
    assert good.columns == batch.columns


def test_quarantine_of_duplicates_only(rows, ctx):
    tagged = quality.tag_failures(rows(*BAD), quality.RULES)
    good, bad = quality.split(tagged, quality.quarantining(quality.RULES, only=["duplicate_record_id"]), ctx)
    assert values(bad, "record_id") == [(7,), (7,)]
    assert good.count() == 10


def test_all_duplicate_batch_leaves_nothing(rows, ctx):
    tagged = quality.tag_failures(rows({"record_id": 1}, {"record_id": 1}), quality.RULES)
    assert quality.split(tagged, quality.quarantining(quality.RULES), ctx)[0].count() == 0


def test_missing_id_rule(rows, ctx):
    rules = [*quality.RULES, quality.MISSING_RECORD_ID]
    tagged = quality.tag_failures(rows(*BAD), rules)
    good, _ = quality.split(tagged, quality.quarantining(rules), ctx)
    assert good.filter("record_id is null").count() == 0


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_tags_do_not_depend_on_the_join(rows, broadcast_bytes):
    tagged = quality.tag_failures(rows(*BAD), quality.RULES, broadcast_bytes=broadcast_bytes)
    assert tagged.filter(F.array_contains("failed_rules", "duplicate_record_id")).count() == 2
    assert tagged.count() == len(BAD)


def test_sticky_quarantine_keeps_rows_without_id(rows):
    history = rows({"record_id": 1}, {"record_id": None})
    kept = quality.without_quarantined(rows({"record_id": 1}, {"record_id": 2}, {"record_id": None}), history)
    assert values(kept, "record_id") == [(2,), (None,)]


def test_report_shows_newest_run_worst_first(rows, spark):
    old = quality.run_checks(rows(*BAD), quality.RULES, RunContext(datetime(2024, 1, 1), "a"))
    new = quality.run_checks(rows(*BAD), quality.RULES, RunContext(datetime(2024, 1, 2), "b"))
    catalog = quality.catalog(spark, quality.RULES)
    listed = [(r.passed, r.severity) for r in quality.report(old.unionByName(new), catalog).collect()]
    assert len(listed) == 7
    assert listed == sorted(listed, key=lambda r: (r[0], r[1] != "Critical"))
    textual = [r.severity for r in quality.report(new, catalog, textual=True).collect()]
    assert textual[0] == "Warning"  # plain text order puts it first


def test_recent_quarantine_is_strict(rows, spark):
    log = rows({"record_id": 1}, {"record_id": 2}).withColumn(
        "quarantined_at",
        F.when(F.col("record_id") == 1, F.lit("2024-06-29 12:00:00")).otherwise("2024-06-29 12:00:01").cast("timestamp_ntz"),
    )
    recent = quality.recent_quarantine(log, RunContext(datetime(2024, 6, 30, 12)))
    assert values(recent, "record_id") == [(2,)]


def test_rule_needs_a_known_category_and_one_test():
    with pytest.raises(ValueError):
        quality.Rule("x", "Guess", "Critical", "true")
    with pytest.raises(ValueError):
        quality.Rule("x", "Validity", "Info", "true")
    with pytest.raises(ValueError):
        quality.Rule("x", "Validity", "Critical")


def test_rules_live_in_a_table(rows, ctx, spark):
    extra = quality.Rule("old_part", "Validity", "Warning", "part_cost_usd > 50")
    off = quality.Rule("off", "Validity", "Critical", "true", active=False)
    stored = quality.catalog(spark, [*quality.RULES, extra, off]).unionByName(quality.catalog(spark, [extra], "elsewhere"))
    rules = quality.read_rules(stored)
    assert sorted(r.name for r in rules) == sorted([r.name for r in quality.RULES] + ["old_part"])
    results = failed(quality.run_checks(rows(*BAD), rules, ctx))
    assert results["old_part"] == 12 and results["duplicate_record_id"] == 2


def test_constraints_let_null_pass(rows):
    batch = rows({"fleet_type": None}, {"fleet_type": "Glider"}, {"humidity_avg_pct": None}, {"humidity_avg_pct": 101},
                 {"design_mtbf_hours": 0}, {"prior_removal_count": None})
    found = constraint_violations(
        batch, ["prior_removal_count"], {"fleet_type": ["Regional"]}, {"humidity_avg_pct": (0, 100)}, ["design_mtbf_hours"]
    )
    assert values(found, "column_name", "violations") == [
        ("design_mtbf_hours", 1), ("fleet_type", 1), ("humidity_avg_pct", 1), ("prior_removal_count", 1),
    ]


def test_keys_and_orphans(rows):
    batch = rows({"record_id": 1}, {"record_id": 1}, {"record_id": None}, {"record_id": None},
                 {"record_id": 3, "supplier_id": "S9"}, {"record_id": 4, "supplier_id": None})
    assert values(key_violations(batch, ["record_id"])) == [(1, 2)]
    parent = rows({"supplier_id": "S1"})
    assert values(fk_orphans(batch, "supplier_id", parent, "supplier_id")) == [("supplier_id", "S9", 1)]


def test_tags_of_a_stored_table_are_not_stored_again(spark, rows):
    plain = rows({"record_id": 1}, {"record_id": 1}, {"record_id": 2, "component_serial_number": None}, {"record_id": None}, {"record_id": 3})
    staged = stage(plain, "rows")
    tagged = quality.readable_tags(staged, quality.RULES)
    assert set(staged.inputFiles()) <= set(tagged.inputFiles())
    assert not any("/tagged/" in f for f in tagged.inputFiles())
    assert values(tagged, "record_id", "failed_rules") == values(quality.tag_failures(plain, quality.RULES), "record_id", "failed_rules")
