from datetime import date, datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.operators import features, monitor, quality
from fleetpulse.operators.merge import DuplicateKey
from fleetpulse.plans import jobs, load
from fleetpulse.session import RunContext, stage
from fleetpulse.sources import extract, months

FIRST, SECOND = RunContext(datetime(2024, 7, 1), "b1", "loader"), RunContext(datetime(2024, 7, 2), "b2", "loader")
BATCH = [
    {"record_id": 1},
    {"record_id": 2, "component_serial_number": "C2", "snapshot_date": date(2024, 5, 1)},
    {"record_id": 3, "component_serial_number": None},
    {"record_id": 4}, {"record_id": 4},
    {"record_id": 5, "snapshot_date": date(2031, 1, 15), "component_serial_number": "C2"},
]


@pytest.fixture
def layout(tmp_path):
    return load.Layout(str(tmp_path / "wh"), date(2024, 1, 1), date(2025, 1, 1))


def counts(df):
    return dict(values(df))


def test_load_counts_and_audit(rows, layout, spark):
    got = counts(load.load_and_promote(rows(*BATCH), layout, FIRST))
    assert got == {"dim_aircraft": 1, "dim_component": 2, "dim_supplier": 1, "fact": 3, "quarantine": 3}
    audit = spark.read.parquet(layout.path("audit_log"))
    assert values(audit, "operation", "row_pk", "db_user") == [("INSERT", "1", "loader"), ("INSERT", "2", "loader"), ("INSERT", "5", "loader")]
    assert values(months.read_months(spark, layout.path("fact")), "record_id", "partition_name") == [(1, "2024_06"), (2, "2024_05"), (5, "default")]
    quarantine = spark.read.parquet(layout.path("quarantine"))
    assert values(quarantine, "record_id", "quarantine_reason", "load_batch_id") == [
        (3, "missing_component_serial", "b1"), (4, "duplicate_record_id", "b1"), (4, "duplicate_record_id", "b1"),
    ]


def test_same_batch_twice_changes_no_curated_row(rows, layout, spark):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    before = {n: values(df.drop("updated_at", "ingested_at")) for n, df in load.curated(spark, layout).items()}
    load.load_and_promote(rows(*BATCH), layout, SECOND)
    after = {n: values(df.drop("updated_at", "ingested_at")) for n, df in load.curated(spark, layout).items()}
    assert before == after
    audit = spark.read.parquet(layout.path("audit_log"))
    assert counts(audit.groupBy("operation").count()) == {"INSERT": 3, "UPDATE": 3}


def test_redelivery_refreshes_five_measures(rows, layout, spark):
    load.load_and_promote(rows({"record_id": 1}), layout, FIRST)
    load.load_and_promote(
        rows({"record_id": 1, "cumulative_flight_hours": 999, "last_maintenance_type": "New", "installation_date": date(2024, 1, 1),
              "aircraft_model": "M2", "health_monitoring_score": None}),
        layout, SECOND,
    )
    fact = months.read_months(spark, layout.path("fact")).first()
    assert (float(fact.cumulative_flight_hours), fact.last_maintenance_type, fact.health_monitoring_score, fact.ingested_at) == (
        999, None, None, SECOND.as_of)
    assert values(load.curated(spark, layout)["dim_component"], "installation_date", "created_at", "updated_at") == [
        (date(2020, 1, 1), FIRST.as_of, SECOND.as_of)]
    assert values(load.curated(spark, layout)["dim_aircraft"], "aircraft_model") == [("M2",)]


def test_untouched_months_keep_their_files(rows, layout, spark, tmp_path):
    load.load_and_promote(rows(*BATCH[:2]), layout, FIRST)
    may = sorted(p.name for p in (tmp_path / "wh/fact/partition_name=2024_05").iterdir())
    load.load_and_promote(rows({"record_id": 8}), layout, SECOND)
    assert sorted(p.name for p in (tmp_path / "wh/fact/partition_name=2024_05").iterdir()) == may
    assert months.read_months(spark, layout.path("fact")).count() == 3


def test_gate_stops_the_load_only_if_asked(rows, layout, spark):
    with pytest.raises(load.GateClosed):
        load.load_and_promote(rows(*BATCH), layout, FIRST, enforce=True)
    assert months.read_if_exists(spark, layout.path("fact")) is None
    assert spark.read.parquet(layout.path("quality_results")).count() == 8
    load.load_and_promote(rows(BATCH[0]), layout, FIRST, enforce=True)


def test_literal_quarantine_stops_on_a_missing_key(rows, layout):
    literal = dict(quarantine_only=["duplicate_record_id"])
    with pytest.raises(ValueError, match="component_serial_number"):
        load.load_and_promote(rows(*BATCH), layout, FIRST, **literal)
    with pytest.raises(ValueError, match="record_id"):
        load.load_and_promote(rows({"record_id": None}, {"record_id": None}), layout, FIRST, **literal)


def test_missing_ids_are_quarantined_by_default(rows, layout):
    got = counts(load.load_and_promote(rows({}, {"record_id": None}, {"record_id": None}), layout, FIRST))
    assert (got["fact"], got["quarantine"]) == (1, 2)


def test_quarantine_is_forgotten_unless_sticky(rows, layout):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    fixed = rows({"record_id": 4}, {"record_id": 6})
    assert counts(load.load_and_promote(fixed, layout, SECOND, sticky=True))["fact"] == 4
    assert counts(load.load_and_promote(fixed, layout, SECOND))["fact"] == 5


def test_promotion_refuses_a_repeated_snapshot(rows, layout):
    with pytest.raises(DuplicateKey):
        load.promote(rows({}, {}), layout, FIRST)


def test_row_for_a_later_month_leaves_default_when_the_spine_grows(rows, layout, spark):
    load.load_and_promote(
        rows({"record_id": 1, "snapshot_date": date(2025, 1, 15)}, {"record_id": 2, "snapshot_date": date(2031, 1, 1)}), layout, FIRST)
    wider = load.extend_spine(layout, date(2025, 2, 1), spark)
    fact = months.read_months(spark, layout.path("fact"))
    assert values(fact, "record_id", "partition_name") == [(1, "2025_01"), (2, "default")]
    load.extend_spine(wider, date(2031, 2, 1), spark)
    assert values(months.read_months(spark, layout.path("fact")), "record_id", "partition_name") == [(1, "2025_01"), (2, "2031_01")]


def test_monthly_job_opens_next_month(rows, layout, spark):
    load.load_and_promote(rows({"snapshot_date": date(2025, 1, 15)}), layout, FIRST)
    wider = jobs.run_monthly(spark, layout, RunContext(datetime(2024, 12, 1)))
    assert wider.spine_end == date(2025, 2, 1)
    assert values(months.read_months(spark, layout.path("fact")), "partition_name") == [("2025_01",)]
    assert jobs.run_monthly(spark, layout, RunContext(datetime(2024, 3, 1))).spine_end == date(2025, 2, 1)


def test_loads_after_an_extension_keep_every_row(rows, layout, spark):
    """Each job builds its layout anew, as after a restart."""
    january = {"snapshot_date": date(2025, 1, 15)}

    def fresh():
        return load.Layout(layout.root, layout.spine_start, layout.spine_end)

    def fact():
        return values(months.read_months(spark, layout.path("fact")), "record_id", "partition_name")

    load.load_and_promote(rows({"record_id": 1, **january}), fresh(), FIRST)
    assert fact() == [(1, "default")]
    load.extend_spine(fresh(), date(2025, 2, 1), spark)
    load.load_and_promote(rows({"record_id": 2, **january}, {"record_id": 3, "snapshot_date": date(2025, 2, 2)}), fresh(), SECOND)
    assert fact() == [(1, "2025_01"), (2, "2025_01"), (3, "default")]
    load.extend_spine(fresh(), date(2025, 3, 1), spark)
    load.load_and_promote(rows({"record_id": 1, **january}, {"record_id": 3, "snapshot_date": date(2025, 2, 2)}), fresh(), SECOND)
    assert fact() == [(1, "2025_01"), (2, "2025_01"), (3, "2025_02")]


def test_move_that_broke_off_is_completed(rows, layout, spark):
    late = {"record_id": 1, "snapshot_date": date(2025, 1, 15)}
    load.load_and_promote(rows(late, {"record_id": 2, "snapshot_date": date(2031, 1, 1)}), layout, FIRST)
    wider = load.Layout(layout.root, layout.spine_start, date(2025, 2, 1))
    load._open(spark, wider)  # the month is open and written, but default still holds the row
    copy = months.read_months(spark, layout.path("fact"), ["default"]).filter("record_id = 1").drop("partition_name")
    months.write_months(months.route(stage(copy, "copy"), "snapshot_date", wider.spine_start, wider.spine_end), layout.path("fact"))
    assert months.read_months(spark, layout.path("fact")).count() == 3
    load.load_and_promote(rows(late), layout, SECOND)
    assert values(months.read_months(spark, layout.path("fact")), "record_id", "partition_name") == [(1, "2025_01"), (2, "default")]


def test_a_lost_dimension_is_not_rebuilt_from_one_batch(rows, layout, spark, tmp_path):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    (marker,) = (tmp_path / "wh/dim_component").glob("v*/_SUCCESS")
    marker.unlink()
    with pytest.raises(RuntimeError, match="dim_component"):
        load.load_and_promote(rows(*BATCH), layout, SECOND)


def test_half_written_dimension_leaves_the_old_one(rows, layout, spark, tmp_path):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    before = values(load.curated(spark, layout)["dim_component"])
    (tmp_path / "wh/dim_component/v00000002-broken").mkdir()
    assert values(load.curated(spark, layout)["dim_component"]) == before
    load.load_and_promote(rows(*BATCH), layout, SECOND)
    assert load.curated(spark, layout)["dim_component"].count() == 2


def test_repeated_load_leaves_each_log_unchanged(rows, layout, spark):
    logs = ["quarantine", "quality_results"]
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    before = {log: values(extract.read_log(spark, layout.path(log))) for log in logs}
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    assert {log: values(extract.read_log(spark, layout.path(log))) for log in logs} == before
    assert extract.read_log(spark, layout.path("audit_log")).count() == 3


def test_stored_catalog_drives_the_load(rows, layout, spark):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    catalog = months.read_version(spark, layout.path("rule_catalog"))
    assert catalog.count() == 7
    off = F.when(F.col("rule_name") == "missing_component_serial", False).otherwise(F.col("is_active"))
    months.write_version(stage(catalog.withColumn("is_active", off), "catalog"), layout.path("rule_catalog"))
    with pytest.raises(ValueError, match="component_serial_number"):
        load.load_and_promote(rows(*BATCH), layout, SECOND)


def test_checks_from_tags_equal_checks_of_rows(rows, spark):
    batch = rows(*BATCH, {"record_id": None}, {"record_id": 9, "health_monitoring_score": 101}, {"record_id": 10, "cumulative_flight_hours": -1})
    direct = quality.run_checks(batch, quality.RULES, FIRST)
    tagged = quality.results_of_tags(stage(quality.tag_failures(batch, quality.RULES), "tagged"), quality.RULES, FIRST)
    assert values(tagged) == values(direct)


def test_inactive_rules_do_not_quarantine(rows, layout):
    rules = [quality.Rule("never", "Validity", "Critical", "true", active=False)]
    assert counts(load.load_and_promote(rows({}), layout, FIRST, rules=rules))["fact"] == 1


def days(spark, layout):
    """The kept daily sums, and the same worked out anew from the whole fact."""
    tables = load.curated(spark, layout)
    typed = tables["fact"].join(tables["dim_component"].select("component_serial_number", "component_type"), "component_serial_number")
    whole = features.cohort_days(typed, "component_type", "snapshot_date", "failure_within_90_days"), monitor.feature_days(typed)
    kept = [load.days_of(spark, layout, t) for t in ("cohort_days", "feature_days")]
    return [(values(k, *sorted(k.columns)), values(w, *sorted(k.columns))) for k, w in zip(kept, whole)]


def test_daily_sums_follow_each_load(rows, layout, spark):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    assert all(kept == whole for kept, whole in days(spark, layout))
    # Known days get further rows and changed labels, a new month comes, a component is of another type from now on.
    load.load_and_promote(rows(
        {"record_id": 1, "failure_within_90_days": 1, "failure_within_30_days": 1}, {"record_id": 20, "snapshot_date": date(2024, 8, 2)},
        {"record_id": 21, "component_serial_number": "C2", "component_type": "Pump", "snapshot_date": date(2024, 8, 3)},
    ), layout, SECOND)
    both = days(spark, layout)
    assert all(kept == whole for kept, whole in both)
    assert {r[0] for r in both[0][0]} >= {"Engine", "Pump"}
    load.extend_spine(layout, date(2031, 2, 1), spark)
    assert all(kept == whole for kept, whole in days(spark, layout))
    assert "default" not in [r[0] for r in values(months.read_months(spark, layout.path("cohort_days")).select(months.PARTITION).distinct())]


def test_a_load_rewrites_the_daily_sums_of_its_months_only(rows, layout, spark, tmp_path):
    load.load_and_promote(rows(*BATCH), layout, FIRST)
    files = {t: sorted(p.name for p in (tmp_path / "wh" / t / "partition_name=2024_05").glob("*.parquet")) for t in ("cohort_days", "feature_days")}
    load.load_and_promote(rows({"record_id": 30}), layout, SECOND)
    again = {t: sorted(p.name for p in (tmp_path / "wh" / t / "partition_name=2024_05").glob("*.parquet")) for t in ("cohort_days", "feature_days")}
    assert files == again and all(files.values())
    assert all(kept == whole for kept, whole in days(spark, layout))


def test_features_and_drift_from_daily_sums_equal_those_from_rows(rows, layout, spark):
    batch = [{"record_id": i, "snapshot_date": date(2024, 2, 1) + timedelta(days=i * 5), "failure_within_90_days": i % 2, "failure_within_30_days": 0,
              "health_monitoring_score": 50 + i, "sensor_vibration_index": None if i % 3 else i} for i in range(1, 40)]
    load.load_and_promote(rows(*batch[:25]), layout, FIRST)
    load.load_and_promote(rows(*batch[20:]), layout, SECOND)
    built = jobs.refresh_features(spark, layout, SECOND)
    tables = load.curated(spark, layout)
    whole = features.build_features(tables["fact"], tables["dim_component"], tables["dim_aircraft"], tables["dim_supplier"], SECOND)
    assert values(built) == values(whole)
    for until in (None, date(2024, 6, 1)):
        kept = monitor.drift_of_days(load.days_of(spark, layout, "feature_days"), SECOND, until=until)
        scanned = monitor.drift(built if until is None else built.filter(F.col("snapshot_date") <= F.lit(until)), SECOND)
        assert values(kept) == values(scanned)


class Broken(RuntimeError):
    pass


def audit_of(spark, layout):
    return values(extract.read_log(spark, layout.path("audit_log")))


@pytest.mark.parametrize("step", ["write_log", "write_months"])
def test_load_broken_off_and_repeated_gives_the_audit_of_an_unbroken_one(rows, spark, tmp_path, monkeypatch, step):
    first = rows({"record_id": 1}, {"record_id": 2, "snapshot_date": date(2024, 5, 1)})
    again = rows({"record_id": 1, "cumulative_flight_hours": 999}, {"record_id": 8}, {"record_id": 9, "snapshot_date": date(2024, 5, 2)})
    unbroken, broken = (load.Layout(str(tmp_path / name), date(2024, 1, 1), date(2025, 1, 1)) for name in ("whole", "broken"))
    for layout in (unbroken, broken):
        load.promote(first, layout, FIRST)
    load.promote(again, unbroken, SECOND)
    write_months = months.write_months

    def stop(*args, **options):
        if step == "write_months":
            # One of the months is in place, the other is not.
            write_months(args[0].filter(F.col(months.PARTITION) == "2024_06"), *args[1:], **options)
        raise Broken

    with monkeypatch.context() as patch:
        patch.setattr(months if step == "write_months" else extract, step, stop)
        with pytest.raises(Broken):
            load.promote(again, broken, SECOND)
    # Repeated, and once more after it is done.
    for _ in range(2):
        load.promote(again, broken, SECOND)
        assert audit_of(spark, broken) == audit_of(spark, unbroken)
        assert counts(extract.read_log(spark, broken.path("audit_log")).groupBy("operation").count()) == {"INSERT": 4, "UPDATE": 1}
    fact = [values(months.read_months(spark, layout.path("fact"))) for layout in (broken, unbroken)]
    assert fact[0] == fact[1]


def test_repeat_with_further_rows_adds_them_to_the_ledger(rows, layout, spark):
    load.promote(rows({"record_id": 1}), layout, FIRST)
    load.promote(rows({"record_id": 1}, {"record_id": 2}), layout, FIRST)
    assert values(extract.read_log(spark, layout.path("audit_log")), "operation", "row_pk") == [("INSERT", "1"), ("INSERT", "2")]
    load.promote(rows({"record_id": 1}, {"record_id": 2}), layout, SECOND)
    assert counts(extract.read_log(spark, layout.path("audit_log")).groupBy("operation").count()) == {"INSERT": 2, "UPDATE": 2}


def test_a_first_run_does_not_join_its_own_ledger(rows, layout, spark):
    old = load._empty(spark, load.FACT).withColumn("ingested_at", load.F.lit(None).cast("timestamp_ntz"))
    good = rows(BATCH[0])
    assert load._before(spark, layout, good, old, FIRST) is None
    # Made again, the run reads what it found: no row of it was there.
    assert [r.existed for r in load._before(spark, layout, good, old, FIRST).collect()] == [False]
