from datetime import date, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.functions import risk_tier
from fleetpulse.operators import dimensions as dims
from fleetpulse.operators import features
from fleetpulse.session import stage
from fleetpulse.sources import months

DAY = date(2024, 6, 30)


def build(batch, ctx, **options):
    return features.build_features(
        dims.fact_rows(batch), dims.component_rows(batch), dims.aircraft_rows(batch), dims.supplier_rows(batch), ctx, **options
    )


def one(df, column):
    return df.first()[column]


def test_engineered_columns(rows, ctx):
    built = build(rows({}), ctx)
    row = built.first()
    assert str(row.pct_of_design_life_consumed) == "0.2500"
    assert str(row.hours_per_cycle) == "2.500"
    assert str(row.unscheduled_removal_ratio) == "0.2500"
    assert str(row.sensor_composite_risk_score) == "1.8500"  # .40 x 1 + .35 x 2 + .25 x 3
    assert str(row.maintenance_recency_score) == "0.3679"  # exp(-1)
    assert row.feature_version == "v1" and row.computed_at == ctx.as_of


def test_zero_denominators_and_missing_readings(rows, ctx):
    built = build(
        rows({"cumulative_flight_cycles": 0, "prior_removal_count": 0, "sensor_vibration_index": None,
              "sensor_oil_debris_index": None, "anomaly_count_last_30_days": None, "days_since_last_maintenance_event": None}),
        ctx,
    )
    row = built.first()
    assert row.hours_per_cycle is None and row.unscheduled_removal_ratio is None
    assert float(row.sensor_composite_risk_score) == 0 and float(row.maintenance_recency_score) == 1


def test_supplier_is_optional_but_component_and_aircraft_are_not(rows, ctx):
    batch = rows({"record_id": 1, "supplier_id": None}, {"record_id": 2, "component_serial_number": "C2", "aircraft_tail_number": "N2"})
    fact, aircraft = dims.fact_rows(batch), dims.aircraft_rows(batch).filter("aircraft_tail_number = 'N1'")
    built = features.build_features(fact, dims.component_rows(batch), aircraft, dims.supplier_rows(batch), ctx)
    assert values(built, "record_id", "supplier_quality_score") == [(1, None)]


@pytest.mark.parametrize("gap,expected", [(30, "0.5000"), (31, "1.0000")])
def test_window_edge(rows, ctx, gap, expected):
    batch = rows(
        {"record_id": 1, "snapshot_date": DAY - timedelta(days=gap), "failure_within_90_days": 0},
        {"record_id": 2, "snapshot_date": DAY, "failure_within_90_days": 1},
    )
    built = build(batch, ctx).filter("record_id = 2")
    assert str(one(built, features.RATE)) == expected


def test_rate_counts_peers_and_skips_unknown_labels(rows, ctx):
    batch = rows(
        {"record_id": 1, "failure_within_90_days": 1}, {"record_id": 2, "failure_within_90_days": 0},
        {"record_id": 3, "failure_within_90_days": None},
        {"record_id": 4, "component_serial_number": "C2", "component_type": "Wheel", "failure_within_90_days": 1},
    )
    rates = dict(values(build(batch, ctx), "record_id", features.RATE))
    assert {k: str(v) for k, v in rates.items()} == {1: "0.5000", 2: "0.5000", 3: "0.5000", 4: "1.0000"}


def test_lagged_rate_leaves_out_the_own_day(rows, ctx):
    batch = rows(
        {"record_id": 1, "snapshot_date": DAY - timedelta(days=1), "failure_within_90_days": 0},
        {"record_id": 2, "snapshot_date": DAY, "failure_within_90_days": 1},
    )
    rates = dict(values(build(batch, ctx, lagged=True), "record_id", features.RATE))
    assert rates[1] is None and float(rates[2]) == 0


def test_two_stage_rate_equals_direct_window(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3).alias("kind"),
        F.date_add(F.lit(DAY), (F.col("id") * 7919 % 211).cast("int")).alias("day"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 2).cast("int")).alias("label"),
        "id",
    )
    staged = features.rolling_rate(df, "kind", "day", "label")
    direct = features.rolling_rate_direct(df, "kind", "day", "label")
    assert values(df.join(staged, ["kind", "day"]), "id", features.RATE) == values(direct, "id", features.RATE)


def test_result_does_not_depend_on_partitions_or_joins(rows, ctx):
    batch = rows(*[{"record_id": i, "component_serial_number": f"C{i % 5}", "failure_within_90_days": i % 2} for i in range(40)])
    expected = values(build(batch, ctx))
    assert values(build(batch.repartition(7), ctx)) == expected
    assert values(build(batch.coalesce(1), ctx, broadcast_bytes=0)) == expected


def test_split_limits_belong_to_validation(spark):
    df = spark.createDataFrame([(DAY - timedelta(days=d),) for d in (0, 59, 60, 61, 119, 120, 121)] + [(None,)], "snapshot_date date")
    parts = features.temporal_split(df)
    ages = {name: sorted((DAY - r[0]).days for r in part.collect()) for name, part in parts.items()}
    assert ages == {"train": [121], "validation": [60, 61, 119, 120], "test": [0, 59]}


def test_split_of_nothing(spark):
    parts = features.temporal_split(spark.createDataFrame([], "snapshot_date date"))
    assert [p.count() for p in parts.values()] == [0, 0, 0]


def test_split_prunes_with_a_literal(rows, ctx, spark, tmp_path):
    build(rows({}), ctx).write.parquet(str(tmp_path / "f"))
    plan = features.temporal_split(spark.read.parquet(str(tmp_path / "f")))["test"]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(snapshot_date," in plan


@pytest.mark.parametrize(
    "p30,p90,tier",
    [(0.51, 0.0, "High"), (0.5, 0.51, "Elevated"), (0.5, 0.5, "Watch"), (0.0, 0.2, "Low"), (None, None, "Low"), (None, 0.6, "Elevated")],
)
def test_tier_limits_are_strict(spark, p30, p90, tier):
    df = spark.createDataFrame([(p30, p90)], "a double, b double")
    assert df.select(risk_tier(F.col("a"), F.col("b"))).first()[0] == tier


def test_tier_of_unknown_can_be_named(spark):
    df = spark.createDataFrame([(None, 0.1), (0.1, 0.1)], "a double, b double")
    assert values(df.select(risk_tier(F.col("a"), F.col("b"), null_tier="Watch").alias("t"))) == [("Low",), ("Watch",)]


def test_feature_versions_live_side_by_side(rows, ctx, tmp_path):
    for version in ("v1", "v2"):
        features.save_features(build(rows({}), ctx, version=version), str(tmp_path), version)
    again = features.save_features(build(rows({}, {"record_id": 2}), ctx), str(tmp_path))
    assert again.table.count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["features_v1", "features_v2"]


DATED = [{"record_id": n, "snapshot_date": d} for n, d in enumerate(
    [date(2024, 6, 30), date(2024, 6, 1), date(2024, 4, 15), date(2024, 2, 29), date(2024, 2, 1), date(2019, 1, 1)], 1)]
SPINE = (date(2024, 1, 1), date(2025, 1, 1))


def jobs_run(spark, ctx, action):
    """What the action returns, and how many Spark jobs it ran."""
    group = f"jobs-{action.__name__}-{ctx.run_id}"
    spark.sparkContext.setJobGroup(group, group)
    result = action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_stored_split_equals_the_split_of_a_scan_and_reads_its_months(rows, ctx, spark, tmp_path):
    stored = features.save_features(build(rows(*DATED), ctx), str(tmp_path), "v1", *SPINE)
    scanned = features.temporal_split(stored.table)
    for name, part in stored.split().items():
        assert values(part) == values(scanned[name]), name
        plan = part._jdf.queryExecution().executedPlan().toString()
        pruned = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "partition_name" in pruned and "GreaterThan" in plan or "LessThan" in plan
    test_plan = stored.split()["test"]._jdf.queryExecution().executedPlan().toString()
    assert "2024_06" in test_plan and "2024_02" not in test_plan and "default" not in test_plan
    assert sorted(stored.days) == ["2024_02", "2024_04", "2024_06", "default"]


def test_newest_day_runs_no_scan(rows, ctx, spark, tmp_path):
    stored = features.save_features(build(rows(*DATED), ctx), str(tmp_path), "v1", *SPINE)
    newest, n = jobs_run(spark, ctx, lambda: stored.newest)
    assert (newest, n) == (date(2024, 6, 30), 0)
    assert features.read_features(spark, str(tmp_path)).newest == newest


def test_dated_rows_hold_both_limits(rows, ctx, tmp_path):
    stored = features.save_features(build(rows(*DATED), ctx), str(tmp_path), "v1", *SPINE)
    assert values(stored.dated(date(2024, 2, 29), date(2024, 6, 1)), "record_id") == [(2,), (3,), (4,)]
    assert values(stored.dated(last=date(2019, 1, 1)), "record_id") == [(6,)]
    assert stored.dated(date(2030, 1, 1)).count() == 0


def test_stored_version_without_rows(rows, ctx, tmp_path):
    stored = features.save_features(build(rows({}), ctx).limit(0), str(tmp_path), "v1", *SPINE)
    assert stored.newest is None and [p.count() for p in stored.split().values()] == [0, 0, 0]


def test_rebuild_broken_off_leaves_the_old_version_in_force(rows, ctx, spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    features.save_features(build(rows(*DATED), ctx), root, "v1", *SPINE)
    with monkeypatch.context() as broken:
        broken.setattr(months, "write_version", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            features.save_features(build(rows(DATED[0]), ctx), root, "v1", *SPINE)
    assert features.read_features(spark, root).table.count() == 6
    for _ in range(2):
        features.save_features(build(rows(*DATED[:2]), ctx), root, "v1", *SPINE)
    assert features.read_features(spark, root).table.count() == 2
    # The version in force and the one before it.
    assert len([p for p in (tmp_path / "features_v1").iterdir() if p.name.startswith("data-")]) == 2


def test_missing_version_says_what_builds_it(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="refresh_features"):
        features.read_features(spark, str(tmp_path), "v9")


def test_build_reads_only_what_it_needs_and_broadcasts_small_dimensions(rows, ctx, spark, tmp_path):
    batch = rows({}, {"record_id": 2, "snapshot_date": date(2024, 5, 1)})
    months.write_months(months.route(dims.fact_rows(batch), "snapshot_date", date(2024, 1, 1), date(2025, 1, 1)), str(tmp_path / "fact"))
    june = months.between_days(months.read_months(spark, str(tmp_path / "fact")), "snapshot_date", date(2024, 6, 1), date(2024, 6, 30))
    stored = [stage(rows_of(batch), "dim") for rows_of in (dims.component_rows, dims.aircraft_rows, dims.supplier_rows)]
    built = features.build_features(june, *stored, ctx)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    fact_scan = next(line for line in plan.splitlines() if "FileScan" in line and "cumulative_flight_hours" in line)
    assert "inspection_technician_id" not in fact_scan and "partition_name" in fact_scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert values(built, "record_id") == [(1,)]


def test_rate_takes_no_attribute_of_the_aircraft(rows, ctx, monkeypatch):
    plans, stage = {}, features.stage
    monkeypatch.setattr(features, "stage", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or stage(df, name))
    batch = rows({"record_id": 1}, {"record_id": 2, "aircraft_tail_number": None}, {"record_id": 3, "aircraft_tail_number": "N2", "failure_within_90_days": 1})
    lost = dims.aircraft_rows(batch).filter("aircraft_tail_number != 'N2'")
    built = features.build_features(
        dims.fact_rows(batch), dims.component_rows(batch), lost, dims.supplier_rows(batch), ctx, broadcast_bytes=0
    )
    assert values(built, "record_id", features.RATE) == [(1, 0)]
    assert "LeftAnti" in plans["cohort_rates"] and "Join Inner, (aircraft_tail_number" not in plans["cohort_rates"]
