from datetime import date, datetime

import pytest
from conftest import GOOD_ROW, values
from pyspark.sql import functions as F

from fleetpulse.operators import dimensions as dims
from fleetpulse.operators import scoring
from fleetpulse.plans import marts
from fleetpulse.session import RunContext, stage
from fleetpulse.sources import extract, months

OLD, NEW = RunContext(datetime(2024, 7, 1), "r1"), RunContext(datetime(2024, 7, 2), "r2")


@pytest.fixture
def tables(rows):
    batch = rows(
        {"record_id": 1}, {"record_id": 2}, {"record_id": 3, "component_serial_number": "C2", "aircraft_tail_number": "N2", "supplier_id": "S2"},
        {"record_id": 4, "component_serial_number": "C3"},
    )
    silent = rows({"record_id": 9, "supplier_id": "S9"}).select("supplier_id", "supplier_quality_score")
    supplier = dims.supplier_rows(batch)
    return {
        "fact": dims.fact_rows(batch), "component": dims.component_rows(batch), "aircraft": dims.aircraft_rows(batch),
        "supplier": supplier.unionByName(silent.select(*[F.col(c).cast(supplier.schema[c].dataType) for c in silent.columns])),
    }


def scored(spark, ctx, *outputs):
    """Prediction rows from (record, component, 30-day, 90-day)."""
    df = spark.createDataFrame(
        [(r, c, GOOD_ROW["snapshot_date"], 100.0, p30, p90) for r, c, p30, p90 in outputs],
        "record_id bigint, component_serial_number string, snapshot_date date, predicted_rul_days double, "
        "predicted_failure_prob_30d double, predicted_failure_prob_90d double",
    )
    return scoring.prediction_rows(df, ctx)


def risk(spark, tables, *outputs, ctx=NEW):
    return marts.latest_component_risk(scored(spark, ctx, *outputs), tables["component"], tables["fact"], tables["aircraft"])


def test_tie_on_scoring_time_goes_to_the_newest_record(spark, tables):
    latest = risk(spark, tables, (1, "C1", 0.1, 0.1), (2, "C1", 0.9, 0.9), (3, "C2", 0.1, 0.6))
    assert values(latest, "component_serial_number", "risk_tier", "aircraft_tail_number") == [("C1", "High", "N1"), ("C2", "Elevated", "N2")]


def test_newer_run_wins(spark, tables):
    both = scored(spark, OLD, (2, "C1", 0.9, 0.9)).unionByName(scored(spark, NEW, (1, "C1", 0.1, 0.1)))
    latest = marts.latest_component_risk(both, tables["component"], tables["fact"], tables["aircraft"])
    assert values(latest, "risk_tier", "scored_at") == [("Low", NEW.as_of)]


def test_prediction_without_its_snapshot_does_not_compete(spark, tables):
    latest = risk(spark, tables, (1, "C1", 0.9, 0.9), (77, "C1", 0.1, 0.1), (78, "C7", 0.9, 0.9))
    assert values(latest, "component_serial_number", "risk_tier") == [("C1", "High")]


def test_tier_uses_unrounded_values(spark):
    row = scored(spark, NEW, (1, "C1", 0.50004, 0.0)).first()
    assert (str(row.predicted_failure_prob_30d), row.risk_tier) == ("0.5000", "High")


def test_ranking_takes_the_two_worst_tiers(spark, tables):
    latest = risk(spark, tables, (1, "C1", 0.6, 0.1), (3, "C2", 0.3, 0.9), (4, "C3", 0.4, 0.3))
    ranked = marts.risk_ranking(latest, tables["component"])
    assert [r.component_serial_number for r in ranked.collect()] == ["C1", "C2"]
    assert marts.risk_ranking(latest, tables["component"], top=1).count() == 1
    assert "part_cost_usd" in ranked.columns


def test_aircraft_summary(spark, tables):
    latest = risk(spark, tables, (1, "C1", 0.6, 0.1), (3, "C2", 0.3, 0.9), (4, "C3", 0.4, 0.3))
    summary = [tuple(r)[:1] + tuple(r)[2:5] for r in marts.aircraft_summary(latest).collect()]
    assert summary == [("N1", 2, 1, 0), ("N2", 1, 0, 1)]


def test_supplier_risk_counts_join_rows_or_components(spark, tables):
    runs = scored(spark, OLD, (4, "C3", 0.9, 0.9)).unionByName(scored(spark, NEW, (1, "C1", 0.6, 0.1), (2, "C1", 0.6, 0.1), (3, "C2", 0.1, 0.1)))

    def table(**options):
        result = marts.supplier_risk(tables["supplier"], tables["component"], runs, **options)
        return {r.supplier_id: (r.components_supplied, r.at_risk_components, None if r.risk_pct is None else float(r.risk_pct)) for r in result.collect()}

    # C1 twice in the newest run, C3 only in the old one, S9 supplies nothing
    assert table() == {"S1": (3, 2, 66.67), "S2": (1, 0, 0.0), "S9": (0, 0, None)}
    assert table(distinct=True) == {"S1": (2, 1, 50.0), "S2": (1, 0, 0.0), "S9": (0, 0, None)}


def test_tier_summary(spark):
    total = scoring.tier_summary(scored(spark, NEW, (1, "C1", 0.6, 0.1), (2, "C1", 0.1, 0.6), (3, "C2", None, None))).first()
    assert tuple(total) == (3, 1, 1)


def kept(spark, tables, path, *runs):
    """The view after each of the runs (context, outputs), and all predictions that are in force then."""
    view = None
    for ctx, outputs in runs:
        extract.write_log(scored(spark, ctx, *outputs), path, ctx)
        log = extract.read_log(spark, path)
        run = extract.read_run(spark, path, ctx)
        view = stage(marts.refresh_risk_view(view, run, ctx, tables["fact"], tables["aircraft"], log), "view")
    return view, log


LATE = RunContext(datetime(2024, 6, 1), "r0")


@pytest.mark.parametrize("runs", [
    [(OLD, [(1, "C1", 0.1, 0.1), (3, "C2", 0.1, 0.1)]), (NEW, [(2, "C1", 0.9, 0.9)])],
    # A late run, with a component of its own.
    [(NEW, [(2, "C1", 0.9, 0.9)]), (LATE, [(1, "C1", 0.1, 0.1), (4, "C3", 0.6, 0.6)])],
    # A repeated run that no longer has a component, one that loses all its rows, and a snapshot that does not exist.
    [(OLD, [(1, "C1", 0.2, 0.2), (3, "C2", 0.2, 0.2)]), (NEW, [(2, "C1", 0.9, 0.9), (3, "C2", 0.9, 0.9)]), (NEW, [(3, "C2", 0.3, 0.3)])],
    [(NEW, [(2, "C1", 0.9, 0.9), (4, "C3", 0.9, 0.9)]), (OLD, [(1, "C1", 0.2, 0.2), (77, "C9", 0.9, 0.9)]), (NEW, [])],
])
def test_kept_view_equals_the_full_recompute(spark, tables, tmp_path, runs):
    view, log = kept(spark, tables, str(tmp_path / "predictions"), *runs)
    whole = marts.latest_component_risk(log, tables["component"], tables["fact"], tables["aircraft"])
    mine = marts.component_risk(view, tables["component"], tables["aircraft"])
    assert mine.columns == whole.columns and values(mine) == values(whole) and whole.count() > 0


def test_a_run_reads_its_own_partition_and_the_months_of_its_snapshots(spark, tables, tmp_path):
    path, fact_path = str(tmp_path / "predictions"), str(tmp_path / "fact")
    months.write_months(months.route(tables["fact"], "snapshot_date", date(2024, 1, 1), date(2025, 1, 1)), fact_path)
    view, log = kept(spark, tables, path, (OLD, [(1, "C1", 0.1, 0.1)]))
    extract.write_log(scored(spark, NEW, (2, "C1", 0.9, 0.9)), path, NEW)
    run = extract.read_run(spark, path, NEW)
    refreshed = marts.refresh_risk_view(view, run, NEW, months.read_months(spark, fact_path), tables["aircraft"], log)
    assert all("run=r2" in f for f in run.inputFiles()) and len(run.inputFiles()) > 0
    plan = refreshed._jdf.queryExecution().toString()
    assert "run=r1" not in plan
    assert "partition_name#" in plan.split("PartitionFilters: [")[-1] or "2024_06" in plan


def test_predictions_are_not_shuffled_to_their_aircraft(spark, tables):
    tables = {name: stage(df, name) for name, df in tables.items()}
    lost = tables["aircraft"].filter("aircraft_tail_number != 'N2'")
    log = scored(spark, NEW, (1, "C1", 0.1, 0.1), (3, "C2", 0.1, 0.6), (4, "C3", 0.9, 0.9))
    small, large = (
        marts.latest_component_risk(log, tables["component"], tables["fact"], stage(lost, "aircraft"), **strategy)
        for strategy in ({}, {"broadcast_bytes": 0})
    )
    assert values(large) == values(small)
    assert values(large, "component_serial_number") == [("C1",), ("C3",)]
    # What shuffles by tail are the winners, after the pick of the newest.
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (aircraft_tail_number") < plan.index("Window")
