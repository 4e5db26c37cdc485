from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.operators import evaluate, monitor
from fleetpulse.operators.quality import newest_run
from fleetpulse.session import RunContext

DAY = date(2024, 6, 30)
PRED = "record_id bigint, snapshot_date date, run_id string, model_version string, predicted_rul_days double, p double"
TRUTH = "record_id bigint, snapshot_date date, remaining_useful_life_days double, y int"


@pytest.fixture
def scored(spark):
    predictions = [
        (1, DAY, "r", "v1", 110.0, 0.9), (2, DAY, "r", "v1", 80.0, 0.6), (3, DAY, "r", "v1", None, 0.5), (4, DAY, "r", "v1", 100.0, 0.1),
        (1, DAY, "old", "v1", 0.0, 0.9), (1, DAY, "r", "v0", 0.0, 0.9), (9, DAY, "r", "v1", 0.0, 0.9),
    ]
    truth = [(1, DAY, 100.0, 1), (2, DAY, 100.0, 0), (3, DAY, 100.0, 1), (4, DAY, 100.0, 1)]
    return spark.createDataFrame(predictions, PRED), spark.createDataFrame(truth, TRUTH)


def metrics(log):
    return {r.metric_name: (None if r.metric_value is None else float(r.metric_value), r.sample_size, r.n_scored) for r in log.collect()}


def test_regression_filters_run_and_version(scored, ctx):
    log = evaluate.evaluate_regression(*scored, "m", ctx, run_id="r", version="v1")
    assert metrics(log) == {"RMSE": (12.9099, 4, 3), "MAE": (10.0, 4, 3)}
    assert values(log, "evaluation_window_start", "evaluation_window_end") == [(DAY, DAY)] * 2


def test_classifier_threshold_is_strict(scored, ctx):
    log = evaluate.evaluate_classifier(*scored, "m", "p", "y", ctx, run_id="r")
    assert metrics(log) == {"Precision": (0.5, 4, 4), "Recall": (0.3333, 4, 4)}


def test_metrics_without_cases_are_null_and_raise_no_alert(scored, ctx):
    predictions, truth = scored
    log = evaluate.evaluate_classifier(predictions.withColumn("p", F.lit(0.0)), truth.withColumn("y", F.lit(0)), "m", "p", "y", ctx)
    assert {m: v[0] for m, v in metrics(log).items()} == {"Precision": None, "Recall": None}
    empty = evaluate.evaluate_regression(predictions.limit(0), truth, "m", ctx, version="v1")
    assert metrics(empty) == {"RMSE": (None, 0, 0), "MAE": (None, 0, 0)}
    assert monitor.alerts_from_metrics(log.unionByName(empty), ctx).count() == 0


def test_every_version_is_evaluated_on_its_own(scored, ctx):
    log = evaluate.evaluate_regression(*scored, "m", ctx, run_id="r")
    found = {r.model_version for r in scored[0].filter("run_id = 'r'").collect()}
    assert len(found) > 1 and values(log.select("model_version").distinct()) == sorted((v,) for v in found)
    one = evaluate.evaluate_regression(*scored, "m", ctx, run_id="r", version="v1")
    assert values(log.filter("model_version = 'v1'").drop("log_id")) == values(one.drop("log_id"))


def test_evaluation_window_has_both_ends(scored, ctx):
    inside = evaluate.evaluate_regression(*scored, "m", ctx, version="v1", since=DAY, until=DAY)
    assert metrics(inside)["MAE"][1] > 0
    before = evaluate.evaluate_regression(*scored, "m", ctx, version="v1", until=date(2000, 1, 1))
    assert metrics(before) == {"RMSE": (None, 0, 0), "MAE": (None, 0, 0)}


def test_errors_do_not_depend_on_partitions(spark, ctx):
    rows = [(i, DAY, "r", "v1", 0.1 * (i * 7919 % 1000), 0.5) for i in range(500)]
    predictions = spark.createDataFrame(rows, "record_id long, snapshot_date date, run_id string, model_version string, predicted_rul_days double, p double")
    truth = predictions.select("record_id", "snapshot_date", (F.col("predicted_rul_days") * 0.7).alias("remaining_useful_life_days"))
    got = {str(values(evaluate.evaluate_regression(predictions.repartition(n), truth, "m", ctx), "metric_name", "metric_value")) for n in (1, 3, 7)}
    assert len(got) == 1


def test_all_models_in_one_join(scored, ctx):
    targets = [evaluate.Target("a", "regression", "predicted_rul_days", "remaining_useful_life_days"),
               evaluate.Target("b", "classification", "p", "y")]
    log = evaluate.evaluate(*scored, targets, ctx, run_id="r", version="v1")
    assert values(log, "model_name", "metric_name") == [("a", "MAE"), ("a", "RMSE"), ("b", "Precision"), ("b", "Recall")]
    assert log._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_sweep_agrees_with_single_evaluations(scored, ctx):
    sweep = evaluate.threshold_sweep(*scored, "p", "y", run_id="r", version="v1")
    for threshold, precision, recall in values(sweep):
        log = metrics(evaluate.evaluate_classifier(*scored, "m", "p", "y", ctx, run_id="r", threshold=str(threshold)))
        assert (float(precision), float(recall)) == (log["Precision"][0], log["Recall"][0])
    assert "Cartesian" not in sweep._jdf.queryExecution().executedPlan().toString()


def brute_auc(pairs):
    """Over all (failed, sound) pairs, a tie counting half."""
    failed, sound = [p for p, y in pairs if y == 1], [p for p, y in pairs if y == 0]
    good = sum((a > b) + (a == b) / 2 for a in failed for b in sound)
    return round(good / (len(failed) * len(sound)), 4)


def ranked(spark, ctx, pairs, **options):
    """Log values of rows given as (probability, outcome), all in one run."""
    predictions = spark.createDataFrame([(i, DAY, "r", "v1", 0.0, p) for i, (p, _) in enumerate(pairs)], PRED)
    truth = spark.createDataFrame([(i, DAY, 0.0, y) for i, (_, y) in enumerate(pairs)], TRUTH)
    target = [evaluate.Target("c", "classification", "p", "y"), evaluate.Target("m", "regression", "predicted_rul_days", "remaining_useful_life_days")]
    return metrics(evaluate.ranking(predictions, truth, target, ctx, **options))


def test_auc_equals_all_pairs_with_ties(spark, ctx):
    pairs = [(((i * 7919) % 41) / 40, int((i * 31) % 7 < 2)) for i in range(200)]
    assert ranked(spark, ctx, pairs)["AUC"] == (brute_auc(pairs), 200, 200)
    # Scores that differ in their last digits only share a range.
    close = [(0.5 + ((i * 7919) % 97) * 1e-9, int((i * 13) % 5 < 2)) for i in range(150)]
    assert ranked(spark, ctx, close)["AUC"] == (brute_auc(close), 150, 150)


def test_auc_limits(spark, ctx):
    assert ranked(spark, ctx, [(0.9, 1), (1.0, 1), (0.0, 0), (0.1, 0)])["AUC"][0] == 1.0
    assert ranked(spark, ctx, [(0.1, 1), (0.9, 0)])["AUC"][0] == 0.0
    assert ranked(spark, ctx, [(0.3, 1), (0.3, 0), (0.3, 0)])["AUC"][0] == 0.5
    assert ranked(spark, ctx, [(0.3, 1), (0.4, 1)])["AUC"][0] is None


def test_ranking_without_a_score_or_an_outcome(spark, ctx):
    got = ranked(spark, ctx, [(0.9, 1), (0.2, 0), (None, 1), (0.7, None), (0.1, 0)])
    assert got["AUC"] == (1.0, 5, 4)
    # One hit; two flagged and two failed.
    assert got["F1"] == (0.5, 5, 4)
    assert ranked(spark, ctx, [(0.1, 0)])["F1"][0] is None
    assert ranked(spark, ctx, [(0.9, 1)], run_id="none") == {}


def test_rank_sums_beyond_64_bits(spark):
    scores = spark.createDataFrame([("g", 0.2, 0, 10**11), ("g", 0.9, 10**11, 0)], "g string, score double, positives bigint, negatives bigint")
    assert int(evaluate.rank_sums(scores, ["g"]).first().pairs) == 2 * 10**22


def test_trend(spark, ctx):
    log = spark.createDataFrame(
        [("m", "MAE", Decimal(v), ctx.as_of - timedelta(days=d)) for v, d in (("1.0", 1), ("2.0", 2), ("9.0", 90))],
        "model_name string, metric_name string, metric_value decimal(10,4), logged_at timestamp_ntz",
    )
    assert [tuple(map(str, r)) for r in evaluate.metric_trend(log, ctx).collect()] == [("m", "MAE", "1.5000", "1.0000", "2.0000", "2")]


def frame(spark, *rows):
    return spark.createDataFrame([(DAY - timedelta(days=d), Decimal(v) if v else None) for d, v in rows], "snapshot_date date, x decimal(8,3)")


def drift(spark, ctx, *rows):
    return monitor.drift(frame(spark, *rows), ctx, features=["x"]).first()


def test_drift_windows(spark, ctx):
    row = drift(spark, ctx, (0, "12"), (30, "12"), (31, "99"), (90, "99"), (91, "10"))
    assert (float(row.reference_mean), float(row.current_mean), float(row.pct_change), row.drift_flag) == (10, 12, 20, True)
    assert drift(spark, ctx, (0, "11.5"), (91, "10")).drift_flag is False  # exactly 15 % is no drift


def test_drift_of_a_negative_mean(spark, ctx):
    assert float(drift(spark, ctx, (0, "-12"), (91, "-10")).pct_change) == -20


@pytest.mark.parametrize("rows", [[(0, "1"), (91, "0")], [(0, "1")], [(0, None), (91, "1")], []])
def test_drift_unknown_raises_nothing(spark, ctx, rows):
    log = monitor.drift(frame(spark, *rows), ctx, features=["x"])
    assert log.first().pct_change is None and log.first().drift_flag is None
    assert monitor.alerts_from_drift(log, ctx).count() == 0


def test_drift_reads_its_table_once_after_the_date(spark, ctx, tmp_path):
    frame(spark, (0, "1"), (91, "2")).withColumn("y", F.col("x")).write.parquet(str(tmp_path / "t"))
    log = monitor.drift(spark.read.parquet(str(tmp_path / "t")), ctx, features=["x", "y"])
    assert log._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert log.count() == 2


def test_alert_texts(spark, ctx):
    log = monitor.drift(frame(spark, (0, "12"), (91, "10")), ctx, features=["x"])
    alert = monitor.alerts_from_drift(log, ctx).first()
    assert alert.message == 'Feature "x" shifted 20.0000% vs. baseline — review upstream source and consider retraining.'
    assert (alert.alert_type, alert.severity, alert.related_entity, alert.entity_kind) == ("Data Drift", "Warning", "x", "feature")
    metric = spark.createDataFrame(
        [("m", "RMSE", Decimal("150.0001"), ctx.as_of), ("m", "RMSE", Decimal("150"), ctx.as_of), ("m", "Recall", Decimal("0.5999"), ctx.as_of),
         ("m", "Recall", Decimal("0.6"), ctx.as_of), ("m", "MAE", Decimal("999"), ctx.as_of)],
        "model_name string, metric_name string, metric_value decimal(10,4), logged_at timestamp_ntz",
    )
    assert values(monitor.alerts_from_metrics(metric, ctx), "severity", "message") == [
        ("Critical", "m recall dropped to 0.5999 (threshold: 0.60) — schedule retraining review."),
        ("Warning", "RUL model RMSE degraded to 150.0001 days (threshold: 150)."),
    ]


@pytest.fixture
def alerts(spark, ctx):
    rows = [
        (1, "Data Drift", "Warning", "a", "x", "feature", 1, False),
        (2, "Data Drift", "Warning", "a", "x", "feature", 2, False),
        (3, "Model Performance", "Critical", "b", "m", "model", 1, False),
        (4, "Model Performance", "Critical", "c", "m", "model", 7, False),  # exactly seven days old
        (5, "Data Quality", "Critical", "d", "q", "rule", 1, False),
        (6, "Data Drift", "Info", "e", "x", "feature", 1, False),
        (7, "Data Drift", "Warning", "f", "x", "feature", 1, True),
    ]
    return spark.createDataFrame(
        [(*r[:6], ctx.as_of - timedelta(days=r[6]), r[7], None, None) for r in rows],
        "alert_id bigint, alert_type string, severity string, message string, related_entity string, entity_kind string, "
        "raised_at timestamp_ntz, acknowledged boolean, acknowledged_by string, acknowledged_at timestamp_ntz",
    )


def test_retraining_signal(alerts, ctx):
    assert values(monitor.retraining_required(alerts, ctx)) == [("m", "model", "b"), ("x", "feature", "a")]


def test_open_alerts_order(alerts):
    assert [r.severity for r in monitor.open_alerts(alerts).collect()] == ["Critical"] * 3 + ["Warning"] * 2 + ["Info"]
    assert monitor.open_alerts(alerts, textual=True).first().severity == "Warning"
    assert monitor.open_alerts(alerts, ["Info"]).count() == 1


def test_acknowledge(alerts, ctx, spark):
    seen = monitor.acknowledge(alerts, spark.createDataFrame([(3,), (99,)], "alert_id bigint"), ctx)
    assert values(seen.table.filter("acknowledged"), "alert_id", "acknowledged_by") == [(3, "tester"), (7, None)]
    assert seen.table.count() == 7 and seen.changes.count() == 1


def test_newest_run(alerts):
    assert values(newest_run(alerts, "raised_at"), "alert_id") == [(1,), (3,), (5,), (6,), (7,)]


def test_recent_drift(spark):
    at = datetime(2024, 6, 30)
    log = spark.createDataFrame(
        [("a", True, at), ("b", False, at), ("c", None, at), ("d", True, at - timedelta(days=7))],
        "feature_name string, drift_flag boolean, evaluated_at timestamp_ntz",
    )
    assert values(monitor.recent_drift(log, RunContext(at)), "feature_name") == [("a",)]


def test_limits_are_checked():
    with pytest.raises(ValueError):
        monitor.Limit("RMSE", "Severe", "x", above="1")
    with pytest.raises(ValueError):
        monitor.Limit("RMSE", "Warning", "x")
