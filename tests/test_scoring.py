import json
from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.operators import evaluate, features, scoring
from fleetpulse.plans import jobs, load
from fleetpulse.session import RunContext, stage
from fleetpulse.sources import months

ROUNDS = 8


@pytest.fixture(scope="module")
def history(rows, spark):
    """A year of snapshots in which a high debris reading goes with failure and short life."""
    ctx = RunContext(datetime(2024, 12, 31))
    days = [date(2024, 12, 30) - timedelta(days=d) for d in range(0, 360, 3)]
    batch = []
    for i, day in enumerate(days * 6):
        worn = (i * 7919) % 10 >= 7
        batch.append({
            "record_id": i, "snapshot_date": day, "component_serial_number": f"C{i % 40}", "aircraft_tail_number": f"N{i % 9}",
            "sensor_oil_debris_index": 8 + i % 3 if worn else i % 3, "sensor_vibration_index": None if i % 11 == 0 else 1,
            "remaining_useful_life_days": 20 if worn else 300, "failure_within_90_days": int(worn),
            "failure_within_30_days": int(worn and i % 2 == 0),
        })
    return rows(*batch), ctx


@pytest.fixture(scope="module")
def trained(history, spark, tmp_path_factory):
    batch, ctx = history
    layout = load.Layout(str(tmp_path_factory.mktemp("wh")), date(2024, 1, 1), date(2025, 1, 1))
    load.load_and_promote(batch, layout, ctx)
    jobs.run_nightly(spark, layout, ctx)
    jobs.train_models(spark, layout, ctx, rounds=ROUNDS, balanced=True)
    jobs.score_test_split(spark, layout, ctx)
    return layout, ctx


def test_nightly_without_models_logs_drift(trained, spark):
    layout, _ = trained
    assert spark.read.parquet(layout.path("drift_log")).count() == 4
    assert features.read_features(spark, layout.root).table.count() == 720


def test_scores_are_probabilities_for_every_test_row(trained, spark):
    layout, ctx = trained
    predictions = spark.read.parquet(layout.path("predictions"))
    test = features.temporal_split(features.read_features(spark, layout.root).table)["test"]
    assert predictions.count() == test.count() > 0
    out = predictions.filter(
        ~F.col("predicted_failure_prob_30d").between(0, 1) | ~F.col("predicted_failure_prob_90d").between(0, 1)
        | F.col("risk_tier").isNull()
    )
    assert out.count() == 0
    assert values(predictions.select("run_id", "scored_at").distinct()) == [(ctx.run_id, ctx.as_of)]
    factors = json.loads(predictions.first().top_contributing_factors)
    assert set(factors) == {"predicted_rul_days", "predicted_failure_prob_30d", "predicted_failure_prob_90d"}


def test_models_beat_a_constant_guess(trained, spark):
    layout, ctx = trained
    metrics = {(r.model_name, r.metric_name): float(r.metric_value) for r in jobs.run_weekly(spark, layout, ctx).collect()}
    assert metrics[scoring.RUL.name, "MAE"] < 100  # the mean would be off by about 118
    assert metrics[scoring.FAILURE_90D.name, "Recall"] > 0.9
    assert metrics[scoring.FAILURE_90D.name, "Precision"] > 0.9
    assert metrics[scoring.FAILURE_90D.name, "AUC"] > 0.9 and metrics[scoring.FAILURE_90D.name, "F1"] > 0.9
    assert spark.read.parquet(layout.path("performance_log")).count() == 10
    noted = months.read_version(spark, layout.path("model_registry")).filter("is_active")
    kept = {r.model_name: json.loads(r.performance_metrics) for r in noted.collect()}
    assert {(m, name): value for m, each in kept.items() for name, value in each.items()} == metrics
    assert jobs.retraining_signal(spark, layout, ctx).columns == ["entity", "entity_kind", "reason"]


def test_registry_keeps_the_first_card_of_a_version(trained, spark):
    layout, ctx = trained
    before = values(months.read_version(spark, layout.path("model_registry")), "model_name", "training_data_summary")
    assert len(before) == 3
    cards = scoring.registry_rows(spark, scoring.MODELS, 5, "features_v1", ctx)
    registry = months.read_version(spark, layout.path("model_registry"))
    assert scoring.register(registry, cards).count() == 0
    assert scoring.register(None, cards).count() == 3
    assert scoring.active_models(registry).count() == 3
    card = cards.filter(F.col("model_name") == scoring.FAILURE_30D.name).first()
    assert json.loads(card.hyperparameters) == {"n_estimators": 250, "max_depth": 5, "learning_rate": 0.05}
    assert json.loads(card.training_data_summary) == {"training_rows": 5}


def test_training_is_repeatable_and_names_its_strongest_inputs(trained, spark):
    layout, _ = trained
    split = features.temporal_split(features.read_features(spark, layout.root).table)
    models = [scoring.train(split["train"], scoring.FAILURE_90D, rounds=2) for _ in range(2)]
    a, b = [values(scoring.predict(split["test"], m, scoring.FAILURE_90D), "record_id", "predicted_failure_prob_90d") for m in models]
    assert a == b
    top = list(json.loads(scoring.contributing_factors(models[0], scoring.FAILURE_90D)))
    assert len(top) >= 5 and top[0] in ("sensor_oil_debris_index", "sensor_composite_risk_score")


def test_unseen_category_and_missing_numbers_still_score(trained, spark):
    layout, _ = trained
    split = features.temporal_split(features.read_features(spark, layout.root).table)
    model = scoring.train(split["train"], scoring.RUL, rounds=2)
    odd = split["test"].limit(3).withColumns({
        "component_type": F.lit("Never seen"), "fleet_type": F.lit(None).cast("string"),
        **{c: F.lit(None).cast("double") for c in scoring.NUMERIC},
    })
    assert scoring.predict(odd, model, scoring.RUL).filter("predicted_rul_days is not null").count() == 3


def test_more_categories_than_default_bins(trained, spark):
    layout, _ = trained
    table = features.read_features(spark, layout.root).table
    many = table.withColumn("component_type", F.concat(F.lit("kind "), F.col("record_id") % 70))
    assert scoring.predict(many, scoring.train(many, scoring.RUL, rounds=1), scoring.RUL).count() == table.count()


def test_inputs_hold_no_answer():
    leaks = {"record_id", "snapshot_date", "component_serial_number", "aircraft_tail_number", "computed_at",
             "remaining_useful_life_days", "failure_within_30_days", "failure_within_90_days"}
    assert not leaks & set(scoring.NUMERIC + scoring.CATEGORICAL)


def test_class_weight_balances(spark):
    df = spark.createDataFrame([(1.0,)] + [(0.0,)] * 9, "label double")
    weighted = df.withColumn("w", scoring.class_weight(df, "label"))
    assert {k: round(v, 6) for k, v in values(weighted.groupBy("label").agg(F.sum("w")))} == {0.0: 5.0, 1.0: 5.0}
    assert df.filter("label = 0").select(scoring.class_weight(df.filter("label = 0"), "label").alias("w")).first().w == 1.0


def test_override_log_and_sample(trained, spark):
    layout, ctx = trained
    table = features.read_features(spark, layout.root).table
    with pytest.raises(ValueError):
        scoring.override_row(spark, 1, 1, {}, "Maybe", "me", "", ctx)
    verdicts = [scoring.override_row(spark, i, 1, {"risk_tier": "High"}, d, "me", "", ctx)
                for i, d in ((1, "Confirmed"), (1, "Confirmed"), (2, "Overridden"), (3, "Confirmed"))]
    log = stage(verdicts[0].unionByName(verdicts[1]).unionByName(verdicts[2]).unionByName(verdicts[3]), "overrides")
    assert values(scoring.confirmed_sample(table, log), "record_id") == [(1,), (3,)]
    assert scoring.confirmed_sample(table, log, rows=1).collect() == scoring.confirmed_sample(table, log, rows=1).collect()
    assert scoring.confirmed_sample(table, log, rows=1, seed=3).count() == 1


def test_threshold_is_chosen_on_the_validation_split(trained, spark):
    layout, ctx = trained
    split = features.temporal_split(features.read_features(spark, layout.root).table)
    model = scoring.train(split["train"], scoring.FAILURE_90D, rounds=ROUNDS)
    scored = scoring.predict(split["validation"], model, scoring.FAILURE_90D)
    sweep = evaluate.threshold_sweep(scored, split["validation"], "predicted_failure_prob_90d", "failure_within_90_days")
    assert [str(r.threshold) for r in sweep.collect()] == ["0.2000", "0.3000", "0.4000", "0.5000"]


def test_override_rows_equal_single_rows(spark, ctx):
    rows = [(i, tier, "Confirmed") for i, tier in enumerate(["High", 'a "b"\\', None, "Low", "High"])]
    table = spark.createDataFrame(rows, "record_id long, risk_tier string, verdict string")
    log = scoring.override_rows(table, 1, ["risk_tier", "record_id"], F.col("verdict"), F.lit("me"), F.lit("seen"), ctx)
    single = [scoring.override_row(spark, i, 1, {"risk_tier": t, "record_id": i}, d, "me", "seen", ctx) for i, t, d in rows]
    assert values(log) == sorted(v for one in single for v in values(one.select(*log.columns)))
    with pytest.raises(Exception, match="decision must be one of"):
        scoring.override_rows(table, 1, [], F.lit("Maybe"), F.lit("me"), F.lit(""), ctx).collect()


def test_override_log_holds_every_high_prediction(spark):
    from fleetpulse.testbed.queries import QUERIES
    from fleetpulse.testbed.tables import bed

    sf = "/root/testdata/sf0.001"
    high = bed(spark, sf).predictions.filter("run_id = 'r2' and risk_tier = 'High'")
    assert high.count() > 3
    assert values(QUERIES["override_log"](spark, sf), "record_id") == values(high, "record_id")


def test_validation_stops_the_boosting(trained, spark):
    layout, ctx = trained
    # The label is noise here, so that more rounds fit the training rows only.
    noise = F.pmod(F.xxhash64("record_id"), F.lit(2)).cast("int")
    parts = {k: stage(v.withColumn("failure_within_90_days", noise), k) for k, v in features.read_features(spark, layout.root).split().items()}
    train, held = parts["train"], parts["validation"]
    assert held.count() > 0
    most = 6
    stopped = scoring.train(train, scoring.FAILURE_90D, rounds=most, balanced=True, validation=held)
    assert 1 <= scoring.rounds_used(stopped) < most
    # Nothing held, nothing to stop by.
    nothing = held.withColumn("failure_within_90_days", F.lit(None).cast("int"))
    assert scoring.rounds_used(scoring.train(train, scoring.FAILURE_90D, rounds=2, validation=nothing)) == 2


def test_boosting_runs_a_task_per_core_and_not_per_file(trained, spark, monkeypatch):
    layout, _ = trained
    table = features.read_features(spark, layout.root).table
    sc, files = spark.sparkContext, 24
    many = stage(table.repartition(files), "many_files").repartition(files)

    def tasks(name):
        sc.setJobGroup(name, name)
        model = scoring.train(many, scoring.FAILURE_90D, rounds=3)
        sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(i) for i in tracker.getJobInfo(max(tracker.getJobIdsForGroup(name))).stageIds]
        return max(s.numTasks for s in stages if s and s.numCompletedTasks), model

    assert tasks("few rows")[0] == 1
    monkeypatch.setattr(scoring, "LEAST_ROWS", 10)
    found, model = tasks("more rows")
    assert found == sc.defaultParallelism < files
    monkeypatch.setattr(scoring, "MOST_ROWS", 100)
    found, again = tasks("many rows")
    assert found == sc.defaultParallelism * 2 and table.count() == 720
    # Every row is dealt once, in shares of one size.
    dealt = scoring._dealt(many.select("record_id", "snapshot_date"), 720)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in sizes) == 720 and max(r[1] for r in sizes) - min(r[1] for r in sizes) <= files
    assert scoring.rounds_used(model) == scoring.rounds_used(again) == 3


def test_card_names_the_rounds(trained, spark):
    layout, _ = trained
    cards = months.read_version(spark, layout.path("model_registry")).collect()
    assert {json.loads(r.training_data_summary)["rounds_used"] for r in cards} == {ROUNDS}


def test_boosting_moves_a_byte_per_input_and_finds_the_trees_of_mllib(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.evaluation import RegressionEvaluator

    from fleetpulse.operators import boosting

    kinds = F.array(*[F.lit(k) for k in "abcde"])
    table = stage(spark.range(3000).select(
        (F.col("id") % 7).cast("double").alias("x"), ((F.col("id") * 31) % 30).cast("double").alias("z"),
        F.element_at(kinds, (F.col("id") % 5 + 1).cast("int")).alias("kind"),
    ).withColumn("y", F.col("x") * 10 + F.when(F.col("kind").isin("b", "d"), 40).otherwise(0) + F.when(F.col("z") > 14, 7).otherwise(0)), "boosted")
    spec = replace(scoring.RUL, label="y", output="p", numeric=["x", "z"], categorical=["kind"], depth=3, rounds=4, rate=0.5)
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    model = scoring.train(table, spec)
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == before

    assembled = PipelineModel(model.stages[:-1]).transform(scoring._inputs(table, spec)).withColumn("label", F.col("y").cast("double"))
    whole = scoring._estimator(spec, 4, 32, None, 1).fit(assembled)
    for ours, theirs in zip(model.stages[-1].trees, whole.trees):
        assert ours.numNodes == theirs.numNodes and ours.depth == theirs.depth
    error = RegressionEvaluator()
    assert error.evaluate(model.stages[-1].transform(assembled)) == pytest.approx(error.evaluate(whole.transform(assembled)), rel=1e-6)
    assert list(model.stages[-1].featureImportances.toArray()) == pytest.approx(list(whole.featureImportances.toArray()), rel=1e-6)

    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert values(scoring.predict(table, again, spec)) == values(scoring.predict(table, model, spec))
    assert again.stages[-1].getMaxIter() == 4

    inputs = [boosting.Input("x", np.array([0.5])), boosting.Input("z", np.array([3.5, 7.5])), boosting.Input("kind", categories=5)]
    blocks = boosting._blocks(table.coalesce(1).withColumn("kind", F.lit(1.0)), inputs, False, "y", None, None)
    assert [b.bins.shape for b in blocks.collect()] == [(3, 3000)] and blocks.first().bins.itemsize == 1
    blocks.unpersist()


def test_pure_nodes_are_leaves_and_empty_bins_stay_empty():
    from fleetpulse.operators import boosting

    inputs = [boosting.Input("x", np.array([1.0, 2.0])), boosting.Input("k", categories=3)]
    same = np.array([[[3.0, 2.0, 1.0], [2.0, 2.0, 2.0]], [[0.3, 0.2, 0.1], [0.2, 0.2, 0.2]]])
    apart = np.array([[[3.0, 2.0, 0.0], [2.0, 0.0, 3.0]], [[0.0, 8.0, 0.0], [8.0, 0.0, 0.0]]])
    none, split = boosting._splits(np.stack([same, apart]), inputs)
    assert none is None
    i, goes_left, gain, left, right = split
    assert (i, list(goes_left), list(left), list(right)) == (0, [True, False, False], [3, 0], [2, 8])
    assert gain == pytest.approx(16 * 2 / 5 - (8 / 5) ** 2)
    found = boosting._splits(apart[None, :, 1:].repeat(2, axis=2), inputs[1:] * 2)[0]
    assert found[0] == 0 and list(np.flatnonzero(found[1])) in ([2], [0])
