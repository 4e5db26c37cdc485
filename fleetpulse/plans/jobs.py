"""The recurring jobs as plain functions; any scheduler can call them."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators import evaluate, features, monitor, scoring
from fleetpulse.operators.quality import newest_run
from fleetpulse.plans import marts
from fleetpulse.plans.load import Layout, curated, days_of, extend_spine, spine
from fleetpulse.session import RunContext, stage
from fleetpulse.sources import extract, months


def refresh_features(spark: SparkSession, layout: Layout, ctx: RunContext, version: str = features.VERSION) -> DataFrame:
    """Rebuild a feature version from the curated tables and return its rows."""
    tables = curated(spark, layout)
    built = features.build_features(
        tables["fact"], tables["dim_component"], tables["dim_aircraft"], tables["dim_supplier"], ctx, version=version,
        days=days_of(spark, layout, "cohort_days"),
    )
    in_force = spine(spark, layout)
    return features.save_features(built, layout.root, version, in_force.spine_start, in_force.spine_end).table


def run_nightly(spark: SparkSession, layout: Layout, ctx: RunContext) -> DataFrame:
    """Refresh the features, log drift, raise its alerts, score if models exist.

    Returns the drift rows.
    """
    built = refresh_features(spark, layout, ctx)
    days, newest = days_of(spark, layout, "feature_days"), features.read_features(spark, layout.root).newest
    drift = stage(monitor.drift(built, ctx, end=newest) if days is None else monitor.drift_of_days(days, ctx), "drift")
    extract.write_log(drift, layout.path("drift_log"), ctx)
    extract.write_log(monitor.alerts_from_drift(drift, ctx), layout.path("alerts/drift"), ctx)
    if months.read_version(spark, layout.path("model_registry")) is not None:
        score_test_split(spark, layout, ctx)
    return drift


def train_models(
    spark: SparkSession, layout: Layout, ctx: RunContext, specs=tuple(scoring.MODELS), rounds: int | None = None, balanced: bool = False,
    early_stopping: bool = False,
) -> None:
    """Train on the train split, save the pipelines under new versions and make those the active ones.

    A version is registered only after its model is saved, and a registered one is never
    overwritten. ``early_stopping`` ends boosting by the validation split; the card says how
    many rounds a model has.
    """
    parts = features.read_features(spark, layout.root).split()
    split, held = parts["train"], parts["validation"] if early_stopping else None
    registry = months.read_version(spark, layout.path("model_registry"))
    specs = scoring.next_versions(registry, list(specs))
    used = {}
    for spec in specs:
        model = scoring.train(split, spec, rounds=rounds, balanced=balanced, validation=held)
        used[spec.name] = scoring.rounds_used(model)
        model.write().overwrite().save(layout.path(f"models/{spec.name}/{spec.version}"))
    cards = scoring.registry_rows(spark, specs, split.count(), f"features_{features.VERSION}", ctx, used)
    months.write_version(stage(scoring.promote_versions(registry, cards), "registry"), layout.path("model_registry"))


def score_test_split(spark: SparkSession, layout: Layout, ctx: RunContext, specs=tuple(scoring.MODELS)) -> None:
    """Score the newest rows with the active versions of the saved models and log the predictions."""
    registry = months.read_version(spark, layout.path("model_registry"))
    # One row per model.
    active = {r.model_name: r.model_version for r in scoring.active_models(registry).collect()}
    models = {}
    for spec in specs:
        if spec.name in active:
            spec = replace(spec, version=active[spec.name])
            models[spec.name] = (spec, PipelineModel.load(layout.path(f"models/{spec.name}/{spec.version}")))
    rows = scoring.score(features.read_features(spark, layout.root).split()["test"], models, ctx)
    extract.write_log(rows, layout.path("predictions"), ctx)
    refresh_risk(spark, layout, ctx)


def refresh_risk(spark: SparkSession, layout: Layout, ctx: RunContext) -> DataFrame:
    """Bring the kept view of the newest prediction per component up to the run ``ctx``, which is in the log."""
    tables = curated(spark, layout)
    run = extract.read_run(spark, layout.path("predictions"), ctx)
    kept = months.read_version(spark, layout.path("risk_view"))
    log = extract.read_log(spark, layout.path("predictions"))
    view = marts.refresh_risk_view(kept, run, ctx, tables["fact"], tables["dim_aircraft"], log)
    return months.write_version(view, layout.path("risk_view"))


def export_risk(spark: SparkSession, layout: Layout, ctx: RunContext, path: str, days: int = 1) -> None:
    """Export the components whose newest prediction was made within the last days, with their master data."""
    tables = curated(spark, layout)
    view = months.read_version(spark, layout.path("risk_view"))
    extract.export_recent(marts.component_risk(view, tables["dim_component"], tables["dim_aircraft"]), path, ctx, days)


def run_weekly(spark: SparkSession, layout: Layout, ctx: RunContext, limits=tuple(monitor.LIMITS)) -> DataFrame:
    """Evaluate the newest scoring run of all three models, log the metrics, note them in the registry, raise alerts."""
    # The newest run is among the newest day's, which prunes all other days.
    log = spark.read.parquet(layout.path("predictions"))
    day = log.agg(F.max("run_day")).first()[0]
    newest = newest_run(log.filter(F.col("run_day") == F.lit(day)).drop("run_day", "run"), "scored_at")
    # Outcomes are read for the months of the run's snapshots only.
    first, last = newest.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    truth = features.read_features(spark, layout.root).dated(first, last)
    models = [spec.target for spec in scoring.MODELS]
    metrics = evaluate.evaluate(newest, truth, models, ctx).unionByName(evaluate.ranking(newest, truth, models, ctx))
    metrics = stage(metrics, "metrics")
    extract.write_log(metrics, layout.path("performance_log"), ctx)
    extract.write_log(monitor.alerts_from_metrics(metrics, ctx, list(limits)), layout.path("alerts/metrics"), ctx)
    registry = months.read_version(spark, layout.path("model_registry"))
    if registry is not None:
        months.write_version(stage(scoring.with_metrics(registry, metrics), "registry"), layout.path("model_registry"))
    return metrics


def run_monthly(spark: SparkSession, layout: Layout, ctx: RunContext) -> Layout:
    """Open next month's partition ahead of its first load."""
    month = ctx.as_of.year * 12 + ctx.as_of.month + 1
    after = date(month // 12, month % 12 + 1, 1)
    return extend_spine(layout, after, spark)


def retraining_signal(spark: SparkSession, layout: Layout, ctx: RunContext) -> DataFrame:
    """Models and features with open alerts of the last week."""
    return monitor.retraining_required(extract.read_log(spark, layout.path("alerts")), ctx).orderBy(F.col("entity"))
