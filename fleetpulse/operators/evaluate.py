"""Accuracy of stored predictions against known outcomes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetpulse.functions import exact_mean, exact_round, ratio, surrogate_key
from fleetpulse.schema import FACT_KEYS
from fleetpulse.session import RunContext, timestamp

# Decision threshold, sweep thresholds and the metric type.
DECISION = "0.5"
SWEEP = ["0.2", "0.3", "0.4", "0.5"]
METRIC = "decimal(10,4)"
PROBABILITY = "decimal(6,4)"
DAYS = "decimal(12,4)"


@dataclass(frozen=True)
class Target:
    """What to evaluate: a model, the prediction column it filled and its outcome column."""

    model: str
    task: str
    output: str
    label: str

    @property
    def metrics(self) -> list[str]:
        return ["RMSE", "MAE"] if self.task == "regression" else ["Precision", "Recall"]


def with_outcomes(
    predictions: DataFrame, truth: DataFrame, labels: list[str], run_id: str | None = None, version: str | None = None
) -> DataFrame:
    """Predictions joined to their outcomes on record and date, unique on both sides
    within a run. A run or a model version given here really filters."""
    if run_id is not None:
        predictions = predictions.filter(F.col("run_id") == run_id)
    if version is not None:
        predictions = predictions.filter(F.col("model_version") == version)
    outcomes = truth.select(*FACT_KEYS, *[F.col(c).alias(f"true_{c}") for c in dict.fromkeys(labels)])
    return predictions.join(outcomes, FACT_KEYS)


def evaluate(
    predictions: DataFrame,
    truth: DataFrame,
    targets: list[Target],
    ctx: RunContext,
    *,
    run_id: str | None = None,
    version: str | None = None,
    since: date | None = None,
    until: date | None = None,
    threshold: str = DECISION,
    by: list[Column] = (),
) -> DataFrame:
    """Log rows, two metrics per target, all from one join and one aggregation.

    RMSE and MAE for a regression; precision and recall at a strict threshold for a
    classifier, NULL where nothing was flagged or nothing failed. ``sample_size`` counts
    the joined rows, ``n_scored`` those the target has a prediction (and for a regression
    an outcome) for. Rows are chosen by run, version and date (``since`` and ``until``
    included), since one scoring run keeps the output of all models in one row. Every
    model version present is evaluated on its own. ``by`` gives one evaluation per group.
    """
    joined = with_outcomes(_dated(predictions, since, until), truth, [t.label for t in targets], run_id, version)
    aggregates, rows = [], []
    for i, target in enumerate(targets):
        first, second, scored = _metrics(target, threshold)
        aggregates += [first.alias(f"a{i}"), second.alias(f"b{i}"), scored.alias(f"n{i}")]
        rows += [
            F.struct(
                F.lit(target.model).alias("model_name"),
                F.lit(name).alias("metric_name"),
                exact_round(F.col(f"{column}{i}"), 4).cast(METRIC).alias("metric_value"),
                F.col(f"n{i}").alias("n_scored"),
            )
            for name, column in zip(target.metrics, "ab")
        ]
    # A version asked for gives its row even if nothing was scored; else each version found has its own.
    each = [*by, "model_version"] if version is None else list(by)
    totals = joined.groupBy(*each).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.min("snapshot_date").alias("evaluation_window_start"),
        F.max("snapshot_date").alias("evaluation_window_end"),
        *aggregates,
    )
    groups = totals.columns[: len(by)]
    if version is not None:
        totals = totals.withColumn("model_version", F.lit(version))
    window = ["evaluation_window_start", "evaluation_window_end"]
    return _log_rows(totals.select(*groups, "model_version", *window, "sample_size", F.inline(F.array(*rows))), groups, ctx)


def _dated(predictions: DataFrame, since: date | None, until: date | None) -> DataFrame:
    if since is not None:
        predictions = predictions.filter(F.col("snapshot_date") >= F.lit(since))
    if until is not None:
        predictions = predictions.filter(F.col("snapshot_date") <= F.lit(until))
    return predictions


def _log_rows(metrics: DataFrame, groups: list[str], ctx: RunContext) -> DataFrame:
    window = ["evaluation_window_start", "evaluation_window_end"]
    return metrics.select(
        surrogate_key(
            F.col("model_name"), F.col("model_version"), F.col("metric_name"), F.col(window[0]), F.lit(ctx.run_id)
        ).alias("log_id"),
        "model_name",
        "model_version",
        *groups,
        *window,
        "metric_name",
        "metric_value",
        "sample_size",
        "n_scored",
        ctx.time.alias("logged_at"),
    )


# Scores between 0 and 1 are ranked in this many ranges.
RANGES = 1024


def rank_sums(scores: DataFrame, keys: list[str], carried: list[Column] = ()) -> DataFrame:
    """Per group of ``keys``: positives, negatives and ``pairs``, twice the (positive, negative) pairs that the score orders right.

    ``scores`` holds one row per group and score with the counts ``positives`` and
    ``negatives``. A pair of equal scores is half right. Ranks run inside ranges of the score,
    then over the totals of the ranges, of which a group has at most ``RANGES`` + 1, so no task
    ranks all scores of a group, and ties, however many, are one row. Products are decimals:
    pairs outgrow 64 bits before rows do. ``carried`` are aggregates that keep a column's name
    and may be applied to their own results, such as sums; they come along.
    """
    at = F.least(F.greatest(F.floor(F.col("score") * RANGES), F.lit(0)), F.lit(RANGES))
    inside = W.partitionBy(*keys, "_range").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    below = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)

    def fewer(frame) -> Column:
        return F.coalesce(F.sum("negatives").over(frame), F.lit(0)) * 2

    def pairs(negatives: Column) -> Column:
        return F.col("positives").cast("decimal(18,0)") * negatives.cast("decimal(19,0)")

    sums = [F.sum(c).cast(kind).alias(c) for c, kind in (("positives", "bigint"), ("negatives", "bigint"), ("pairs", "decimal(38,0)"))]
    ranked = scores.withColumn("_range", at).withColumn("pairs", pairs(fewer(inside) + F.col("negatives")))
    ranges = ranked.groupBy(*keys, "_range").agg(*sums, *carried)
    return ranges.withColumn("pairs", F.col("pairs") + pairs(fewer(below))).groupBy(*keys).agg(*sums, *carried)


def ranking(
    predictions: DataFrame,
    truth: DataFrame,
    targets: list[Target],
    ctx: RunContext,
    *,
    run_id: str | None = None,
    version: str | None = None,
    since: date | None = None,
    until: date | None = None,
    threshold: str = DECISION,
    by: list[Column] = (),
) -> DataFrame:
    """Log rows of the classifiers among the targets: AUC, and F1 at a strict threshold.

    AUC is the share of (failed, sound) pairs in which the failed one scores higher, a tie
    counting half, exact over all rows with a score and an outcome; NULL if there is no such
    pair. F1 is 2 hits over flagged plus failed, NULL where nothing was flagged or failed. All
    models are ranked together: rows shrink to one per score map-side, then ``rank_sums``.
    Options, ``sample_size`` and ``n_scored`` are those of ``evaluate``; a version without
    rows has none here.
    """
    models = [t for t in targets if t.task == "classification"]
    joined = with_outcomes(_dated(predictions, since, until), truth, [t.label for t in models], run_id, version)
    each = [
        F.struct(
            F.lit(t.model).alias("model_name"),
            F.col(t.output).cast("double").alias("score"),
            (F.col(t.output) > F.lit(threshold).cast(PROBABILITY)).alias("flagged"),
            (F.col(f"true_{t.label}") == 1).alias("failed"),
        )
        for t in models
    ]
    rows = joined.select("model_version", "snapshot_date", F.explode(F.array(*each)).alias("_t"), *by)
    groups = rows.columns[3:]
    keys = ["model_name", "model_version", *groups]
    rows = rows.select("model_version", "snapshot_date", *groups, "_t.*")
    scored, failed, flagged = F.col("score").isNotNull(), F.col("failed"), F.col("flagged")
    start, end = "evaluation_window_start", "evaluation_window_end"
    scores = rows.groupBy(*keys, "score").agg(
        F.count_if(scored & failed).alias("positives"),
        F.count_if(scored & ~failed).alias("negatives"),
        F.count_if(flagged & failed).alias("hits"),
        (F.count_if(flagged) + F.count_if(failed)).alias("either"),
        F.count(F.lit(1)).alias("sample_size"),
        F.count("score").alias("n_scored"),
        F.min("snapshot_date").alias(start),
        F.max("snapshot_date").alias(end),
    )
    carried = [F.sum(c).alias(c) for c in ("hits", "either", "sample_size", "n_scored")] + [F.min(start).alias(start), F.max(end).alias(end)]
    sums = rank_sums(scores, keys, carried)
    both = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    auc = F.col("pairs").cast("double") / F.nullif(both, F.lit(0.0))
    values = [
        F.struct(F.lit("AUC").alias("metric_name"), exact_round(auc, 4).cast(METRIC).alias("metric_value")),
        F.struct(F.lit("F1").alias("metric_name"), ratio(F.col("hits") * 2, F.col("either"), 4).cast(METRIC).alias("metric_value")),
    ]
    return _log_rows(sums.select(*keys, start, end, "sample_size", "n_scored", F.inline(F.array(*values))), groups, ctx)


def evaluate_regression(
    predictions: DataFrame,
    truth: DataFrame,
    model: str,
    ctx: RunContext,
    *,
    pred_col: str = "predicted_rul_days",
    label_col: str = "remaining_useful_life_days",
    **options,
) -> DataFrame:
    """RMSE and MAE of one model."""
    return evaluate(predictions, truth, [Target(model, "regression", pred_col, label_col)], ctx, **options)


def evaluate_classifier(
    predictions: DataFrame, truth: DataFrame, model: str, prob_col: str, label_col: str, ctx: RunContext, **options
) -> DataFrame:
    """Precision and recall of one model."""
    return evaluate(predictions, truth, [Target(model, "classification", prob_col, label_col)], ctx, **options)


def threshold_sweep(
    predictions: DataFrame,
    truth: DataFrame,
    prob_col: str,
    label_col: str,
    *,
    thresholds: list[str] = SWEEP,
    run_id: str | None = None,
    version: str | None = None,
) -> DataFrame:
    """Precision and recall per threshold: one pass with a pair of aggregates each, rather
    than every row once per threshold."""
    joined = with_outcomes(predictions, truth, [label_col], run_id, version)
    aggregates, rows = [], []
    for i, threshold in enumerate(thresholds):
        precision, recall = _precision_recall(prob_col, label_col, threshold)
        aggregates += [precision.alias(f"p{i}"), recall.alias(f"r{i}")]
        rows.append(
            F.struct(
                F.lit(threshold).cast(PROBABILITY).alias("threshold"),
                F.col(f"p{i}").alias("precision"),
                F.col(f"r{i}").alias("recall"),
            )
        )
    return joined.agg(*aggregates).select(F.inline(F.array(*rows))).orderBy("threshold")


def metric_trend(log: DataFrame, ctx: RunContext, days: int = 90) -> DataFrame:
    """Average, lowest and highest value and number of entries per model and metric."""
    recent = log.filter(F.col("logged_at") > timestamp(ctx.as_of - timedelta(days=days)))
    value = F.col("metric_value")
    return (
        recent.groupBy("model_name", "metric_name")
        .agg(
            exact_round(exact_mean(value), 4).alias("avg_metric"),
            F.min(value).alias("min_metric"),
            F.max(value).alias("max_metric"),
            F.count(F.lit(1)).alias("samples"),
        )
        .orderBy("model_name", "metric_name")
    )


def _metrics(target: Target, threshold: str) -> tuple[Column, Column, Column]:
    if target.task == "regression":
        # Exact sums, so that the order of the rows does not show.
        error = F.col(target.output).cast(DAYS) - F.col(f"true_{target.label}").cast(DAYS)
        square, size = F.sum((error * error).cast("decimal(28,8)")), F.sum(F.abs(error))
        n = F.nullif(F.count(error), F.lit(0))
        return F.sqrt(square.cast("double") / n), size.cast("double") / n, F.count(error)
    return *_precision_recall(target.output, target.label, threshold), F.count(F.col(target.output))


def _precision_recall(prob_col: str, label_col: str, threshold: str) -> tuple[Column, Column]:
    flagged = F.col(prob_col) > F.lit(threshold).cast(PROBABILITY)
    failed = F.col(f"true_{label_col}") == 1
    hits = F.count_if(flagged & failed)
    return ratio(hits, F.count_if(flagged), 4), ratio(hits, F.count_if(failed), 4)
