"""Tree models on MLlib: training, batch scoring, registry, overrides and samples."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import exact_round, risk_tier, surrogate_key
from fleetpulse.operators import attribution, boosting
from fleetpulse.operators.evaluate import Target
from fleetpulse.operators.merge import insert_if_absent
from fleetpulse.schema import LOG_DOMAINS, PREDICTIONS, names, require
from fleetpulse.session import RunContext

# Model inputs: no ids, dates or labels, which would leak the answer.
CATEGORICAL = ["component_type", "fleet_type", "operating_environment"]
NUMERIC = [
    "pct_of_design_life_consumed",
    "hours_per_cycle",
    "unscheduled_removal_ratio",
    "sensor_composite_risk_score",
    "maintenance_recency_score",
    "rolling_30d_component_type_failure_rate",
    "aircraft_age_years",
    "avg_daily_utilization_hours",
    "supplier_quality_score",
    "cumulative_flight_hours",
    "cumulative_flight_cycles",
    "prior_removal_count",
    "prior_unscheduled_removal_count",
    "days_since_last_maintenance_event",
    "maintenance_events_last_12_months",
    "sensor_vibration_index",
    "sensor_oil_debris_index",
    "health_monitoring_score",
    "anomaly_count_last_30_days",
    "corrosion_risk_index",
]


# Marks the rows that decide when boosting stops.
HELD = "_held"

# Factors that a prediction keeps of each model.
FACTORS = 5

# Fixed value: the use case all cards name.
USE_CASE = "Component Health Assessment & RUL Estimation"


@dataclass(frozen=True)
class ModelSpec:
    """A model's target and settings, and the card the registry keeps of it."""

    name: str
    task: str
    label: str
    output: str
    rounds: int
    depth: int
    rate: float
    intended_use: str
    known_limitations: str
    version: str = "v1"
    use_case: str = USE_CASE
    risk_classification: str = "High"
    numeric: list[str] = field(default_factory=lambda: list(NUMERIC))
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL))

    def __post_init__(self):
        require(self.task, LOG_DOMAINS["problem_type"], "task")
        require(self.risk_classification, LOG_DOMAINS["risk_classification"], "risk_classification")

    @property
    def target(self) -> Target:
        return Target(self.name, self.task, self.output, self.label)

    @property
    def hyperparameters(self) -> str:
        return json.dumps({"n_estimators": self.rounds, "max_depth": self.depth, "learning_rate": self.rate})


# Rounds, depth and rate of the three models.
RUL = ModelSpec(
    "component_rul_regression", "regression", "remaining_useful_life_days", "predicted_rul_days", 300, 6, 0.05,
    intended_use="Maintenance planning: find components close to the end of their life.",
    known_limitations="Trained on historical extracts; validate again before use on new component types.",
)
FAILURE_90D = ModelSpec(
    "component_failure_90d_classification", "classification", "failure_within_90_days", "predicted_failure_prob_90d",
    300, 5, 0.05,
    intended_use="Rank components for inspection within 90 days.",
    known_limitations="Imbalanced classes (about 9% positive); tune the threshold for recall, review High flags.",
)
FAILURE_30D = ModelSpec(
    "component_failure_30d_classification", "classification", "failure_within_30_days", "predicted_failure_prob_30d",
    250, 5, 0.05,
    intended_use="Urgent triage within 30 days.",
    known_limitations="Very imbalanced classes (about 4% positive); precision drops on unseen component types.",
)
MODELS = [RUL, FAILURE_90D, FAILURE_30D]


# Training rows that one task reads at each tree level, at least (but for the last share) and at most.
LEAST_ROWS, MOST_ROWS = 20_000, 2_000_000

# How much a round must lower the validation error, as a share of it, for boosting to go on.
TOLERANCE = 0.01


def train(
    df: DataFrame, spec: ModelSpec, *, rounds: int | None = None, balanced: bool = False, seed: int = 42,
    validation: DataFrame | None = None, tolerance: float = TOLERANCE,
) -> PipelineModel:
    """Fit a boosted-tree pipeline on the rows with a label.

    Missing numbers get the training median, plus a flag column where training has gaps;
    unseen categories get a bucket of their own; a column without any value is left out. ``balanced`` weights each class by its inverse frequency. The assembled
    rows are kept while fitting, since boosting reads them once per tree level.

    With ``validation`` boosting stops at the round from which the error on its labelled rows
    falls by less than ``tolerance``, a share of it (below an error of 0.01, of 0.01), and keeps the trees up
    to the best one; its rows teach neither trees, medians nor categories. ``rounds`` stays the
    most there can be. Without a labelled row in it, all rounds are made.
    """
    rows = _inputs(df.filter(F.col(spec.label).isNotNull()), spec).withColumn("label", F.col(spec.label).cast("double"))
    weight = None
    if balanced and spec.task == "classification":
        rows, weight = rows.withColumn("weight", class_weight(rows, "label")), "weight"

    total, *known = rows.agg(F.count(F.lit(1)), *[F.count(c) for c in spec.numeric]).first()
    numeric = [c for c, n in zip(spec.numeric, known) if n]
    gaps = [c for c, n in zip(spec.numeric, known) if 0 < n < total]
    prepared = Pipeline(stages=[
        Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric]),
        StringIndexer(
            inputCols=spec.categorical, outputCols=[f"{c}_index" for c in spec.categorical], handleInvalid="keep"
        ),
        VectorAssembler(
            inputCols=[f"{c}_filled" for c in numeric]
            + [f"{c}_missing" for c in gaps]
            + [f"{c}_index" for c in spec.categorical],
            outputCol="features",
        ),
    ]).fit(rows)
    # A tree bins each category separately, so the widest text column sets the number of bins.
    labels = [len(found) + 1 for found in prepared.stages[1].labelsArray]
    bins = max(32, *labels)
    limits = boosting.limits_of(rows, numeric, bins)
    inputs = [
        *[boosting.Input(f"{c}_filled", limits[c]) for c in numeric],
        *[boosting.Input(f"{c}_missing", np.array([0.5])) for c in gaps],
        *[boosting.Input(f"{c}_index", categories=n) for c, n in zip(spec.categorical, labels)],
    ]
    held = None if validation is None else validation.filter(F.col(spec.label).isNotNull())
    stops = held is not None and not held.isEmpty()
    if stops:
        held = _inputs(held, spec).withColumn("label", F.col(spec.label).cast("double"))
        # The error on held rows is not weighted.
        held = held.withColumn("weight", F.lit(1.0)) if weight else held
        rows = rows.withColumn(HELD, F.lit(False)).unionByName(held.withColumn(HELD, F.lit(True)))
    given = [*numeric, *[f"{c}_missing" for c in gaps], *spec.categorical, "label", *([weight] if weight else []), *([HELD] if stops else [])]
    indexed = PipelineModel(prepared.stages[:2]).transform(_dealt(rows.select(*given), total))
    settings = boosting.Settings(spec.task != "regression", rounds or spec.rounds, spec.depth, spec.rate, tolerance)
    model = boosting.fit(indexed, inputs, settings, "label", weight, HELD if stops else None)
    return PipelineModel(prepared.stages + [_estimator(spec, settings.rounds, bins, weight, seed)._copyValues(model)])


def _dealt(rows: DataFrame, total: int) -> DataFrame:
    """The rows in equal shares, by the cores and not by the files they come from.

    Every tree level runs one task per share and shuffles one set of sums of each. Shares are as many as cores, or a
    multiple, so that none waits; fewer for few rows. They are sorted by all columns, so that a rerun bins them alike.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shares = min(cores * -(-total // (cores * MOST_ROWS)), -(-total // LEAST_ROWS))
    return rows.repartition(max(1, shares)).sortWithinPartitions(*rows.columns)


def _estimator(spec: ModelSpec, rounds: int, bins: int, weight: str | None, seed: int):
    kind = GBTRegressor if spec.task == "regression" else GBTClassifier
    trees = kind(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=spec.depth, stepSize=spec.rate,
        maxBins=bins, seed=seed, checkpointInterval=10, maxMemoryInMB=512,
    )
    return trees.setWeightCol(weight) if weight else trees


def _inputs(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Numbers as double with a flag for missing ones; text NULLs as a category."""
    return df.withColumns(
        {
            **{f"{c}_missing": F.col(c).isNull().cast("double") for c in spec.numeric},
            **{c: F.col(c).cast("double") for c in spec.numeric},
            **{c: F.coalesce(F.col(c), F.lit("")) for c in spec.categorical},
        }
    )


def class_weight(df: DataFrame, label: str) -> Column:
    """Inverse class frequency of a 0/1 label, mean weight one."""
    total, positive = df.agg(F.count(label), F.coalesce(F.sum(label), F.lit(0.0))).first()
    if not total or positive in (0, total):
        return F.lit(1.0)
    return F.when(F.col(label) == 1, total / (2.0 * positive)).otherwise(total / (2.0 * (total - positive)))


def predict(df: DataFrame, model: PipelineModel, spec: ModelSpec, factors: str | None = None, most: int = FACTORS) -> DataFrame:
    """The input rows with the model's output: days, or the probability of failure.

    ``factors`` names a column for the ``most`` inputs that moved the row's output most, as JSON.
    """
    out = model.transform(_inputs(df.select(*df.columns, F.struct(*df.columns).alias("_row")), spec))
    value = F.col("prediction") if spec.task == "regression" else vector_to_array("probability")[1]
    shown = [value.alias(spec.output)]
    if factors:
        trees = attribution.ensemble_of(df.sparkSession, model.stages[-1])
        why = attribution.attributed(trees, vector_to_array("features"), input_names(model))
        shown.append(attribution.top_factors(why["factors"], most).alias(factors))
    return out.select("_row.*", *shown)


def input_names(model: PipelineModel) -> list[str]:
    """The column that each of the model's inputs comes from."""
    inputs = model.stages[-2].getInputCols()
    return [name.removesuffix("_filled").removesuffix("_missing").removesuffix("_index") for name in inputs]


def score(df: DataFrame, models: dict[str, tuple[ModelSpec, PipelineModel]], ctx: RunContext, most: int = FACTORS) -> DataFrame:
    """Prediction rows of one scoring run; each model runs once per row.

    The tier comes from the unrounded probabilities, the stored values are rounded. Every
    row has its own factors: the ``most`` inputs that moved each output most, for
    probabilities on the scale of half the log odds; 0 leaves them out. Rows
    carry the name and version of the regression, which stands for the run; the first model
    does if there is none.
    """
    scored, factors = df, {}
    for spec, model in models.values():
        column = f"_factors_{spec.output}" if most else None
        scored = predict(scored, model, spec, column, most)
        if column:
            factors[spec.output] = F.col(column)
    named = models[RUL.name][0] if RUL.name in models else next(iter(models.values()))[0]
    return prediction_rows(scored, ctx, named.name, named.version, attribution.merged_json(factors) if factors else None)


def prediction_rows(
    scored: DataFrame, ctx: RunContext, model: str = RUL.name, version: str = RUL.version, factors: Column | None = None
) -> DataFrame:
    """Stored form of scored rows: tier, rounded outputs, run id and time."""
    return scored.select(
        surrogate_key(F.col("record_id"), F.col("snapshot_date"), F.lit(ctx.run_id)).alias("prediction_id"),
        "record_id",
        "component_serial_number",
        "snapshot_date",
        F.lit(model).alias("model_name"),
        F.lit(version).alias("model_version"),
        exact_round(F.col("predicted_rul_days"), 1, 8).alias("predicted_rul_days"),
        exact_round(F.col("predicted_failure_prob_30d"), 4, 6).alias("predicted_failure_prob_30d"),
        exact_round(F.col("predicted_failure_prob_90d"), 4, 6).alias("predicted_failure_prob_90d"),
        risk_tier(F.col("predicted_failure_prob_30d"), F.col("predicted_failure_prob_90d")).alias("risk_tier"),
        (F.lit(None) if factors is None else factors).cast("string").alias("top_contributing_factors"),
        F.lit(ctx.run_id).alias("run_id"),
        ctx.time.alias("scored_at"),
    ).select(*names(PREDICTIONS))


def contributing_factors(model: PipelineModel, spec: ModelSpec) -> str:
    """The weight of each of the model's inputs as JSON, strongest first.

    These are the model's own weights, the same for all rows; a prediction's own factors are
    in its row.
    """
    inputs = model.stages[-2].getInputCols()
    ranked = sorted(zip(inputs, model.stages[-1].featureImportances.toArray()), key=lambda pair: (-pair[1], pair[0]))
    clean = {name.removesuffix("_filled").removesuffix("_index"): round(float(gain), 4) for name, gain in ranked}
    return json.dumps(clean)


def rounds_used(model: PipelineModel) -> int:
    """Number of trees that a trained model holds."""
    return model.stages[-1].getNumTrees


def registry_rows(
    spark: SparkSession, specs: list[ModelSpec], training_rows: int, feature_table: str, ctx: RunContext, used: dict[str, int] | None = None
) -> DataFrame:
    """Model cards for the registry, with the number of training rows and the rounds used, by model name, as JSON."""
    rows = [
        (
            (used or {}).get(s.name),
            s.name, s.version, s.use_case, s.task, "gradient boosted trees", feature_table, s.label, s.hyperparameters,
            s.intended_use, s.known_limitations, s.risk_classification, True,
        )
        for s in specs
    ]
    columns = (
        "_rounds bigint, model_name string, model_version string, use_case string, problem_type string, algorithm string, "
        "feature_table string, target_column string, hyperparameters string, intended_use string, "
        "known_limitations string, risk_classification string, is_active boolean"
    )
    return spark.createDataFrame(rows, columns).withColumns(
        {
            "training_data_summary": F.to_json(
                F.struct(F.lit(training_rows).cast("bigint").alias("training_rows"), F.col("_rounds").alias("rounds_used"))
            ),
            "performance_metrics": F.lit(None).cast("string"),
            "trained_at": ctx.time,
            "trained_by": F.lit(ctx.user),
            "model_id": surrogate_key(F.col("model_name"), F.col("model_version")),
        }
    ).drop("_rounds")


def with_metrics(registry: DataFrame, metrics: DataFrame) -> DataFrame:
    """The registry with ``performance_metrics`` from an evaluation's log rows, as JSON by metric name.

    A row of predictions carries the version of the regression, so the metrics of a model
    belong to its active version. Models and versions that were not evaluated keep what they had.
    """
    entries = F.array_sort(F.collect_list(F.struct("metric_name", "metric_value")))  # a few metrics a model
    newest = metrics.groupBy("model_name").agg(F.to_json(F.map_from_entries(entries)).alias("_metrics"))
    noted = registry.join(F.broadcast(newest), "model_name", "left")
    fresh = F.when(F.col("is_active"), F.col("_metrics"))
    return noted.withColumn("performance_metrics", F.coalesce(fresh, "performance_metrics")).select(*registry.columns)


def register(registry: DataFrame | None, cards: DataFrame) -> DataFrame:
    """Cards to append: a model version already registered is left alone."""
    if registry is None:
        return cards
    return insert_if_absent(registry, cards, ["model_name", "model_version"])


def next_versions(registry: DataFrame | None, specs: list[ModelSpec]) -> list[ModelSpec]:
    """The specs with the version that a new training gets: one above the highest registered, v1 at first."""
    if registry is None:
        return [replace(s, version="v1") for s in specs]
    number = F.regexp_extract("model_version", r"^v([0-9]+)$", 1).try_cast("int")
    # One row per model.
    highest = {r.model_name: r.n for r in registry.groupBy("model_name").agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).collect()}
    return [replace(s, version=f"v{highest.get(s.name, 0) + 1}") for s in specs]


def promote_versions(registry: DataFrame | None, cards: DataFrame) -> DataFrame:
    """The registry with new cards, which take over as the active versions of their models."""
    if registry is None:
        return cards
    replaced = cards.select("model_name", F.lit(True).alias("_new")).distinct()
    older = registry.join(replaced, "model_name", "left").withColumn("is_active", F.col("is_active") & F.col("_new").isNull())
    return older.select(*registry.columns).unionByName(register(registry, cards))


def active_models(registry: DataFrame) -> DataFrame:
    return registry.filter("is_active").select("model_name", "model_version", "is_active")


def override_row(
    spark: SparkSession, record_id: int, model_id: int, prediction: dict, decision: str, reviewer: str, comment: str, ctx: RunContext
) -> DataFrame:
    """A reviewer's verdict on one prediction, to append to the override log."""
    require(decision, LOG_DOMAINS["reviewer_decision"], "decision")
    row = [(record_id, model_id, json.dumps(prediction), decision, reviewer, comment)]
    columns = (
        "record_id bigint, model_id bigint, original_prediction string, reviewer_decision string, "
        "reviewer_id string, reviewer_comment string"
    )
    return spark.createDataFrame(row, columns).withColumn("reviewed_at", ctx.time).withColumn(
        "override_id", surrogate_key(F.col("record_id"), F.col("reviewer_id"), F.lit(ctx.run_id))
    )


def override_rows(
    predictions: DataFrame, model_id: int, shown: list[str], decision: Column, reviewer: Column, comment: Column, ctx: RunContext
) -> DataFrame:
    """``override_row`` of every prediction: the columns ``shown`` are kept as JSON. A decision outside its domain is an error."""
    # The array's brackets are taken off, as JSON functions write no single values.
    named = [
        F.concat(F.lit(json.dumps(c) + ": "), F.expr(f"substring(to_json(array(`{c}`)), 2, length(to_json(array(`{c}`))) - 2)")) for c in shown
    ]
    allowed = LOG_DOMAINS["reviewer_decision"]
    known = F.when(decision.isNull() | decision.isin(*allowed), decision).otherwise(
        F.raise_error(F.concat(F.lit(f"decision must be one of {allowed}, got "), decision)).cast("string")
    )
    return predictions.select(
        "record_id", F.lit(model_id).cast("bigint").alias("model_id"),
        F.concat(F.lit("{"), F.concat_ws(", ", *named), F.lit("}")).alias("original_prediction"),
        known.alias("reviewer_decision"), reviewer.alias("reviewer_id"), comment.alias("reviewer_comment"),
    ).withColumn("reviewed_at", ctx.time).withColumn(
        "override_id", surrogate_key(F.col("record_id"), F.col("reviewer_id"), F.lit(ctx.run_id))
    )


def confirmed_sample(
    features: DataFrame, overrides: DataFrame, rows: int = 500, seed: int | None = None, decision: str = "Confirmed"
) -> DataFrame:
    """Feature rows a reviewer confirmed, a random sample of them.

    Without a seed the order is a hash of the key, so that a rerun draws the same rows.
    """
    require(decision, LOG_DOMAINS["reviewer_decision"], "decision")
    reviewed = overrides.filter(F.col("reviewer_decision") == decision).select("record_id").distinct()
    chosen = features.join(reviewed, "record_id", "left_semi")
    if seed is not None:
        return chosen.orderBy(F.rand(seed)).limit(rows)
    key = F.md5(F.concat_ws("|", F.col("record_id").cast("string"), F.col("snapshot_date").cast("string")))
    return chosen.orderBy(key, "record_id", "snapshot_date").limit(rows)


def tier_summary(predictions: DataFrame) -> DataFrame:
    """Number of predictions, and of those in the two highest tiers."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col("risk_tier") == "High").alias("high_risk"),
        F.count_if(F.col("risk_tier") == "Elevated").alias("elevated_risk"),
    )
