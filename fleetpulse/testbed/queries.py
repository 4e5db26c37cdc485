"""Every operator as a query over one folder of test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.operators import attribution, constraints, evaluate, features, keys, merge, monitor, quality, scoring
from fleetpulse.operators import dimensions as dims
from fleetpulse.operators.joins import lookup_join
from fleetpulse.plans import calendar, load, marts
from fleetpulse.schema import DOMAINS, EXTRACT, FACT, NOT_NULL, POSITIVE, RANGES, names
from fleetpulse.session import RunContext, stage, timestamp
from fleetpulse.sources import extract, months
from fleetpulse.testbed import mapping
from fleetpulse.testbed.tables import Bed, bed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Dates at which the monitoring queries look back; the test tables end late in 2001.
LOOK_BACK = datetime(2001, 6, 3)
SMALL_DRIFT = 0.5  # percent; the test data has no 15 % shift
EASY_LIMITS = [
    monitor.Limit("RMSE", "Warning", monitor.LIMITS[0].message, above="20"),
    monitor.LIMITS[1],
]
DRIFT_RUNS = {"d1": datetime(2000, 7, 1), "d2": datetime(2001, 7, 1)}
ARCHIVED = "1996_03"
IDS_SPLIT = "1996-01-01"


def query(function: Callable[[Bed], DataFrame]) -> Callable[[Bed], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: plain(function(bed(spark, sf_dir)))
    return function


def plain(df: DataFrame) -> DataFrame:
    """Types every engine reports alike: double for exact and small numbers, text for times."""
    shown = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.IntegerType, T.ShortType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.substring(column.cast("string"), 1, 19)
        shown.append(column.alias(field.name))
    return df.select(*shown)


# ---- sources and partitions ----


@query
def extract_map(b: Bed) -> DataFrame:
    return b.extract


@query
def extract_csv_roundtrip(b: Bed) -> DataFrame:
    # Quotes, commas, backslashes and line ends, as standard CSV quotes them.
    odd = F.element_at(F.array(*map(F.lit, ['"', ', "a", b', "c, \\", '\nnext "line"'])), (F.col("record_id") % 4 + 1).cast("int"))
    path = f"{b.root}/csv-{uuid.uuid4().hex}"
    extract.write_csv(b.landed.withColumn("work_order_number", F.concat("work_order_number", odd)), path, compression="gzip")
    return extract.read_extract(b.spark, path, multi_line=True)


@query
def month_spine(b: Bed) -> DataFrame:
    routed = b.landed.groupBy(months.month_name(F.col("snapshot_date")).alias(months.PARTITION)).agg(
        F.count(F.lit(1)).alias("rows")
    )
    ends = b.landed.agg(
        F.min("snapshot_date").alias("start"), F.date_add(F.max("snapshot_date"), 1).alias("end")
    )
    spine = months.month_spine_of(ends)
    return spine.join(routed, months.PARTITION, "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))


@query
def partition_bounds(b: Bed) -> DataFrame:
    return months.partition_bounds(b.landed, "snapshot_date").distinct()


@query
def partition_routing(b: Bed) -> DataFrame:
    routed = months.route(b.landed, "snapshot_date", mapping.SPINE_START, mapping.SPINE_END)
    return routed.groupBy(months.PARTITION).agg(F.count(F.lit(1)).alias("rows"))


@query
def fact_months(b: Bed) -> DataFrame:
    return b.fact.groupBy(months.PARTITION).agg(
        F.count(F.lit(1)).alias("rows"), F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day")
    )


@query
def fact_between_days(b: Bed) -> DataFrame:
    first, last = datetime(1997, 2, 10).date(), datetime(1997, 5, 20).date()
    return months.between_days(b.fact, "snapshot_date", first, last).select(
        "record_id", "snapshot_date", "component_serial_number", "health_monitoring_score"
    )


@query
def archive_month(b: Bed) -> DataFrame:
    # The month is detached from a copy of its own, twice, as a repeated job would.
    root = f"{b.root}/archive-{uuid.uuid4().hex}"
    months.write_months(b.fact.filter(F.col(months.PARTITION).startswith("1996") | (F.col(months.PARTITION) == months.DEFAULT)), f"{root}/fact")
    for _ in range(2):
        archived = months.archive_month(b.spark, f"{root}/fact", f"{root}/archive", ARCHIVED, drop=True)
    untouched = ~F.col(months.PARTITION).startswith("1996") & (F.col(months.PARTITION) != months.DEFAULT)
    live = months.read_months(b.spark, f"{root}/fact").unionByName(b.fact.filter(untouched))
    sides = [df.select(F.lit(side).alias("side"), months.PARTITION) for side, df in (("archive", archived), ("live", live))]
    return reduce(DataFrame.unionByName, sides).groupBy("side", months.PARTITION).agg(F.count(F.lit(1)).alias("rows"))


@query
def spine_extended(b: Bed) -> DataFrame:
    # Two loads, a later end of the spine, and the second load once more; every job builds its layout anew.
    root = f"{b.root}/spine-{uuid.uuid4().hex}"

    def layout() -> load.Layout:
        return load.Layout(root, mapping.SPINE_START, mapping.SPINE_END)

    # Of a batch, a promotion reads the fact's columns only.
    first, second = (stage(batch.select(*names(FACT)), "batch") for batch in _batches(b))
    load.promote(first, layout(), b.scored("r0"), strict=False)
    load.promote(second, layout(), b.scored("r1"), strict=False)
    load.extend_spine(layout(), mapping.LATER_END, b.spark)
    load.promote(second, layout(), b.scored("r2"), strict=False)
    return months.read_months(b.spark, layout().path("fact")).groupBy(months.PARTITION).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("cumulative_flight_hours").alias("hours")
    )


@query
def export_recent(b: Bed) -> DataFrame:
    path = f"{b.root}/export-{uuid.uuid4().hex}"
    ctx = RunContext(mapping.RUNS["r2"])
    risk = b.predictions.select("record_id", "component_serial_number", "predicted_failure_prob_30d", "risk_tier", "scored_at")
    extract.export_recent(risk, path, ctx)
    return b.spark.read.schema(risk.schema).csv(path, header=True)


# ---- quality ----


@query
def dq_results(b: Bed) -> DataFrame:
    return quality.results_of_tags(b.staging, quality.RULES, b.ctx).drop("result_id", "run_at")


@query
def dq_failed_rows_by_rule(b: Bed) -> DataFrame:
    return (
        b.staging.select(F.explode("failed_rules").alias("rule_name"), "snapshot_date")
        .groupBy("rule_name", F.year("snapshot_date").cast("bigint").alias("year"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def dq_report(b: Bed) -> DataFrame:
    first = b.landed.filter(F.col("snapshot_date") < F.lit(mapping.BATCH_DAY))
    log = quality.run_checks(first, quality.RULES, b.scored("r1")).unionByName(
        quality.run_checks(b.landed, quality.RULES, b.scored("r2"))
    )
    return quality.report(stage(log, "quality_results"), quality.catalog(b.spark, quality.RULES))


QUARANTINED = ["record_id", "snapshot_date", "component_serial_number", "quarantine_reason", "quarantined_at"]


@query
def quarantine_duplicates(b: Bed) -> DataFrame:
    return b.split(only=["duplicate_record_id"])[1].select(*QUARANTINED)


@query
def quarantine_critical(b: Bed) -> DataFrame:
    return b.split()[1].select(*QUARANTINED)


@query
def quarantine_recent(b: Bed) -> DataFrame:
    # Rows are taken to be quarantined when they were recorded, so that the log has a history.
    log = b.split()[1].withColumn("quarantined_at", F.col("record_created_timestamp"))
    return quality.recent_quarantine(log, RunContext(LOOK_BACK)).select(*QUARANTINED)


@query
def good_rows(b: Bed) -> DataFrame:
    return b.good.select(*names(EXTRACT))


@query
def sticky_quarantine(b: Bed) -> DataFrame:
    # The first batch's quarantine keeps the same ids out of the second batch.
    early = F.col("snapshot_date") < F.lit(mapping.BATCH_DAY)
    history = b.split()[1].filter(early)
    return quality.without_quarantined(b.landed.filter(~early), history).select("record_id", "snapshot_date")


@query
def constraint_violations(b: Bed) -> DataFrame:
    not_null = list(dict.fromkeys(c for columns in NOT_NULL.values() for c in columns))
    return constraints.constraint_violations(b.landed, not_null, DOMAINS, RANGES, POSITIVE)


@query
def key_violations(b: Bed) -> DataFrame:
    single = constraints.key_violations(b.landed, ["record_id"]).select("record_id", F.lit("").alias("day"), "copies")
    pair = constraints.key_violations(b.landed, ["record_id", "snapshot_date"]).select(
        "record_id", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"), "copies"
    )
    return single.unionByName(pair)


@query
def fk_orphans(b: Bed) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            constraints.fk_orphans(b.landed, key, table, key)
            for key, table in (
                ("aircraft_tail_number", b.dim_aircraft),
                ("component_serial_number", b.dim_component),
                ("supplier_id", b.dim_supplier),
            )
        ],
    )


# ---- dimensions, merge, audit ----


@query
def dim_supplier(b: Bed) -> DataFrame:
    return b.dim_supplier


@query
def dim_aircraft(b: Bed) -> DataFrame:
    return b.dim_aircraft


@query
def dim_component(b: Bed) -> DataFrame:
    return b.dim_component


def _batches(b: Bed) -> tuple[DataFrame, DataFrame]:
    early = F.col("snapshot_date") < F.lit(mapping.BATCH_DAY)
    return b.good.filter(early), b.good.filter(~early)


@query
def upsert_two_batches(b: Bed) -> DataFrame:
    first, second = _batches(b)
    none = dims.component_rows(first.limit(0)).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    )
    table = none
    for batch, run in ((first, "r1"), (second, "r2")):
        table = merge.upsert(
            table, dims.component_rows(batch), dims.COMPONENT_KEY, dims.COMPONENT_UPDATES, b.scored(run),
            created="created_at", touch="updated_at", strict=False,
        ).table
    return table


@query
def insert_if_absent(b: Bed) -> DataFrame:
    def orders(batch: DataFrame) -> DataFrame:
        return batch.groupBy("work_order_number").agg(
            F.min("snapshot_date").alias("first_seen"), F.count(F.lit(1)).alias("snapshots")
        )

    first, second = _batches(b)
    known = orders(first)
    return known.unionByName(merge.insert_if_absent(known, orders(second), ["work_order_number"]))


def _redelivery(b: Bed) -> merge.Merged:
    """The first batch is known; then every row is delivered again with other values."""
    first, _ = _batches(b)
    known = dims.fact_rows(first).withColumn("ingested_at", b.scored("r1").time)
    changed = b.good.withColumns(
        {
            "cumulative_flight_hours": F.col("cumulative_flight_hours") + 10,
            "last_maintenance_type": F.lit("Changed"),
            "failure_within_30_days": F.lit(None).cast("int"),
        }
    )
    return load.promote_rows(known, changed, b.scored("r2"), strict=False)


@query
def promote_fact(b: Bed) -> DataFrame:
    return _redelivery(b).table


def _audit(b: Bed) -> DataFrame:
    doomed = b.fact.filter(F.col("failure_within_30_days") == 1)
    gone = merge.delete_rows(b.fact.select(*names(FACT)), doomed, ["record_id", "snapshot_date"], b.ctx, table="fact")
    return _redelivery(b).changes.unionByName(gone.changes)


@query
def audit_ops(b: Bed) -> DataFrame:
    return _audit(b).select("event_time", "db_user", "schema_name", "table_name", "operation", "row_pk")


@query
def audit_recent(b: Bed) -> DataFrame:
    return merge.newest_audit(_audit(b), "fact").select("event_time", "db_user", "schema_name", "operation", "row_pk")


@query
def row_counts(b: Bed) -> DataFrame:
    return quality.row_counts(
        {
            "dim_aircraft": b.dim_aircraft,
            "dim_component": b.dim_component,
            "dim_supplier": b.dim_supplier,
            "fact": b.fact,
            "quarantine": b.split()[1],
        }
    )


@query
def load_and_promote(b: Bed) -> DataFrame:
    # The load lands the extract itself.
    layout = load.Layout(f"{b.root}/load-{uuid.uuid4().hex}", mapping.SPINE_START, mapping.SPINE_END)
    return load.load_and_promote(b.extract, layout, b.ctx)


# ---- features ----


@query
def features_v1(b: Bed) -> DataFrame:
    return b.features.drop("computed_at")


def _typed_snapshots(b: Bed) -> DataFrame:
    kind = b.dim_component.select("component_serial_number", "component_type")
    return lookup_join(b.fact, kind, ["component_serial_number"])


@query
def rolling_rate(b: Bed) -> DataFrame:
    return features.rolling_rate(_typed_snapshots(b), "component_type", "snapshot_date", "failure_within_90_days")


@query
def rolling_rate_lagged(b: Bed) -> DataFrame:
    return features.rolling_rate(
        _typed_snapshots(b), "component_type", "snapshot_date", "failure_within_90_days", lagged=True
    )


def _loaded(b: Bed) -> load.Layout:
    """The fact after two loads, the daily sums kept up with each by the months that it touched."""
    layout = load.Layout(f"{b.root}/days-{uuid.uuid4().hex}", mapping.SPINE_START, mapping.SPINE_END)
    for batch, run in zip(_batches(b), ("r0", "r1")):
        batch = stage(batch.select(*names(FACT)), "batch")
        load.promote(batch, layout, b.scored(run), strict=False)
        touched = months.partition_names(months.route(batch, "snapshot_date", layout.spine_start, layout.spine_end))
        load.refresh_days(b.spark, layout, touched, b.dim_component)
    return layout


@query
def rolling_rate_kept(b: Bed) -> DataFrame:
    return features.rate_of_days(load.days_of(b.spark, _loaded(b), "cohort_days"), "component_type", "snapshot_date")


SPLIT_COLUMNS = ["record_id", "snapshot_date", "component_type", "failure_within_90_days"]


@query
def split_train(b: Bed) -> DataFrame:
    return b.feature_store.split()["train"].select(*SPLIT_COLUMNS)


@query
def split_validation(b: Bed) -> DataFrame:
    return b.feature_store.split()["validation"].select(*SPLIT_COLUMNS)


@query
def split_test(b: Bed) -> DataFrame:
    return b.feature_store.split()["test"].select(*SPLIT_COLUMNS)


@query
def split_sizes(b: Bed) -> DataFrame:
    parts = b.feature_store.split()
    return quality.row_counts(parts).withColumnRenamed("tbl", "split")


# ---- predictions and their evaluation ----


@query
def risk_tiers(b: Bed) -> DataFrame:
    return b.predictions.drop("prediction_id", "top_contributing_factors")


@query
def tier_summary(b: Bed) -> DataFrame:
    return scoring.tier_summary(b.predictions)


LOG = ["model_name", "model_version", "metric_name", "metric_value", "sample_size", "n_scored",
       "evaluation_window_start", "evaluation_window_end"]


@query
def eval_versions(b: Bed) -> DataFrame:
    # Two versions in one log, each evaluated on its own, for the snapshots of a window.
    runs = b.predictions.filter(F.col("run_id").isin("r1", "r2"))
    window = {"since": datetime(1996, 1, 1).date(), "until": mapping.BATCH_DAY}
    log = evaluate.evaluate_regression(runs, b.features, scoring.RUL.name, b.ctx, **window)
    return log.select("model_version", "metric_name", "metric_value", "sample_size", "n_scored")


@query
def eval_rul(b: Bed) -> DataFrame:
    return evaluate.evaluate_regression(b.predictions, b.features, scoring.RUL.name, b.ctx, run_id="r2").select(*LOG)


def _classifier(b: Bed, spec: scoring.ModelSpec) -> DataFrame:
    return evaluate.evaluate_classifier(
        b.predictions, b.features, spec.name, spec.output, spec.label, b.ctx, run_id="r2"
    )


@query
def eval_classifier_30(b: Bed) -> DataFrame:
    return _classifier(b, scoring.FAILURE_30D).select(*LOG)


@query
def eval_classifier_90(b: Bed) -> DataFrame:
    return _classifier(b, scoring.FAILURE_90D).select(*LOG)


@query
def eval_ranking(b: Bed) -> DataFrame:
    models = [spec.target for spec in scoring.MODELS]
    return evaluate.ranking(b.predictions, b.features, models, b.ctx, run_id="r2").select(*LOG)


@query
def eval_ranking_yearly(b: Bed) -> DataFrame:
    # Every version and year is ranked on its own.
    year = [F.trunc("snapshot_date", "YEAR").alias("year")]
    log = evaluate.ranking(b.predictions, b.features, [scoring.FAILURE_30D.target], b.ctx, by=year)
    return log.select("model_version", "year", "metric_name", "metric_value", "sample_size")


@query
def registry_metrics(b: Bed) -> DataFrame:
    models = [spec.target for spec in scoring.MODELS]
    metrics = stage(evaluate.evaluate(b.predictions, b.features, models, b.ctx, run_id="r2"), "metrics")
    cards = scoring.registry_rows(b.spark, scoring.MODELS, 0, "features_v1", b.ctx)
    noted = scoring.with_metrics(cards, metrics)
    return noted.select("model_name", F.explode(F.from_json("performance_metrics", "map<string, double>")).alias("metric_name", "metric_value"))


@query
def threshold_sweep(b: Bed) -> DataFrame:
    return evaluate.threshold_sweep(
        b.predictions, b.features, "predicted_failure_prob_30d", "failure_within_30_days", run_id="r2"
    )


def _monthly_log(b: Bed) -> DataFrame:
    """A metric history: each month evaluated on its own and logged when it is over."""
    month = [F.trunc("snapshot_date", "MM").alias("month")]
    models = [spec.target for spec in (scoring.RUL, scoring.FAILURE_30D, scoring.FAILURE_90D)]
    log = evaluate.evaluate(b.predictions, b.features, models, b.ctx, run_id="r2", by=month)
    return log.withColumn("logged_at", F.add_months("month", 1).cast("timestamp_ntz")).drop("month")


@query
def metric_trend(b: Bed) -> DataFrame:
    return evaluate.metric_trend(_monthly_log(b), RunContext(LOOK_BACK))


def _drift_log(b: Bed) -> DataFrame:
    runs = [
        monitor.drift(
            b.features.filter(F.col("snapshot_date") < F.lit(at.date())), RunContext(at, run_id=run), limit_pct=SMALL_DRIFT
        )
        for run, at in DRIFT_RUNS.items()
    ]
    return reduce(DataFrame.unionByName, runs)


@query
def drift_log(b: Bed) -> DataFrame:
    return monitor.drift(b.features, b.ctx).drop("log_id")


@query
def drift_recent(b: Bed) -> DataFrame:
    return monitor.recent_drift(_drift_log(b), RunContext(DRIFT_RUNS["d2"])).drop("log_id")


@query
def drift_kept(b: Bed) -> DataFrame:
    # Two end days from one table of daily sums.
    days = load.days_of(b.spark, _loaded(b), "feature_days")
    runs = [
        monitor.drift_of_days(days, RunContext(at, run_id=run), limit_pct=SMALL_DRIFT, until=at.date() - timedelta(days=1))
        for run, at in DRIFT_RUNS.items()
    ]
    return reduce(DataFrame.unionByName, runs).drop("log_id")


ALERT = ["alert_type", "severity", "message", "related_entity", "entity_kind", "raised_at", "acknowledged"]


@query
def alerts_drift(b: Bed) -> DataFrame:
    return monitor.alerts_from_drift(_drift_log(b), b.ctx).select(*ALERT)


@query
def alerts_performance(b: Bed) -> DataFrame:
    return monitor.alerts_from_metrics(_monthly_log(b), b.ctx, EASY_LIMITS).select(*ALERT)


def _alerts(b: Bed) -> DataFrame:
    """All alerts, those of the first drift run acknowledged."""
    alerts = stage(
        monitor.alerts_from_drift(_drift_log(b), b.ctx).unionByName(
            monitor.alerts_from_metrics(_monthly_log(b), b.ctx, EASY_LIMITS)
        ),
        "alerts",
    )
    seen = alerts.filter(F.col("raised_at") <= timestamp(DRIFT_RUNS["d1"]))
    return monitor.acknowledge(alerts, seen, b.ctx).table


@query
def alerts_acknowledged(b: Bed) -> DataFrame:
    return _alerts(b).select(*ALERT, "acknowledged_by", "acknowledged_at")


@query
def retraining_required(b: Bed) -> DataFrame:
    return monitor.retraining_required(_alerts(b), RunContext(LOOK_BACK))


@query
def open_alerts(b: Bed) -> DataFrame:
    return monitor.open_alerts(_alerts(b), ["Warning", "Critical"]).select(*ALERT)


# ---- marts ----


def _risk(b: Bed) -> DataFrame:
    return marts.latest_component_risk(b.predictions, b.dim_component, b.fact, b.dim_aircraft)


@query
def latest_component_risk(b: Bed) -> DataFrame:
    return _risk(b)


def _risk_view(b: Bed) -> DataFrame:
    """The view kept over four scorings: a first run, the newest, a late one, and the first repeated with half its rows."""
    path, view = f"{b.root}/runs-{uuid.uuid4().hex}", None
    for run, part in (("r1", 1), ("r2", 2), ("r0", 1), ("r2", 1)):
        rows = b.predictions.filter((F.col("run_id") == run) & (F.col("record_id") % part == 0))
        extract.write_log(rows, path, b.scored(run))
        again = extract.read_run(b.spark, path, b.scored(run))
        log = extract.read_log(b.spark, path)
        view = stage(marts.refresh_risk_view(view, again, b.scored(run), b.fact, b.dim_aircraft, log), "risk_view")
    return view


@query
def component_risk_kept(b: Bed) -> DataFrame:
    return marts.component_risk(_risk_view(b), b.dim_component, b.dim_aircraft)


@query
def export_risk_view(b: Bed) -> DataFrame:
    path = f"{b.root}/export-{uuid.uuid4().hex}"
    risk = marts.component_risk(_risk_view(b), b.dim_component, b.dim_aircraft)
    extract.export_recent(risk, path, RunContext(mapping.RUNS["r2"]))
    return b.spark.read.schema(risk.schema).csv(path, header=True)


@query
def risk_ranking_top50(b: Bed) -> DataFrame:
    return marts.risk_ranking(_risk(b), b.dim_component)


@query
def aircraft_summary(b: Bed) -> DataFrame:
    return marts.aircraft_summary(_risk(b))


@query
def supplier_risk(b: Bed) -> DataFrame:
    return marts.supplier_risk(b.dim_supplier, b.dim_component, b.predictions)


@query
def supplier_risk_distinct(b: Bed) -> DataFrame:
    return marts.supplier_risk(b.dim_supplier, b.dim_component, b.predictions, distinct=True)


@query
def override_log(b: Bed) -> DataFrame:
    # Every high-risk snapshot is reviewed, by one of three reviewers; each verdict keeps the prediction it is about.
    reviewed = b.predictions.filter((F.col("run_id") == "r2") & (F.col("risk_tier") == "High"))
    desk = F.pmod(F.col("record_id"), F.lit(3))
    decision = F.element_at(F.array(*[F.lit(d) for d in ("Confirmed", "Overridden", "Escalated")]), (desk + 1).cast("int"))
    rows = scoring.override_rows(
        reviewed, 1, ["risk_tier", "record_id"], decision, F.concat(F.lit("rev-"), desk.cast("string")), F.lit("seen"), b.ctx
    )
    return rows.drop("override_id")


@query
def override_sample(b: Bed) -> DataFrame:
    # A technician's finding stands for a reviewer's verdict on the snapshot.
    verdicts = {"Critical": "Confirmed", "Major": "Escalated"}
    finding = F.col("inspection_finding_severity")
    verdict = reduce(lambda c, pair: c.when(finding == pair[0], pair[1]), verdicts.items(), F.when(F.lit(False), ""))
    overrides = b.fact.select("record_id", verdict.otherwise("Overridden").alias("reviewer_decision"))
    return scoring.confirmed_sample(b.features, overrides).select("record_id", "snapshot_date", "component_type")


# ---- models ----


@query
def prediction_factors(b: Bed) -> DataFrame:
    trees = attribution.ensemble(b.spark.createDataFrame(mapping.TREES, attribution.NODES), mapping.TREE_WEIGHTS)
    inputs = F.array(*[F.col(c).cast("double") for c in mapping.TREE_INPUTS])
    rows = b.features.select("record_id", "snapshot_date", attribution.attributed(trees, inputs, mapping.TREE_INPUTS).alias("why"))
    top = attribution.top_factors(F.col("why.factors"), 1)
    return rows.select(
        "record_id", "snapshot_date", "why.margin", "why.base", *[F.col("why.factors")[c].alias(f"by_{c}") for c in mapping.TREE_INPUTS],
        F.element_at(F.json_object_keys(top), 1).alias("strongest"),
    )


def _train_score(b: Bed, spec: scoring.ModelSpec, balanced: bool) -> DataFrame:
    """Every test row with its label, and what holds of its score: that there is one, that it is in range, and that
    the model does better than a constant guess, by squared error or by telling failures from the rest."""
    parts = b.feature_store.split()
    model = scoring.train(parts["train"], spec, balanced=balanced)
    rows = stage(scoring.predict(parts["test"], model, spec), f"scored_{spec.label}")
    label, output = F.col(spec.label).cast("double"), F.col(spec.output)
    if spec.task == "regression":
        guess = parts["train"].agg(F.avg(spec.label)).first()[0] or 0
        gain = F.sum((label - F.lit(float(guess))) ** 2) - F.sum((label - output) ** 2)
        in_range = output >= 0
    else:
        gain = F.avg(F.when(label == 1, output)) - F.avg(F.when(label == 0, output))
        in_range = output.between(0, 1)
    better = rows.agg(gain.alias("gain")).select(F.coalesce(F.col("gain") > 0, F.lit(False)).alias("better"))
    checked = rows.select("record_id", "snapshot_date", spec.label, output.isNotNull().alias("scored"), in_range.alias("in_range"))
    return checked.crossJoin(F.broadcast(better))  # one row


@query
def train_score_rul(b: Bed) -> DataFrame:
    return _train_score(b, scoring.RUL, False)


@query
def train_score_90(b: Bed) -> DataFrame:
    return _train_score(b, scoring.FAILURE_90D, True)


@query
def train_score_30(b: Bed) -> DataFrame:
    return _train_score(b, scoring.FAILURE_30D, True)


@query
def registry_versions(b: Bed) -> DataFrame:
    # All models are registered; one is trained again and takes over under its next version.
    rows = b.feature_store.split()["train"].count()
    registry = None
    for specs in (scoring.MODELS, [scoring.RUL]):
        cards = scoring.registry_rows(b.spark, scoring.next_versions(registry, specs), rows, "features_v1", b.ctx)
        registry = stage(scoring.promote_versions(registry, cards), "registry")
    return registry.select("model_name", "model_version", "is_active")


@query
def registry_rows(b: Bed) -> DataFrame:
    rows = b.feature_store.split()["train"].count()
    cards = scoring.registry_rows(b.spark, scoring.MODELS, rows, "features_v1", b.ctx)
    known = cards.filter(F.col("model_name") == scoring.RUL.name)
    registry = known.unionByName(scoring.register(known, cards))
    return registry.join(scoring.active_models(registry).select("model_name", "model_version"), ["model_name", "model_version"]).select(
        "model_name", "model_version", "problem_type", "target_column", "training_data_summary", "is_active"
    )


@query
def surrogate_ids(b: Bed) -> DataFrame:
    # Two runs; the first is made again after the second and keeps its ids.
    path, middle = f"{b.root}/id_marks-{uuid.uuid4().hex}", F.lit(IDS_SPLIT).cast("date")
    rows = b.fact.select("record_id", "snapshot_date")
    runs = {"i1": rows.filter(F.col("snapshot_date") < middle), "i2": rows.filter(F.col("snapshot_date") >= middle)}
    given = [keys.allocate(runs[r], ["record_id", "snapshot_date"], path, RunContext(b.ctx.as_of, run_id=r)) for r in ("i1", "i2", "i1")]
    return given[1].unionByName(given[2])


@query
def due_runs(b: Bed) -> DataFrame:
    # A job's run is taken to have been made where its day saw a component that was about to fail.
    days = b.fact.select("snapshot_date", (F.col("failure_within_30_days") == 1).alias("made"))
    since, now = days.agg(F.min("snapshot_date").cast("timestamp_ntz"), F.max("snapshot_date").cast("timestamp_ntz")).first()
    seen = days.filter("made").select(F.col("snapshot_date").alias("day")).distinct()
    made = reduce(DataFrame.unionByName, [
        seen.select(F.lit(j.name).alias("job"), (F.col("day").cast("timestamp_ntz") + F.lit(j.at)).alias("due_at")) for j in calendar.JOBS
    ])
    return calendar.missed(made, since, now, b.spark)
