"""Decision tables built from predictions and master data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import exact_mean, exact_round, ratio
from fleetpulse.operators.joins import latest_per_key, lookup_join, with_known
from fleetpulse.operators.quality import newest_run
from fleetpulse.schema import FACT_KEYS
from fleetpulse.session import RunContext
from fleetpulse.sources import months

AT_RISK = ["High", "Elevated"]
NEWEST_PREDICTION = ["scored_at", "snapshot_date", "record_id"]


def latest_component_risk(
    predictions: DataFrame, component: DataFrame, fact: DataFrame, aircraft: DataFrame, **strategy
) -> DataFrame:
    """One row per component: its newest prediction with master data.

    Only predictions whose component, snapshot and aircraft exist compete for newest, so
    the joins that can reject a row come first; the attributes of component and aircraft are
    added to the winners only.
    """
    needed = predictions.select(
        "component_serial_number", *FACT_KEYS, "predicted_rul_days", "predicted_failure_prob_30d",
        "predicted_failure_prob_90d", "risk_tier", "scored_at",
    )
    fleet = aircraft.select("aircraft_tail_number", "aircraft_model", "fleet_type", "operating_region")
    known = needed.join(_on_aircraft(fact, aircraft, **strategy), FACT_KEYS)
    newest = latest_per_key(known, ["component_serial_number"], [F.desc_nulls_first(c) for c in NEWEST_PREDICTION])
    newest = lookup_join(newest, fleet, ["aircraft_tail_number"], **strategy)
    parts = component.select("component_serial_number", "component_type", "component_subtype")
    return newest.join(parts, "component_serial_number").select(
        "component_serial_number", "component_type", "component_subtype", "aircraft_tail_number",
        "aircraft_model", "fleet_type", "operating_region", "predicted_rul_days", "predicted_failure_prob_30d",
        "predicted_failure_prob_90d", "risk_tier", "snapshot_date", "scored_at",
    )


def _on_aircraft(fact: DataFrame, aircraft: DataFrame, **strategy) -> DataFrame:
    """Keys and tail of the snapshots whose aircraft exists."""
    return with_known(fact.select(*FACT_KEYS, "aircraft_tail_number"), aircraft, ["aircraft_tail_number"], **strategy)


OUTPUTS = ["predicted_rul_days", "predicted_failure_prob_30d", "predicted_failure_prob_90d", "risk_tier"]
RISK_VIEW = ["component_serial_number", *FACT_KEYS, "aircraft_tail_number", *OUTPUTS, "scored_at", "run_id"]


def refresh_risk_view(
    view: DataFrame | None, run: DataFrame, ctx: RunContext, fact: DataFrame, aircraft: DataFrame, log: DataFrame, **strategy
) -> DataFrame:
    """The newest prediction per component after a scoring run, from the view before it and the run's own rows.

    ``view`` is what the last call gave, ``run`` the predictions of the run ``ctx``, ``log`` all
    predictions. Newest is the greatest by ``NEWEST_PREDICTION``, whatever the order in which
    runs arrive, so a late run takes only what it holds newer. If the run is repeated, the
    view's rows of it no longer hold: what their components have is looked up in the log,
    which is read in no other case. Of the fact only the months of the run's snapshots are
    read, and in the view master data are left out; ``component_risk`` adds them.
    """
    rows = _candidates(run, _months_of(run, fact), aircraft, **strategy)
    if view is not None:
        mine = F.col("run_id") == F.lit(ctx.run_id)
        stale = view.filter(mine).select("component_serial_number")
        rows = view.filter(~mine).unionByName(rows)
        if not stale.isEmpty():
            again = log.join(stale, "component_serial_number", "left_semi")
            rows = rows.unionByName(_candidates(again, fact, aircraft, **strategy))
    return latest_per_key(rows, ["component_serial_number"], [F.desc_nulls_first(c) for c in NEWEST_PREDICTION])


def _months_of(run: DataFrame, fact: DataFrame) -> DataFrame:
    if months.PARTITION not in fact.columns:
        return fact
    first, last = run.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    return fact.limit(0) if first is None else months.between_days(fact, "snapshot_date", first, last)


def _candidates(predictions: DataFrame, fact: DataFrame, aircraft: DataFrame, **strategy) -> DataFrame:
    """Predictions whose snapshot and aircraft exist, as rows of the view."""
    return predictions.join(_on_aircraft(fact, aircraft, **strategy), FACT_KEYS).select(*RISK_VIEW)


def component_risk(view: DataFrame, component: DataFrame, aircraft: DataFrame, **strategy) -> DataFrame:
    """The rows of ``latest_component_risk``, from the kept view: one row per component is joined, no history."""
    fleet = aircraft.select("aircraft_tail_number", "aircraft_model", "fleet_type", "operating_region")
    parts = component.select("component_serial_number", "component_type", "component_subtype")
    return lookup_join(view, fleet, ["aircraft_tail_number"], **strategy).join(parts, "component_serial_number").select(
        "component_serial_number", "component_type", "component_subtype", "aircraft_tail_number",
        "aircraft_model", "fleet_type", "operating_region", *OUTPUTS, "snapshot_date", "scored_at",
    )


def risk_ranking(risk: DataFrame, component: DataFrame, top: int = 50) -> DataFrame:
    """The components most likely to fail within 30 days, with their cost.

    The top rows are taken first, so only they meet the component dimension.
    """
    worst = (
        risk.filter(F.col("risk_tier").isin(AT_RISK))
        .orderBy(F.desc_nulls_first("predicted_failure_prob_30d"), "component_serial_number")
        .limit(top)
    )
    cost = component.select("component_serial_number", "part_cost_usd")
    return (
        cost.join(F.broadcast(worst), "component_serial_number")
        .select(
            "component_serial_number", "component_type", "component_subtype", "part_cost_usd",
            "aircraft_tail_number", "aircraft_model", "operating_region", "predicted_rul_days",
            "predicted_failure_prob_30d", "predicted_failure_prob_90d", "risk_tier", "scored_at",
        )
        .orderBy(F.desc_nulls_first("predicted_failure_prob_30d"), "component_serial_number")
    )


def aircraft_summary(risk: DataFrame) -> DataFrame:
    """Components, tier counts and mean remaining life per aircraft, most at risk first.

    Tail and model already sit on the risk rows, so this is one aggregation.
    """
    return (
        risk.groupBy("aircraft_tail_number", "aircraft_model")
        .agg(
            F.count(F.lit(1)).alias("total_components"),
            F.sum(F.when(F.col("risk_tier") == "High", 1).otherwise(0)).alias("high_risk_count"),
            F.sum(F.when(F.col("risk_tier") == "Elevated", 1).otherwise(0)).alias("elevated_risk_count"),
            exact_round(exact_mean(F.col("predicted_rul_days")), 1).alias("avg_rul_days"),
        )
        .orderBy(F.desc("high_risk_count"), "aircraft_tail_number", "aircraft_model")
    )


def supplier_risk(supplier: DataFrame, component: DataFrame, predictions: DataFrame, distinct: bool = False) -> DataFrame:
    """Components supplied, how many are at risk in the newest run, and the percentage.

    A component counts once per prediction of the newest run, and once if it has none;
    ``distinct`` counts it once always. Suppliers without components stay with zeros.

    Predictions shrink to one row per component and components to one row per supplier
    before each join, so neither a hot component nor a hot supplier is ever multiplied out.
    """
    newest = newest_run(predictions, "scored_at")
    at_risk = F.col("risk_tier").isin(AT_RISK)
    scored = newest.groupBy("component_serial_number").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(at_risk).alias("_risky")
    )
    parts = component.select("component_serial_number", "supplier_id").join(scored, "component_serial_number", "left")
    rows = F.lit(1) if distinct else F.coalesce(F.col("_rows"), F.lit(1))
    risky: Column = F.coalesce(F.col("_risky"), F.lit(0))
    if distinct:
        risky = F.when(risky > 0, 1).otherwise(0)
    per_supplier = parts.groupBy("supplier_id").agg(F.sum(rows).alias("_supplied"), F.sum(risky).alias("_at_risk"))
    supplied = F.coalesce(F.col("_supplied"), F.lit(0))
    bad = F.coalesce(F.col("_at_risk"), F.lit(0))
    return (
        supplier.select("supplier_id", "supplier_quality_score")
        .join(per_supplier, "supplier_id", "left")
        .select(
            "supplier_id",
            "supplier_quality_score",
            supplied.cast("bigint").alias("components_supplied"),
            bad.cast("bigint").alias("at_risk_components"),
            ratio(F.lit(100) * bad, supplied, 2).alias("risk_pct"),
        )
        .orderBy(F.desc_nulls_first("risk_pct"), "supplier_id")
    )
