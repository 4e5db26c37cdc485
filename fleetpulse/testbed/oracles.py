"""The same results in plain SQL, written independently of the operators.

Each oracle is a chain of common table expressions over the raw test tables. Shown types
follow the queries': double for decimals and small integers, text for dates and times.
"""

from __future__ import annotations

from datetime import datetime

from fleetpulse.schema import (
    DIM_AIRCRAFT,
    DIM_COMPONENT,
    DIM_SUPPLIER,
    DOMAINS,
    EXTRACT,
    FACT,
    FEATURES,
    NOT_NULL,
    POSITIVE,
    PREDICTIONS,
    RANGES,
    Layout,
    names,
)
from fleetpulse.testbed import mapping

ORACLES: dict[str, str] = {}


def shown(name: str, kind: str, source: str | None = None) -> str:
    source = source or name
    if kind.startswith("decimal") or kind in ("int", "smallint"):
        return f"cast({source} as double) as {name}"
    if kind == "date":
        return f"strftime({source}, '%Y-%m-%d') as {name}"
    if kind == "timestamp_ntz":
        return f"strftime({source}, '%Y-%m-%d %H:%M:%S') as {name}"
    return f"{source} as {name}"


def show(layout: Layout, only: list[str] | None = None) -> str:
    return ", ".join(shown(n, t) for n, t in layout if only is None or n in only)


def as_type(name: str, kind: str, sql: str) -> str:
    return f"cast({sql} as {kind.replace('timestamp_ntz', 'timestamp')}) as {name}"


def rounded(sql: str, places: int, precision: int = 18) -> str:
    return f"cast(round(cast({sql} as decimal(20,10)), {places}) as decimal({precision},{places}))"


def ts(value: datetime) -> str:
    return f"timestamp '{value:%Y-%m-%d %H:%M:%S}'"


def text(value: datetime) -> str:
    return f"'{value:%Y-%m-%d %H:%M:%S}'"


def newest(key: str, layout: Layout, source: str) -> str:
    columns = ", ".join(as_type(n, t, n) for n, t in layout)
    return (
        f"select {columns} from (select *, row_number() over (partition by {key} order by record_id desc nulls first) as rn "
        f"from {source}) where rn = 1"
    )


BATCH = f"date '{mapping.BATCH_DAY}'"
SPINE = f"snapshot_date >= date '{mapping.SPINE_START}' and snapshot_date < date '{mapping.SPINE_END}'"

EXTRACT_SQL = ", ".join(as_type(n, t, mapping.EXPRESSIONS[n]) for n, t in EXTRACT)
NO_FIRMWARE = "N/A - Non-Electronic"


def _prediction(run: str) -> str:
    out = mapping.OUTPUTS[run]
    p30, p90 = out["predicted_failure_prob_30d"], out["predicted_failure_prob_90d"]
    return f"""
      select record_id, component_serial_number, snapshot_date, 'component_rul_regression' as model_name, '{mapping.VERSIONS[run]}' as model_version,
        {rounded(out["predicted_rul_days"], 1)} as predicted_rul_days,
        {rounded(p30, 4)} as predicted_failure_prob_30d, {rounded(p90, 4)} as predicted_failure_prob_90d,
        case when {p30} > 0.5 then 'High' when {p90} > 0.5 then 'Elevated' when {p90} > 0.2 then 'Watch' else 'Low' end as risk_tier,
        '{run}' as run_id, {ts(mapping.RUNS[run])} as scored_at
      from fact"""


FEATURE_EXPRESSIONS = {
    "pct_of_design_life_consumed": rounded("f.cumulative_flight_hours / nullif(c.design_mtbf_hours, 0)", 4),
    "hours_per_cycle": rounded("f.cumulative_flight_hours / nullif(f.cumulative_flight_cycles, 0)", 3),
    "unscheduled_removal_ratio": rounded("f.prior_unscheduled_removal_count / nullif(f.prior_removal_count, 0)", 4),
    "sensor_composite_risk_score": rounded(
        "0.40 * coalesce(f.sensor_vibration_index, 0) + 0.35 * coalesce(f.sensor_oil_debris_index, 0) "
        "+ 0.25 * coalesce(f.anomaly_count_last_30_days, 0)", 4,
    ),
    "maintenance_recency_score": rounded("exp(-1.0 * coalesce(f.days_since_last_maintenance_event, 0) / 90.0)", 4),
    "rolling_30d_component_type_failure_rate": rounded(
        "avg(f.failure_within_90_days) over (partition by c.component_type order by f.snapshot_date "
        "range between interval 30 days preceding and current row)", 4,
    ),
    "component_type": "c.component_type",
    "fleet_type": "a.fleet_type",
    "operating_environment": "a.operating_environment",
    "aircraft_age_years": "a.aircraft_age_years",
    "avg_daily_utilization_hours": "a.avg_daily_utilization_hours",
    "supplier_quality_score": "s.supplier_quality_score",
}

BASE = {
    "e": f"""select {EXTRACT_SQL} from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "t": """select *, record_id in (select record_id from e group by record_id having count(*) > 1) as is_dup,
        coalesce(health_monitoring_score < 0 or health_monitoring_score > 100, false) as is_score,
        coalesce(cumulative_flight_hours < 0 or cumulative_flight_cycles < 0, false) as is_negative,
        component_serial_number is null as is_no_component, aircraft_tail_number is null as is_no_aircraft,
        coalesce(flight_hours_since_last_overhaul > cumulative_flight_hours, false) as is_overhaul,
        coalesce(failure_within_30_days = 1 and failure_within_90_days = 0, false) as is_label
      from e""",
    "g": """select * from t where not (is_dup or is_score or is_negative or is_no_component or is_no_aircraft or is_label)""",
    "bad": f"""select *, concat_ws(',', case when is_score then 'health_score_out_of_range' end,
        case when is_negative then 'negative_usage_hours' end, case when is_no_component then 'missing_component_serial' end,
        case when is_no_aircraft then 'missing_aircraft_tail' end, case when is_dup then 'duplicate_record_id' end,
        case when is_label then 'failure_label_conflict' end) as quarantine_reason, {ts(mapping.AS_OF)} as quarantined_at
      from t where is_dup or is_score or is_negative or is_no_component or is_no_aircraft or is_label""",
    "sup": newest("supplier_id", DIM_SUPPLIER, "g"),
    "air": newest("aircraft_tail_number", DIM_AIRCRAFT, "g"),
    "comp": newest(
        "component_serial_number", DIM_COMPONENT,
        f"(select * replace (nullif(firmware_version, '{NO_FIRMWARE}') as firmware_version) from g)",
    ),
    "fact": "select "
    + ", ".join(as_type(n, t, "coalesce(data_quality_flag, 'Complete')" if n == "data_quality_flag" else n) for n, t in FACT)
    + " from g",
    "feat": "select "
    + ", ".join(as_type(n, t, FEATURE_EXPRESSIONS.get(n, f"f.{n}")) for n, t in FEATURES)
    + """ from fact f join comp c on c.component_serial_number = f.component_serial_number
      join air a on a.aircraft_tail_number = f.aircraft_tail_number left join sup s on s.supplier_id = c.supplier_id""",
    "pred": " union all ".join(_prediction(run) for run in mapping.OUTPUTS),
    "scored": """select p.*, f.remaining_useful_life_days as rul, f.failure_within_30_days as y30, f.failure_within_90_days as y90
      from pred p join feat f on f.record_id = p.record_id and f.snapshot_date = p.snapshot_date where p.run_id = 'r2'""",
}


def oracle(name: str, body: str, **more: str) -> None:
    """Register ``body`` over the base expressions it needs, plus its own."""
    ctes = {**BASE, **more}
    order = list(ctes)
    needed: set[str] = set()
    pending = [body]
    while pending:
        sql = f" {pending.pop()} ".replace("(", " ").replace(")", " ").replace(",", " ").replace("\n", " ")
        for cte in order:
            if f" {cte} " in sql and cte not in needed:
                needed.add(cte)
                pending.append(ctes[cte])
    chain = ",\n".join(f"{cte} as ({ctes[cte]})" for cte in order if cte in needed)
    ORACLES[name] = f"with {chain}\n{body}" if chain else body


# ---- sources and partitions ----

oracle("extract_map", f"select {show(EXTRACT)} from e")
oracle(
    "extract_csv_roundtrip",
    f"""select {show(EXTRACT)} from (select * replace (work_order_number || case record_id % 4 when 0 then '"' when 1 then ', "a", b'
      when 2 then 'c, ' || chr(92) else chr(10) || 'next "line"' end as work_order_number) from e)""",
)
oracle(
    "month_spine",
    """select strftime(m, '%Y_%m') as partition_name, strftime(m, '%Y-%m-%d') as lo,
      strftime(m + interval 1 month, '%Y-%m-%d') as hi, coalesce(n, 0) as rows
    from spine left join counted on month = m""",
    spine="""select unnest(generate_series(cast(date_trunc('month', min(snapshot_date)) as timestamp),
      cast(max(snapshot_date) as timestamp), interval 1 month)) as m from e""",
    counted="select date_trunc('month', snapshot_date) as month, count(*) as n from e group by 1",
)
oracle(
    "partition_bounds",
    """select distinct strftime(snapshot_date, '%Y_%m') as partition_name,
      strftime(date_trunc('month', snapshot_date), '%Y-%m-%d') as lo,
      strftime(date_trunc('month', snapshot_date) + interval 1 month, '%Y-%m-%d') as hi from e""",
)
ROUTED = f"case when {SPINE} then strftime(snapshot_date, '%Y_%m') else 'default' end"
oracle("partition_routing", f"select {ROUTED} as partition_name, count(*) as rows from e group by 1")
oracle(
    "fact_months",
    f"""select {ROUTED} as partition_name, count(*) as rows, strftime(min(snapshot_date), '%Y-%m-%d') as first_day,
      strftime(max(snapshot_date), '%Y-%m-%d') as last_day from fact group by 1""",
)
oracle(
    "fact_between_days",
    f"""select {show(FACT, ["record_id", "snapshot_date", "component_serial_number", "health_monitoring_score"])} from fact
    where snapshot_date between date '1997-02-10' and date '1997-05-20'""",
)
oracle(
    "archive_month",
    f"""select case when {ROUTED} = '1996_03' then 'archive' else 'live' end as side, {ROUTED} as partition_name, count(*) as rows
    from fact group by 1, 2""",
)
# All rows of a month move when it opens, those that arrived before and those that arrived after.
oracle(
    "spine_extended",
    f"""select case when snapshot_date >= date '{mapping.SPINE_START}' and snapshot_date < date '{mapping.LATER_END}'
        then strftime(snapshot_date, '%Y_%m') else 'default' end as partition_name, count(*) as rows,
      cast(sum(cumulative_flight_hours) as double) as hours
    from fact group by 1""",
)
oracle(
    "export_recent",
    f"""select record_id, component_serial_number, cast(predicted_failure_prob_30d as double) as predicted_failure_prob_30d, risk_tier,
      {shown("scored_at", "timestamp_ntz")} from pred
    where scored_at >= {ts(mapping.RUNS["r2"])} - interval 1 day""",
)

# ---- quality ----

RULE_FLAGS = [
    ("health_score_out_of_range", "Validity", "Critical", "is_score"),
    ("negative_usage_hours", "Validity", "Critical", "is_negative"),
    ("missing_component_serial", "Completeness", "Critical", "is_no_component"),
    ("missing_aircraft_tail", "Completeness", "Critical", "is_no_aircraft"),
    ("duplicate_record_id", "Uniqueness", "Critical", "is_dup"),
    ("inconsistent_overhaul_hours", "Consistency", "Warning", "is_overhaul"),
    ("failure_label_conflict", "Consistency", "Critical", "is_label"),
]


def rule_results(source: str) -> str:
    return " union all ".join(
        f"""select '{rule}' as rule_name, '{category}' as rule_category, '{severity}' as severity, count(*) as rows_checked,
        count(*) filter (where {flag}) as rows_failed,
        cast({rounded(f"100.0 * (count(*) - count(*) filter (where {flag})) / greatest(count(*), 1)", 2)} as double) as pass_rate_pct,
        count(*) filter (where {flag}) = 0 as passed from {source} """
        for rule, category, severity, flag in RULE_FLAGS
    )


oracle("dq_results", rule_results("t"))
oracle(
    "dq_failed_rows_by_rule",
    " union all ".join(
        f"select '{rule}' as rule_name, year(snapshot_date) as year, count(*) as rows from t where {flag} group by 2"
        for rule, _, _, flag in RULE_FLAGS
    ),
)
oracle(
    "dq_report",
    f"""select rule_name, rows_checked, rows_failed, pass_rate_pct, passed, {text(mapping.RUNS["r2"])} as run_at, rule_category, severity
    from ({rule_results("t")})""",
)
QUARANTINED = (
    "record_id, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, component_serial_number, "
    "{reason} as quarantine_reason, strftime({time}, '%Y-%m-%d %H:%M:%S') as quarantined_at"
)
oracle(
    "quarantine_duplicates",
    f"""select {QUARANTINED.format(reason="'duplicate_record_id'", time=ts(mapping.AS_OF))} from e
    where record_id in (select record_id from e group by record_id having count(*) > 1)""",
)
oracle("quarantine_critical", f"select {QUARANTINED.format(reason='quarantine_reason', time='quarantined_at')} from bad")
oracle(
    "quarantine_recent",
    f"""select {QUARANTINED.format(reason='quarantine_reason', time='record_created_timestamp')} from bad
    where record_created_timestamp > timestamp '2001-06-02 00:00:00'""",
)
oracle("good_rows", f"select {show(EXTRACT)} from g")
oracle(
    "sticky_quarantine",
    f"""select record_id, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date from e where snapshot_date >= {BATCH}
    and record_id not in (select record_id from bad where snapshot_date < {BATCH} and record_id is not null)""",
)


def _checks() -> str:
    parts = []
    for name in dict.fromkeys(c for columns in NOT_NULL.values() for c in columns):
        parts.append((name, "not null", f"{name} is null"))
    for name, allowed in DOMAINS.items():
        values = ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in allowed)
        parts.append((name, "domain", f"{name} not in ({values})"))
    for name, (low, high) in RANGES.items():
        limits = [f"{name} < {low}"] if low is not None else []
        limits += [f"{name} > {high}"] if high is not None else []
        parts.append((name, "range", " or ".join(limits)))
    for name in POSITIVE:
        parts.append((name, "positive", f"{name} <= 0"))
    return " union all ".join(
        f"select '{name}' as column_name, '{kind}' as check_kind, count(*) filter (where {bad}) as violations from e "
        for name, kind, bad in parts
    )


oracle("constraint_violations", _checks())
oracle(
    "key_violations",
    """select record_id, '' as day, count(*) as copies from e where record_id is not null group by 1 having count(*) > 1
    union all select record_id, strftime(snapshot_date, '%Y-%m-%d') as day, count(*) as copies from e
    where record_id is not null and snapshot_date is not null group by 1, 2 having count(*) > 1""",
)
oracle(
    "fk_orphans",
    " union all ".join(
        f"""select '{key}' as foreign_key, {key} as orphan_value, count(*) as child_rows from e
        where {key} is not null and not exists (select 1 from {table} d where d.{key} = e.{key}) group by 2"""
        for key, table in (("aircraft_tail_number", "air"), ("component_serial_number", "comp"), ("supplier_id", "sup"))
    ),
)

# ---- dimensions, merge, audit ----

oracle("dim_supplier", f"select {show(DIM_SUPPLIER)} from sup")
oracle("dim_aircraft", f"select {show(DIM_AIRCRAFT)} from air")
oracle("dim_component", f"select {show(DIM_COMPONENT)} from comp")
_plain_firmware = f"(select * replace (nullif(firmware_version, '{NO_FIRMWARE}') as firmware_version) from g where snapshot_date {{}} {BATCH})"
oracle(
    "upsert_two_batches",
    "select "
    + ", ".join(
        shown(
            n, t,
            "coalesce(c1.component_serial_number, c2.component_serial_number)" if n == "component_serial_number"
            else "case when c1.component_serial_number is not null then c1.installation_date else c2.installation_date end"
            if n == "installation_date"
            else f"case when c2.component_serial_number is not null then c2.{n} else c1.{n} end",
        )
        for n, t in DIM_COMPONENT
    )
    + f""", case when c1.component_serial_number is not null then {text(mapping.RUNS["r1"])} else {text(mapping.RUNS["r2"])} end as created_at,
      case when c2.component_serial_number is not null then {text(mapping.RUNS["r2"])} else {text(mapping.RUNS["r1"])} end as updated_at
    from c1 full join c2 on c1.component_serial_number = c2.component_serial_number""",
    c1=newest("component_serial_number", DIM_COMPONENT, _plain_firmware.format("<")),
    c2=newest("component_serial_number", DIM_COMPONENT, _plain_firmware.format(">=")),
)
oracle(
    "insert_if_absent",
    f"""select work_order_number, strftime(min(snapshot_date), '%Y-%m-%d') as first_seen, count(*) as snapshots from g
    where snapshot_date < {BATCH} or work_order_number not in (select work_order_number from g where snapshot_date < {BATCH})
    group by 1""",
)
_redelivered = {
    "cumulative_flight_hours": "cast(g.cumulative_flight_hours + 10 as decimal(12,1))",
    "last_maintenance_type": f"case when f.snapshot_date < {BATCH} then f.last_maintenance_type else 'Changed' end",
    "failure_within_30_days": "cast(null as smallint)",
}
oracle(
    "promote_fact",
    "select "
    + ", ".join(shown(n, t, _redelivered.get(n, f"f.{n}")) for n, t in FACT)
    + f""", {text(mapping.RUNS["r2"])} as ingested_at from fact f
    join g on g.record_id = f.record_id and g.snapshot_date = f.snapshot_date""",
)
AUDIT = f"""select {text(mapping.RUNS["r2"])} as event_time, 'pipeline' as db_user, 'curated' as schema_name, 'fact' as table_name,
      case when snapshot_date < {BATCH} then 'UPDATE' else 'INSERT' end as operation, cast(record_id as varchar) as row_pk from g
    union all select {text(mapping.AS_OF)} as event_time, 'pipeline' as db_user, 'curated' as schema_name, 'fact' as table_name,
      'DELETE' as operation, cast(record_id as varchar) as row_pk from g where failure_within_30_days = 1"""
oracle("audit_ops", AUDIT)
oracle(
    "audit_recent",
    f"select event_time, db_user, schema_name, operation, row_pk from ({AUDIT}) order by event_time desc, row_pk, operation limit 100",
)
COUNTS = """select 'dim_aircraft' as tbl, count(*) as rows from air union all select 'dim_component', count(*) from comp
    union all select 'dim_supplier', count(*) from sup union all select 'fact', count(*) from fact
    union all select 'quarantine', count(*) from bad"""
oracle("row_counts", COUNTS)
oracle("load_and_promote", COUNTS)

# ---- features ----

oracle("features_v1", f"select {show(FEATURES)}, 'v1' as feature_version from feat")
RATE = "rolling_30d_component_type_failure_rate"


def _rates(last: str) -> str:
    """Every day of a cohort against all its rows of the window, by a self join."""
    return f"""select d.component_type, strftime(d.snapshot_date, '%Y-%m-%d') as snapshot_date,
      cast({rounded("avg(r.failure_within_90_days)", 4)} as double) as {RATE}
    from (select distinct component_type, snapshot_date from k) d left join k r
      on r.component_type = d.component_type and r.snapshot_date >= d.snapshot_date - interval 30 days
      and r.snapshot_date <= d.snapshot_date - interval {last} days
    group by 1, d.snapshot_date"""


_kinds = """select c.component_type, f.snapshot_date, f.failure_within_90_days
    from fact f join comp c on c.component_serial_number = f.component_serial_number"""
oracle("rolling_rate", _rates("0"), k=_kinds)
oracle("rolling_rate_lagged", _rates("1"), k=_kinds)
oracle("rolling_rate_kept", _rates("0"), k=_kinds)
SPLITS = {
    "train": "snapshot_date < last - interval 120 days",
    "validation": "snapshot_date between last - interval 120 days and last - interval 60 days",
    "test": "snapshot_date > last - interval 60 days",
}
_last = {"m": "select max(snapshot_date) as last from fact"}
SPLIT_COLUMNS = ["record_id", "snapshot_date", "component_type", "failure_within_90_days"]
for _name, _condition in SPLITS.items():
    oracle(f"split_{_name}", f"select {show(FEATURES, SPLIT_COLUMNS)} from feat cross join m where {_condition}", **_last)
oracle(
    "split_sizes",
    " union all ".join(
        f"select '{n}' as split, count(*) as rows from feat cross join m where {c} " for n, c in SPLITS.items()
    ),
    **_last,
)

# ---- predictions and their evaluation ----

oracle(
    "risk_tiers",
    f"select {show([c for c in PREDICTIONS if c[0] not in ('prediction_id', 'top_contributing_factors')])} from pred",
)
oracle(
    "tier_summary",
    """select count(*) as total_predictions, count(case when risk_tier = 'High' then 1 end) as high_risk,
      count(case when risk_tier = 'Elevated' then 1 end) as elevated_risk from pred""",
)
RUL, P90, P30 = "component_rul_regression", "component_failure_90d_classification", "component_failure_30d_classification"
ERROR = "(cast(predicted_rul_days as double) - cast(rul as double))"


def hit_rate(flag: str, label: str, of: str) -> str:
    return rounded(
        f"cast(sum(case when {flag} and {label} = 1 then 1 else 0 end) as double) / nullif(sum(case when {of} then 1 else 0 end), 0)", 4
    )


def metric_rows(by: str = "") -> str:
    rows = [
        (RUL, "RMSE", rounded(f"sqrt(avg({ERROR} * {ERROR}))", 4), "predicted_rul_days"),
        (RUL, "MAE", rounded(f"avg(abs({ERROR}))", 4), "predicted_rul_days"),
    ]
    for model, prob, label in ((P30, "predicted_failure_prob_30d", "y30"), (P90, "predicted_failure_prob_90d", "y90")):
        rows.append((model, "Precision", hit_rate(f"{prob} > 0.5", label, f"{prob} > 0.5"), prob))
        rows.append((model, "Recall", hit_rate(f"{prob} > 0.5", label, f"{label} = 1"), prob))
    group = f"group by {by}" if by else ""
    extra = f", {by} as month" if by else ""
    return " union all ".join(
        f"""select '{model}' as model_name, max(model_version) as model_version, '{metric}' as metric_name,
        cast({value} as decimal(10,4)) as metric_value, count(*) as sample_size, count({scored}) as n_scored,
        min(snapshot_date) as evaluation_window_start, max(snapshot_date) as evaluation_window_end{extra} from scored {group}"""
        for model, metric, value, scored in rows
    )


LOG = """select model_name, model_version, metric_name, cast(metric_value as double) as metric_value, sample_size, n_scored,
    strftime(evaluation_window_start, '%Y-%m-%d') as evaluation_window_start,
    strftime(evaluation_window_end, '%Y-%m-%d') as evaluation_window_end from ({}) where model_name = '{}'"""
oracle(
    "eval_versions",
    f"""select model_version, metric_name, cast(metric_value as double) as metric_value, sample_size, n_scored from (
      select run_id, max(model_version) as model_version, 'RMSE' as metric_name, {rounded(f"sqrt(avg({ERROR} * {ERROR}))", 4)} as metric_value,
        count(*) as sample_size, count(predicted_rul_days) as n_scored from every_run group by run_id
      union all select run_id, max(model_version), 'MAE', {rounded(f"avg(abs({ERROR}))", 4)}, count(*), count(predicted_rul_days)
      from every_run group by run_id)""",
    every_run=f"""select p.*, f.remaining_useful_life_days as rul from pred p join feat f on f.record_id = p.record_id
      and f.snapshot_date = p.snapshot_date where p.run_id in ('r1', 'r2') and p.snapshot_date between date '1996-01-01' and {BATCH}""",
)
oracle("eval_rul", LOG.format(metric_rows(), RUL))
oracle("eval_classifier_30", LOG.format(metric_rows(), P30))
oracle("eval_classifier_90", LOG.format(metric_rows(), P90))


def _ranked(source: str, by: str, prob: str, label: str) -> str:
    """AUC from mid-ranks (the sum of the positives' ranks), F1 from counts."""
    f1 = rounded(f"cast(2 * sum(case when {prob} > 0.5 and {label} = 1 then 1 else 0 end) as double) "
                 f"/ nullif(sum(case when {prob} > 0.5 then 1 else 0 end) + sum(case when {label} = 1 then 1 else 0 end), 0)", 4)
    both = f"{prob} is not null and {label} is not null"
    pos, neg = (f"count(case when {label} = {v} and {prob} is not null then 1 end)" for v in (1, 0))
    auc = rounded(f"(2 * sum(case when {label} = 1 then mid end) - cast({pos} as double) * ({pos} + 1)) "
                  f"/ nullif(2.0::double * {pos} * {neg}, 0)", 4)
    return f"""select {by}, {auc} as auc, {f1} as f1, count(*) as sample_size, count({prob}) as n_scored, min(snapshot_date) as lo,
      max(snapshot_date) as hi from (select *, case when {both} then (rank() over (partition by {by}, {both} order by {prob})
      + rank() over (partition by {by}, {both} order by {prob}) + count(*) over (partition by {by}, {both}, {prob}) - 1) / 2.0::double end as mid
      from {source}) group by {by}"""


oracle(
    "eval_ranking",
    " union all ".join(
        f"""select '{model}' as model_name, model_version, '{name}' as metric_name, cast({value} as double) as metric_value, sample_size, n_scored,
          strftime(lo, '%Y-%m-%d') as evaluation_window_start, strftime(hi, '%Y-%m-%d') as evaluation_window_end from {ranked}"""
        for model, ranked in ((P30, "r30"), (P90, "r90")) for name, value in (("AUC", "auc"), ("F1", "f1"))
    ),
    r30=_ranked("scored", "model_version", "predicted_failure_prob_30d", "y30"),
    r90=_ranked("scored", "model_version", "predicted_failure_prob_90d", "y90"),
)
oracle(
    "eval_ranking_yearly",
    " union all ".join(
        f"""select model_version, strftime(year, '%Y-%m-%d') as year, '{name}' as metric_name, cast({value} as double) as metric_value, sample_size
          from yearly"""
        for name, value in (("AUC", "auc"), ("F1", "f1"))
    ),
    all_runs="""select p.*, f.failure_within_30_days as y30, date_trunc('year', p.snapshot_date) as year from pred p
      join feat f on f.record_id = p.record_id and f.snapshot_date = p.snapshot_date""",
    yearly=_ranked("all_runs", "model_version, year", "predicted_failure_prob_30d", "y30"),
)
oracle("registry_metrics", f"select model_name, metric_name, cast(metric_value as double) as metric_value from ({metric_rows()})")
oracle(
    "threshold_sweep",
    f"""select cast(threshold as double) as threshold,
      cast({hit_rate("predicted_failure_prob_30d > threshold", "y30", "predicted_failure_prob_30d > threshold")} as double) as precision,
      cast({hit_rate("predicted_failure_prob_30d > threshold", "y30", "y30 = 1")} as double) as recall
    from (select 0.2 as threshold union all select 0.3 union all select 0.4 union all select 0.5) cross join scored
    group by threshold""",
)
_monthly = {"log": f"select *, month + interval 1 month as logged_at from ({metric_rows('date_trunc(' + chr(39) + 'month' + chr(39) + ', snapshot_date)')})"}
LOOK_BACK = datetime(2001, 6, 3)
oracle(
    "metric_trend",
    f"""select model_name, metric_name, cast({rounded("avg(metric_value)", 4)} as double) as avg_metric,
      cast(min(metric_value) as double) as min_metric, cast(max(metric_value) as double) as max_metric, count(*) as samples
    from log where logged_at > {ts(LOOK_BACK)} - interval 90 days group by 1, 2""",
    **_monthly,
)

DRIFTING = ["health_monitoring_score", "sensor_vibration_index", "sensor_oil_debris_index", "anomaly_count_last_30_days"]


def drift_rows(until: datetime | None, at: datetime, limit: float) -> str:
    rows = f"(select * from feat where snapshot_date < timestamp '{until}')" if until else "feat"
    parts = []
    for feature in DRIFTING:
        means = f"""select avg({feature}) filter (where snapshot_date < last - interval 90 days) as r,
            avg({feature}) filter (where snapshot_date >= last - interval 30 days) as c
          from {rows} cross join (select max(snapshot_date) as last from {rows} )"""
        pct = rounded("100.0 * (c - r) / nullif(abs(r), 0)", 4, 12)
        parts.append(
            f"""select '{feature}' as feature_name, r, c, {pct} as pct, abs({pct}) > {limit} as drift_flag, {ts(at)} as evaluated_at
            from ({means})"""
        )
    return " union all ".join(parts)


DRIFT = f"""select feature_name, cast({rounded("r", 6)} as double) as reference_mean, cast({rounded("c", 6)} as double) as current_mean,
    cast(pct as double) as pct_change, drift_flag, {shown("evaluated_at", "timestamp_ntz")} from ({{}})"""
D1, D2 = datetime(2000, 7, 1), datetime(2001, 7, 1)
TWO_RUNS = f"{drift_rows(D1, D1, 0.5)} union all {drift_rows(D2, D2, 0.5)}"
oracle("drift_log", DRIFT.format(drift_rows(None, mapping.AS_OF, 15)))
oracle(
    "drift_recent",
    DRIFT.format(f"select * from ({TWO_RUNS}) where drift_flag and evaluated_at > {ts(D2)} - interval 7 days"),
)
oracle("drift_kept", DRIFT.format(TWO_RUNS))
DRIFT_ALERTS = f"""select 'Data Drift' as alert_type, 'Warning' as severity,
      'Feature "' || feature_name || '" shifted ' || cast(pct as varchar) || '% vs. baseline — review upstream source and consider retraining.' as message,
      feature_name as related_entity, 'feature' as entity_kind, evaluated_at as raised_at from ({TWO_RUNS}) where drift_flag"""
METRIC_ALERTS = """select 'Model Performance' as alert_type, case metric_name when 'RMSE' then 'Warning' else 'Critical' end as severity,
      case metric_name when 'RMSE' then 'RUL model RMSE degraded to ' || cast(metric_value as varchar) || ' days (threshold: 20).'
        else model_name || ' recall dropped to ' || cast(metric_value as varchar) || ' (threshold: 0.60) — schedule retraining review.' end as message,
      model_name as related_entity, 'model' as entity_kind, logged_at as raised_at from log
    where (metric_name = 'RMSE' and metric_value > 20) or (metric_name = 'Recall' and metric_value < 0.6)"""
ALERT = "alert_type, severity, message, related_entity, entity_kind, strftime(raised_at, '%Y-%m-%d %H:%M:%S') as raised_at, {} as acknowledged"
_alerts = {**_monthly, "alerts": f"select * from ({DRIFT_ALERTS}) union all select * from ({METRIC_ALERTS})"}
SEEN = f"(raised_at <= {ts(D1)})"
oracle("alerts_drift", f"select {ALERT.format('false')} from ({DRIFT_ALERTS})")
oracle("alerts_performance", f"select {ALERT.format('false')} from ({METRIC_ALERTS})", **_monthly)
oracle(
    "alerts_acknowledged",
    f"""select {ALERT.format(SEEN)}, case when {SEEN} then 'pipeline' end as acknowledged_by,
      case when {SEEN} then {text(mapping.AS_OF)} end as acknowledged_at from alerts""",
    **_alerts,
)
oracle(
    "retraining_required",
    f"""select distinct related_entity as entity, entity_kind, message as reason from alerts
    where severity in ('Warning', 'Critical') and raised_at > {ts(LOOK_BACK)} - interval 7 days and not {SEEN}""",
    **_alerts,
)
oracle("open_alerts", f"select {ALERT.format('false')} from alerts where not {SEEN}", **_alerts)

# ---- marts ----

RISK = {
    "risk": """select * from (
      select p.component_serial_number, c.component_type, c.component_subtype, f.aircraft_tail_number, a.aircraft_model, a.fleet_type,
        a.operating_region, p.predicted_rul_days, p.predicted_failure_prob_30d, p.predicted_failure_prob_90d, p.risk_tier,
        p.snapshot_date, p.scored_at,
        row_number() over (partition by p.component_serial_number order by p.scored_at desc, p.snapshot_date desc, p.record_id desc) as rn
      from pred p join comp c on c.component_serial_number = p.component_serial_number
      join fact f on f.record_id = p.record_id and f.snapshot_date = p.snapshot_date
      join air a on a.aircraft_tail_number = f.aircraft_tail_number) where rn = 1""",
}
_values = """cast(predicted_rul_days as double) as predicted_rul_days, cast(predicted_failure_prob_30d as double) as predicted_failure_prob_30d,
    cast(predicted_failure_prob_90d as double) as predicted_failure_prob_90d, risk_tier"""
_scored_at = shown("scored_at", "timestamp_ntz")
oracle(
    "latest_component_risk",
    f"""select component_serial_number, component_type, component_subtype, aircraft_tail_number, aircraft_model, fleet_type,
      operating_region, {_values}, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, {_scored_at} from risk""",
    **RISK,
)
oracle(
    "component_risk_kept",
    f"""select component_serial_number, component_type, component_subtype, aircraft_tail_number, aircraft_model, fleet_type,
      operating_region, {_values}, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, {_scored_at} from risk""",
    **RISK,
)
oracle(
    "export_risk_view",
    f"""select component_serial_number, component_type, component_subtype, aircraft_tail_number, aircraft_model, fleet_type,
      operating_region, {_values}, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, {_scored_at} from risk
    where scored_at >= {ts(mapping.RUNS["r2"])} - interval 1 day""",
    **RISK,
)
oracle(
    "risk_ranking_top50",
    f"""select r.component_serial_number, r.component_type, r.component_subtype, cast(c.part_cost_usd as double) as part_cost_usd,
      aircraft_tail_number, aircraft_model, operating_region, {_values}, {_scored_at}
    from risk r join comp c on c.component_serial_number = r.component_serial_number
    where risk_tier in ('High', 'Elevated') order by r.predicted_failure_prob_30d desc, r.component_serial_number limit 50""",
    **RISK,
)
oracle(
    "aircraft_summary",
    f"""select r.aircraft_tail_number, a.aircraft_model, count(*) as total_components,
      cast(sum(case when risk_tier = 'High' then 1 else 0 end) as bigint) as high_risk_count,
      cast(sum(case when risk_tier = 'Elevated' then 1 else 0 end) as bigint) as elevated_risk_count,
      cast({rounded("avg(predicted_rul_days)", 1)} as double) as avg_rul_days
    from risk r join air a on a.aircraft_tail_number = r.aircraft_tail_number group by 1, 2""",
    **RISK,
)


def _supplier(count: str, risky: str) -> str:
    return f"""select s.supplier_id, cast(s.supplier_quality_score as double) as supplier_quality_score, {count} as components_supplied,
      {risky} as at_risk_components, cast({rounded(f"100.0 * {risky} / nullif({count}, 0)", 2)} as double) as risk_pct
    from sup s left join comp c on c.supplier_id = s.supplier_id
    left join pred p on p.component_serial_number = c.component_serial_number and p.scored_at = (select max(scored_at) from pred)
    group by 1, 2"""


_at_risk = "case when p.risk_tier in ('High', 'Elevated') then {} end"
oracle("supplier_risk", _supplier("count(c.component_serial_number)", f"count({_at_risk.format(1)})"))
oracle(
    "supplier_risk_distinct",
    _supplier("count(distinct c.component_serial_number)", f"count(distinct {_at_risk.format('c.component_serial_number')})"),
)
oracle(
    "override_log",
    f"""select record_id, cast(1 as bigint) as model_id, '{{"risk_tier": "High", "record_id": ' || record_id || '}}' as original_prediction,
      ['Confirmed', 'Overridden', 'Escalated'][n] as reviewer_decision, 'rev-' || (n - 1) as reviewer_id, 'seen' as reviewer_comment,
      {text(mapping.AS_OF)} as reviewed_at
    from (select record_id, record_id % 3 + 1 as n from pred where run_id = 'r2' and risk_tier = 'High')""",
)
oracle(
    "override_sample",
    """select record_id, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, component_type from feat f
    where exists (select 1 from fact h where h.record_id = f.record_id and h.inspection_finding_severity = 'Critical')
    order by md5(concat_ws('|', cast(record_id as varchar), cast(snapshot_date as varchar))), record_id, snapshot_date limit 500""",
)
oracle(
    "registry_versions",
    f"""select model_name, version as model_version, version = newest as is_active
    from (values ('{RUL}', 'v2'), ('{P90}', 'v1'), ('{P30}', 'v1')) m(model_name, newest), (values ('v1'), ('v2')) v(version)
    where version <= newest""",
)
TRAINED = f"""select record_id, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, cast({{0}} as double) as {{0}},
  component_type is not null as scored, {{1}} as in_range, (select count(distinct {{0}}) > 1 from feat cross join m where {SPLITS["test"]}) as better
  from feat cross join m where {SPLITS["test"]}"""
oracle("train_score_rul", TRAINED.format("remaining_useful_life_days", "remaining_useful_life_days >= 0"), **_last)
oracle("train_score_90", TRAINED.format("failure_within_90_days", "failure_within_90_days between 0 and 1"), **_last)
oracle("train_score_30", TRAINED.format("failure_within_30_days", "failure_within_30_days between 0 and 1"), **_last)
oracle(
    "registry_rows",
    f"""select model_name, 'v1' as model_version, problem_type, target_column,
      '{{"training_rows":' || cast(n as varchar) || '}}' as training_data_summary, true as is_active
    from (select count(*) as n from fact cross join m where {SPLITS["train"]}) cross join
      (select '{RUL}' as model_name, 'regression' as problem_type, 'remaining_useful_life_days' as target_column
       union all select '{P90}', 'classification', 'failure_within_90_days'
       union all select '{P30}', 'classification', 'failure_within_30_days')""",
    **_last,
)


def _factors() -> str:
    """Each input's share: at every split on it that a row comes to, the step from the node's value to the child's."""
    nodes = {(t, n): (value, left, right, split_on, split, kinds) for t, n, value, left, right, split_on, split, kinds in mapping.TREES}
    steps: dict[int, list[str]] = {i: [] for i in range(len(mapping.TREE_INPUTS))}

    def walk(tree: int, node: int, path: list[str]) -> None:
        value, left, right, split_on, split, kinds = nodes[tree, node]
        if left < 0:
            return
        name = mapping.TREE_INPUTS[split_on]
        test = f"{name} <= {split[0]}" if kinds < 0 else f"{name} in ({', '.join(map(str, split))})"
        for child, way in ((left, test), (right, f"not ({test})")):
            step = mapping.TREE_WEIGHTS[tree] * (nodes[tree, child][0] - value)
            steps[split_on].append(f"case when {' and '.join([*path, way])} then {step} else 0 end")
            walk(tree, child, [*path, way])

    for tree in range(len(mapping.TREE_WEIGHTS)):
        walk(tree, 0, [])
    base = sum(w * nodes[t, 0][0] for t, w in enumerate(mapping.TREE_WEIGHTS))
    shares = ", ".join(f"cast({' + '.join(s)} as double) as by_{mapping.TREE_INPUTS[i]}" for i, s in steps.items())
    total = " + ".join(f"by_{c}" for c in mapping.TREE_INPUTS)
    named = ", ".join(f"{{'weak': -abs(by_{c}), 'name': '{c}'}}" for c in mapping.TREE_INPUTS)
    return f"""select record_id, strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, cast({base} + {total} as double) as margin,
      cast({base} as double) as base, {", ".join(f"by_{c}" for c in mapping.TREE_INPUTS)},
      list_filter(list_sort([{named}]), lambda f: f.weak < 0)[1].name as strongest
    from (select record_id, snapshot_date, {shares} from feat)"""


oracle("prediction_factors", _factors())

oracle(
    "surrogate_ids",
    f"""select {show(FACT, ["record_id", "snapshot_date"])},
      row_number() over (order by snapshot_date >= date '1996-01-01', record_id, snapshot_date) as id from fact""",
)
oracle(
    "due_runs",
    """select job, strftime(day + later, '%Y-%m-%d %H:%M:%S') as due_at
    from (select unnest(generate_series(min(snapshot_date)::timestamp, max(snapshot_date)::timestamp, interval 1 day)) as day from fact),
      (values ('monthly', interval 1 hour), ('nightly', interval 2 hour), ('weekly', interval 3 hour)) as j(job, later)
    where (job = 'nightly' or (job = 'weekly' and isodow(day) = 1) or (job = 'monthly' and day(day) = 1))
      and day + later <= (select max(snapshot_date)::timestamp from fact)
      and day::date not in (select snapshot_date from fact where failure_within_30_days = 1 and snapshot_date is not null)""",
)
