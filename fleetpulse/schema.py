"""Column layouts, domains, ranges and keys of the tables the pipeline handles.

Layouts are lists of ``(column, SQL type)`` so one list serves a read schema, a typed
projection and a test. Times are ``timestamp_ntz`` holding UTC wall-clock values, so no
result depends on the time zone of the session that reads it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Layout = list[tuple[str, str]]

# ---- Fixed values: column names, types, domains and ranges of the data model ----------

# Measures of the flat extract have no declared precision; 18,6 holds them.
OPEN_NUMERIC = "decimal(18,6)"

EXTRACT: Layout = [
    ("record_id", "bigint"),
    ("snapshot_date", "date"),
    ("aircraft_tail_number", "string"),
    ("aircraft_model", "string"),
    ("fleet_type", "string"),
    ("aircraft_age_years", OPEN_NUMERIC),
    ("operating_region", "string"),
    ("operating_environment", "string"),
    ("route_type", "string"),
    ("avg_daily_utilization_hours", OPEN_NUMERIC),
    ("component_serial_number", "string"),
    ("component_type", "string"),
    ("component_subtype", "string"),
    ("component_manufacturer", "string"),
    ("part_number", "string"),
    ("part_cost_usd", OPEN_NUMERIC),
    ("installation_date", "date"),
    ("design_mtbf_hours", OPEN_NUMERIC),
    ("cumulative_flight_hours", OPEN_NUMERIC),
    ("cumulative_flight_cycles", OPEN_NUMERIC),
    ("flight_hours_since_last_overhaul", OPEN_NUMERIC),
    ("flight_cycles_since_last_overhaul", OPEN_NUMERIC),
    ("flight_hours_since_last_removal", OPEN_NUMERIC),
    ("prior_removal_count", "int"),
    ("prior_unscheduled_removal_count", "int"),
    ("days_since_last_maintenance_event", "int"),
    ("last_maintenance_type", "string"),
    ("maintenance_events_last_12_months", "int"),
    ("inspection_finding_severity", "string"),
    ("inspection_technician_id", "string"),
    ("work_order_number", "string"),
    ("sensor_vibration_index", OPEN_NUMERIC),
    ("sensor_temperature_avg_c", OPEN_NUMERIC),
    ("sensor_pressure_avg_psi", OPEN_NUMERIC),
    ("sensor_oil_debris_index", OPEN_NUMERIC),
    ("health_monitoring_score", OPEN_NUMERIC),
    ("anomaly_count_last_30_days", "int"),
    ("ambient_temperature_avg_c", OPEN_NUMERIC),
    ("humidity_avg_pct", OPEN_NUMERIC),
    ("corrosion_risk_index", OPEN_NUMERIC),
    ("supplier_id", "string"),
    ("supplier_quality_score", OPEN_NUMERIC),
    ("warranty_status", "string"),
    ("firmware_version", "string"),
    ("data_quality_flag", "string"),
    ("remaining_useful_life_days", OPEN_NUMERIC),
    ("failure_within_30_days", "int"),
    ("failure_within_90_days", "int"),
    ("record_created_timestamp", "timestamp_ntz"),
]

LINEAGE: Layout = [("load_batch_id", "string"), ("loaded_at", "timestamp_ntz")]

DIM_AIRCRAFT: Layout = [
    ("aircraft_tail_number", "string"),
    ("aircraft_model", "string"),
    ("fleet_type", "string"),
    ("aircraft_age_years", "decimal(6,2)"),
    ("operating_region", "string"),
    ("operating_environment", "string"),
    ("route_type", "string"),
    ("avg_daily_utilization_hours", "decimal(6,2)"),
]

DIM_SUPPLIER: Layout = [("supplier_id", "string"), ("supplier_quality_score", "decimal(5,1)")]

DIM_COMPONENT: Layout = [
    ("component_serial_number", "string"),
    ("component_type", "string"),
    ("component_subtype", "string"),
    ("component_manufacturer", "string"),
    ("part_number", "string"),
    ("part_cost_usd", "decimal(12,2)"),
    ("installation_date", "date"),
    ("design_mtbf_hours", "decimal(10,1)"),
    ("supplier_id", "string"),
    ("warranty_status", "string"),
    ("firmware_version", "string"),
]

FACT: Layout = [
    ("record_id", "bigint"),
    ("snapshot_date", "date"),
    ("aircraft_tail_number", "string"),
    ("component_serial_number", "string"),
    ("cumulative_flight_hours", "decimal(12,1)"),
    ("cumulative_flight_cycles", "decimal(12,0)"),
    ("flight_hours_since_last_overhaul", "decimal(12,1)"),
    ("flight_cycles_since_last_overhaul", "decimal(12,0)"),
    ("flight_hours_since_last_removal", "decimal(12,1)"),
    ("prior_removal_count", "int"),
    ("prior_unscheduled_removal_count", "int"),
    ("days_since_last_maintenance_event", "int"),
    ("last_maintenance_type", "string"),
    ("maintenance_events_last_12_months", "int"),
    ("inspection_finding_severity", "string"),
    ("inspection_technician_id", "string"),
    ("work_order_number", "string"),
    ("sensor_vibration_index", "decimal(8,3)"),
    ("sensor_temperature_avg_c", "decimal(6,2)"),
    ("sensor_pressure_avg_psi", "decimal(8,1)"),
    ("sensor_oil_debris_index", "decimal(8,3)"),
    ("health_monitoring_score", "decimal(5,2)"),
    ("anomaly_count_last_30_days", "int"),
    ("ambient_temperature_avg_c", "decimal(6,2)"),
    ("humidity_avg_pct", "decimal(5,1)"),
    ("corrosion_risk_index", "decimal(5,2)"),
    ("data_quality_flag", "string"),
    ("remaining_useful_life_days", "decimal(8,1)"),
    ("failure_within_30_days", "smallint"),
    ("failure_within_90_days", "smallint"),
    ("record_created_timestamp", "timestamp_ntz"),
]

FEATURES: Layout = [
    ("record_id", "bigint"),
    ("snapshot_date", "date"),
    ("component_serial_number", "string"),
    ("aircraft_tail_number", "string"),
    ("component_type", "string"),
    ("fleet_type", "string"),
    ("operating_environment", "string"),
    ("pct_of_design_life_consumed", "decimal(8,4)"),
    ("hours_per_cycle", "decimal(10,3)"),
    ("unscheduled_removal_ratio", "decimal(6,4)"),
    ("sensor_composite_risk_score", "decimal(10,4)"),
    ("maintenance_recency_score", "decimal(8,4)"),
    ("rolling_30d_component_type_failure_rate", "decimal(6,4)"),
    ("aircraft_age_years", "decimal(6,2)"),
    ("avg_daily_utilization_hours", "decimal(6,2)"),
    ("supplier_quality_score", "decimal(5,1)"),
    ("cumulative_flight_hours", "decimal(12,1)"),
    ("cumulative_flight_cycles", "decimal(12,0)"),
    ("prior_removal_count", "int"),
    ("prior_unscheduled_removal_count", "int"),
    ("days_since_last_maintenance_event", "int"),
    ("maintenance_events_last_12_months", "int"),
    ("sensor_vibration_index", "decimal(8,3)"),
    ("sensor_oil_debris_index", "decimal(8,3)"),
    ("health_monitoring_score", "decimal(5,2)"),
    ("anomaly_count_last_30_days", "int"),
    ("corrosion_risk_index", "decimal(5,2)"),
    ("remaining_useful_life_days", "decimal(8,1)"),
    ("failure_within_30_days", "smallint"),
    ("failure_within_90_days", "smallint"),
]

PREDICTIONS: Layout = [
    ("prediction_id", "bigint"),
    ("record_id", "bigint"),
    ("component_serial_number", "string"),
    ("snapshot_date", "date"),
    ("model_name", "string"),
    ("model_version", "string"),
    ("predicted_rul_days", "decimal(8,1)"),
    ("predicted_failure_prob_30d", "decimal(6,4)"),
    ("predicted_failure_prob_90d", "decimal(6,4)"),
    ("risk_tier", "string"),
    ("top_contributing_factors", "string"),
    ("run_id", "string"),
    ("scored_at", "timestamp_ntz"),
]

# A fact re-delivered for the same key refreshes these measures only.
FACT_KEYS = ["record_id", "snapshot_date"]
FACT_REFRESHED = [
    "cumulative_flight_hours",
    "health_monitoring_score",
    "remaining_useful_life_days",
    "failure_within_30_days",
    "failure_within_90_days",
]

NO_FIRMWARE = "N/A - Non-Electronic"
COMPLETE = "Complete"

# Allowed values per column; NULL always passes.
DOMAINS: dict[str, list] = {
    "fleet_type": ["Narrowbody", "Regional", "Specialized-Mission"],
    "operating_environment": ["Desert", "Coastal", "Temperate", "Arctic", "Tropical"],
    "route_type": ["Short-haul", "Medium-haul", "Long-haul"],
    "warranty_status": ["In Warranty", "Out of Warranty", "Extended Warranty"],
    "inspection_finding_severity": ["None", "Minor", "Major", "Critical"],
    "failure_within_30_days": [0, 1],
    "failure_within_90_days": [0, 1],
}
LOG_DOMAINS: dict[str, list] = {
    "rule_category": ["Completeness", "Validity", "Consistency", "Uniqueness", "Referential Integrity"],
    "rule_severity": ["Warning", "Critical"],
    "operation": ["INSERT", "UPDATE", "DELETE"],
    "problem_type": ["regression", "classification"],
    "risk_classification": ["Low", "Medium", "High"],
    "reviewer_decision": ["Confirmed", "Overridden", "Escalated"],
    "risk_tier": ["Low", "Watch", "Elevated", "High"],
    "alert_type": ["Data Quality", "Data Drift", "Model Performance", "Prediction Volume"],
    "severity": ["Info", "Warning", "Critical"],
}

# (lowest, highest) allowed value per column; None is open. NULL always passes.
RANGES: dict[str, tuple] = {
    "aircraft_age_years": (0, None),
    "avg_daily_utilization_hours": (0, None),
    "part_cost_usd": (0, None),
    "cumulative_flight_hours": (0, None),
    "cumulative_flight_cycles": (0, None),
    "flight_hours_since_last_overhaul": (0, None),
    "flight_cycles_since_last_overhaul": (0, None),
    "flight_hours_since_last_removal": (0, None),
    "prior_removal_count": (0, None),
    "prior_unscheduled_removal_count": (0, None),
    "days_since_last_maintenance_event": (0, None),
    "maintenance_events_last_12_months": (0, None),
    "health_monitoring_score": (0, 100),
    "anomaly_count_last_30_days": (0, None),
    "humidity_avg_pct": (0, 100),
    "corrosion_risk_index": (0, 100),
    "supplier_quality_score": (0, 100),
    "remaining_useful_life_days": (0, None),
}
POSITIVE = ["design_mtbf_hours"]

NOT_NULL = {
    "aircraft": [
        "aircraft_tail_number", "aircraft_model", "fleet_type",
        "operating_region", "operating_environment", "route_type",
    ],
    "component": [
        "component_serial_number", "component_type", "component_subtype",
        "component_manufacturer", "part_number", "installation_date",
    ],
    "fact": [
        "record_id", "snapshot_date", "aircraft_tail_number", "component_serial_number",
        "cumulative_flight_hours", "cumulative_flight_cycles", "prior_removal_count",
        "prior_unscheduled_removal_count", "data_quality_flag", "record_created_timestamp",
    ],
}
# ---- end of fixed values --------------------------------------------------------------


def names(layout: Layout) -> list[str]:
    return [name for name, _ in layout]


def struct_type(layout: Layout) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {sql_type}" for name, sql_type in layout))


def typed(layout: Layout) -> list[Column]:
    """Projection that casts every column of a layout to its declared type.

    Decimal casts round half away from zero and raise on overflow (ANSI mode).
    """
    return [F.col(name).cast(sql_type).alias(name) for name, sql_type in layout]


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns an insert left out; a column that is present, NULL or not, is kept."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})


def require(value, allowed: Iterable, what: str):
    """Reject a parameter outside its domain."""
    if value is not None and value not in allowed:
        raise ValueError(f"{what} must be one of {list(allowed)}, got {value!r}")
    return value
