"""How a row of the test tables becomes a row of the extract.

Every expression is plain SQL with the same meaning in Spark and in the oracle engine.
The mapping yields failing rows for most rules, NULL readings, zero denominators and
repeated ids, so that the operators have something to find.
"""

from __future__ import annotations

from datetime import date, datetime

# Whole numbers kept as double in the test tables are taken as integers: exact and cheap.
QUANTITY = "cast(floor(l_quantity+0.5) as int)"

# One expression per extract column, over lineitem x orders x customer x part x supplier.
EXPRESSIONS: dict[str, str] = {
    "record_id": "l_orderkey*10+l_linenumber",
    "snapshot_date": "cast(l_shipdate as date)",
    "aircraft_tail_number": "case when l_orderkey%991=0 then null else c_name end",
    "aircraft_model": "c_mktsegment",
    "fleet_type": "case c_nationkey%3 when 0 then 'Narrowbody' when 1 then 'Regional' else 'Specialized-Mission' end",
    "aircraft_age_years": "c_nationkey",
    "operating_region": "case c_nationkey%4 when 0 then 'North' when 1 then 'South' when 2 then 'East' else 'West' end",
    "operating_environment": "case c_nationkey%5 when 0 then 'Desert' when 1 then 'Coastal' when 2 then 'Temperate' "
    "when 3 then 'Arctic' else 'Tropical' end",
    "route_type": "case c_nationkey%3 when 0 then 'Short-haul' when 1 then 'Medium-haul' else 'Long-haul' end",
    "avg_daily_utilization_hours": "c_custkey%14+1",
    "component_serial_number": "case when l_orderkey%997=0 then null else concat('C', cast(l_partkey as string)) end",
    "component_type": "p_type",
    "component_subtype": "p_brand",
    "component_manufacturer": "p_brand",
    "part_number": "p_name",
    "part_cost_usd": "p_retailprice",
    "installation_date": "cast(o_orderdate as date)",
    "design_mtbf_hours": "p_size*100",
    "cumulative_flight_hours": "case when l_orderkey%983=0 then cast(-1 as double) else l_extendedprice/20 end",
    "cumulative_flight_cycles": f"case when l_linenumber=7 then 0 else {QUANTITY}*10 end",
    "flight_hours_since_last_overhaul": "l_extendedprice/20*(l_tax+cast(0 as double))*15",
    "flight_cycles_since_last_overhaul": f"{QUANTITY}*2",
    "flight_hours_since_last_removal": "l_extendedprice/40",
    "prior_removal_count": f"{QUANTITY}%6",
    "prior_unscheduled_removal_count": f"{QUANTITY}%3",
    "days_since_last_maintenance_event": "case when l_linenumber=6 then null else cast((l_partkey*7+l_orderkey*13)%400 as int) end",
    "last_maintenance_type": "case l_linenumber%3 when 0 then 'Inspection' when 1 then 'Repair' else 'Overhaul' end",
    "maintenance_events_last_12_months": "l_linenumber%5",
    "inspection_finding_severity": "case l_linenumber%4 when 0 then 'None' when 1 then 'Minor' when 2 then 'Major' else 'Critical' end",
    "inspection_technician_id": "concat('T', cast(l_suppkey%20 as string))",
    "work_order_number": "concat('W', cast(l_orderkey as string))",
    "sensor_vibration_index": "case when l_linenumber=5 then null else cast(floor(l_discount*100+0.5) as int) end",
    "sensor_temperature_avg_c": f"{QUANTITY}+40",
    "sensor_pressure_avg_psi": f"{QUANTITY}*20",
    "sensor_oil_debris_index": "cast(floor(l_tax*100+0.5) as int)",
    "health_monitoring_score": f"100-{QUANTITY}*cast(2.01 as decimal(3,2))",
    "anomaly_count_last_30_days": "l_linenumber",
    "ambient_temperature_avg_c": "c_nationkey",
    "humidity_avg_pct": "c_nationkey*4",
    "corrosion_risk_index": "c_nationkey*3",
    # A supplier that only rows with negative hours name, so that no good row brings it into its dimension.
    "supplier_id": "case when l_orderkey%983=0 then 'SX' else concat('S', cast(l_suppkey as string)) end",
    "supplier_quality_score": "cast(round(cast((s_acctbal+1000)/110 as decimal(20,10)),1) as double)",
    "warranty_status": "case when l_orderkey%977=0 then 'Expired' when l_linenumber%3=0 then 'In Warranty' when l_linenumber%3=1 then 'Out of Warranty' else 'Extended Warranty' end",
    "firmware_version": "case when p_size%4=0 then 'N/A - Non-Electronic' else concat('fw-', cast(p_size as string)) end",
    "data_quality_flag": "case when l_linenumber=4 then null else 'Complete' end",
    "remaining_useful_life_days": f"{QUANTITY}*cast(7.5 as decimal(2,1))",
    "failure_within_30_days": "case when l_orderkey%503=0 or (l_returnflag='R' and l_linestatus='F') then 1 else 0 end",
    "failure_within_90_days": "case when l_returnflag='R' then 1 else 0 end",
    "record_created_timestamp": "l_shipdate",
}

# Stand-in model outputs over the snapshot rows, per scoring run.
RUNS = {"r0": datetime(2001, 11, 1), "r1": datetime(2001, 12, 1), "r2": datetime(2001, 12, 2)}
# The model version of each run: the last run's model was trained anew.
VERSIONS = {"r0": "v1", "r1": "v1", "r2": "v2"}
OUTPUTS = {
    "r0": {
        "predicted_rul_days": "cast(remaining_useful_life_days as double)*cast(0.7 as double)+30",
        "predicted_failure_prob_30d": "cast((record_id*41+3)%100 as double)/100",
        "predicted_failure_prob_90d": "cast((record_id*41+18)%100 as double)/100",
    },
    "r1": {
        "predicted_rul_days": "cast(remaining_useful_life_days as double)*cast(0.9 as double)+10",
        "predicted_failure_prob_30d": "cast((record_id*37+7)%100 as double)/100",
        "predicted_failure_prob_90d": "cast((record_id*37+22)%100 as double)/100",
    },
    "r2": {
        "predicted_rul_days": "cast(remaining_useful_life_days as double)*cast(0.8 as double)+20",
        "predicted_failure_prob_30d": "cast((record_id*31)%100 as double)/100",
        "predicted_failure_prob_90d": "cast((record_id*31+15)%100 as double)/100",
    },
}

AS_OF = datetime(2001, 12, 2, 12)
# First and last month of the fact's spine; some test rows lie outside on purpose.
SPINE_START = date(1995, 1, 1)
SPINE_END = date(2001, 7, 1)
# To here the spine is extended later.
LATER_END = date(2001, 10, 1)
# A batch boundary that puts rows of every size of test data on both sides.
BATCH_DAY = date(1998, 7, 1)

# A stand-in ensemble: (tree, node, value, left, right, input, split, categories), in eighths, so that sums are exact.
TREE_INPUTS = ["health_monitoring_score", "sensor_oil_debris_index", "aircraft_age_years", "prior_removal_count"]
TREE_WEIGHTS = [1.0, 0.5, 0.5]
TREES = [
    (0, 0, 2.0, 1, 4, 0, [50.5], -1),
    (0, 1, 4.5, 2, 3, 1, [3.0], -1),
    (0, 2, 6.0, -1, -1, -1, [], -1),
    (0, 3, 3.25, -1, -1, -1, [], -1),
    (0, 4, 0.75, -1, -1, -1, [], -1),
    (1, 0, 1.0, 1, 4, 3, [0.0, 2.0, 5.0], 6),
    (1, 1, -1.5, 2, 3, 2, [12.0], -1),
    (1, 2, -3.0, -1, -1, -1, [], -1),
    (1, 3, 0.25, -1, -1, -1, [], -1),
    (1, 4, 2.5, -1, -1, -1, [], -1),
    (2, 0, -0.5, 1, 2, 0, [80.0], -1),
    (2, 1, -2.25, -1, -1, -1, [], -1),
    (2, 2, 3.0, 3, 4, 1, [5.0], -1),
    (2, 3, 1.125, -1, -1, -1, [], -1),
    (2, 4, 4.0, -1, -1, -1, [], -1),
]
