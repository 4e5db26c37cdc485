import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from fleetpulse.schema import EXTRACT, struct_type  # noqa: E402
from fleetpulse.session import RunContext, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "4g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")), "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ctx():
    return RunContext(datetime(2024, 6, 30, 12), run_id="run", user="tester")


GOOD_ROW = {
    "record_id": 1,
    "snapshot_date": date(2024, 6, 1),
    "aircraft_tail_number": "N1",
    "aircraft_model": "M1",
    "fleet_type": "Regional",
    "aircraft_age_years": 4,
    "operating_region": "North",
    "operating_environment": "Desert",
    "route_type": "Short-haul",
    "avg_daily_utilization_hours": 6,
    "component_serial_number": "C1",
    "component_type": "Engine",
    "component_subtype": "Fan",
    "component_manufacturer": "Maker",
    "part_number": "P1",
    "part_cost_usd": 100,
    "installation_date": date(2020, 1, 1),
    "design_mtbf_hours": 1000,
    "cumulative_flight_hours": 250,
    "cumulative_flight_cycles": 100,
    "flight_hours_since_last_overhaul": 50,
    "flight_cycles_since_last_overhaul": 20,
    "flight_hours_since_last_removal": 25,
    "prior_removal_count": 4,
    "prior_unscheduled_removal_count": 1,
    "days_since_last_maintenance_event": 90,
    "sensor_vibration_index": 1,
    "sensor_oil_debris_index": 2,
    "health_monitoring_score": 80,
    "anomaly_count_last_30_days": 3,
    "supplier_id": "S1",
    "supplier_quality_score": 90,
    "firmware_version": "fw-1",
    "remaining_useful_life_days": 300,
    "failure_within_30_days": 0,
    "failure_within_90_days": 0,
    "record_created_timestamp": datetime(2024, 6, 1),
}


@pytest.fixture(scope="session")
def rows(spark):
    """Extract frame from rows given as changes to a row without faults."""
    from decimal import Decimal

    schema = struct_type(EXTRACT)

    def build(*changes):
        data = []
        for change in changes:
            row = {**GOOD_ROW, **change}
            data.append(
                tuple(
                    Decimal(str(row[f.name])) if f.dataType.typeName() == "decimal" and row.get(f.name) is not None
                    else row.get(f.name)
                    for f in schema
                )
            )
        return spark.createDataFrame(data, schema)

    return build


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is None, str(v)) for v in r])
