from datetime import date, datetime

from conftest import values

from fleetpulse.plans import load
from fleetpulse.session import RunContext
from fleetpulse.sources import extract, months
from fleetpulse.streaming.landing import load_new_files

CTX = RunContext(datetime(2024, 7, 1), "inbox")


def test_each_file_is_loaded_once(rows, spark, tmp_path):
    inbox, layout = str(tmp_path / "inbox"), load.Layout(str(tmp_path / "wh"), date(2024, 1, 1), date(2025, 1, 1))

    def arrive(batch):
        extract.write_csv(batch, str(tmp_path / "out"))
        (tmp_path / "inbox").mkdir(exist_ok=True)
        for i, part in enumerate(sorted((tmp_path / "out").glob("*.csv"))):
            (tmp_path / "inbox" / f"{part.name}").write_bytes(part.read_bytes())

    arrive(rows({"record_id": 1}, {"record_id": 2, "health_monitoring_score": 200}))
    load_new_files(spark, inbox, layout, CTX)
    arrive(rows({"record_id": 1, "cumulative_flight_hours": 300}, {"record_id": 3}))
    load_new_files(spark, inbox, layout, CTX)
    load_new_files(spark, inbox, layout, CTX)  # nothing new

    fact = months.read_months(spark, layout.path("fact"))
    assert [(i, float(h)) for i, h in values(fact, "record_id", "cumulative_flight_hours")] == [(1, 300.0), (3, 250.0)]
    assert values(spark.read.parquet(layout.path("quarantine")), "record_id") == [(2,)]
    assert values(spark.read.parquet(layout.path("finished_loads")), "run_id") == [("inbox-0",), ("inbox-1",)]
