from datetime import date, datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.schema import EXTRACT, names, with_defaults
from fleetpulse.session import RunContext, stage, work_dir
from fleetpulse.sources import extract, months

START, END = date(2024, 1, 1), date(2024, 4, 1)


def line(**fields):
    return ",".join(fields.get(n, "") for n in names(EXTRACT))


def write(path, *lines):
    path.write_text("\n".join(["header,is,never,read", *lines]) + "\n")
    return str(path)


def test_csv_tells_null_from_empty_text(spark, tmp_path):
    path = write(
        tmp_path / "x.csv",
        line(record_id="1", snapshot_date="2024-01-02", aircraft_model='""', part_cost_usd="1.25", record_created_timestamp="2024-01-02 03:04:05"),
        line(record_id="2"),
    )
    got = values(extract.read_extract(spark, path), "record_id", "snapshot_date", "aircraft_model", "route_type", "record_created_timestamp")
    assert got == [(1, date(2024, 1, 2), "", None, datetime(2024, 1, 2, 3, 4, 5)), (2, None, None, None, None)]


@pytest.mark.parametrize("bad", ["1,not a date", "1,2024-01-01"])
def test_bad_row_fails_the_load(spark, tmp_path, bad):
    path = write(tmp_path / "x.csv", bad if "not" not in bad else line(record_id="x"))
    with pytest.raises(Exception):
        extract.read_extract(spark, path).collect()


def test_csv_round_trip(rows, spark, tmp_path):
    batch = rows({"aircraft_model": ""}, {"record_id": 2, "route_type": None}, {"record_id": 3, "part_number": 'a,"b"\\c'})
    extract.write_csv(batch, str(tmp_path / "out"))
    assert values(extract.read_extract(spark, str(tmp_path / "out"))) == values(batch)


QUOTED = {"aircraft_model": '"12"" fan"', "route_type": '"said ""a, b"", c"', "part_number": '"a, b\\"', "supplier_id": '"\\"'}


@pytest.mark.parametrize("columns", [None, ["record_id", "aircraft_model", "supplier_id"]])
def test_quoted_text_is_read_as_standard_csv(spark, tmp_path, columns):
    path = write(tmp_path / "x.csv", line(record_id="1", **QUOTED), line(record_id="2", route_type="plain"))
    got = {r.record_id: r for r in extract.read_extract(spark, path).select(*(columns or names(EXTRACT))).collect()}
    assert (got[1].aircraft_model, got[1].supplier_id) == ('12" fan', "\\")
    if columns is None:
        assert (got[1].route_type, got[1].part_number, got[2].route_type) == ('said "a, b", c', "a, b\\", "plain")


def test_line_ends_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "x.csv", line(record_id="1", aircraft_model='"two\nlines, ""q"""'), line(record_id="2"))
    got = values(extract.read_extract(spark, path, multi_line=True), "record_id", "aircraft_model")
    assert got == [(1, 'two\nlines, "q"'), (2, None)]


def test_landing_replaces_and_stamps_once(rows, ctx, tmp_path):
    path = str(tmp_path / "stg")
    extract.land(rows({}, {"record_id": 2}), path, ctx)
    landed = extract.land(rows({"record_id": 3}, {"record_id": 4}), path, ctx)
    assert values(landed, "record_id", "load_batch_id", "loaded_at") == [(3, "run", ctx.as_of), (4, "run", ctx.as_of)]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([(None,)], "a int")
    assert values(with_defaults(df, {"a": F.lit(1), "b": F.lit(2)})) == [(None, 2)]


def test_export_keeps_the_last_day_inclusive(spark, tmp_path):
    at = datetime(2024, 6, 30)
    risk = spark.createDataFrame([(1, at), (2, at - timedelta(days=1)), (3, at - timedelta(days=1, seconds=1))], "id int, scored_at timestamp_ntz")
    extract.export_recent(risk, str(tmp_path / "out"), RunContext(at))
    text = [f.read_text() for f in (tmp_path / "out").glob("*.csv")]
    assert all(t.startswith("id,scored_at\n") for t in text if t)
    assert sorted(l.split(",")[0] for t in text for l in t.splitlines()[1:]) == ["1", "2"]


def test_default_spine_has_thirty_months(spark):
    spine = months.month_spine(spark).collect()
    assert len(spine) == 30
    assert tuple(spine[0]) == ("2023_06", date(2023, 6, 1), date(2023, 7, 1))
    assert tuple(spine[-1]) == ("2025_11", date(2025, 11, 1), date(2025, 12, 1))
    assert months.month_spine(spark, START, START).count() == 0


def routed(spark, *days):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day date")
    return months.route(df, "day", START, END)


def test_routing(spark):
    df = routed(spark, date(2024, 1, 1), date(2024, 3, 31), date(2024, 4, 1), date(2023, 12, 31), None)
    assert values(df, "id", "partition_name") == [(0, "2024_01"), (1, "2024_03"), (2, "default"), (3, "default"), (4, "default")]


def test_overwrite_replaces_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    months.write_months(routed(spark, date(2024, 1, 5), date(2024, 2, 5), date(2030, 1, 1)), path)
    months.write_months(routed(spark, date(2024, 2, 6), date(2024, 2, 7)), path, sort=["id"])
    assert values(months.read_months(spark, path), "day") == [(date(2024, 1, 5),), (date(2024, 2, 6),), (date(2024, 2, 7),), (date(2030, 1, 1),)]


def test_writes_are_rebalanced_by_size(spark):
    plan = routed(spark, date(2024, 1, 5)).hint("rebalance", months.PARTITION)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_reads_prune_months(spark, tmp_path):
    path = str(tmp_path / "t")
    months.write_months(routed(spark, date(2024, 1, 31), date(2024, 2, 5), date(2024, 3, 5)), path)
    some = months.between_days(months.read_months(spark, path), "day", date(2024, 1, 31), date(2024, 2, 5))
    assert values(some, "id") == [(0,), (1,)]
    assert len(some.inputFiles()) == 3  # the relation knows all files, the scan reads two partitions
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [partition_name" in plan and "2024_02" in plan and "2024_03" not in plan.split("PartitionFilters")[1].split("]")[0]


def test_archive_copies_then_drops(spark, tmp_path):
    path, cold = str(tmp_path / "t"), str(tmp_path / "cold")
    months.write_months(routed(spark, date(2024, 1, 5), date(2024, 2, 5)), path)
    archived = months.archive_month(spark, path, cold, "2024_01", drop=True)
    assert values(archived, "day", "partition_name") == [(date(2024, 1, 5), "2024_01")]
    assert values(months.read_months(spark, path), "day") == [(date(2024, 2, 5),)]


def test_second_archive_call_keeps_the_archive(spark, tmp_path):
    path, cold = str(tmp_path / "t"), str(tmp_path / "cold")
    months.write_months(routed(spark, date(2024, 1, 5), date(2024, 2, 5)), path)
    for _ in range(2):
        archived = months.archive_month(spark, path, cold, "2024_01", drop=True)
        assert values(archived, "day", "partition_name") == [(date(2024, 1, 5), "2024_01")]
    late = spark.createDataFrame([(7, date(2024, 1, 9))], "id int, day date")
    months.write_months(months.route(late, "day", START, END), path)
    for drop in (False, False, True, True):
        assert values(months.archive_month(spark, path, cold, "2024_01", drop=drop), "id") == [(0,), (7,)]
    assert values(months.read_months(spark, path), "id") == [(1,)]
    with pytest.raises(ValueError, match="2024_03"):
        months.archive_month(spark, path, cold, "2024_03")


def test_versions_replace_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert months.read_version(spark, path) is None
    for n in range(1, 5):
        months.write_version(spark.range(n), path)
        assert months.read_version(spark, path).count() == n
    assert len(months.versions(spark, path)) == 2


def test_missing_table_is_none(spark, tmp_path):
    assert months.read_if_exists(spark, str(tmp_path / "nothing")) is None


def test_stage_uses_the_named_folder(spark):
    kept = stage(spark.range(3).toDF("id"), "three")
    assert work_dir(spark) in kept.inputFiles()[0].replace("file://", "")
    assert "InMemoryFileIndex" in kept._jdf.queryExecution().executedPlan().toString()


def test_csv_files_stay_small(spark, tmp_path):
    path = str(tmp_path / "csv")
    extract.write_csv(spark.range(0, 25, 1, 1).toDF("id"), path, file_rows=10)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 3
    assert sorted(r.id for r in spark.read.schema("id bigint").csv(path, header=True).collect()) == list(range(25))


def test_compressed_csv_round_trip(rows, spark, tmp_path):
    batch = rows({"aircraft_model": ""}, {"record_id": 2, "route_type": None}, {"record_id": 3, "part_number": 'a,"b"\\c\nd'})
    for compression in ("none", "gzip"):
        extract.write_csv(batch.coalesce(1), str(tmp_path / compression), file_rows=2, compression=compression)
        assert values(extract.read_extract(spark, str(tmp_path / compression), multi_line=True)) == values(batch)
    assert len(list((tmp_path / "gzip").glob("part-*.csv.gz"))) == 2

    many = batch.select(*[F.col(c) for c in batch.columns]).crossJoin(spark.range(2000)).drop("id")
    size = {}
    for compression in ("none", "gzip"):
        extract.write_csv(many.coalesce(1), str(tmp_path / f"many_{compression}"), compression=compression)
        size[compression] = sum(f.stat().st_size for f in (tmp_path / f"many_{compression}").glob("part-*"))
    assert size["gzip"] * 3 < size["none"]
