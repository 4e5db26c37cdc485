from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import keys
from fleetpulse.session import RunContext


def run(name):
    return RunContext(datetime(2024, 6, 1), run_id=name)


def test_ids_are_gapless_across_runs_and_the_same_on_a_rerun(spark, tmp_path):
    path = str(tmp_path / "marks")
    # A third of the rows tie in the order, another third have none.
    rows = spark.range(0, 3000, 1, 7).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).alias("k")
    )
    first = {r.row: r.id for r in keys.allocate(rows, ["k"], path, run("a")).collect()}
    assert sorted(first.values()) == list(range(1, 3001))
    order = {r.row: (r.k is not None, r.k or 0) for r in rows.collect()}
    by_id = [order[row] for row, _ in sorted(first.items(), key=lambda p: p[1])]
    assert by_id == sorted(by_id)
    second = keys.allocate(rows.limit(10), ["k"], path, run("b")).collect()
    assert sorted(r.id for r in second) == list(range(3001, 3011))
    # The first run again, its rows split otherwise, after the mark has moved on.
    again = {r.row: r.id for r in keys.allocate(rows.repartition(3, "row"), ["k"], path, run("a")).collect()}
    assert again == first
    with pytest.raises(ValueError, match="other ones"):
        keys.allocate(rows.withColumn("row", F.col("row") + 1), ["k"], path, run("a"))


def test_equal_rows_clashing_names_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "marks")
    rows = spark.createDataFrame([(1, None), (1, None), (0, "x")], "_part int, _row string")
    assert keys.allocate(rows.limit(0), ["_part"], path, run("none")).collect() == []
    got = keys.allocate(rows, ["_part"], path, run("a"), column="n").collect()
    assert sorted((r.n, r._part) for r in got) == [(1, 0), (2, 1), (3, 1)]
