import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetpulse.operators import joins
from fleetpulse.operators.joins import UNPACKED, fits, key_filter, latest_per_key, lookup_join, member_flag, possible_members, stored_bytes, with_known
from fleetpulse.session import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third have none; the hot rows are exact copies."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    many = stage(spark.range(0, 300_000, 1, 8).select(key.alias("k"), F.lit("payload " * 4).alias("text")), "many")
    lookup = stage(spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "lookup")
    return many, lookup


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_strategies_agree(skewed, how):
    many, lookup = skewed

    def totals(limit):
        joined = lookup_join(many, lookup, ["k"], how, broadcast_bytes=limit)
        return joined.agg(F.count(F.lit(1)), F.count("v"), F.sum("v"), F.sum("k")).first()

    assert totals(0) == totals(1 << 30)


def test_strategy_follows_measured_size(skewed):
    many, lookup = skewed
    size = stored_bytes(lookup) * UNPACKED
    assert fits(lookup, size) and not fits(lookup, size - 1)
    # One column of a table with long texts counts like all of it.
    assert not fits(many.select("k"), stored_bytes(many))
    small = lookup_join(many, lookup, ["k"])._jdf.queryExecution().executedPlan().toString()
    large = lookup_join(many, lookup, ["k"], broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_split(spark, skewed, how):
    many, lookup = skewed
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = lookup_join(many, lookup, ["k"], how, broadcast_bytes=0)
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_member_flag_keeps_every_row(spark):
    many = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,)], "k int")
    assert values(member_flag(many, keys, ["k"], "hit")) == [(1, True), (1, True), (2, False), (None, False)]


def test_only_possible_members_are_shuffled(spark, skewed, monkeypatch):
    many, lookup = skewed
    keys = stage(lookup.filter("k % 50 = 7").select("k"), "keys")
    small, large = (member_flag(many, keys, ["k"], "hit", broadcast_bytes=b) for b in (1 << 30, 0))
    totals = [F.count(F.lit(1)), F.count_if("hit"), F.sum(F.when(F.col("hit"), F.col("k"))), F.count_if(F.col("k").isNull() & F.col("hit"))]
    counts = [df.agg(*totals).first() for df in (small, large)]
    assert counts[0] == counts[1] and counts[0][0] == 300_000 and counts[0][3] == 0
    words = key_filter(keys, ["k"])
    possible = possible_members(many, words, ["k"], "possible")
    assert possible.join(keys, "k", "left_semi").filter(~F.col("possible")).isEmpty()
    assert possible.filter("possible").count() < counts[0][1] * 1.01 + 100
    # The filter stands below the exchange of the rows.
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "_bits" in plan.split("Exchange hashpartitioning(k", 1)[1]
    # A crowded filter lets more rows through and changes no flag.
    monkeypatch.setattr(joins, "FILTER_BITS", 128)
    assert key_filter(keys, ["k"]).count() == 2
    assert member_flag(many, keys, ["k"], "hit", broadcast_bytes=0).agg(*totals).first() == counts[0]


def test_two_key_columns_and_no_keys(spark):
    many = stage(spark.createDataFrame([(1, "a", 0), (1, None, 1), (2, "a", 2)], "k int, t string, n int"), "many")
    keys = stage(spark.createDataFrame([(1, "a")], "k int, t string"), "keys")
    flag = lambda ks: values(member_flag(many.drop("n"), ks, ["k", "t"], "hit", broadcast_bytes=0))
    assert flag(keys) == [(1, "a", True), (1, None, False), (2, "a", False)]
    assert flag(stage(keys.limit(0), "none")) == [(1, "a", False), (1, None, False), (2, "a", False)]


def test_latest_limits_groups_before_the_shuffle(skewed):
    many, _ = skewed
    plan = latest_per_key(many, ["k"], [F.desc_nulls_first("text")])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_rows_are_marked_by_place(spark, skewed):
    many, lookup = skewed
    keys = stage(lookup.filter("k % 50 = 7").select("k"), "keys")
    size = stored_bytes(keys) * UNPACKED - 1
    assert joins.marks_fit(many, size) and not joins.marks_fit(many, 1000) and not joins.marks_fit(many, 0)
    flagged = member_flag(many, keys, ["k"], "hit", broadcast_bytes=size)
    # Wide rows meet the marks where they are read: nothing of them is sent.
    assert "Exchange hashpartitioning" not in flagged._jdf.queryExecution().executedPlan().toString()
    counts = flagged.groupBy("k", "hit").count()
    assert counts.exceptAll(member_flag(many, keys, ["k"], "hit").groupBy("k", "hit").count()).isEmpty()
    assert flagged.count() == 300_000 and flagged.filter("hit").count() == many.join(keys, "k", "left_semi").count()
    # Filters above the scan leave the places of the rows as they are.
    assert flagged.filter("k = 7 and not hit").isEmpty() and flagged.filter("k = 8 and hit").isEmpty()
    assert not joins.marks_fit(spark.range(3).toDF("k"))


def test_lookup_of_middling_size_sorts_nothing(skewed):
    many, lookup = skewed
    limit = stored_bytes(lookup) * UNPACKED // 2
    joined = lookup_join(many, lookup, ["k"], "left", broadcast_bytes=limit)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("ShuffledHashJoin", "")
    totals = [F.count(F.lit(1)), F.count("v"), F.sum("v")]
    assert joined.agg(*totals).first() == lookup_join(many, lookup, ["k"], "left").agg(*totals).first()


def test_known_rows_stay_where_they_are(skewed):
    many, _ = skewed
    lookup = stage(many.select("k").distinct().filter("k != 8"), "lookup")
    small, large = (with_known(many, lookup, ["k"], broadcast_bytes=b) for b in (1 << 30, stored_bytes(lookup) * UNPACKED - 1))
    assert values(small.groupBy("k").count()) == values(large.groupBy("k").count())
    assert large.filter("k = 8 or k is null").isEmpty() and not large.isEmpty()
    none = stage(lookup.filter("k is null"), "none")
    assert with_known(many, none, ["k"], broadcast_bytes=0).isEmpty()
