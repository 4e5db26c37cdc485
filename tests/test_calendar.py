from datetime import datetime, timedelta

import pytest

from fleetpulse.plans import calendar
from fleetpulse.plans.load import Layout
from fleetpulse.session import RunContext


def test_due_times_are_those_of_a_plain_walk(spark):
    since, now = datetime(2024, 1, 31, 2, 30), datetime(2024, 3, 4, 3, 0)
    want, hour = [], datetime(2024, 1, 31)
    while hour <= now:
        if hour >= since:
            want += [("monthly", hour)] * (hour.day == 1 and hour.hour == 1) + [("nightly", hour)] * (hour.hour == 2)
            want += [("weekly", hour)] * (hour.weekday() == 0 and hour.hour == 3)
        hour += timedelta(hours=1)
    assert sorted(map(tuple, calendar.due_times(spark, since, now).collect())) == sorted(want)
    assert calendar.due_times(spark, now, since).collect() == []


def test_missed_runs_are_made_in_order_each_once(spark, tmp_path):
    made, broken = [], {datetime(2024, 3, 1, 2)}

    def job(name):
        def make(spark, layout, ctx):
            if ctx.as_of in broken:
                raise RuntimeError("lost")
            made.append((name, ctx.as_of, ctx.run_id))
        return make

    jobs = [
        calendar.Job("monthly", "month", timedelta(hours=2), job("monthly")),
        calendar.Job("nightly", "day", timedelta(hours=2), job("nightly")),
    ]
    layout, since = Layout(str(tmp_path)), datetime(2024, 2, 28)
    now = RunContext(datetime(2024, 3, 2, 12))
    with pytest.raises(RuntimeError, match="lost"):
        calendar.catch_up(spark, layout, since, now, jobs)
    assert [m[:2] for m in made] == [("nightly", datetime(2024, 2, 28, 2)), ("nightly", datetime(2024, 2, 29, 2))]
    broken.clear()
    assert calendar.catch_up(spark, layout, since, now, jobs) == [
        ("monthly", datetime(2024, 3, 1, 2)), ("nightly", datetime(2024, 3, 1, 2)), ("nightly", datetime(2024, 3, 2, 2))
    ]
    assert len(made) == len(set(made)) == 5
    assert calendar.catch_up(spark, layout, since, now, jobs) == []


def test_unknown_interval_is_refused():
    with pytest.raises(ValueError, match="every"):
        calendar.Job("x", "year", timedelta(), print)
