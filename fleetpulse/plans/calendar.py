"""Which runs of the recurring jobs are due, worked out from the log of those that were made."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.plans import jobs
from fleetpulse.plans.load import Layout
from fleetpulse.session import RunContext, timestamp
from fleetpulse.sources import extract, months


@dataclass(frozen=True)
class Job:
    """A job that is due once every day, week (on Monday) or month (on its first day), at a time of day."""

    name: str
    every: str
    at: timedelta
    run: Callable[[SparkSession, Layout, RunContext], object]

    def __post_init__(self):
        if self.every not in ("day", "week", "month"):
            raise ValueError(f"a job is due every day, week or month, not every {self.every}")


# In the order in which runs of one time are made: a month is opened before it is read.
JOBS = [
    Job("monthly", "month", timedelta(hours=1), jobs.run_monthly),
    Job("nightly", "day", timedelta(hours=2), jobs.run_nightly),
    Job("weekly", "week", timedelta(hours=3), jobs.run_weekly),
]

LOG = "job string, due_at timestamp_ntz"


def due_times(spark: SparkSession, since: datetime, now: datetime, calendar: list[Job] = JOBS) -> DataFrame:
    """(job, due_at) of every run due from ``since`` to ``now``, both included."""
    if since > now:
        return spark.createDataFrame([], LOG)

    def of(job: Job) -> DataFrame:
        first = F.date_trunc(job.every, timestamp(since)).cast("timestamp_ntz")
        days = spark.range(1).select(F.explode(F.sequence(first, timestamp(now), F.expr(f"interval 1 {job.every}"))).alias("day"))
        due = days.select(F.lit(job.name).alias("job"), (F.col("day") + F.lit(job.at)).cast("timestamp_ntz").alias("due_at"))
        return due.filter(F.col("due_at").between(timestamp(since), timestamp(now)))

    return reduce(DataFrame.unionByName, map(of, calendar))


def missed(made: DataFrame | None, since: datetime, now: datetime, spark: SparkSession, calendar: list[Job] = JOBS) -> DataFrame:
    """(job, due_at) of the due runs that are not among those made."""
    due = due_times(spark, since, now, calendar)
    return due if made is None else due.join(made.select("job", "due_at").distinct(), ["job", "due_at"], "left_anti")


def catch_up(spark: SparkSession, layout: Layout, since: datetime, ctx: RunContext, calendar: list[Job] = JOBS) -> list[tuple[str, datetime]]:
    """Make every missed run up to the time of ``ctx``, oldest first, each once and as of the time it was due.

    A run is noted in the job log after it has been made. Its id comes from its job and time,
    so one that broke off is made again by the next call and replaces its own log rows. An
    error stops the call; runs noted before it are not repeated. Returns the runs made.
    """
    log = layout.path("job_log")
    made = months.read_if_exists(spark, log)
    rank = {job.name: i for i, job in enumerate(calendar)}
    # One row per run: a few for each day of the gap.
    gap = missed(None if made is None else extract.read_log(spark, log), since, ctx.as_of, spark, calendar).collect()
    runs = sorted(((r.due_at, rank[r.job]) for r in gap))
    for due_at, i in runs:
        job = calendar[i]
        run = RunContext(due_at, run_id=f"{job.name}-{due_at:%Y%m%dT%H%M}", user=ctx.user)
        job.run(spark, layout, run)
        extract.write_log(spark.createDataFrame([(job.name, due_at)], LOG).withColumn("made_at", ctx.time), log, run)
    return [(calendar[i].name, due_at) for due_at, i in runs]
