"""Feature build, the rolling cohort rate and the temporal split."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetpulse.functions import ratio, recency, weighted_sum
from fleetpulse.operators.joins import lookup_join, with_known
from fleetpulse.schema import FEATURES, typed
from fleetpulse.session import RunContext, stage
from fleetpulse.sources import months

# Sensor weights, decay and window of feature version v1.
SENSOR_WEIGHTS = {
    "sensor_vibration_index": "0.40",
    "sensor_oil_debris_index": "0.35",
    "anomaly_count_last_30_days": "0.25",
}
DECAY_DAYS = 90
WINDOW_DAYS = 30
VERSION = "v1"

RATE = "rolling_30d_component_type_failure_rate"


def cohort_days(df: DataFrame, cohort: str, day: str, label: str) -> DataFrame:
    """One row per cohort and day: the sum of the label and how many rows have one.

    Sums of disjoint sets of rows can be added up, so a stored table of them is kept by
    replacing the days that changed.
    """
    return df.groupBy(cohort, day).agg(
        F.sum(F.col(label).cast("bigint")).alias("positives"), F.count(label).alias("labelled")
    )


def rate_of_days(days: DataFrame, cohort: str, day: str, window_days: int = WINDOW_DAYS, lagged: bool = False) -> DataFrame:
    """The rolling rate from ``cohort_days``, one row per cohort and day."""
    frame = W.partitionBy(cohort).orderBy(F.unix_date(day)).rangeBetween(-window_days, -1 if lagged else 0)
    positives, labelled = F.sum("positives").over(frame), F.sum("labelled").over(frame)
    return days.select(cohort, day, ratio(positives, labelled, 4).cast("decimal(6,4)").alias(RATE))


def rolling_rate(
    df: DataFrame, cohort: str, day: str, label: str, window_days: int = WINDOW_DAYS, lagged: bool = False
) -> DataFrame:
    """Mean label per cohort over the window ending at each of the cohort's days.

    One row per (cohort, day). The rows are first reduced to a sum and a count per day,
    which combines map-side, so the window afterwards sees at most one row per calendar
    day and cohort however large the cohort is. ``lagged`` ends the window the day before,
    so a row's own label is not part of its feature.
    """
    return rate_of_days(cohort_days(df, cohort, day, label), cohort, day, window_days, lagged)


def rolling_rate_direct(
    df: DataFrame, cohort: str, day: str, label: str, window_days: int = WINDOW_DAYS
) -> DataFrame:
    """The same rate as one window over all rows: as many tasks as cohorts. For comparison."""
    frame = W.partitionBy(cohort).orderBy(F.unix_date(day)).rangeBetween(-window_days, 0)
    value = F.col(label).cast("bigint")
    return df.withColumn(RATE, ratio(F.sum(value).over(frame), F.count(value).over(frame), 4).cast("decimal(6,4)"))


def derived(weights: dict[str, str] = SENSOR_WEIGHTS, decay_days: int = DECAY_DAYS) -> dict[str, Column]:
    """The engineered columns that need one row only."""
    hours = F.col("cumulative_flight_hours")
    return {
        "pct_of_design_life_consumed": ratio(hours, F.col("design_mtbf_hours"), 4),
        "hours_per_cycle": ratio(hours, F.col("cumulative_flight_cycles"), 3),
        "unscheduled_removal_ratio": ratio(
            F.col("prior_unscheduled_removal_count"), F.col("prior_removal_count"), 4
        ),
        "sensor_composite_risk_score": weighted_sum(weights, 4),
        "maintenance_recency_score": recency(F.col("days_since_last_maintenance_event"), decay_days, 4),
    }


def build_features(
    fact: DataFrame,
    component: DataFrame,
    aircraft: DataFrame,
    supplier: DataFrame,
    ctx: RunContext,
    *,
    window_days: int = WINDOW_DAYS,
    weights: dict[str, str] = SENSOR_WEIGHTS,
    decay_days: int = DECAY_DAYS,
    lagged: bool = False,
    version: str = VERSION,
    days: DataFrame | None = None,
    **strategy,
) -> DataFrame:
    """Model-ready rows: the fact with its component, aircraft and supplier attributes.

    The dimensions are stored tables with one row per key. Supplier scores are attached to
    the component dimension, not to the fact, so the fact takes three lookups: component,
    aircraft and the daily cohort rate. ``days`` is the stored table of ``cohort_days`` of
    the component types, if there is one; without it the fact is read once more for the rate.
    """
    parts = stage(
        lookup_join(
            component.select("component_serial_number", "component_type", "design_mtbf_hours", "supplier_id"),
            supplier.select("supplier_id", "supplier_quality_score"),
            ["supplier_id"],
            "left",
            **strategy,
        ).drop("supplier_id"),
        "component_with_supplier",
    )
    fleet = aircraft.select(
        "aircraft_tail_number", "fleet_type", "operating_environment", "aircraft_age_years",
        "avg_daily_utilization_hours",
    )
    joined = lookup_join(fact, parts, ["component_serial_number"], **strategy)
    joined = lookup_join(joined, fleet, ["aircraft_tail_number"], **strategy)
    cohort = ("component_type", "snapshot_date")
    if days is None:
        # The rate needs no attribute of the aircraft, only that there is one.
        labels = with_known(
            fact.select("component_serial_number", "aircraft_tail_number", "snapshot_date", "failure_within_90_days"),
            fleet, ["aircraft_tail_number"], **strategy,
        )
        kinds = parts.select("component_serial_number", "component_type")
        days = cohort_days(lookup_join(labels, kinds, ["component_serial_number"], **strategy), *cohort, "failure_within_90_days")
    rates = stage(rate_of_days(days, *cohort, window_days, lagged), "cohort_rates")
    rated = lookup_join(joined, rates, ["component_type", "snapshot_date"], "left", **strategy)
    return rated.withColumns(derived(weights, decay_days)).select(
        *typed(FEATURES), F.lit(version).alias("feature_version"), ctx.time.alias("computed_at")
    )


# A row of a version's manifest: a month partition, its rows and days, and the folder that holds the version's data.
MANIFEST = "partition_name string, rows bigint, first_day date, last_day date, folder string"

STORED = ", ".join(
    f"`{name}` {kind}"
    for name, kind in [*FEATURES, ("feature_version", "string"), ("computed_at", "timestamp_ntz"), (months.PARTITION, "string")]
)


@dataclass(frozen=True)
class StoredFeatures:
    """A feature version in force: its rows by month, and the days that each month covers, known from its manifest."""

    rows: DataFrame
    days: dict[str, tuple[date, date]]

    @property
    def table(self) -> DataFrame:
        return self.rows.drop(months.PARTITION)

    @property
    def newest(self) -> date | None:
        return max((last for _, last in self.days.values()), default=None)

    def dated(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Rows dated first..last, both included; reads the months only that hold such days."""
        named = [n for n, (lo, hi) in self.days.items() if (last is None or lo <= last) and (first is None or hi >= first)]
        rows = self.rows.filter(F.col(months.PARTITION).isin(named)).filter(F.col("snapshot_date").isNotNull())
        if first is not None:
            rows = rows.filter(F.col("snapshot_date") >= F.lit(first))
        if last is not None:
            rows = rows.filter(F.col("snapshot_date") <= F.lit(last))
        return rows.drop(months.PARTITION)

    def split(self, valid_days: int = 120, test_days: int = 60, end: date | None = None) -> dict[str, DataFrame]:
        """As ``temporal_split``, by partitions: no scan for the newest day, and each part reads its own months."""
        end = end or self.newest
        if end is None:
            return {name: self.table.limit(0) for name in ("train", "validation", "test")}
        first, last, day = end - timedelta(days=valid_days), end - timedelta(days=test_days), timedelta(days=1)
        return {"train": self.dated(last=first - day), "validation": self.dated(first, last), "test": self.dated(last + day)}


def save_features(
    features: DataFrame, root: str, version: str = VERSION, start: date = months.SPINE_START, end: date = months.SPINE_END
) -> StoredFeatures:
    """Replace one feature version; other versions stay as they are.

    The rows go to a folder of their own, partitioned by the months of the spine. The manifest,
    written after them, puts the folder in force, so a writer lost half-way leaves the old
    rows in force. The folder before is kept for readers that are still on it.
    """
    spark, path = features.sparkSession, f"{root}/features_{version}"
    folder = f"data-{uuid.uuid4().hex}"
    months.write_months(months.route(features, "snapshot_date", start, end), f"{path}/{folder}", sort=["component_serial_number", "snapshot_date"])
    before = months.read_version(spark, f"{path}/manifest")
    kept = {folder} | ({r.folder for r in before.select("folder").distinct().collect()} if before is not None else set())
    written = spark.read.schema(f"snapshot_date date, {months.PARTITION} string").parquet(f"{path}/{folder}")
    covered = written.groupBy(months.PARTITION).agg(
        F.count(F.lit(1)).alias("rows"), F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day")
    )
    # One row per month; a version without rows has a manifest too, of one row without a month.
    rows = [(*r, folder) for r in covered.collect()] or [(None, 0, None, None, folder)]
    months.write_version(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{path}/manifest")
    months.drop_folders(spark, path, "data-", kept)
    return read_features(spark, root, version)


def read_features(spark: SparkSession, root: str, version: str = VERSION) -> StoredFeatures:
    """The version in force. Only the manifest, one row per month, is read here."""
    path = f"{root}/features_{version}"
    manifest = months.read_version(spark, f"{path}/manifest")
    if manifest is None:
        raise FileNotFoundError(f"no features of version {version} at {root}; refresh_features builds them")
    covered = manifest.collect()
    days = {r.partition_name: (r.first_day, r.last_day) for r in covered if r.first_day is not None}
    return StoredFeatures(spark.read.schema(STORED).parquet(f"{path}/{covered[0].folder}"), days)


def latest_day(df: DataFrame, day: str) -> date | None:
    """The newest date, as a value: a literal prunes files and partitions, a subquery cannot."""
    return df.agg(F.max(day)).first()[0]


def temporal_split(
    df: DataFrame, day: str = "snapshot_date", valid_days: int = 120, test_days: int = 60, end: date | None = None
) -> dict[str, DataFrame]:
    """train, validation and test by date, measured back from the newest day.

    Disjoint, and together all rows with a date. Both limits belong to validation.
    """
    end = end or latest_day(df, day)
    if end is None:
        return {name: df.limit(0) for name in ("train", "validation", "test")}
    first, last = F.lit(end - timedelta(days=valid_days)), F.lit(end - timedelta(days=test_days))
    return {
        "train": df.filter(F.col(day) < first),
        "validation": df.filter(F.col(day).between(first, last)),
        "test": df.filter(F.col(day) > last),
    }

