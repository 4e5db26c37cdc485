"""Month partitions of a dated table: spine, bounds, routing, pruned reads, merge, archive.

A partitioned table is a Parquet folder with one ``partition_name=`` directory per month
(``2023_06``) plus ``partition_name=default`` for dates outside the spine.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The months a new installation opens, end exclusive.
SPINE_START = date(2023, 6, 1)
SPINE_END = date(2025, 12, 1)

PARTITION = "partition_name"
DEFAULT = "default"


def month_name(day: Column) -> Column:
    return F.date_format(day, "yyyy_MM")


def month_spine(spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    """One row per month in [start, end): name, lower bound, upper bound (exclusive)."""
    return month_spine_of(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def month_spine_of(bounds: DataFrame) -> DataFrame:
    """As ``month_spine``, for a one-row frame of (start, end); no months if end <= start."""
    first, last = F.trunc("start", "MM"), F.trunc(F.date_sub("end", 1), "MM")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return partition_bounds(bounds.select(F.explode(months).alias("month")), "month")


def partition_bounds(df: DataFrame, day: str) -> DataFrame:
    """Name and half-open bounds of the month partition each day belongs to."""
    lo = F.trunc(day, "MM")
    return df.select(month_name(F.col(day)).alias(PARTITION), lo.alias("lo"), F.add_months(lo, 1).alias("hi"))


def route(df: DataFrame, day: str, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    """Add the partition a row goes to; a NULL date goes to the default partition too."""
    inside = (F.col(day) >= F.trunc(F.lit(start), "MM")) & (F.col(day) < F.lit(end))
    return df.withColumn(PARTITION, F.when(inside, month_name(F.col(day))).otherwise(DEFAULT))


def write_months(df: DataFrame, path: str, mode: str = "overwrite", sort: list[str] | None = None) -> None:
    """Write a routed table. Overwrite replaces only the partitions present in ``df``.

    Rebalancing by partition gives a small month one file and splits a huge one into
    many tasks by measured size, whatever its keys are. Sorting inside the files lets
    Parquet statistics prune on the sort columns.
    """
    (
        df.hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, *(sort or []))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Read a month-partitioned table, only the named partitions if given."""
    df = spark.read.parquet(path)
    return df if names is None else df.filter(F.col(PARTITION).isin(names))


def between_days(df: DataFrame, day: str, first: date, last: date) -> DataFrame:
    """Rows dated first..last of a month-partitioned table, reading only those months.

    A filter on the date alone cannot prune directories named by month.
    """
    months = [f"{n // 12}_{n % 12 + 1:02d}" for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    return df.filter(F.col(PARTITION).isin(months + [DEFAULT]) & F.col(day).between(F.lit(first), F.lit(last)))


def partition_names(df: DataFrame) -> list[str]:
    """Partitions present in a routed batch. At most one per month of its span."""
    return sorted(row[0] for row in df.select(PARTITION).distinct().collect())


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None if nothing was ever written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def archive_month(spark: SparkSession, path: str, archive_path: str, name: str, drop: bool = False) -> DataFrame:
    """Copy one month to the archive and return the archived rows.

    The copy is written aside, read back and compared by count and checksum before it takes
    the archive's place. Rows already archived are kept: late rows of a month that was
    dropped before are added to them, and a month without live rows leaves its archive as
    it is. With ``drop`` the month's directory is then removed from the live table.
    """
    target, aside = f"{archive_path}/{PARTITION}={name}", f"{archive_path}/_writing-{name}-{uuid.uuid4().hex}"
    live, kept = read_months(spark, path, [name]).drop(PARTITION), read_if_exists(spark, target)
    if live.isEmpty():
        if kept is None:
            raise ValueError(f"{name} has no rows to archive")
        return kept.withColumn(PARTITION, F.lit(name))
    # Rows that an earlier call copied but did not drop are in both places.
    whole = live if kept is None else kept.unionByName(live.exceptAll(kept))
    wanted = _fingerprint(whole)
    whole.write.parquet(aside)
    if _fingerprint(spark.read.parquet(aside)) != wanted:
        raise RuntimeError(f"archive of {name} is incomplete, live partition kept")
    _move(spark, aside, target)
    if drop:
        drop_partition(spark, path, name)
    return spark.read.parquet(target).withColumn(PARTITION, F.lit(name))


def _fingerprint(df: DataFrame) -> tuple:
    """Rows and a checksum that does not depend on their order."""
    columns = [F.col(c) for c in sorted(df.columns)]
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first())


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a complete folder in the place of another."""
    new, files = _folder(spark, source)
    old = _folder(spark, target)[0]
    before = _folder(spark, f"{target.rpartition('/')[0]}/_before-{uuid.uuid4().hex}")[0]
    replaced = files.exists(old) and files.rename(old, before)
    if not files.rename(new, old):
        raise RuntimeError(f"{source} could not be moved to {target}")
    if replaced:
        files.delete(before, True)


def drop_partition(spark: SparkSession, path: str, name: str) -> None:
    """Remove one partition's directory from a table."""
    gone, files = _folder(spark, f"{path}/{PARTITION}={name}")
    files.delete(gone, True)


def drop_folders(spark: SparkSession, path: str, prefix: str, kept: set[str]) -> None:
    """Remove the folders at a path whose names begin with the prefix, but for those kept."""
    place, files = _folder(spark, path)
    for found in files.listStatus(place):
        name = found.getPath().getName()
        if name.startswith(prefix) and name not in kept:
            files.delete(found.getPath(), True)


# ---- tables that are replaced as a whole ----


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a table, oldest first. A version counts once Spark has marked it as written."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(n for n in names if n.startswith("v") and files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0]))


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a table, or None if there is none."""
    known = versions(spark, path)
    return spark.read.parquet(f"{path}/{known[-1]}") if known else None


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Replace a whole table and return it.

    The new version is a folder of its own beside the old one, so a writer lost half-way
    leaves the old version in force. The version before is kept, older ones are removed.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    name = f"v{int(known[-1][1:9]) + 1 if known else 1:08d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{name}")
    for old in known[:-1]:
        gone, files = _folder(spark, f"{path}/{old}")
        files.delete(gone, True)
    return spark.read.parquet(f"{path}/{name}")
