"""Gapless ids for the rows of a run, counted on from a stored high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.session import RunContext, stage
from fleetpulse.sources import months

# monotonically_increasing_id holds the partition above these bits and the place in it below.
PLACE_BITS = 33

MARKS = "run_id string, first bigint, rows bigint, digest decimal(38,0)"


def allocate(rows: DataFrame, order: list[str], path: str, ctx: RunContext, column: str = "id") -> DataFrame:
    """The rows with ids that follow those of earlier runs, gapless within the run, in the order of ``order``.

    Rows are sorted by range; only the number of rows of each range is summed up in one place.
    Rows that tie in ``order`` are told apart by a hash of all their columns, and rows that
    are equal altogether are interchangeable. A run's first id and its rows' checksum are
    kept at ``path`` before any id is given out, so a repeated run gives the same rows the
    same ids; with other rows it is refused. Runs of one ``path`` must not overlap, as with the other tables. No
    rows leave the mark where it is.
    """
    spark = rows.sparkSession
    keys = [F.col(f"_k{i}") for i in range(len(order))] + [F.col("_tie")]
    packed = rows.select(
        F.struct(*rows.columns).alias("_row"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)],
        F.xxhash64(*rows.columns).alias("_tie"),
    )
    ranged = packed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Places hold once they are stored.
    ranged = stage(ranged.select("_row", "_tie", F.monotonically_increasing_id().alias("_at")), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", PLACE_BITS))
    totals = stage(
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_tie").cast("decimal(38,0)")).alias("digest")), "range_totals"
    )
    count, digest = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("digest").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))).first()
    first = _reserve(spark, path, ctx, count, digest)
    # One row per range, so one task and a broadcast are enough.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + first).alias("_start"))
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return ranged.join(F.broadcast(starts), "_part").select("_row.*", (F.col("_start") + place).alias(column))


def _reserve(spark, path: str, ctx: RunContext, count: int, digest) -> int:
    """First id of the run: the one kept of it, else the next free one, which is then kept."""
    marks = months.read_version(spark, path)
    own = None if marks is None else marks.filter(F.col("run_id") == ctx.run_id).first()
    if own is not None:
        if (own.rows, own.digest) != (count, digest):
            raise ValueError(f"run {ctx.run_id} got its ids for {own.rows} rows; it is repeated with {count} or with other ones")
        return own.first
    first = 1 if marks is None else marks.agg(F.max(F.col("first") + F.col("rows"))).first()[0]
    mark = spark.createDataFrame([(ctx.run_id, first, count, digest)], MARKS)
    months.write_version(mark if marks is None else marks.unionByName(mark), path)
    return first
