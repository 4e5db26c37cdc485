"""What the corpus operators share: packed rows, lineage cuts, global running sums, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.session import stage, work_dir

# A side of a join is broadcast only if its counted rows times their stated width stay below this.
BROADCAST_BYTES = 32 * 1024 * 1024
# What Spark hands to a Python worker at once, so that long texts do not fill it.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(rows: DataFrame) -> DataFrame:
    """Limit the Arrow batches of the session by their bytes, unless the session already does."""
    conf = rows.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return rows


def packed_columns(rows: DataFrame, carry: list[str] | None = None) -> Column:
    """The row (or its columns in ``carry``) as one struct ``doc``: no input column can clash with an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in (rows.columns if carry is None else carry)]).alias("doc")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder. For small tables inside loops."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession))
    return df.checkpoint()


def small_or_merge(side: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored table for broadcast if its counted size allows it, else for a sort-merge join.

    Adaptive execution splits a hot key of the other side of the merge join.
    """
    return F.broadcast(side) if side.count() * row_bytes <= limit else side.hint("merge")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def held_out(doc_id: str | Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3. Never null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def running(rows: DataFrame, order: list[Column], sums: list[str], name: str) -> tuple[DataFrame, dict[str, int]]:
    """Number all rows in a global order and add what the rows before each one sum up to.

    Rows are dealt into sorted ranges, each task keeps its own running sums, and the driver
    adds up one total per range. The result is stored with ``row`` (from 0) and
    ``<sum>_before``; the second value holds the grand totals and ``rows``. Ties are broken
    by place in the input, which also splits a key that many rows share over several ranges.
    """
    spark = rows.sparkSession
    ranged = (
        small_batches(rows).withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, F.col("_tie"))
        .sortWithinPartitions(*order, "_tie")
        .withColumn("_range", F.spark_partition_id())
    )
    added = ["row", *(f"{s}_before" for s in sums)]
    schema = T.StructType([*ranged.schema.fields, *(T.StructField(f"_{a}", T.LongType()) for a in added)])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, so_far = 0, dict.fromkeys(sums, 0)
        for batch in batches:
            columns, names = list(batch.columns), list(batch.schema.names)
            columns.append(pa.array(range(seen, seen + batch.num_rows), pa.int64()))
            seen += batch.num_rows
            for s in sums:
                value = batch.column(names.index(s)).cast(pa.int64())
                through = pc.add(pc.cumulative_sum(value), so_far[s])
                columns.append(pc.subtract(through, value))
                so_far[s] = through[-1].as_py() if batch.num_rows else so_far[s]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f"_{a}" for a in added)])

    stored = stage(ranged.mapInArrow(local, schema), name)
    totals = stored.groupBy("_range").agg(
        F.count("*").alias("rows"), *[F.sum(s).cast("long").alias(s) for s in sums]
    ).collect()  # one row per range
    offsets, so_far = [], dict.fromkeys(["rows", *sums], 0)
    for total in sorted(totals, key=lambda t: t["_range"]):
        offsets.append((total["_range"], *so_far.values()))
        so_far = {k: v + total[k] for k, v in so_far.items()}
    starts = spark.createDataFrame(offsets, "_range int, " + ", ".join(f"_o{i} long" for i in range(len(added))))
    numbered = stored.join(F.broadcast(starts), "_range").select(
        *[c for c in rows.columns], *[(F.col(f"_{a}") + F.col(f"_o{i}")).alias(a) for i, a in enumerate(added)]
    )
    return numbered, so_far
