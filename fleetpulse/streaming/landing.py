"""Load extract files as they arrive: the batch load, driven by a file stream.

The pipeline itself is batch work; there is no event time, window or state here. The
stream only remembers which files were loaded.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.plans.load import Layout, load_and_promote
from fleetpulse.schema import EXTRACT, struct_type
from fleetpulse.session import RunContext
from fleetpulse.sources.extract import EXTRACT_CSV
from fleetpulse.sources.months import read_if_exists


def load_new_files(spark: SparkSession, inbox: str, layout: Layout, ctx: RunContext, **options) -> None:
    """Load every file of a folder not loaded before, then stop.

    All files that wait when the call starts are one load with its own run id, so what is
    quarantined does not depend on how they are dealt out. A finished load is noted, so a
    micro-batch replayed after a failure is not loaded twice; one that failed half-way is
    loaded again, which the curated tables absorb. ``ctx.run_id`` must therefore stay the
    same for one inbox.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run = replace(ctx, run_id=f"{ctx.run_id}-{batch_id}")
        if not _finished(spark, layout, run.run_id):
            load_and_promote(batch, layout, run, **options)
            _mark(spark, layout, run)

    stream = (
        spark.readStream.options(**EXTRACT_CSV)
        .schema(struct_type(EXTRACT))
        .csv(inbox)
    )
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", layout.path("_loaded_files"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _finished(spark: SparkSession, layout: Layout, run_id: str) -> bool:
    done = read_if_exists(spark, layout.path("finished_loads"))
    return done is not None and not done.filter(done.run_id == run_id).isEmpty()


def _mark(spark: SparkSession, layout: Layout, run: RunContext) -> None:
    spark.createDataFrame([(run.run_id, run.as_of)], "run_id string, loaded_at timestamp_ntz").write.mode("append").parquet(
        layout.path("finished_loads")
    )
