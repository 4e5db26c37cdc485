"""Session settings, the per-run context and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The JVM never compiles a method above this many bytes of bytecode.
METHOD_SETTING, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def compiled(spark: SparkSession) -> SparkSession:
    """The session, in which wide rows take code per operator that the JVM compiles, not one method that it interprets.

    A limit that the session sets itself stays.
    """
    if spark.conf.get(METHOD_SETTING, None) is None:
        spark.conf.set(METHOD_SETTING, METHOD_BYTES)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitter's settings apply instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fleetpulse")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # A small file is read in as many splits as there are cores.
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.sql.files.minPartitionNum", str(cores))
        .config(METHOD_SETTING, METHOD_BYTES)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class RunContext:
    """What a run stamps on the rows it writes. One value per run, like a transaction's clock."""

    as_of: datetime
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    user: str = "pipeline"

    @classmethod
    def now(cls, user: str = "pipeline") -> RunContext:
        return cls(datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0), user=user)

    @property
    def time(self) -> Column:
        return timestamp(self.as_of)


def timestamp(value: datetime) -> Column:
    """UTC wall-clock literal, independent of the session's and the driver's time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the shared one the cluster names.

    Only a local session may fall back to a temporary folder, which is then also made the
    session's checkpoint folder; executors of a cluster could not read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="fleetpulse-")
        spark.conf.set("spark.checkpoint.dir", shared)
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and leaves a table whose row count and
    size are known from file footers, so later joins can choose by real size.
    """
    path = f"{work_dir(df.sparkSession)}/fleetpulse/{uuid.uuid4().hex}/{name}"
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
