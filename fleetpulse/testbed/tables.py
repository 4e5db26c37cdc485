"""The pipeline's tables derived from one folder of test tables.

``bed(spark, sf_dir)`` gives the tables of a folder. The ones the pipeline stores are
built when first asked for, written once to the shared work folder and read from there
by every later query of the session, as in production.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators import dimensions as dims
from fleetpulse.operators import features, quality
from fleetpulse.operators.joins import lookup_join
from fleetpulse.operators.scoring import prediction_rows
from fleetpulse.schema import EXTRACT, typed
from fleetpulse.session import RunContext, compiled, stage, work_dir
from fleetpulse.sources import months
from fleetpulse.testbed import mapping


class Bed:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.ctx = RunContext(mapping.AS_OF, run_id="bed", user="pipeline")
        self.root = f"{work_dir(spark)}/fleetpulse/{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def extract(self) -> DataFrame:
        """The 49-column extract, typed."""
        # Orders take their customer first: there are fewer of them than rows of the extract.
        orders = self.source("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.source("customer").withColumn("o_custkey", F.col("c_custkey"))
        owned = lookup_join(orders, customer, ["o_custkey"])
        rows = lookup_join(self.source("lineitem"), owned.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"])
        for table, key, foreign in (("part", "p_partkey", "l_partkey"), ("supplier", "s_suppkey", "l_suppkey")):
            side = self.source(table).withColumn(foreign, F.col(key))
            rows = lookup_join(rows, side, [foreign])
        mapped = rows.select(*[F.expr(sql).alias(name) for name, sql in mapping.EXPRESSIONS.items()])
        return mapped.select(*typed(EXTRACT))

    @cached_property
    def landed(self) -> DataFrame:
        """The extract stored, as a load lands it: the repeated ids and the tags each read it."""
        return stage(self.extract, "extract")

    @cached_property
    def staging(self) -> DataFrame:
        """The landed extract with the rules each row breaks."""
        return quality.readable_tags(self.landed, quality.RULES)

    def split(self, only: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        return quality.split(self.staging, quality.quarantining(quality.RULES, only=only), self.ctx)

    @property
    def good(self) -> DataFrame:
        return self.split()[0]

    @cached_property
    def dim_aircraft(self) -> DataFrame:
        return stage(dims.aircraft_rows(self.good), "dim_aircraft")

    @cached_property
    def dim_component(self) -> DataFrame:
        return stage(dims.component_rows(self.good), "dim_component")

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return stage(dims.supplier_rows(self.good), "dim_supplier")

    @cached_property
    def fact_path(self) -> str:
        path = f"{self.root}/fact"
        routed = months.route(dims.fact_rows(self.good), "snapshot_date", mapping.SPINE_START, mapping.SPINE_END)
        months.write_months(routed, path, sort=["component_serial_number", "snapshot_date"])
        return path

    @property
    def fact(self) -> DataFrame:
        return months.read_months(self.spark, self.fact_path)

    def build_features(self, **options) -> DataFrame:
        return features.build_features(
            self.fact, self.dim_component, self.dim_aircraft, self.dim_supplier, self.ctx, **options
        )

    @cached_property
    def feature_store(self) -> features.StoredFeatures:
        return features.save_features(
            self.build_features(), f"{self.root}/store", start=mapping.SPINE_START, end=mapping.SPINE_END
        )

    @property
    def features(self) -> DataFrame:
        return self.feature_store.table

    def scored(self, run: str) -> RunContext:
        return RunContext(mapping.RUNS[run], run_id=run, user="pipeline")

    @property
    def predictions(self) -> DataFrame:
        """Scoring runs of a stand-in model over the snapshots."""
        runs = [
            prediction_rows(
                self.fact.withColumns({name: F.expr(sql) for name, sql in outputs.items()}), self.scored(run),
                version=mapping.VERSIONS[run],
            )
            for run, outputs in mapping.OUTPUTS.items()
        ]
        return reduce(DataFrame.unionByName, runs)


_beds: dict[tuple[str, str], Bed] = {}


def bed(spark: SparkSession, sf_dir: str) -> Bed:
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _beds:
        _beds[key] = Bed(compiled(spark), str(sf_dir))
    return _beds[key]

