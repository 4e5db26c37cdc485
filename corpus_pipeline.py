"""From raw documents to training shards: judge, deduplicate, decontaminate, mix, shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import decontaminate, mixing, quality, sharding, simhash
from fleetpulse.llm.frames import table
from fleetpulse.session import stage

TEXT, LENGTH = "text", "n_chars"


def _length(docs: DataFrame) -> str | None:
    return LENGTH if LENGTH in docs.columns else None


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, unchanged."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).filter("predicted = 1").select("doc.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, unchanged."""
    return simhash.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, without the few words that lie in its passages."""
    marked = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.decontaminated(marked, TEXT, _length(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last copy perhaps in part."""
    return mixing.copies(mixing.mix(docs), TEXT, _length(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot in it."""
    dealt = sharding.shard_by_bytes(docs)
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return dealt.select(*own, "shard", "slot")


STAGES = [
    ("quality", judge),
    ("near_duplicates", deduplicate),
    ("decontamination", clean),
    ("mixing", mix),
    ("sharding", shard),
]

# The classifier's scores have no SQL; the stages are tested one by one in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored and read back by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
