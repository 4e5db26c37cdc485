"""Declarative quality rules: one-pass counts, row tagging, quarantine, reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import exact_round, severity_rank, surrogate_key
from fleetpulse.operators.joins import marks_fit, member_flag
from fleetpulse.schema import LOG_DOMAINS, require
from fleetpulse.session import RunContext, stage, timestamp


@dataclass(frozen=True)
class Rule:
    """One catalog row. ``fails`` is a SQL predicate over a single row, TRUE = the row fails.

    A uniqueness rule names its key in ``unique`` instead; every copy of a repeated key
    fails, and a NULL key never does.
    """

    name: str
    category: str
    severity: str
    fails: str = ""
    unique: str = ""
    active: bool = True

    def __post_init__(self):
        require(self.category, LOG_DOMAINS["rule_category"], "category")
        require(self.severity, LOG_DOMAINS["rule_severity"], "severity")
        if bool(self.fails) == bool(self.unique):
            raise ValueError(f"rule {self.name} needs either a predicate or a unique key")


# The catalog's seven rules.
RULES = [
    Rule(
        "health_score_out_of_range", "Validity", "Critical",
        "health_monitoring_score IS NOT NULL AND (health_monitoring_score < 0 OR health_monitoring_score > 100)",
    ),
    Rule(
        "negative_usage_hours", "Validity", "Critical",
        "cumulative_flight_hours < 0 OR cumulative_flight_cycles < 0",
    ),
    Rule("missing_component_serial", "Completeness", "Critical", "component_serial_number IS NULL"),
    Rule("missing_aircraft_tail", "Completeness", "Critical", "aircraft_tail_number IS NULL"),
    Rule("duplicate_record_id", "Uniqueness", "Critical", unique="record_id"),
    Rule(
        "inconsistent_overhaul_hours", "Consistency", "Warning",
        "flight_hours_since_last_overhaul > cumulative_flight_hours",
    ),
    Rule(
        "failure_label_conflict", "Consistency", "Critical",
        "failure_within_30_days = 1 AND failure_within_90_days = 0",
    ),
]

# The key column of the fact may not be NULL, which the seven rules leave unchecked.
MISSING_RECORD_ID = Rule("missing_record_id", "Completeness", "Critical", "record_id IS NULL")

def catalog(spark: SparkSession, rules: list[Rule], target: str = "extract") -> DataFrame:
    """The rules as a table, to store, extend and switch on or off."""
    rows = [(r.name, r.category, target, r.fails or None, r.unique or None, r.severity, r.active) for r in rules]
    columns = (
        "rule_name string, rule_category string, target_table string, rule_sql string, unique_key string, "
        "severity string, is_active boolean"
    )
    return spark.createDataFrame(rows, columns).select(surrogate_key(F.col("rule_name")).alias("rule_id"), "*")


def read_rules(stored: DataFrame, target: str = "extract") -> list[Rule]:
    """The active rules of a catalog table for one target. A catalog is a few rows people write."""
    rows = stored.filter(F.col("is_active") & (F.col("target_table") == target)).orderBy("rule_name").collect()
    return [Rule(r.rule_name, r.rule_category, r.severity, r.rule_sql or "", r.unique_key or "") for r in rows]


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the number of copies. Counts combine map-side."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


_COUNTS = (
    "array<struct<rule_name: string, rule_category: string, severity: string, rows_checked: bigint, rows_failed: bigint>>"
)


def run_checks(df: DataFrame, rules: list[Rule], ctx: RunContext) -> DataFrame:
    """Count the failing rows of every active rule; one result row per rule.

    All row rules share one scan as conditional counts. A uniqueness rule adds a pass over
    its key column only.
    """
    active = [r for r in rules if r.active]
    counts = []
    row_rules = [r for r in active if r.fails]
    if row_rules:
        totals = df.agg(
            F.count(F.lit(1)).alias("rows_checked"),
            *[F.count_if(F.expr(r.fails)).alias(r.name) for r in row_rules],
        )
        counts.append(_unpivot(totals, row_rules))
    for rule in active:
        if rule.unique:
            copies = df.groupBy(rule.unique).agg(F.count(F.lit(1)).alias("n"))
            bad = (F.col("n") > 1) & F.col(rule.unique).isNotNull()
            totals = copies.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
                F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias(rule.name),
            )
            counts.append(_unpivot(totals, [rule]))
    if not counts:
        counts.append(_unpivot(df.agg(F.count(F.lit(1)).alias("rows_checked")), []))
    return _results(reduce(DataFrame.unionByName, counts), ctx)


def _results(counts: DataFrame, ctx: RunContext) -> DataFrame:
    checked, failed = F.col("rows_checked"), F.col("rows_failed")
    return counts.select(
        surrogate_key(F.col("rule_name"), F.lit(ctx.run_id)).alias("result_id"),
        "rule_name",
        "rule_category",
        "severity",
        "rows_checked",
        "rows_failed",
        exact_round(
            (checked - failed).cast("decimal(20,0)") * 100 / F.greatest(checked, F.lit(1)).cast("decimal(20,0)"),
            2, 5,
        ).alias("pass_rate_pct"),
        (failed == 0).alias("passed"),
        ctx.time.alias("run_at"),
    )


def results_of_tags(tagged: DataFrame, rules: list[Rule], ctx: RunContext) -> DataFrame:
    """As ``run_checks``, counted from the tags of ``tag_failures`` in one aggregation of the tagged rows."""
    active = [r for r in rules if r.active]
    totals = tagged.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(F.array_contains("failed_rules", r.name)).alias(r.name) for r in active],
    )
    return _results(_unpivot(totals, active), ctx)


def _unpivot(totals: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(r.name).alias("rule_name"),
            F.lit(r.category).alias("rule_category"),
            F.lit(r.severity).alias("severity"),
            F.col("rows_checked"),
            F.col(r.name).alias("rows_failed"),
        )
        for r in rules
    ]
    return totals.select(F.inline(F.array(*rows).cast(_COUNTS)))


def gate_passed(results: DataFrame) -> bool:
    """True if no Critical rule failed. Results hold one row per rule, so this is a small read."""
    return results.filter(~F.col("passed") & (F.col("severity") == "Critical")).isEmpty()


def tag_failures(df: DataFrame, rules: list[Rule], **strategy) -> DataFrame:
    """Add ``failed_rules``, the names of the active rules each row breaks."""
    active = [r for r in rules if r.active]
    tagged, flags = df, []
    for i, rule in enumerate(active):
        if rule.unique:
            repeated = stage(repeated_keys(df, [rule.unique]).drop("copies"), f"repeated_{rule.unique}")
            tagged = member_flag(tagged, repeated, [rule.unique], f"_dup{i}", **strategy)
            broken = F.col(f"_dup{i}")
        else:
            broken = F.expr(rule.fails)
        flags.append(F.when(broken, rule.name).otherwise(""))
    return tagged.select(*df.columns, F.array_remove(F.array(*flags), "").alias("failed_rules"))


def readable_tags(staged: DataFrame, rules: list[Rule]) -> DataFrame:
    """As ``tag_failures`` for a stored table whose tags are read many times.

    Tags follow from the row and its place in the table, so they are worked out wherever the
    rows are read; rows with tags are stored a second time only if the places are too many for that.
    """
    tagged = tag_failures(staged, rules)
    return tagged if marks_fit(staged) else stage(tagged, "tagged")


def breaks(rules: list[Rule]) -> Column:
    """Names of the given rules a tagged row breaks, in catalog order."""
    return F.array_intersect("failed_rules", F.array(*[F.lit(r.name) for r in rules]))


def quarantining(rules: list[Rule], severity: str = "Critical", only: list[str] | None = None) -> list[Rule]:
    """The rules that send a row to quarantine: all of a severity, or just those named."""
    return [r for r in rules if r.active and (r.name in only if only is not None else r.severity == severity)]


def split(tagged: DataFrame, rules: list[Rule], ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): disjoint, together the whole batch."""
    reasons = breaks(rules)
    good = tagged.filter(F.size(reasons) == 0).drop("failed_rules")
    quarantined = tagged.filter(F.size(reasons) > 0).select(
        *[c for c in tagged.columns if c != "failed_rules"],
        F.array_join(reasons, ",").alias("quarantine_reason"),
        ctx.time.alias("quarantined_at"),
    )
    return good, quarantined


def without_quarantined(df: DataFrame, history: DataFrame, key: str = "record_id", **strategy) -> DataFrame:
    """Drop every row whose id was ever quarantined; rows without an id stay."""
    ids = stage(history.select(key).filter(F.col(key).isNotNull()).distinct(), "quarantined_ids")
    return member_flag(df, ids, [key], "_gone", **strategy).filter(~F.col("_gone")).drop("_gone")


def newest_run(log: DataFrame, at: str = "run_at") -> DataFrame:
    """Rows of a log's newest run."""
    return log.filter(F.col(at) == log.agg(F.max(at)).scalar())


def report(results: DataFrame, rules: DataFrame, textual: bool = False) -> DataFrame:
    """Newest results with the catalog's category and severity: failed rules first, worst first."""
    newest = newest_run(results).select("rule_name", "rows_checked", "rows_failed", "pass_rate_pct", "passed", "run_at")
    return (
        newest.join(rules.select("rule_name", "rule_category", "severity"), "rule_name")
        .orderBy("passed", severity_rank(F.col("severity"), textual).desc(), "pass_rate_pct", "rule_name")
    )


def recent_quarantine(quarantine: DataFrame, ctx: RunContext, days: int = 1) -> DataFrame:
    """Rows quarantined within the last days, newest first."""
    return quarantine.filter(F.col("quarantined_at") > timestamp(ctx.as_of - timedelta(days=days))).orderBy(
        F.desc("quarantined_at"), "record_id"
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, the load's closing check."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
