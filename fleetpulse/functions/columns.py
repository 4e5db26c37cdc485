"""Column expressions. All are built from Spark SQL functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_round(value: Column, places: int, precision: int = 20) -> Column:
    """Round half away from zero, going through an exact decimal.

    Rounding a binary double directly breaks ties by its representation error.
    """
    return F.round(value.cast("decimal(30,12)"), places).cast(f"decimal({precision},{places})")


def ratio(numerator: Column, denominator: Column, places: int, kind: str = "decimal(18,4)") -> Column:
    """Exact quotient; NULL where the denominator is zero or either side is NULL.

    ``kind`` is the decimal type both sides are held in; give it more digits or places where
    they have more, as a value that does not fit it is rounded or refused.
    """
    return exact_round(numerator.cast(kind) / F.nullif(denominator.cast(kind), F.lit(0)), places)


def exact_mean(value: Column, kind: str = "decimal(14,4)") -> Column:
    """Mean over a group from an exact decimal sum: the same whatever the order of the rows.

    ``kind`` is the decimal type the values are held in. The mean is not rounded; Spark's own
    mean of a decimal keeps four more places only, so rounding it again could round twice.
    """
    return F.sum(value.cast(kind)) / F.nullif(F.count(value), F.lit(0))


def weighted_sum(weights: dict[str, str], places: int) -> Column:
    """Sum of weight x column, a NULL reading counting as zero. Weights are decimal text."""
    total = F.lit(0).cast("decimal(18,6)")
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name), F.lit(0)).cast("decimal(12,3)") * F.lit(weight).cast("decimal(4,2)")
    return exact_round(total, places)


def recency(days: Column, decay_days: float, places: int) -> Column:
    """Exponential decay of days since an event; unknown counts as today."""
    return exact_round(F.exp(-F.coalesce(days, F.lit(0)).cast("double") / F.lit(float(decay_days))), places)


def risk_tier(
    prob_30d: Column,
    prob_90d: Column,
    high: float = 0.5,
    elevated: float = 0.5,
    watch: float = 0.2,
    null_tier: str = "Low",
) -> Column:
    """Tier from the two failure probabilities; every limit is strict, the first match wins.

    ``null_tier`` is the tier when neither probability decides, by default the lowest.
    """
    decided = (
        F.when(prob_30d > F.lit(high), "High")
        .when(prob_90d > F.lit(elevated), "Elevated")
        .when(prob_90d > F.lit(watch), "Watch")
    )
    if null_tier == "Low":
        return decided.otherwise("Low")
    return decided.when(prob_30d.isNull() | prob_90d.isNull(), null_tier).otherwise("Low")


def severity_rank(severity: Column, textual: bool = False) -> Column:
    """Sort key of a severity. ``textual`` is the plain text order (Warning above Critical)."""
    if textual:
        return severity
    return F.when(severity == "Critical", 3).when(severity == "Warning", 2).when(severity == "Info", 1)


def row_digest(columns: list[Column]) -> Column:
    """MD5 over the whole row, NULLs included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def surrogate_key(*columns: Column) -> Column:
    """Id of a log row, computed from its content; needs no coordination between tasks."""
    return F.xxhash64(*columns)
