"""Validators for the constraints a relational schema would enforce on write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.quality import repeated_keys


def constraint_violations(
    df: DataFrame,
    not_null: list[str] = (),
    domains: dict[str, list] | None = None,
    ranges: dict[str, tuple] | None = None,
    positive: list[str] = (),
) -> DataFrame:
    """Violations of NOT NULL, domain and range constraints, all counted in one scan.

    As in SQL, a NULL passes every check but NOT NULL.
    """
    checks: list[tuple[str, str, Column]] = []
    for name in not_null:
        checks.append((name, "not null", F.col(name).isNull()))
    for name, allowed in (domains or {}).items():
        checks.append((name, "domain", ~F.col(name).isin(allowed)))
    for name, (low, high) in (ranges or {}).items():
        limits = []
        if low is not None:
            limits.append(F.col(name) < F.lit(low))
        if high is not None:
            limits.append(F.col(name) > F.lit(high))
        checks.append((name, "range", reduce(lambda a, b: a | b, limits)))
    for name in positive:
        checks.append((name, "positive", F.col(name) <= F.lit(0)))
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("check_kind"), F.col(f"c{i}").alias("violations"))
        for i, (name, kind, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the number of copies."""
    return repeated_keys(df, keys)


def fk_orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent row, and how many child rows carry each.

    The child is reduced to one row per value first, so the anti join never sees a hot key.
    """
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("orphan_value"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    parents = parent.select(F.col(key).alias("orphan_value"))
    return used.join(parents, "orphan_value", "left_anti").select(
        F.lit(foreign_key).alias("foreign_key"), F.col("orphan_value").cast("string").alias("orphan_value"), "child_rows"
    )
