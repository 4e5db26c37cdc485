"""Dimension rows and fact rows drawn from a batch of good extract rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.joins import latest_per_key
from fleetpulse.schema import (
    COMPLETE,
    DIM_AIRCRAFT,
    DIM_COMPONENT,
    DIM_SUPPLIER,
    FACT,
    NO_FIRMWARE,
    names,
    typed,
)

AIRCRAFT_KEY = ["aircraft_tail_number"]
COMPONENT_KEY = ["component_serial_number"]
SUPPLIER_KEY = ["supplier_id"]

AIRCRAFT_UPDATES = [c for c in names(DIM_AIRCRAFT) if c not in AIRCRAFT_KEY]
# The installation date of a component is written once.
COMPONENT_UPDATES = [c for c in names(DIM_COMPONENT) if c not in (*COMPONENT_KEY, "installation_date")]
SUPPLIER_UPDATES = ["supplier_quality_score"]

_NEWEST = "record_id"


def aircraft_rows(batch: DataFrame) -> DataFrame:
    """Newest row per tail number."""
    return _newest(batch, AIRCRAFT_KEY, names(DIM_AIRCRAFT)).select(*typed(DIM_AIRCRAFT))


def component_rows(batch: DataFrame) -> DataFrame:
    """Newest row per component; the marker for "no firmware" becomes NULL."""
    newest = _newest(batch, COMPONENT_KEY, names(DIM_COMPONENT))
    return newest.withColumn("firmware_version", F.nullif(F.col("firmware_version"), F.lit(NO_FIRMWARE))).select(
        *typed(DIM_COMPONENT)
    )


def supplier_rows(batch: DataFrame, distinct_only: bool = False) -> DataFrame:
    """Newest score per supplier.

    ``distinct_only`` is the distinct (supplier, score) pairs: two scores of one supplier
    in a batch then give two rows, which a strict upsert refuses.
    """
    known = batch.filter(F.col("supplier_id").isNotNull())
    if distinct_only:
        return known.select(*typed(DIM_SUPPLIER)).distinct()
    return _newest(known, SUPPLIER_KEY, names(DIM_SUPPLIER)).select(*typed(DIM_SUPPLIER))


def fact_rows(batch: DataFrame) -> DataFrame:
    """Typed snapshot rows; a missing quality flag becomes the default."""
    return batch.withColumn("data_quality_flag", F.coalesce(F.col("data_quality_flag"), F.lit(COMPLETE))).select(
        *typed(FACT)
    )


def _newest(batch: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Newest row per key; rows that tie on the id are ordered by content."""
    order = [_NEWEST] + [c for c in columns if c not in keys]
    needed = batch.select(*dict.fromkeys(columns + [_NEWEST]))
    return latest_per_key(needed, keys, [F.desc_nulls_first(c) for c in order])
