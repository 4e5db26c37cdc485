"""The operators as queries over one folder of test tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import (
    bpe, decontaminate, langid, merkle, mixing, pii, quality, resample, secrets, sharding, simhash, spotsigs, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.op1_sharding,
    "op2_fingerprints": spotsigs.op2_fingerprints,
    "op3_simhash": simhash.op3_simhash,
    "op4_quality": quality.op4_quality,
    "op5_warc": warc.op5_warc,
    "op6_mixing": mixing.op6_mixing,
    "op7_personal_data": pii.op7_personal_data,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_secrets": secrets.op9_secrets,
    "op10_language": langid.op10_language,
    "op11_merkle": merkle.op11_merkle,
    "op12_resampling": resample.op12_resampling,
    "op13_bpe": bpe.op13_bpe,
}
# The others are tested against brute force, an exact round trip or held-out accuracy in tests/llm.
ORACLES: dict[str, str] = {
    "op1_sharding": sharding.ORACLE,
    "op2_fingerprints": spotsigs.ORACLE,
    "op5_warc": warc.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_personal_data": pii.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op9_secrets": secrets.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op12_resampling": resample.ORACLE,
}
