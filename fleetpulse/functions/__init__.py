from fleetpulse.functions.columns import (
    exact_mean,
    exact_round,
    ratio,
    recency,
    risk_tier,
    row_digest,
    severity_rank,
    surrogate_key,
    weighted_sum,
)

__all__ = [
    "exact_mean",
    "exact_round",
    "ratio",
    "recency",
    "risk_tier",
    "row_digest",
    "severity_rank",
    "surrogate_key",
    "weighted_sum",
]
