"""Generic DataFrame operators (no rule knowledge)."""

from gatewatch.operators.aggregates import (
    conditional_rates,
    first_last_drift,
    inactivity,
    rolling_baseline,
    session_diversity,
)
from gatewatch.operators.dedup import latest_by_key
from gatewatch.operators.joins import interval_join, with_evidence, without_evidence
from gatewatch.operators.scan import asof_join, neighbors, offsets, running_extremes, time_bucket
from gatewatch.operators.scoring import timeline, top_k, union_all, weighted_score
from gatewatch.operators.sequence import geo_velocity, match_sequence

__all__ = [
    "asof_join",
    "conditional_rates",
    "first_last_drift",
    "geo_velocity",
    "inactivity",
    "interval_join",
    "latest_by_key",
    "match_sequence",
    "neighbors",
    "rolling_baseline",
    "offsets",
    "running_extremes",
    "session_diversity",
    "time_bucket",
    "timeline",
    "top_k",
    "union_all",
    "weighted_score",
    "with_evidence",
    "without_evidence",
]
