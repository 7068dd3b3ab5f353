"""Column expressions."""

from lakemart.functions.aggregates import count_true, mean, measure, total
from lakemart.functions.columns import (
    clamp,
    clean_id,
    event_date,
    floor_at,
    full_name,
    guarded_ratio,
    named,
    on_time,
    ordered_actual,
    pct,
    ratio,
    restate_cancelled,
    safe_cast,
)

__all__ = [
    "clamp",
    "clean_id",
    "count_true",
    "event_date",
    "floor_at",
    "full_name",
    "guarded_ratio",
    "mean",
    "measure",
    "named",
    "on_time",
    "ordered_actual",
    "pct",
    "ratio",
    "restate_cancelled",
    "safe_cast",
    "total",
]
