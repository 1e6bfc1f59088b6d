"""Column expressions."""

from zonalake.functions.columns import (
    air_zone,
    exact_sum,
    hour_label,
    hour_of_text,
    level_label,
    rounded,
    traffic_level,
    traffic_zone,
    weighted_mean,
    zone_label,
)

__all__ = [
    "air_zone",
    "exact_sum",
    "hour_label",
    "hour_of_text",
    "level_label",
    "rounded",
    "traffic_level",
    "traffic_zone",
    "weighted_mean",
    "zone_label",
]
