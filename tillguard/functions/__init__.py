"""Scalar Column expressions (all JVM-side, no UDFs)."""

from tillguard.functions.geo import haversine_km, EARTH_RADIUS_KM
from tillguard.functions.scoring import (
    TIER_ORDER, TIER_THRESHOLDS, ALERTABLE_TIERS, XGBOOST_WEIGHT,
    tier_for_probability, is_alertable, amount_ratio_for_scoring, amount_vs_bin_avg_ratio,
    normalize_anomaly, blend_score, severity_rank, tier_from_rank, is_reversal, has_geo_jump,
)
from tillguard.functions.display import pct, tier_rgb, tier_hex

__all__ = [
    "haversine_km", "EARTH_RADIUS_KM", "TIER_ORDER", "TIER_THRESHOLDS", "ALERTABLE_TIERS",
    "XGBOOST_WEIGHT", "tier_for_probability", "is_alertable", "amount_ratio_for_scoring",
    "amount_vs_bin_avg_ratio", "normalize_anomaly", "blend_score", "severity_rank",
    "tier_from_rank", "is_reversal", "has_geo_jump", "pct", "tier_rgb", "tier_hex",
]
