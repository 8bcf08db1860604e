"""Score blending, tiering and feature-ratio expressions (PRJ-4..9, 11, 13)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert tiers, most severe first, with their lower thresholds.
TIER_ORDER = ["critical", "high", "medium", "low"]
TIER_THRESHOLDS = {"critical": 0.85, "high": 0.60, "medium": 0.30, "low": 0.0}
ALERTABLE_TIERS = ["medium", "high", "critical"]
# Fixed value: weight of the classifier probability in the blend.
XGBOOST_WEIGHT = 0.7


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tier_for_probability(p) -> Column:
    """First tier whose threshold p reaches; NULL/NaN/negative -> low."""
    p = _c(p)
    valid = p.isNotNull() & ~F.isnan(p)
    return (F.when(valid & (p >= TIER_THRESHOLDS["critical"]), "critical")
            .when(valid & (p >= TIER_THRESHOLDS["high"]), "high")
            .when(valid & (p >= TIER_THRESHOLDS["medium"]), "medium")
            .otherwise("low"))


def is_alertable(tier) -> Column:
    return _c(tier).isin(*ALERTABLE_TIERS)


def severity_rank(tier) -> Column:
    """0 for critical .. 3 for low, NULL for anything else."""
    tier = _c(tier)
    expr = None
    for i, t in enumerate(TIER_ORDER):
        expr = F.when(tier == t, F.lit(i)) if expr is None else expr.when(tier == t, F.lit(i))
    return expr


def tier_from_rank(rank) -> Column:
    rank = _c(rank)
    expr = None
    for i, t in enumerate(TIER_ORDER):
        expr = F.when(rank == i, F.lit(t)) if expr is None else expr.when(rank == i, F.lit(t))
    return expr


def amount_vs_bin_avg_ratio(amount, rate) -> Column:
    """Feature ratio: NULL when the trailing average is 0 or NULL (no ANSI error)."""
    return F.try_divide(_c(amount), _c(rate))


def amount_ratio_for_scoring(amount, rate) -> Column:
    """Scoring-time ratio: 0.0 when the baseline is <= 0 (no signal)."""
    rate = _c(rate)
    return F.when(rate <= 0, F.lit(0.0)).otherwise(F.try_divide(_c(amount), rate))


def normalize_anomaly(raw) -> Column:
    """clamp((1 - raw) / 2, 0, 1); NULL stays NULL (least/greatest skip NULLs)."""
    raw = _c(raw)
    v = (F.lit(1.0) - raw) / 2.0
    return F.when(raw.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))


def blend_score(xgb, iso, weight: float = XGBOOST_WEIGHT) -> Column:
    """weight * xgb + (1 - weight) * iso, unrounded (tier is taken from this)."""
    return F.lit(float(weight)) * _c(xgb) + F.lit(1.0 - float(weight)) * _c(iso)


def is_reversal(fraud_type) -> Column:
    return F.when(_c(fraud_type) == "fake_reversal", F.lit(1)).otherwise(F.lit(0))


def has_geo_jump(geo) -> Column:
    return (_c(geo) > 0).cast("int")
