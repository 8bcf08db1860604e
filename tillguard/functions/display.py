"""Display attributes derived in the marts (PRJ-14, PRJ-15)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillguard.functions.numeric import round_half_up

# Tier colours (RGB and hex) and the neutral grey for no tier.
TIER_RGB = {
    "critical": [214, 39, 40],
    "high": [255, 127, 14],
    "medium": [255, 215, 0],
    "low": [44, 160, 44],
}
TIER_HEX = {
    "critical": "#d62728",
    "high": "#ff7f0e",
    "medium": "#ffd700",
    "low": "#2ca02c",
}
UNFLAGGED_RGB = [128, 128, 128]
UNFLAGGED_HEX = "#808080"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct(p, digits: int = 1) -> Column:
    return round_half_up(_c(p) * 100.0, digits)


def tier_rgb(tier) -> Column:
    lookup = F.create_map(*[x for t, rgb in TIER_RGB.items()
                            for x in (F.lit(t), F.array(*[F.lit(v) for v in rgb]))])
    default = F.array(*[F.lit(v) for v in UNFLAGGED_RGB])
    tier = _c(tier)
    return F.when(tier.isNull(), default).otherwise(F.coalesce(F.try_element_at(lookup, tier), default))


def tier_hex(tier) -> Column:
    lookup = F.create_map(*[x for t, h in TIER_HEX.items() for x in (F.lit(t), F.lit(h))])
    tier = _c(tier)
    return F.when(tier.isNull(), F.lit(UNFLAGGED_HEX)).otherwise(
        F.coalesce(F.try_element_at(lookup, tier), F.lit(UNFLAGGED_HEX)))
