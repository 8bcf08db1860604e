"""Great-circle distance as native Column arithmetic (PRJ-10)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used by the reference distance.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; NULL when any input is NULL.

    ``a`` is clamped to 1 with ``when`` rather than ``least``: ``least``
    skips NULLs and would turn a NULL input into a 20,015 km jump.
    """
    lat1, lon1, lat2, lon2 = (F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2) - F.radians(lat1)
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
