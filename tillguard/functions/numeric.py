"""Deterministic decimal rounding of doubles.

``round_half_up(x, d) = floor(x * 10^d + 0.5) / 10^d`` evaluated in IEEE
doubles.  Engines disagree on half-way cases for ``round`` (Spark rounds the
shortest decimal string, others the scaled binary value); this formula gives
the same bits in Spark and in any SQL engine with IEEE doubles.  NULL, NaN
and magnitudes >= 1e15 are returned unchanged.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x, digits: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    scale = float(10 ** digits)
    safe = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(1e15))
    return F.when(safe, F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)).otherwise(x)


def sql_round_half_up(expr: str, digits: int) -> str:
    """The same rounding as SQL text (for the DuckDB oracles)."""
    scale = f"{10 ** digits}.0e0"
    return (f"(CASE WHEN ({expr}) IS NULL OR isnan({expr}) OR abs({expr}) >= 1e15 THEN ({expr}) "
            f"ELSE floor(({expr}) * {scale} + 0.5e0) / {scale} END)")
