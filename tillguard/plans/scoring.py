"""Scoring: blend model outputs into a fraud probability and tier (ML-14).

``blend_scores`` is the columnar form of the reference's per-request scorer:
classifier probability and raw anomaly output in, the 7-column score table
out.  ``score_features`` runs fitted models on a feature frame first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillguard.functions import (XGBOOST_WEIGHT, amount_ratio_for_scoring, blend_score, normalize_anomaly,
                                 tier_for_probability)
from tillguard.functions.numeric import round_half_up

SCORE_COLUMNS = ["transaction_id", "fraud_probability", "alert_tier", "xgboost_score",
                 "isolation_forest_score", "model_version", "scored_at"]


class ModelsNotReadyError(RuntimeError):
    """Raised when scoring is asked for before both models exist."""


def blend_scores(df: DataFrame, *, xgb_col: str = "xgboost_score", raw_anomaly_col: str = "raw_anomaly",
                 weight: float = XGBOOST_WEIGHT, model_version: str = "v1",
                 scored_at: Column | str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-8 + PRJ-9 + PRJ-4: normalise the anomaly output, blend, tier on the
    unrounded blend, then round the three scores to 4 dp."""
    iso = normalize_anomaly(raw_anomaly_col)
    d = df.withColumn("_iso", iso).withColumn("_p", blend_score(xgb_col, "_iso", weight))
    if scored_at is None:
        sa = F.current_timestamp()
    else:
        sa = F.col(scored_at) if isinstance(scored_at, str) else scored_at
    return d.select(
        "transaction_id",
        round_half_up("_p", 4).alias("fraud_probability"),
        tier_for_probability("_p").alias("alert_tier"),
        round_half_up(F.col(xgb_col), 4).alias("xgboost_score"),
        round_half_up("_iso", 4).alias("isolation_forest_score"),
        F.lit(model_version).alias("model_version"),
        sa.alias("scored_at"),
        *keep,
    )


def with_scoring_ratio(df: DataFrame) -> DataFrame:
    """PRJ-6: the ratio the scorer derives itself (0.0 for a base <= 0)."""
    return df.withColumn("amount_vs_bin_avg_ratio", amount_ratio_for_scoring("amount_ngn", "bin_spend_rate"))


def score_features(features: DataFrame, classifier=None, anomaly_model=None, *, model_version: str = "v1",
                   weight: float = XGBOOST_WEIGHT) -> DataFrame:
    """Score a feature frame with a fitted classifier pipeline (probability of
    class 1) and an isolation-forest model (raw +-1 or decision output)."""
    if classifier is None or anomaly_model is None:
        raise ModelsNotReadyError("both the classifier and the anomaly model are required")
    from tillguard.plans.training import positive_probability

    d = with_scoring_ratio(features)
    d = positive_probability(classifier.transform(d), out="xgboost_score")
    d = anomaly_model.transform(d, out="raw_anomaly")
    return blend_scores(d, weight=weight, model_version=model_version)


#: PRJ-2: the columns a feature row carries into scoring (8).
SCORING_REQUEST_COLUMNS = ["transaction_id", "terminal_id", "velocity_1h", "geo_jump_km", "bin_spend_rate",
                           "terminal_reversal_count", "amount_ngn", "timestamp"]


def scoring_request(features: DataFrame) -> DataFrame:
    """PRJ-2: the scoring projection of a feature row (the ratio is derived
    again at scoring time, PRJ-6)."""
    return features.select(*SCORING_REQUEST_COLUMNS)


class Scorer:
    """Blend + tier expressions built once and applied to any frame with
    ``xgboost_score`` and ``raw_anomaly`` (and optionally ``amount_ngn`` /
    ``bin_spend_rate`` for the scoring ratio).  Re-using the Column objects
    keeps per-request overhead to a single ``select`` (low-latency path)."""

    def __init__(self, weight: float = XGBOOST_WEIGHT, model_version: str = "v1"):
        iso = normalize_anomaly("raw_anomaly")
        p = blend_score("xgboost_score", iso, weight)
        self.columns = [
            "transaction_id",
            round_half_up(p, 4).alias("fraud_probability"),
            tier_for_probability(p).alias("alert_tier"),
            round_half_up(F.col("xgboost_score"), 4).alias("xgboost_score"),
            round_half_up(iso, 4).alias("isolation_forest_score"),
            F.lit(model_version).alias("model_version"),
            F.current_timestamp().alias("scored_at"),
        ]

    def score(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns)


def request_frame(spark, request: dict) -> DataFrame:
    """One scoring request as a one-row frame (bound parameters, folded to a
    local relation by the optimizer: no cluster job for a single request)."""
    names = list(request)
    typed = []
    for k in names:
        v = request[k]
        if isinstance(v, bool) or v is None or isinstance(v, str):
            typed.append(f":{k} AS `{k}`")
        elif isinstance(v, int):
            typed.append(f"CAST(:{k} AS BIGINT) AS `{k}`")
        else:
            typed.append(f"CAST(:{k} AS DOUBLE) AS `{k}`")
    return spark.sql("SELECT " + ", ".join(typed), args={k: request[k] for k in names})
