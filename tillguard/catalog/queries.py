"""Spark side of the registered queries: ``name -> fn(spark, sf_dir)``.

Every query reads the whole driver tables through ``sources.fixtures`` and
runs the engine's operators; ``present`` only rounds for comparison.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillguard.catalog.present import present
from tillguard.plans import features as feat
from tillguard.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@register("features_full")
def features_full(spark, sf_dir):
    """WIN-1..5: the five trailing features per transaction (flagship)."""
    return feat.build_features(fx.transactions(spark, sf_dir))


def _tx(spark, sf_dir):
    return fx.transactions(spark, sf_dir)


@register("features_plain")
def features_plain(spark, sf_dir):
    """WIN-5 with one window partition per key (reference layout); must equal
    the bucketed default."""
    return feat.build_features(_tx(spark, sf_dir), mode="plain")


@register("features_prefix")
def features_prefix(spark, sf_dir):
    """WIN-5 from per-second prefix sums, previous location from short
    buckets; must equal the windows."""
    return feat.build_features(_tx(spark, sf_dir), terminal_mode="prefix", bin_mode="prefix")


@register("velocity_1h")
def velocity_1h(spark, sf_dir):
    """WIN-1."""
    return feat.with_velocity_1h(_tx(spark, sf_dir)).select("transaction_id", "terminal_id", "velocity_1h")


@register("geo_jump_km")
def geo_jump_km(spark, sf_dir):
    """WIN-2 + PRJ-10."""
    return feat.with_geo_jump(_tx(spark, sf_dir)).select("transaction_id", "terminal_id", "geo_jump_km")


@register("bin_spend_rate")
def bin_spend_rate(spark, sf_dir):
    """WIN-3 (bucketed: the 10 BINs are hot keys)."""
    return feat.with_bin_spend_rate(_tx(spark, sf_dir)).select("transaction_id", "card_bin", "bin_spend_rate")


@register("reversal_24h")
def reversal_24h(spark, sf_dir):
    """WIN-4 + PRJ-13."""
    return feat.with_terminal_reversal_count(_tx(spark, sf_dir)).select(
        "transaction_id", "terminal_id", "terminal_reversal_count")


def _minute_tx(spark, sf_dir):
    from pyspark.sql import functions as F
    return _tx(spark, sf_dir).withColumn("timestamp", F.date_trunc("minute", "timestamp"))


@register("trailing_row_ties")
def trailing_row_ties(spark, sf_dir):
    """WIN-6 count with tie_policy='row' on minute-truncated times (ties)."""
    from tillguard.operators.trailing import trailing_window_agg
    d = trailing_window_agg(_minute_tx(spark, sf_dir), "card_bin", 3600, "sum", out="trailing_count",
                            tie_policy="row", tie_order="transaction_id")
    return d.select("transaction_id", "card_bin", "trailing_count")


@register("trailing_mean_peers")
def trailing_mean_peers(spark, sf_dir):
    """WIN-6 mean with tie_policy='peers' on minute-truncated times."""
    from tillguard.operators.trailing import trailing_window_agg
    d = trailing_window_agg(_minute_tx(spark, sf_dir), "terminal_id", 7200, "mean", value="amount_ngn",
                            out="trailing_mean")
    return d.select("transaction_id", "terminal_id", "trailing_mean")


@register("trailing_mean_row_ties")
def trailing_mean_row_ties(spark, sf_dir):
    """WIN-6 mean with tie_policy='row'."""
    from tillguard.operators.trailing import trailing_window_agg
    d = trailing_window_agg(_minute_tx(spark, sf_dir), "card_bin", 3600, "mean", value="amount_ngn",
                            out="trailing_mean", tie_policy="row", tie_order="transaction_id")
    return d.select("transaction_id", "card_bin", "trailing_mean")


def _scores(spark, sf_dir):
    from tillguard.plans.scoring import blend_scores
    return blend_scores(fx.model_outputs(spark, sf_dir), scored_at="scored_at")


@register("scores_blended")
def scores_blended(spark, sf_dir):
    """PRJ-4, PRJ-8, PRJ-9: blend, tier, 4-dp rounding."""
    return _scores(spark, sf_dir)


@register("scoring_ratio_guard")
def scoring_ratio_guard(spark, sf_dir):
    """PRJ-6 vs PRJ-7 on a shifted baseline that reaches <= 0."""
    from pyspark.sql import functions as F
    from tillguard.functions import amount_ratio_for_scoring, amount_vs_bin_avg_ratio
    f = feat.build_features(_tx(spark, sf_dir)).withColumn("base", F.col("bin_spend_rate") - F.lit(50.0))
    return f.select("transaction_id", "base",
                    amount_ratio_for_scoring("amount_ngn", "base").alias("scoring_ratio"),
                    amount_vs_bin_avg_ratio("amount_ngn", "base").alias("feature_ratio"))


def _alerts(spark, sf_dir):
    from tillguard.plans.alerts import build_alerts
    return build_alerts(_scores(spark, sf_dir), _tx(spark, sf_dir), fx.terminals(spark, sf_dir),
                        fx.merchants(spark, sf_dir))


@register("alerts_enriched")
def alerts_enriched(spark, sf_dir):
    """JON-1..4 + PRJ-5: scores within 1 h of their transaction, alertable
    tiers, terminal and merchant names."""
    return _alerts(spark, sf_dir)


@register("latest_reference")
def latest_reference(spark, sf_dir):
    """SRC-7: the transaction stream as a changelog keyed by terminal; the
    latest record per terminal is its current row."""
    from tillguard.sources.changelog import latest_by_key
    t = _tx(spark, sf_dir).select("terminal_id", "transaction_id", "amount_ngn", "state", "timestamp")
    return latest_by_key(t, "terminal_id", ["timestamp", "transaction_id"])


@register("labeled_features")
def labeled_features(spark, sf_dir):
    """JON-5: features with the latest label per transaction (default false)."""
    from tillguard.operators.joins import label_join
    labels = _tx(spark, sf_dir).select("transaction_id", "is_fraud", "timestamp")
    return label_join(feat.build_features(_tx(spark, sf_dir)), labels, order="timestamp").select(
        "transaction_id", "velocity_1h", "geo_jump_km", "bin_spend_rate", "terminal_reversal_count",
        "amount_ngn", "amount_vs_bin_avg_ratio", "is_fraud")


@register("unseen_append")
def unseen_append(spark, sf_dir):
    """JON-6: a replayed batch (from Jan 15) against a table holding rows up to
    Jan 20: only unseen transaction ids are appended."""
    from pyspark.sql import functions as F
    from tillguard.operators.joins import unseen
    tx = _tx(spark, sf_dir)
    target = tx.filter(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp"))
    batch = tx.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp"))
    return unseen(batch, target).select("transaction_id", "terminal_id", "amount_ngn", "timestamp")


def _marts():
    from tillguard.operators import marts
    return marts


@register("alerts_filtered")
def alerts_filtered(spark, sf_dir):
    """FLT-1 + SRT-1 (STR-8 view): high/critical alerts in two states between
    two dates."""
    return _marts().live_alerts(_alerts(spark, sf_dir), tiers=["high", "critical"], states=["Lagos", "Kano"],
                                date_range=("2024-01-05", "2024-01-20"))


@register("alert_facets")
def alert_facets(spark, sf_dir):
    """AGG-9 (arrays joined to text for comparison)."""
    from pyspark.sql import functions as F
    f = _marts().filter_facets(_alerts(spark, sf_dir))
    return f.select(F.array_join("tiers", ",").alias("tiers"), F.array_join("states", ",").alias("states"),
                    "min_date", "max_date")


@register("tier_counts")
def tier_counts(spark, sf_dir):
    """AGG-1 over all scores (every tier present)."""
    return _marts().tier_counts(_scores(spark, sf_dir))


@register("alert_tier_counts")
def alert_tier_counts(spark, sf_dir):
    """AGG-1 over alerts (low is zero-filled)."""
    return _marts().tier_counts(_alerts(spark, sf_dir))


@register("alert_kpis")
def alert_kpis(spark, sf_dir):
    """AGG-6."""
    return _marts().alert_kpis(_alerts(spark, sf_dir))


@register("alerts_by_hour")
def alerts_by_hour(spark, sf_dir):
    """AGG-5."""
    return _marts().alerts_by_hour(_alerts(spark, sf_dir))


@register("score_histogram")
def score_histogram(spark, sf_dir):
    """AGG-10: 20 fixed-width bins of fraud_probability over all scores."""
    return _marts().score_histogram(_scores(spark, sf_dir))


@register("top_terminals")
def top_terminals(spark, sf_dir):
    """AGG-2."""
    return _marts().top_terminals(_alerts(spark, sf_dir))


@register("top_states")
def top_states(spark, sf_dir):
    """AGG-4."""
    return _marts().top_states(_alerts(spark, sf_dir))


@register("top_bins_avg")
def top_bins_avg(spark, sf_dir):
    """AGG-3."""
    return _marts().top_bins_by_avg_probability(_alerts(spark, sf_dir))


@register("top_at_risk")
def top_at_risk(spark, sf_dir):
    """WIN-7 + JON-7."""
    return _marts().top_at_risk_terminals(_alerts(spark, sf_dir), fx.terminals(spark, sf_dir), n=5)


@register("terminal_status")
def terminal_status(spark, sf_dir):
    """AGG-7 + JON-7/9 + PRJ-14/15 (hex colour; RGB array in unit tests)."""
    s = _marts().terminal_status(fx.terminals(spark, sf_dir), _alerts(spark, sf_dir), fx.merchants(spark, sf_dir))
    return s.drop("color")


@register("map_summary")
def map_summary(spark, sf_dir):
    """AGG-8."""
    m = _marts()
    return m.map_summary(m.terminal_status(fx.terminals(spark, sf_dir), _alerts(spark, sf_dir),
                                           fx.merchants(spark, sf_dir)))


def _labeled(spark, sf_dir):
    """Feature frame with its label (JON-5) and the model-frame types (PRJ-3)."""
    from tillguard.operators.joins import label_join
    from tillguard.operators.profile import to_model_frame
    labels = _tx(spark, sf_dir).select("transaction_id", "is_fraud", "timestamp")
    lf = label_join(feat.build_features(_tx(spark, sf_dir)), labels, order="timestamp")
    return to_model_frame(lf, keep=("transaction_id",))


def _real_synth(spark, sf_dir):
    """FIXTURES.md: real = even event ids, synthetic = odd event ids."""
    from pyspark.sql import functions as F
    from tillguard.session import materialize
    # both halves come from one feature build: compute it once
    lf = materialize(_labeled(spark, sf_dir))
    parity = F.col("transaction_id").cast("long") % 2
    return lf.filter(parity == 0), lf.filter(parity == 1)


def _profile():
    from tillguard.operators import profile
    return profile


@register("class_balance")
def class_balance(spark, sf_dir):
    """AGG-11."""
    return _profile().class_balance(_labeled(spark, sf_dir))


@register("missing_counts")
def missing_counts(spark, sf_dir):
    """AGG-12."""
    from tillguard.schemas import FEATURE_COLUMNS
    return _profile().missing_value_counts(_labeled(spark, sf_dir), FEATURE_COLUMNS)


@register("describe_features")
def describe_features(spark, sf_dir):
    """AGG-13 with exact distributed percentiles."""
    return _profile().describe_features(_labeled(spark, sf_dir))


@register("correlation")
def correlation(spark, sf_dir):
    """AGG-14: features + label."""
    from tillguard.schemas import FEATURE_COLUMNS
    return _profile().correlation_matrix(_labeled(spark, sf_dir), [*FEATURE_COLUMNS, "is_fraud"])


@register("scale_pos_weight")
def scale_pos_weight(spark, sf_dir):
    """AGG-15."""
    return _profile().scale_pos_weight(_labeled(spark, sf_dir))


@register("joint_counts")
def joint_counts(spark, sf_dir):
    """AGG-16."""
    return _profile().joint_counts(_labeled(spark, sf_dir))


@register("dataset_rates")
def dataset_rates(spark, sf_dir):
    """AGG-17 for the real and synthetic halves (SET-1 union of the two rows)."""
    real, synth = _real_synth(spark, sf_dir)
    p = _profile()
    return p.dataset_rates(real, name="real").unionByName(p.dataset_rates(synth, name="synthetic"))


def _scored_labeled(spark, sf_dir):
    """Blended fraud probability joined with the transaction label."""
    tx = _tx(spark, sf_dir).select("transaction_id", "is_fraud")
    return _scores(spark, sf_dir).join(tx, "transaction_id")


def _metrics():
    from tillguard.operators import metrics
    return metrics


@register("binary_metrics")
def binary_metrics(spark, sf_dir):
    """ML-6 at the 0.5 threshold on the blended score."""
    return _metrics().binary_metrics(_scored_labeled(spark, sf_dir), "fraud_probability", "is_fraud", 0.5)


@register("best_threshold")
def best_threshold(spark, sf_dir):
    """ML-4: F1-optimal threshold on the blended score."""
    return _metrics().best_threshold(_scored_labeled(spark, sf_dir), "fraud_probability", "is_fraud", decimals=4)


@register("roc_auc")
def roc_auc(spark, sf_dir):
    """ML-7 (ties counted half)."""
    return _metrics().roc_auc(_scored_labeled(spark, sf_dir), "fraud_probability", "is_fraud", decimals=4)


@register("average_precision")
def average_precision(spark, sf_dir):
    """ML-8 (step-wise, not trapezoid)."""
    return _metrics().average_precision(_scored_labeled(spark, sf_dir), "fraud_probability", "is_fraud", decimals=4)


@register("precision_at_k")
def precision_at_k(spark, sf_dir):
    """WIN-8 + ML-13: mean label of the k lowest 'normality' scores, k = the
    number of frauds (score = 1 - fraud_probability, ties by id)."""
    from pyspark.sql import functions as F
    d = _scored_labeled(spark, sf_dir).withColumn("normality", F.lit(1.0) - F.col("fraud_probability"))
    k = d.agg(F.sum(F.col("is_fraud").cast("int"))).first()[0] or 0  # one scalar: the report size
    return _metrics().precision_at_k(d, "normality", "is_fraud", int(k))


def _validation():
    from tillguard.operators import validation
    return validation


@register("summary_diff")
def summary_diff(spark, sf_dir):
    """VAL-1."""
    real, synth = _real_synth(spark, sf_dir)
    return _validation().summary_diff(real, synth)


@register("ks_2samp")
def ks_2samp(spark, sf_dir):
    """VAL-3 statistic for the four continuous columns."""
    from tillguard.schemas import CONTINUOUS_COLUMNS
    real, synth = _real_synth(spark, sf_dir)
    return _validation().ks_statistics(real, synth, CONTINUOUS_COLUMNS)


@register("wasserstein")
def wasserstein(spark, sf_dir):
    """VAL-5 for the four continuous columns."""
    from tillguard.schemas import CONTINUOUS_COLUMNS
    real, synth = _real_synth(spark, sf_dir)
    return _validation().wasserstein_distances(real, synth, CONTINUOUS_COLUMNS)


@register("chi_square_stat")
def chi_square_stat(spark, sf_dir):
    """VAL-4 statistic for the three categorical columns."""
    from tillguard.schemas import CATEGORICAL_COLUMNS
    real, synth = _real_synth(spark, sf_dir)
    return _validation().chi_squares(real, synth, CATEGORICAL_COLUMNS)


@register("validation_gate")
def validation_gate(spark, sf_dir):
    """VAL-8 + VAL-9 over every gating level (rows-only check).  The fits of
    level 4 (many small jobs) and the distances of level 5 (few large ones) do
    not need each other and run at the same time."""
    from concurrent.futures import ThreadPoolExecutor
    from pyspark.sql import functions as F
    from tillguard.operators.nearest import dnnr as privacy
    from tillguard.plans.training import tstr_vs_trtr
    from tillguard.schemas import FEATURE_COLUMNS
    real, synth = _real_synth(spark, sf_dir)
    v = _validation()
    with ThreadPoolExecutor(max_workers=2) as pool:
        model = pool.submit(tstr_vs_trtr, real.drop("transaction_id"), synth.drop("transaction_id"))
        distance = pool.submit(lambda: privacy(real, synth, FEATURE_COLUMNS).first()["dnnr"])
    res = v.validate(real, synth, level4={"auc_gap": model.result()["auc_gap"]}, level5={"dnnr": distance.result()})
    gate = v.approve(res)
    summ = v.validation_summary(res)
    return summ.select("level", "failed", "checks").unionByName(
        gate.select(F.lit("gate").alias("level"),
                    F.when(F.col("approved"), F.lit(0)).otherwise(F.size("reasons")).cast("long").alias("failed"),
                    F.lit(None).cast("long").alias("checks")))


def _scratch(spark, name):
    """A fresh folder under the shared checkpoint dir (never machine-local)."""
    import uuid
    from tillguard.session import checkpoint_path
    return checkpoint_path(spark, f"tillguard-runs/{name}-{uuid.uuid4().hex[:12]}")


SLICE_SECONDS = 5 * 86400


def _staged_slices(spark, tx, slice_col, path):
    """Writes transactions once, by slice, each slice as several files dealt by
    id; returns the slices in order and a reader of one slice's files."""
    from pyspark.sql import functions as F
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = tx.withColumn("_slice", slice_col)
    (staged.repartitionByRange(n, F.col("_slice"), F.xxhash64("transaction_id"))
           .write.partitionBy("_slice").parquet(path))
    held = spark.read.parquet(path)
    slices = [r[0] for r in held.select("_slice").distinct().orderBy("_slice").collect()]  # a folder each
    return slices, lambda s: held.filter(F.col("_slice") == s).drop("_slice")


def _time_slice():
    from pyspark.sql import functions as F
    return F.floor(F.unix_seconds("timestamp") / SLICE_SECONDS)


def _stream_features(spark, sf_dir, history):
    """Slices arrive as JSON files, one after another; the stream takes what
    has come, stops, and goes on from its checkpoint with the next slice."""
    from tillguard.sources.events import to_wire_json
    from tillguard.streaming import run_feature_stream, transaction_stream
    base = _scratch(spark, f"features-{history}")
    slices, rows_of = _staged_slices(spark, _tx(spark, sf_dir), _time_slice(), f"{base}/staged")
    for s in slices:
        to_wire_json(rows_of(s)).write.mode("append").text(f"{base}/source")
        run_feature_stream(transaction_stream(spark, path=f"{base}/source"), f"{base}/features", f"{base}/checkpoint",
                           history=history).awaitTermination()
    return spark.read.parquet(f"{base}/features").drop("event_date")


#: Of the transactions, those that come a slice late.
LATE_EVERY = 8


def _corrected(spark, sf_dir):
    """Transactions replayed in slices, some a slice (up to ten days) late, into
    a transaction table that both keyed operators follow."""
    from pyspark.sql import functions as F
    from tillguard.sinks.tables import append_transactions
    from tillguard.streaming.corrected import changes, run_corrected_features
    base = _scratch(spark, "corrected")
    late = F.when(F.col("transaction_id").cast("long") % LATE_EVERY == 3, F.lit(1)).otherwise(F.lit(0))
    slices, rows_of = _staged_slices(spark, _tx(spark, sf_dir), _time_slice() + late, f"{base}/staged")
    for s in slices:
        append_transactions(rows_of(s), f"{base}/transactions")
        for q in run_corrected_features(spark, f"{base}/transactions", f"{base}/changes", delay=3600, horizon=11 * 86400):
            q.awaitTermination()
    return spark.read.parquet(f"{base}/transactions"), changes(spark, f"{base}/changes")


@register("stream_corrected_features")
def stream_corrected_features(spark, sf_dir):
    """STR-3: keyed event-time state, rows out of order and up to ten days
    late, an hour's wait before values go out; first values with corrections
    applied equal the batch features of all seconds that went out."""
    from tillguard.streaming.corrected import corrected_features
    return corrected_features(*_corrected(spark, sf_dir))


@register("stream_corrections")
def stream_corrections(spark, sf_dir):
    """STR-7: first values, late ones and corrections by feature."""
    from tillguard.streaming.corrected import change_counts
    return change_counts(_corrected(spark, sf_dir)[1])


@register("stream_features_state")
def stream_features_state(spark, sf_dir):
    """STR-1 + STR-3 + STR-6: time-ordered micro-batches with table-backed
    history; must equal the batch features."""
    return _stream_features(spark, sf_dir, "table")


@register("stream_features_microbatch")
def stream_features_microbatch(spark, sf_dir):
    """STR-2: features inside each micro-batch only (reference behaviour):
    windows restart at every 5-day slice."""
    return _stream_features(spark, sf_dir, "batch")


#: Transactions of a slice of the alert replay, about: what the state of the
#: stream join holds of a slice, besides the rows that its watermark keeps.
REPLAY_ROWS = 1_000_000


def _slice_by_rows(tx, rows):
    """A column expression of a timestamp: its slice, of ``rows`` transactions
    about (equal times are in one slice); rows without a time are in the first."""
    from pyspark.sql import functions as F
    n = -(-tx.count() // rows)
    cuts = tx.select(F.unix_micros("timestamp").cast("double").alias("t")).approxQuantile(
        "t", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []  # a number a slice
    at = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
    return lambda ts: F.coalesce(F.size(F.filter(at, lambda c: c <= F.unix_micros(ts).cast("double"))), F.lit(0))


def _staged_wire(df, slice_col, parts, path):
    """Writes rows in their wire form once, by slice, each slice as up to
    ``parts`` files; returns the slices."""
    from pyspark.sql import functions as F
    from tillguard.sources.events import to_wire_json
    wire = to_wire_json(df.withColumn("_slice", slice_col), keep=("_slice",))
    part = F.pmod(F.xxhash64("value"), F.lit(parts))
    wire.repartition("_slice", part).write.partitionBy("_slice").text(path)
    return [r[0] for r in df.sparkSession.read.schema("value string, _slice int").text(path).select("_slice").distinct().collect()]  # a folder each


@contextlib.contextmanager
def _conf(spark, values):
    """Runtime settings within a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@register("stream_alerts")
def stream_alerts(spark, sf_dir):
    """STR-5: score and transaction file streams, watermarked interval join,
    static reference joins, parquet sink; must equal the batch alerts.  Both
    arrive in slices of time, cut at the same times, so that the watermark moves
    and the join state holds a slice and not the whole table."""
    from pyspark.sql import functions as F
    from tillguard.streaming import alert_stream, score_stream, stream_to_table, transaction_stream
    base = _scratch(spark, "alerts")
    tx, scores = _tx(spark, sf_dir), _scores(spark, sf_dir)
    slice_of = _slice_by_rows(tx, REPLAY_ROWS)
    # a slice needs no more state stores, or files, than there are tasks to serve them
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, 2 * spark.sparkContext.defaultParallelism))
    slices = {*_staged_wire(tx, slice_of("timestamp"), stores, f"{base}/staged-tx"),
              *_staged_wire(scores, slice_of("scored_at"), stores, f"{base}/staged-scores")}
    terminals, merchants = fx.terminals(spark, sf_dir), fx.merchants(spark, sf_dir)
    for s in sorted(slices) or [0]:
        for name in ("tx", "scores"):
            staged = spark.read.schema("value string, _slice int").text(f"{base}/staged-{name}")
            staged.filter(F.col("_slice") == s).select("value").write.mode("append").text(f"{base}/{name}")
        # the state before a slice is read from its files if a task is run again, and not held beside the new one
        with _conf(spark, {"spark.sql.shuffle.partitions": str(stores), "spark.sql.streaming.maxBatchesToRetainInMemory": "1"}):
            a = alert_stream(score_stream(spark, path=f"{base}/scores"), transaction_stream(spark, path=f"{base}/tx"), terminals, merchants)
            q = stream_to_table(a, f"{base}/alerts", f"{base}/checkpoint")
        q.awaitTermination()
    return spark.read.parquet(f"{base}/alerts")


@register("alert_stream_read")
def alert_stream_read(spark, sf_dir):
    """SRC-8: alerts published as JSON with upper-case names, read back as a
    typed stream into a table."""
    from tillguard.sources.events import to_wire_json
    from tillguard.streaming import read_alert_stream, stream_to_table
    base = _scratch(spark, "alert-events")
    alerts = _alerts(spark, sf_dir)
    to_wire_json(alerts.toDF(*[c.upper() for c in alerts.columns])).write.text(f"{base}/events")
    stream = read_alert_stream(spark, path=f"{base}/events", schema=alerts.schema)
    stream_to_table(stream, f"{base}/alerts", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{base}/alerts")


@register("training_pools")
def training_pools(spark, sf_dir):
    """ML-5 + SET-1: rows by pool and class once synthetic rows are added; the
    test pool holds real rows only."""
    from pyspark.sql import functions as F
    from tillguard.plans.training import training_pools as pools
    real, synth = _real_synth(spark, sf_dir)
    synthetic = synth.withColumn("transaction_id", F.lit(None).cast("string"))  # synthetic rows have no ids
    return pools(real, synthetic).groupBy(F.col("pool"), F.col("is_fraud").cast("int").alias("is_fraud")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when((F.col("pool") == "test") & (F.col("origin") != "real"), 1)).alias("n_synthetic_in_test"))


@register("augmented_training")
def augmented_training(spark, sf_dir):
    """ML-5: holdout metrics with synthetic rows added to the training pool
    (rows-only)."""
    from pyspark.sql import functions as F
    from tillguard.plans.training import train_with_holdout
    real, synth = _real_synth(spark, sf_dir)
    return train_with_holdout(real, synth.withColumn("transaction_id", F.lit(None).cast("string")))[1]


@register("gate_document")
def gate_document(spark, sf_dir):
    """SNK-8 + SRC-9 + SRC-10: the nested results document of every level,
    written, read back and flattened again; opted-in synthetic rows come back
    only if it approves them.  The levels that SQL can state."""
    from pyspark.sql import functions as F
    from tillguard.schemas import FEATURE_COLUMNS
    from tillguard.sinks.tables import write_synthetic, write_validation_results
    from tillguard.sources.events import read_gated_synthetic, read_validation_results
    real, synth = _real_synth(spark, sf_dir)
    v, base = _validation(), _scratch(spark, "gate")
    write_validation_results(v.results_document(v.validate(real, synth)), f"{base}/results")
    write_synthetic(synth, f"{base}/synthetic", [*FEATURE_COLUMNS, "is_fraud"])
    document = read_validation_results(spark, f"{base}/results")
    rows, _ = read_gated_synthetic(spark, f"{base}/synthetic", document, True)
    metrics = [("level1", FEATURE_COLUMNS, "mean_pct_diff"), ("level3a", v.CONTINUOUS_COLUMNS, "ks_statistic"),
               ("level3c", v.CONTINUOUS_COLUMNS, "normalized_score"), ("level3b", v.CATEGORICAL_COLUMNS, "chi2_statistic")]
    entries = [F.struct(F.lit(level).alias("level"), F.lit(c).alias("column"), F.lit(m).alias("metric"),
                        F.col(f"{level}.{c}.metrics.{m}").cast("double").alias("value")) for level, cols, m in metrics for c in cols]
    flat = document.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    # levels 4 and 5 did not run, so the gate must be closed and no row come back
    return flat.unionByName(document.select(
        F.lit("gate").alias("level"), F.lit("all").alias("column"), F.lit("approved").alias("metric"),
        F.col("approved_for_training").cast("int").cast("double").alias("value"))).unionByName(
        rows.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("gate").alias("level"), F.lit("all").alias("column"), F.lit("rows").alias("metric"), "value"))


@register("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    """SRC-2 + SRC-3: transactions -> JSON wire text -> decoded, valid rows."""
    from pyspark.sql import functions as F
    from tillguard.sources.events import decode_json, to_wire_json
    d = decode_json(to_wire_json(_tx(spark, sf_dir)))
    return d.filter("is_valid").drop("is_valid").withColumn("timestamp", F.col("timestamp"))


@register("keyed_json")
def keyed_json(spark, sf_dir):
    """SNK-5: key + JSON value per score (the topic message form)."""
    from tillguard.sinks.tables import keyed_json as kj
    from pyspark.sql import functions as F
    s = _scores(spark, sf_dir).select("transaction_id", "alert_tier", "fraud_probability")
    return kj(s, "transaction_id").select("key", F.get_json_object("value", "$.alert_tier").alias("alert_tier"),
                                          F.get_json_object("value", "$.fraud_probability")
                                           .cast("double").alias("fraud_probability"))


@register("stratified_split")
def stratified_split(spark, sf_dir):
    """ML-1: exact per-class 20 % test split by seeded id hash (rows-only:
    the hash differs from other engines; class shares are exact)."""
    from pyspark.sql import functions as F
    from tillguard.plans.training import stratified_split as split
    s = split(_labeled(spark, sf_dir), "is_fraud", 0.2)
    return s.groupBy("is_fraud", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("classifier_metrics")
def classifier_metrics(spark, sf_dir):
    """ML-2 + ML-4 + ML-5 + ML-6..8: holdout metrics of the boosted-tree
    classifier at 0.5 and at the F1-tuned threshold (rows-only)."""
    from tillguard.plans.training import train_with_holdout
    return train_with_holdout(_labeled(spark, sf_dir))[1]


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """ML-10 (+ ML-15 save/load round trip): importances of the classifier
    trained on all labelled rows (rows-only)."""
    from tillguard.plans import registry
    from tillguard.plans.training import feature_importance as fi, train_classifier
    root = _scratch(spark, "registry")
    registry.register_model(spark, train_classifier(_labeled(spark, sf_dir)), root, "fraud-classifier")
    return fi(registry.load_model(spark, root, "fraud-classifier"))


def _iforest(spark, sf_dir):
    from tillguard.plans.isolation_forest import fit_isolation_forest, training_rows
    from tillguard.session import materialize
    lab = materialize(_labeled(spark, sf_dir))  # the fit and the scores read it
    model = fit_isolation_forest(training_rows(lab))
    return model.transform(lab)


@register("isolation_forest_scores")
def isolation_forest_scores(spark, sf_dir):
    """ML-11 + ML-12: anomaly score and raw +-1 label per transaction
    (rows-only: randomised trees)."""
    return _iforest(spark, sf_dir).select("transaction_id", "anomaly_score", "raw_anomaly", "is_fraud")


@register("isolation_forest_eval")
def isolation_forest_eval(spark, sf_dir):
    """ML-13: AGG-18 score stats + WIN-8 precision@(fraud count) (rows-only)."""
    from pyspark.sql import functions as F
    from tillguard.operators.metrics import precision_at_k
    from tillguard.operators.profile import score_stats
    sc = _iforest(spark, sf_dir).cache()
    k = sc.agg(F.sum("is_fraud")).first()[0] or 0
    p = precision_at_k(sc, "anomaly_score", "is_fraud", int(k)).first()["precision_at_k"]
    out = score_stats(sc, "anomaly_score", "is_fraud").withColumn("precision_at_k", F.lit(p))
    return out


@register("tstr_trtr")
def tstr_trtr(spark, sf_dir):
    """VAL-6: train-on-synthetic vs train-on-real AUC on a 30 % real test
    split (rows-only)."""
    from tillguard.plans.training import tstr_vs_trtr
    real, synth = _real_synth(spark, sf_dir)
    r = tstr_vs_trtr(real.drop("transaction_id"), synth.drop("transaction_id"))
    return spark.createDataFrame([(k, str(v)) for k, v in r.items()], "metric string, value string")


@register("eda_report")
def eda_report(spark, sf_dir):
    """AGG-19: rows, class balance, missing counts, describe, correlations
    in long form."""
    return _profile().eda_report(_labeled(spark, sf_dir))


@register("distribution_tables")
def distribution_tables(spark, sf_dir):
    """VAL-2: 20-bin densities per column for real and synthetic."""
    real, synth = _real_synth(spark, sf_dir)
    return _validation().distribution_tables(real, synth)


@register("deterministic_shuffle")
def deterministic_shuffle(spark, sf_dir):
    """SRT-3 + SET-1: real and synthetic rows in one bag, seeded order
    (rows-only: the order itself is engine-specific)."""
    real, synth = _real_synth(spark, sf_dir)
    return _profile().deterministic_shuffle(real.unionByName(synth), 42, "transaction_id")


@register("scoring_request")
def scoring_request(spark, sf_dir):
    """PRJ-2 + PRJ-6 + ML-14 blend on a feature stream's rows: the
    scoring projection with the scorer's own ratio."""
    from tillguard.plans.scoring import scoring_request as proj, with_scoring_ratio
    return with_scoring_ratio(proj(feat.build_features(_tx(spark, sf_dir))))


@register("transactions_from_json")
def transactions_from_json(spark, sf_dir):
    """SRC-3: the transactions as wire JSON files, loaded with the declared
    schema."""
    from tillguard.sources.events import read_transactions, to_wire_json
    base = _scratch(spark, "wire")
    to_wire_json(_tx(spark, sf_dir)).write.text(base)
    return read_transactions(spark, base)


@register("transactions_from_table")
def transactions_from_table(spark, sf_dir):
    """SRC-4 + SNK-2 + SNK-3: appended to a table, one day rebuilt, then the
    table replaced by a full recompute, and read back."""
    from pyspark.sql import functions as F
    from tillguard.sinks.tables import append_transactions, overwrite_dates, overwrite_table
    from tillguard.sources.events import read_table
    base = _scratch(spark, "table")
    tx = _tx(spark, sf_dir)
    append_transactions(tx, base)
    overwrite_dates(tx.filter(F.to_date("timestamp") == F.lit("2024-01-10").cast("date")), base)
    overwrite_table(read_table(spark, base).drop("event_date"), f"{base}-full")
    overwrite_table(tx, f"{base}-full")  # replaced, not doubled
    return read_table(spark, f"{base}-full").drop("event_date").unionByName(read_table(spark, base).drop("event_date")).distinct()


@register("keyed_records")
def keyed_records(spark, sf_dir):
    """SRC-6: records whose id is the record key and not in the value."""
    from pyspark.sql import functions as F
    from tillguard.sources.events import decode_json
    tx = _tx(spark, sf_dir)
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    value = F.to_json(F.struct(*[stamp if c == "timestamp" else F.col(c) for c in tx.columns if c != "transaction_id"]))
    return decode_json(tx.select(F.col("transaction_id").alias("key"), value.alias("value")), key_col="key").filter("is_valid").drop("is_valid")


@register("alerts_with_defaults")
def alerts_with_defaults(spark, sf_dir):
    """SNK-6: alert events without id and time, appended twice (a replay) to
    the alert table: ids are filled in and nothing is doubled."""
    from pyspark.sql import functions as F
    from tillguard.sinks.tables import append_alerts
    base = _scratch(spark, "alert-table")
    bare = _alerts(spark, sf_dir).select("transaction_id", "terminal_id", "merchant_id", "card_bin", "fraud_probability", "alert_tier")
    for _ in range(2):
        append_alerts(bare, base)
    return spark.read.parquet(base).drop("event_date").withColumn("created_at", F.col("created_at").isNotNull())


@register("zero_jump_features")
def zero_jump_features(spark, sf_dir):
    """PRJ-12: rows whose drawn jump flag is 0 get a jump of 0."""
    from pyspark.sql import functions as F
    flag = F.when(F.col("transaction_id").cast("long") % 3 == 0, F.lit(1)).otherwise(F.lit(0))
    return _profile().enforce_zero_jump(_labeled(spark, sf_dir).withColumn("has_geo_jump", flag))


@register("forest_training_rows")
def forest_training_rows(spark, sf_dir):
    """FLT-2: the rows that the isolation forest learns from, by velocity."""
    from pyspark.sql import functions as F
    from tillguard.plans.isolation_forest import training_rows
    return training_rows(_labeled(spark, sf_dir)).groupBy(F.col("velocity_1h").cast("long").alias("velocity_1h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_fraud").cast("long").alias("n_fraud"))


@register("stream_deduplicated")
def stream_deduplicated(spark, sf_dir):
    """STR-6 + SNK-1: every fifth transaction is delivered again with the next
    slice; the idempotent table holds each once."""
    from pyspark.sql import functions as F
    from tillguard.sinks.tables import append_idempotent
    from tillguard.sources.events import to_wire_json
    from tillguard.streaming import transaction_stream
    base = _scratch(spark, "deduplicated")
    again = F.col("transaction_id").cast("long") % 5 == 0
    sent = F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    tx = _tx(spark, sf_dir).withColumn("_late", sent)
    slices, rows_of = _staged_slices(spark, tx, _time_slice() + F.col("_late"), f"{base}/staged")
    for s in slices:
        to_wire_json(rows_of(s).drop("_late")).write.mode("append").text(f"{base}/source")
        (transaction_stream(spark, path=f"{base}/source").writeStream.option("checkpointLocation", f"{base}/checkpoint")
         .foreachBatch(lambda d, _: append_idempotent(d, f"{base}/table", sidecar=True) and None)
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{base}/table").drop("event_date", "_group")


@register("stream_scores")
def stream_scores(spark, sf_dir):
    """STR-4 + SNK-7: a feature file stream scored per micro-batch
    (blended stand-in model outputs) and dual-written to the score table."""
    from pyspark.sql import functions as F
    from tillguard.plans.scoring import blend_scores
    from tillguard.sources.events import to_wire_json
    from tillguard.streaming import run_score_stream
    from tillguard.sources.events import decode_json
    from tillguard.schemas import FEATURE_SCHEMA
    base = _scratch(spark, "scores")
    f = feat.to_feature_table(feat.build_features(_tx(spark, sf_dir)))
    to_wire_json(f).write.text(f"{base}/features")
    outputs = fx.model_outputs(spark, sf_dir)
    stream = decode_json(spark.readStream.schema("value string").format("text").load(f"{base}/features"),
                         FEATURE_SCHEMA, required=["transaction_id"]).drop("is_valid")

    def score(batch):
        return blend_scores(batch.join(outputs, "transaction_id"), scored_at="scored_at")

    published = []
    q = run_score_stream(stream, f"{base}/scores", f"{base}/checkpoint", score,
                         publish=lambda d: published.append(d.count()))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/scores").drop("event_date").withColumn(
        "scored_at", F.col("scored_at"))


def _fitted_scorer(spark, lab):
    from tillguard.plans.ensemble import FittedScorer, flatten_classifier, flatten_forest
    from tillguard.plans.isolation_forest import fit_isolation_forest, training_rows
    from tillguard.plans.training import train_classifier
    gbt, forest = train_classifier(lab, maxIter=50), fit_isolation_forest(training_rows(lab))
    return gbt, FittedScorer(flatten_classifier(gbt), flatten_forest(forest))


@register("fitted_scores")
def fitted_scores(spark, sf_dir):
    """ML-14 + STR-4: classifier and isolation forest fitted on the labelled
    rows, both as node arrays; every feature row scored by a stream into the
    score table and read back.  Each row says whether the array model's
    probability is MLlib's (1e-9) and whether blend and tier follow from the
    written outputs; the oracle expects that of every transaction."""
    from pyspark.sql import functions as F
    from tillguard.plans.training import predict_proba
    from tillguard.session import materialize
    from tillguard.streaming import run_score_stream
    base = _scratch(spark, "fitted-scores")
    lab = materialize(_labeled(spark, sf_dir))
    gbt, scorer = _fitted_scorer(spark, lab)
    lab.withColumn("timestamp", F.lit("2026-01-01").cast("timestamp")).write.parquet(f"{base}/features")
    features = spark.read.parquet(f"{base}/features")
    run_score_stream(spark.readStream.schema(features.schema).parquet(f"{base}/features"), f"{base}/scores", f"{base}/checkpoint",
                     lambda d: scorer.score(d, scored_at="timestamp")).awaitTermination()
    scored = spark.read.parquet(f"{base}/scores").drop("event_date")
    arrays = scorer.outputs(features).select("transaction_id", F.col("xgboost_score").alias("p"), "raw_anomaly")
    from tillguard.plans.scoring import with_scoring_ratio
    mllib = predict_proba(gbt, with_scoring_ratio(features)).select("transaction_id", "probability_1")
    d = scored.join(arrays, "transaction_id").join(mllib, "transaction_id")
    blend = F.expr("0.7 * p + (1 - 0.7) * (1 - raw_anomaly) / 2")
    tier = F.expr("CASE WHEN b >= 0.85 THEN 'critical' WHEN b >= 0.6 THEN 'high' WHEN b >= 0.3 THEN 'medium' ELSE 'low' END")
    return d.withColumn("b", blend).select(
        "transaction_id", (F.abs(F.col("p") - F.col("probability_1")) <= 1e-9).alias("same_probability"),
        (F.abs(F.col("fraud_probability") - F.col("b")) <= 0.50001e-4).alias("same_blend"), (F.col("alert_tier") == tier).alias("same_tier"),
        (F.abs(F.col("xgboost_score") - F.col("p")) <= 0.50001e-4).alias("same_score"))


@register("grid_sweep")
def grid_sweep(spark, sf_dir):
    """ML-9 on a grid cut to short fits (the declared one is
    ``ensemble.PARAM_GRID``): one row a combination (rows-only)."""
    from tillguard.plans.ensemble import staged_sweep
    from tillguard.session import materialize
    return staged_sweep(materialize(_labeled(spark, sf_dir)), {"maxDepth": [3, 4], "stepSize": [0.1], "maxIter": [5, 10]}, k=2)


@register("dnnr")
def dnnr(spark, sf_dir):
    """VAL-7: privacy distance ratio with exact nearest neighbours (k-d
    leaves + bounding-box pruning, no pair join)."""
    from tillguard.operators.nearest import dnnr as run
    from tillguard.schemas import FEATURE_COLUMNS
    real, synth = _real_synth(spark, sf_dir)
    return run(real, synth, FEATURE_COLUMNS)
