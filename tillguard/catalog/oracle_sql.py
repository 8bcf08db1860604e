"""DuckDB SQL oracles for the registered queries.

Each string runs on the driver's pre-registered views (``events``,
``customer``, ``supplier``, ``nation`` ...).  The fixture mapping of
``tillguard.sources.fixtures`` is restated here as CTEs, so every oracle is
an independent SQL formulation of the same result.
"""

from __future__ import annotations

from tillguard.functions.numeric import sql_round_half_up


def r6(expr: str) -> str:
    return sql_round_half_up(expr, 6)


def r4(expr: str) -> str:
    return sql_round_half_up(expr, 4)


def _pad(prefix: str, expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"('{prefix}' || CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"


def _state(expr: str) -> str:
    return (f"CASE ({expr}) % 5 WHEN 0 THEN 'Lagos' WHEN 1 THEN 'FCT' WHEN 2 THEN 'Kano' "
            f"WHEN 3 THEN 'Rivers' ELSE 'Oyo' END")


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"(12742.0e0 * asin(sqrt(CASE WHEN {a} > 1 THEN 1.0e0 ELSE {a} END)))"


TX_CTE = f"""
ev_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
ev_f AS (
  SELECT *, CASE WHEN event_type = 'error' AND k % 4 = 0 THEN 'fake_reversal'
                 WHEN event_type = 'purchase' AND value > 120 THEN 'cloned_card'
                 ELSE '' END AS fraud_type
  FROM ev_k
),
tx_all AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         {_pad('TRM', 'user_id', 5)} AS terminal_id,
         {_pad('MRC', 'user_id % 120', 4)} AS merchant_id,
         CAST(539980 + k % 10 AS VARCHAR) AS card_bin,
         value AS amount_ngn,
         {_state('user_id')} AS state,
         'LGA' || CAST(user_id % 20 AS VARCHAR) AS lga,
         4.0e0 + (user_id % 80) / 10.0e0
           + CASE WHEN fraud_type <> '' THEN (event_id % 10) / 10.0e0 ELSE 0.0e0 END AS latitude,
         3.0e0 + (user_id % 110) / 10.0e0 AS longitude,
         ts AS timestamp,
         fraud_type <> '' AS is_fraud,
         fraud_type,
         event_id AS ev_id,
         k AS ev_k,
         epoch_us(ts) // 1000000 AS sec
  FROM ev_f
),
transactions AS (
  SELECT transaction_id, terminal_id, merchant_id, card_bin, amount_ngn, state, lga,
         latitude, longitude, timestamp, is_fraud, fraud_type
  FROM tx_all
),
terminals AS (
  SELECT {_pad('TRM', 'c_custkey', 5)} AS terminal_id,
         c_name AS terminal_name,
         {_pad('MRC', 'c_custkey % 120', 4)} AS merchant_id,
         {_state('c_custkey')} AS state,
         'LGA' || CAST(c_custkey % 20 AS VARCHAR) AS lga,
         4.0e0 + (c_custkey % 80) / 10.0e0 AS latitude,
         3.0e0 + (c_custkey % 110) / 10.0e0 AS longitude,
         c_mktsegment AS operator,
         c_acctbal >= 0 AS is_active
  FROM customer
),
merchants AS (
  SELECT {_pad('MRC', 's_suppkey', 4)} AS merchant_id,
         s_name AS merchant_name,
         n_name AS category,
         {_state('s_suppkey')} AS state,
         'LGA' || CAST(s_suppkey % 20 AS VARCHAR) AS lga,
         CAST(DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS registration_date,
         s_acctbal < 0 AS is_flagged
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
tx_prev AS (
  SELECT *,
         lag(latitude) OVER (PARTITION BY terminal_id ORDER BY timestamp, transaction_id) AS prev_lat,
         lag(longitude) OVER (PARTITION BY terminal_id ORDER BY timestamp, transaction_id) AS prev_lon
  FROM tx_all
),
features AS (
  SELECT transaction_id, terminal_id, card_bin, amount_ngn,
         count(transaction_id) OVER (PARTITION BY terminal_id ORDER BY sec
                                     RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS velocity_1h,
         CASE WHEN prev_lat IS NOT NULL THEN {haversine('prev_lat', 'prev_lon', 'latitude', 'longitude')}
              ELSE 0.0e0 END AS geo_jump_km,
         avg(amount_ngn) OVER (PARTITION BY card_bin ORDER BY sec
                               RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS bin_spend_rate,
         CAST(sum(CASE WHEN fraud_type = 'fake_reversal' THEN 1 ELSE 0 END)
              OVER (PARTITION BY terminal_id ORDER BY sec
                    RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS BIGINT) AS terminal_reversal_count,
         timestamp, ev_id, is_fraud, fraud_type
  FROM tx_prev
),
features_r AS (
  SELECT *, CASE WHEN bin_spend_rate = 0 THEN NULL ELSE amount_ngn / bin_spend_rate END AS amount_vs_bin_avg_ratio
  FROM features
),
scores_raw AS (
  SELECT transaction_id,
         least(1.0e0, {r4('amount_ngn / 200.0e0')}) AS x,
         CASE WHEN ev_k >= 90 THEN -1.0e0 ELSE 1.0e0 END AS raw,
         timestamp + to_minutes(CAST(ev_id % 90 AS INTEGER)) AS scored_at
  FROM tx_all
),
scores_b AS (
  SELECT *, 0.7e0 * x + (1.0e0 - 0.7e0) * iso AS p
  FROM (SELECT *, greatest(0.0e0, least(1.0e0, (1.0e0 - raw) / 2.0e0)) AS iso FROM scores_raw)
),
scores AS (
  SELECT transaction_id, {r4('p')} AS fraud_probability,
         CASE WHEN p >= 0.85e0 THEN 'critical' WHEN p >= 0.6e0 THEN 'high'
              WHEN p >= 0.3e0 THEN 'medium' ELSE 'low' END AS alert_tier,
         {r4('x')} AS xgboost_score, {r4('iso')} AS isolation_forest_score,
         'v1' AS model_version, scored_at
  FROM scores_b
),
alerts AS (
  SELECT sha256(s.transaction_id || '|' || s.alert_tier) AS alert_id, s.transaction_id,
         t.terminal_id, t.merchant_id, t.card_bin, s.fraud_probability, s.alert_tier, t.state,
         tr.terminal_name, mr.merchant_name, s.scored_at AS created_at
  FROM scores s
  JOIN transactions t ON s.transaction_id = t.transaction_id
   AND t.timestamp >= s.scored_at - INTERVAL 1 HOUR AND t.timestamp <= s.scored_at + INTERVAL 1 HOUR
  LEFT JOIN terminals tr ON t.terminal_id = tr.terminal_id
  LEFT JOIN merchants mr ON t.merchant_id = mr.merchant_id
  WHERE s.alert_tier IN ('medium', 'high', 'critical')
)"""


def with_ctes(body: str) -> str:
    return f"WITH {TX_CTE}\n{body}"


FEATURES_FULL = with_ctes(f"""
SELECT transaction_id, terminal_id, card_bin, {r6('amount_ngn')} AS amount_ngn, velocity_1h,
       {r6('geo_jump_km')} AS geo_jump_km, {r6('bin_spend_rate')} AS bin_spend_rate,
       terminal_reversal_count, {r6('amount_vs_bin_avg_ratio')} AS amount_vs_bin_avg_ratio, timestamp
FROM features_r""")

MINUTE_TX = """
mtx AS (
  SELECT transaction_id, terminal_id, card_bin, amount_ngn, epoch_us(date_trunc('minute', timestamp)) // 1000000 AS sec
  FROM transactions
)"""


def _row_ties(group: str, seconds: int, value: str | None, out: str) -> str:
    v = value or "1"
    s_early = f"sum({v}) OVER (PARTITION BY {group} ORDER BY sec RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)"
    s_peer = f"sum({v}) OVER (PARTITION BY {group}, sec ORDER BY transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    n_early = f"count({v}) OVER (PARTITION BY {group} ORDER BY sec RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)"
    n_peer = f"count({v}) OVER (PARTITION BY {group}, sec ORDER BY transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    s = f"(coalesce({s_early}, 0) + coalesce({s_peer}, 0))"
    n = f"(coalesce({n_early}, 0) + coalesce({n_peer}, 0))"
    if value is None:
        return f"CAST({n} AS BIGINT) AS {out}"
    return f"{r6(f'CASE WHEN {n} = 0 THEN NULL ELSE CAST({s} AS DOUBLE) / {n} END')} AS {out}"


TIERS_AXIS = "(SELECT * FROM (VALUES ('critical', 0), ('high', 1), ('medium', 2), ('low', 3)) AS v(alert_tier, pos))"

TERMINAL_STATUS = """
roll AS (
  SELECT terminal_id, count(*) AS alert_count, max(coalesce(fraud_probability, 0.0e0)) AS max_p,
         min(CASE alert_tier WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2
                             WHEN 'low' THEN 3 END) AS rnk
  FROM alerts GROUP BY terminal_id
),
status AS (
  SELECT t.terminal_id, t.terminal_name, t.merchant_id, t.state, t.lga, t.latitude AS lat, t.longitude AS lon,
         t.operator, t.is_active,
         CASE r.rnk WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' END AS tier,
         CAST(coalesce(r.alert_count, 0) AS BIGINT) AS alert_count,
         coalesce(r.max_p, 0.0e0) * 100.0e0 AS p100,
         coalesce(m.merchant_name, t.merchant_id) AS merchant_name
  FROM terminals t LEFT JOIN roll r ON t.terminal_id = r.terminal_id
  LEFT JOIN merchants m ON t.merchant_id = m.merchant_id
)"""

ORACLES: dict[str, str] = {
    "features_full": FEATURES_FULL,
    "features_plain": FEATURES_FULL,
    "features_prefix": FEATURES_FULL,
    "velocity_1h": with_ctes("SELECT transaction_id, terminal_id, velocity_1h FROM features_r"),
    "geo_jump_km": with_ctes(f"SELECT transaction_id, terminal_id, {r6('geo_jump_km')} AS geo_jump_km FROM features_r"),
    "bin_spend_rate": with_ctes(
        f"SELECT transaction_id, card_bin, {r6('bin_spend_rate')} AS bin_spend_rate FROM features_r"),
    "reversal_24h": with_ctes("SELECT transaction_id, terminal_id, terminal_reversal_count FROM features_r"),
    "trailing_row_ties": with_ctes(f""",{MINUTE_TX}
SELECT transaction_id, card_bin, {_row_ties('card_bin', 3600, None, 'trailing_count')} FROM mtx"""),
    "trailing_mean_row_ties": with_ctes(f""",{MINUTE_TX}
SELECT transaction_id, card_bin, {_row_ties('card_bin', 3600, 'amount_ngn', 'trailing_mean')} FROM mtx"""),
    "trailing_mean_peers": with_ctes(f""",{MINUTE_TX}
SELECT transaction_id, terminal_id,
       {r6('avg(amount_ngn) OVER (PARTITION BY terminal_id ORDER BY sec RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW)')}
         AS trailing_mean
FROM mtx"""),
    "scores_blended": with_ctes("SELECT * FROM scores"),
    "scoring_ratio_guard": with_ctes(f"""
SELECT transaction_id, {r6('base')} AS base,
       {r6('CASE WHEN base <= 0 THEN 0.0e0 ELSE amount_ngn / base END')} AS scoring_ratio,
       {r6('CASE WHEN base = 0 THEN NULL ELSE amount_ngn / base END')} AS feature_ratio
FROM (SELECT *, bin_spend_rate - 50.0e0 AS base FROM features_r)"""),
    "alerts_enriched": with_ctes("SELECT * FROM alerts"),
    "latest_reference": with_ctes("""
SELECT terminal_id, arg_max(transaction_id, (timestamp, transaction_id)) AS transaction_id,
       arg_max(amount_ngn, (timestamp, transaction_id)) AS amount_ngn,
       arg_max(state, (timestamp, transaction_id)) AS state,
       max(timestamp) AS timestamp
FROM transactions GROUP BY terminal_id"""),
    "labeled_features": with_ctes(f"""
SELECT transaction_id, velocity_1h, {r6('geo_jump_km')} AS geo_jump_km, {r6('bin_spend_rate')} AS bin_spend_rate,
       terminal_reversal_count, {r6('amount_ngn')} AS amount_ngn,
       {r6('amount_vs_bin_avg_ratio')} AS amount_vs_bin_avg_ratio, coalesce(is_fraud, false) AS is_fraud
FROM features_r"""),
    "unseen_append": with_ctes("""
SELECT b.transaction_id, b.terminal_id, b.amount_ngn, b.timestamp
FROM transactions b
WHERE b.timestamp >= TIMESTAMP '2024-01-15'
  AND NOT EXISTS (SELECT 1 FROM transactions t
                  WHERE t.timestamp < TIMESTAMP '2024-01-20' AND t.transaction_id = b.transaction_id)"""),
    "alerts_filtered": with_ctes("""
SELECT * FROM alerts
WHERE alert_tier IN ('high', 'critical') AND state IN ('Lagos', 'Kano')
  AND CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "alert_facets": with_ctes("""
SELECT (SELECT string_agg(alert_tier, ',' ORDER BY r) FROM (
          SELECT DISTINCT alert_tier, CASE alert_tier WHEN 'critical' THEN 0 WHEN 'high' THEN 1
                                      WHEN 'medium' THEN 2 WHEN 'low' THEN 3 END AS r
          FROM alerts WHERE alert_tier IN ('critical', 'high', 'medium', 'low'))) AS tiers,
       (SELECT string_agg(state, ',' ORDER BY state) FROM (
          SELECT DISTINCT state FROM alerts WHERE state IS NOT NULL AND state <> '')) AS states,
       (SELECT min(CAST(created_at AS DATE)) FROM alerts) AS min_date,
       (SELECT max(CAST(created_at AS DATE)) FROM alerts) AS max_date"""),
    "tier_counts": with_ctes(f"""
SELECT a.alert_tier, CAST(coalesce(c.n, 0) AS BIGINT) AS alert_count
FROM {TIERS_AXIS} a LEFT JOIN (SELECT alert_tier, count(*) AS n FROM scores GROUP BY 1) c
  ON a.alert_tier = c.alert_tier"""),
    "alert_tier_counts": with_ctes(f"""
SELECT a.alert_tier, CAST(coalesce(c.n, 0) AS BIGINT) AS alert_count
FROM {TIERS_AXIS} a LEFT JOIN (SELECT alert_tier, count(*) AS n FROM alerts GROUP BY 1) c
  ON a.alert_tier = c.alert_tier"""),
    "alert_kpis": with_ctes("""
SELECT count(*) AS total_alerts, count(*) FILTER (WHERE alert_tier = 'critical') AS critical,
       count(*) FILTER (WHERE alert_tier = 'high') AS high, count(*) FILTER (WHERE alert_tier = 'medium') AS medium
FROM alerts"""),
    "alerts_by_hour": with_ctes("""
SELECT CAST(h.hour AS INTEGER) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS alert_count
FROM range(24) h(hour) LEFT JOIN (SELECT hour(created_at) AS hour, count(*) AS n FROM alerts
                                  WHERE created_at IS NOT NULL GROUP BY 1) c ON h.hour = c.hour"""),
    "score_histogram": with_ctes(f"""
SELECT bin, count(*) AS n, {r6('0.0e0 + bin * 0.05e0')} AS bin_lo, {r6('0.0e0 + (bin + 1) * 0.05e0')} AS bin_hi
FROM (SELECT CAST(greatest(0, least(19, floor((fraud_probability - 0.0e0) / 0.05e0))) AS INTEGER) AS bin
      FROM scores WHERE fraud_probability IS NOT NULL AND NOT isnan(fraud_probability))
GROUP BY bin"""),
    "top_terminals": with_ctes("""
SELECT terminal_id, count(*) AS alert_count FROM alerts GROUP BY terminal_id
ORDER BY alert_count DESC, terminal_id LIMIT 5"""),
    "top_states": with_ctes("""
SELECT state, count(*) AS alert_count FROM alerts WHERE state IS NOT NULL AND state <> ''
GROUP BY state ORDER BY alert_count DESC, state LIMIT 5"""),
    "top_bins_avg": with_ctes(f"""
SELECT card_bin, {r6('avg(coalesce(fraud_probability, 0.0e0))')} AS avg_fraud_probability
FROM alerts WHERE card_bin IS NOT NULL AND card_bin <> ''
GROUP BY card_bin ORDER BY avg(coalesce(fraud_probability, 0.0e0)) DESC, card_bin LIMIT 5"""),
    "top_at_risk": with_ctes("""
, worst AS (
  SELECT terminal_id, fraud_probability, alert_tier FROM (
    SELECT *, row_number() OVER (PARTITION BY terminal_id
                                 ORDER BY fraud_probability DESC NULLS LAST, created_at, transaction_id) AS rn
    FROM alerts) WHERE rn = 1
), top AS (
  SELECT * FROM worst ORDER BY fraud_probability DESC NULLS LAST, terminal_id LIMIT 5
)
SELECT top.terminal_id,
       CASE WHEN t.terminal_id IS NULL THEN top.terminal_id ELSE t.terminal_name END AS terminal_name,
       top.fraud_probability, top.alert_tier
FROM top LEFT JOIN terminals t ON top.terminal_id = t.terminal_id"""),
    "terminal_status": with_ctes(f""",{TERMINAL_STATUS}
SELECT terminal_id, terminal_name, merchant_id, state, lga, {r6('lat')} AS lat, {r6('lon')} AS lon, operator,
       is_active, tier, alert_count, {r6(sql_round_half_up('p100', 1))} AS fraud_probability_pct,
       tier IS NOT NULL AS flagged,
       CASE tier WHEN 'critical' THEN '#d62728' WHEN 'high' THEN '#ff7f0e' WHEN 'medium' THEN '#ffd700'
                 WHEN 'low' THEN '#2ca02c' ELSE '#808080' END AS color_hex,
       coalesce(tier, 'none') AS tier_label, merchant_name
FROM status"""),
    "map_summary": with_ctes(f""",{TERMINAL_STATUS}
SELECT {r6('coalesce(avg(lat), 9.082e0)')} AS center_lat, {r6('coalesce(avg(lon), 8.6753e0)')} AS center_lon,
       count(*) FILTER (WHERE tier IS NOT NULL) AS flagged_terminals, count(*) AS total_terminals
FROM status"""),
}

FEATURES6 = ["velocity_1h", "geo_jump_km", "bin_spend_rate", "terminal_reversal_count", "amount_ngn",
             "amount_vs_bin_avg_ratio"]
CONTINUOUS4 = ["geo_jump_km", "bin_spend_rate", "amount_ngn", "amount_vs_bin_avg_ratio"]
CATEGORICAL3 = ["is_fraud", "velocity_1h", "terminal_reversal_count"]

LABELED = """
, lab AS (
  SELECT transaction_id, CAST(velocity_1h AS DOUBLE) AS velocity_1h, geo_jump_km, bin_spend_rate,
         CAST(terminal_reversal_count AS DOUBLE) AS terminal_reversal_count, amount_ngn, amount_vs_bin_avg_ratio,
         CAST(coalesce(is_fraud, false) AS INTEGER) AS is_fraud, ev_id
  FROM features_r
), real_rows AS (SELECT * FROM lab WHERE ev_id % 2 = 0),
synth_rows AS (SELECT * FROM lab WHERE ev_id % 2 = 1),
scored AS (
  SELECT s.*, t.is_fraud FROM scores s JOIN transactions t ON s.transaction_id = t.transaction_id
), score_counts AS (
  SELECT fraud_probability AS score, sum(CAST(is_fraud AS INTEGER)) AS pos, sum(1 - CAST(is_fraud AS INTEGER)) AS neg
  FROM scored GROUP BY 1
), desc_cum AS (
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         sum(pos) OVER () AS P
  FROM score_counts
)"""


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _two_sample(col: str) -> str:
    return f"""(SELECT v AS value, sum(c1) AS c1, sum(c2) AS c2 FROM (
      SELECT CAST({col} AS DOUBLE) AS v, 1 AS c1, 0 AS c2 FROM real_rows
      UNION ALL SELECT CAST({col} AS DOUBLE), 0, 1 FROM synth_rows) u
    WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY v)"""


def _ks(col: str) -> str:
    return f"""SELECT '{col}' AS column, {r6('max(abs(cc1 / n1 - cc2 / n2))')} AS ks,
       CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2
FROM (SELECT sum(c1) OVER w AS cc1, sum(c2) OVER w AS cc2, sum(c1) OVER () AS n1, sum(c2) OVER () AS n2
      FROM {_two_sample(col)} t WINDOW w AS (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _wasserstein(col: str) -> str:
    raw = "coalesce(sum(abs(cc1 / n1 - cc2 / n2) * (nv - value)), 0.0e0)"
    sd = f"(SELECT stddev_samp(CAST({col} AS DOUBLE)) FROM real_rows)"
    return f"""SELECT '{col}' AS column, {r6(raw)} AS raw_distance,
       {r6(f'CASE WHEN {sd} > 0 THEN {raw} / {sd} ELSE CAST(' + "'inf'" + ' AS DOUBLE) END')} AS normalized_score
FROM (SELECT value, lead(value) OVER (ORDER BY value) AS nv,
             sum(c1) OVER w AS cc1, sum(c2) OVER w AS cc2, sum(c1) OVER () AS n1, sum(c2) OVER () AS n2
      FROM {_two_sample(col)} t WINDOW w AS (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _chi(col: str) -> str:
    exp = "(CASE WHEN e = 0 THEN 1e-6 ELSE e END)"
    return f"""SELECT '{col}' AS column, {r6(f'sum(pow(c1 - {exp}, 2) / {exp})')} AS chi2_statistic,
       count(*) AS categories
FROM (SELECT c1, c2 / (sum(c2) OVER ()) * (sum(c1) OVER ()) AS e FROM {_two_sample(col)} t)"""


def _describe(col: str) -> str:
    return f"""SELECT '{col}' AS column, count({col}) AS count, {r6(f'avg({col})')} AS mean,
       {r6(f'stddev_samp({col})')} AS std, {r6(f'min({col})')} AS min,
       {r6(f'quantile_cont({col}, 0.25)')} AS p25, {r6(f'quantile_cont({col}, 0.5)')} AS p50,
       {r6(f'quantile_cont({col}, 0.75)')} AS p75, {r6(f'max({col})')} AS max
FROM lab"""


def _corr_pairs(cols):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            expr = r6(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))")
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {expr} AS corr FROM lab")
            if a != b:
                parts.append(f"SELECT '{b}' AS column_a, '{a}' AS column_b, {expr} AS corr FROM lab")
    return _union(parts)


def _mean_diff(col: str) -> str:
    rm, sm = f"(SELECT avg({col}) FROM real_rows)", f"(SELECT avg({col}) FROM synth_rows)"
    diff = f"CASE WHEN {rm} <> 0 THEN abs({rm} - {sm}) / abs({rm}) * 100.0e0 ELSE CAST('inf' AS DOUBLE) END"
    return f"""SELECT '{col}' AS column, {r6(rm)} AS real_mean, {r6(sm)} AS synthetic_mean,
       {r6(diff)} AS mean_pct_diff,
       CASE WHEN {diff} <= 10 THEN 'ok' WHEN {diff} <= 20 THEN 'warn' ELSE 'fail' END AS flag"""


ORACLES.update({
    "class_balance": with_ctes(f"{LABELED}\nSELECT is_fraud, count(*) AS n FROM lab GROUP BY is_fraud"),
    "missing_counts": with_ctes(LABELED + "\n" + _union([
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS missing FROM lab"
        for c in FEATURES6])),
    "describe_features": with_ctes(LABELED + "\n" + _union([_describe(c) for c in FEATURES6])),
    "correlation": with_ctes(LABELED + "\n" + _corr_pairs(FEATURES6 + ["is_fraud"])),
    "scale_pos_weight": with_ctes(f"""{LABELED}
SELECT CAST(sum(is_fraud) AS BIGINT) AS positives, CAST(sum(1 - is_fraud) AS BIGINT) AS negatives,
       {r6('CASE WHEN sum(is_fraud) = 0 THEN 1.0e0 ELSE sum(1 - is_fraud) / sum(is_fraud) END')} AS scale_pos_weight
FROM lab"""),
    "joint_counts": with_ctes(f"""{LABELED}
SELECT is_fraud, CAST(terminal_reversal_count AS BIGINT) AS terminal_reversal_count,
       CAST(velocity_1h AS BIGINT) AS velocity_1h, CAST(geo_jump_km > 0 AS INTEGER) AS has_geo_jump, count(*) AS n
FROM lab GROUP BY ALL"""),
    "dataset_rates": with_ctes(f"""{LABELED}
SELECT 'real' AS dataset, count(*) AS n, CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS n_fraud,
       {r6('avg(CAST(is_fraud AS DOUBLE))')} AS fraud_rate FROM real_rows
UNION ALL
SELECT 'synthetic', count(*), CAST(coalesce(sum(is_fraud), 0) AS BIGINT), {r6('avg(CAST(is_fraud AS DOUBLE))')}
FROM synth_rows"""),
    "binary_metrics": with_ctes(f"""{LABELED}
SELECT 0.5e0 AS threshold, tp, fp, fn,
       {r6('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END')} AS precision,
       {r6('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END')} AS recall,
       {r6('CASE WHEN tp > 0 THEN 2.0e0 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) ELSE 0.0e0 END')} AS f1
FROM (SELECT CAST(count(*) FILTER (WHERE fraud_probability >= 0.5e0 AND is_fraud) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE fraud_probability >= 0.5e0 AND NOT is_fraud) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE fraud_probability < 0.5e0 AND is_fraud) AS BIGINT) AS fn
      FROM scored)"""),
    "best_threshold": with_ctes(f"""{LABELED}
, f AS (SELECT score, tp / (tp + fp) AS precision, tp / P AS recall,
               2 * (tp / (tp + fp)) * (tp / P) / (tp / (tp + fp) + tp / P + 1e-12) AS f1 FROM desc_cum)
SELECT {r6('score')} AS threshold, {r6('f1')} AS f1, {r6('precision')} AS precision, {r6('recall')} AS recall
FROM f ORDER BY f1 DESC, score ASC LIMIT 1"""),
    "roc_auc": with_ctes(f"""{LABELED}
SELECT {r6('sum(pos * (below + neg / 2.0e0)) / (sum(pos) * sum(neg))')} AS roc_auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS below FROM score_counts)"""),
    "average_precision": with_ctes(f"""{LABELED}
SELECT {r6('sum(pos * (tp / (tp + fp))) / sum(pos)')} AS average_precision, CAST(sum(pos) AS BIGINT) AS positives
FROM desc_cum"""),
    "precision_at_k": with_ctes(f"""{LABELED}
, k AS (SELECT CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS k FROM scored)
SELECT {r6('avg(CAST(is_fraud AS INTEGER))')} AS precision_at_k, (SELECT k FROM k) AS k
FROM (SELECT is_fraud FROM scored ORDER BY 1.0e0 - fraud_probability, transaction_id
      LIMIT (SELECT k FROM k))"""),
    "summary_diff": with_ctes(LABELED + "\n" + _union([_mean_diff(c) for c in FEATURES6])),
    "ks_2samp": with_ctes(LABELED + "\n" + _union([_ks(c) for c in CONTINUOUS4])),
    "wasserstein": with_ctes(LABELED + "\n" + _union([_wasserstein(c) for c in CONTINUOUS4])),
    "chi_square_stat": with_ctes(LABELED + "\n" + _union([_chi(c) for c in CATEGORICAL3])),
})


#: Greatest event time (ms) less an hour's wait: seconds before it went out.
CLOCK = "CAST(floor((max(epoch_us(timestamp)) // 1000 - 3600000) / 1000) AS BIGINT)"

STREAM_CORRECTED = FEATURES_FULL.rstrip() + f"""
WHERE epoch_us(timestamp) // 1000000 < (SELECT {CLOCK} FROM transactions)"""

# every slice's state: windows over what has come, and whether a second is out
STREAM_CORRECTIONS = with_ctes(f"""
, come AS (
  SELECT *, sec // {5 * 86400} + CASE WHEN ev_id % 8 = 3 THEN 1 ELSE 0 END AS slice FROM tx_all),
clocks AS (
  SELECT slice, max(clock) OVER (ORDER BY slice) AS clock, max(clock) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT slice, {CLOCK} AS clock FROM come GROUP BY slice)),
-- by run: the rows that had come by then
held AS (
  SELECT c.slice AS run, c.clock, c.before, t.terminal_id, t.card_bin, t.sec, t.timestamp, t.transaction_id, t.slice, t.latitude, t.longitude,
         CAST(round(t.amount_ngn * 1000000) AS HUGEINT) AS amount, t.amount_ngn IS NOT NULL AS has, CASE WHEN t.fraud_type = 'fake_reversal' THEN 1 ELSE 0 END AS rev
  FROM clocks c JOIN come t ON t.slice <= c.slice),
w AS (
  SELECT *, count(*) OVER (PARTITION BY run, terminal_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS velocity,
         sum(rev) OVER (PARTITION BY run, terminal_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS reversals,
         count(amount) OVER (PARTITION BY run, card_bin ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n,
         sum(amount) OVER (PARTITION BY run, card_bin ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS s,
         lag(latitude) OVER (PARTITION BY run, terminal_id ORDER BY timestamp, transaction_id) AS p_lat,
         lag(longitude) OVER (PARTITION BY run, terminal_id ORDER BY timestamp, transaction_id) AS p_lon
  FROM held),
jump AS (SELECT *, CASE WHEN p_lat IS NOT NULL THEN {haversine('p_lat', 'p_lon', 'latitude', 'longitude')} ELSE 0.0e0 END AS geo FROM w),
v AS (
  SELECT 'velocity_1h' AS feature, run, clock, before, terminal_id AS k, sec, '' AS id, min(slice) AS first_slice, any_value(velocity) AS a, 1 AS b FROM jump GROUP BY ALL
  UNION ALL SELECT 'terminal_reversal_count', run, clock, before, terminal_id, sec, '', min(slice), any_value(reversals), 1 FROM jump GROUP BY ALL
  UNION ALL SELECT 'bin_spend_rate', run, clock, before, card_bin, sec, '', min(slice), any_value(s), any_value(n) FROM jump GROUP BY ALL
  UNION ALL SELECT 'geo_jump_km', run, clock, before, terminal_id, sec, transaction_id, slice, CAST(round(geo * 1000000) AS HUGEINT), 1 FROM jump),
-- values that are out at the end of a run, and those of the run before
o AS (
  SELECT *, lag(a) OVER (PARTITION BY feature, k, sec, id ORDER BY run) AS pa, lag(b) OVER (PARTITION BY feature, k, sec, id ORDER BY run) AS pb,
         lag(run) OVER (PARTITION BY feature, k, sec, id ORDER BY run) AS was
  FROM v WHERE sec < clock)
SELECT feature, count(*) FILTER (was IS NULL) AS n_first,
       count(*) FILTER (was IS NULL AND first_slice = run AND sec < before) AS n_late,
       count(*) FILTER (was IS NOT NULL AND a * pb <> pa * b) AS n_corrections
FROM o GROUP BY feature""")

ORACLES.update({
    "stream_features_state": FEATURES_FULL,
    "stream_corrected_features": STREAM_CORRECTED,
    "stream_corrections": STREAM_CORRECTIONS,
    "stream_features_microbatch": with_ctes(f"""
, sl AS (SELECT *, sec // {5 * 86400} AS slice FROM tx_all),
slp AS (
  SELECT *,
         lag(latitude) OVER (PARTITION BY slice, terminal_id ORDER BY timestamp, transaction_id) AS p_lat,
         lag(longitude) OVER (PARTITION BY slice, terminal_id ORDER BY timestamp, transaction_id) AS p_lon,
         avg(amount_ngn) OVER (PARTITION BY slice, card_bin ORDER BY sec
                               RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS rate
  FROM sl
)
SELECT transaction_id, terminal_id, card_bin, {r6('amount_ngn')} AS amount_ngn,
       count(transaction_id) OVER (PARTITION BY slice, terminal_id ORDER BY sec
                                   RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS velocity_1h,
       {r6(f"CASE WHEN p_lat IS NOT NULL THEN {haversine('p_lat', 'p_lon', 'latitude', 'longitude')} ELSE 0.0e0 END")}
         AS geo_jump_km,
       {r6('rate')} AS bin_spend_rate,
       CAST(sum(CASE WHEN fraud_type = 'fake_reversal' THEN 1 ELSE 0 END)
            OVER (PARTITION BY slice, terminal_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)
            AS BIGINT) AS terminal_reversal_count,
       {r6('CASE WHEN rate = 0 THEN NULL ELSE amount_ngn / rate END')} AS amount_vs_bin_avg_ratio,
       timestamp
FROM slp"""),
    "stream_alerts": with_ctes("SELECT * FROM alerts"),
    "json_roundtrip": with_ctes(f"""
SELECT transaction_id, terminal_id, merchant_id, card_bin, {r6('amount_ngn')} AS amount_ngn, state, lga,
       {r6('latitude')} AS latitude, {r6('longitude')} AS longitude, timestamp, is_fraud, fraud_type
FROM transactions"""),
    "keyed_json": with_ctes("SELECT transaction_id AS key, alert_tier, fraud_probability FROM scores"),
})


def _dist(col: str) -> str:
    return f"""SELECT \"column\", dataset, bin, {r6('lo + bin * w')} AS bin_lo, {r6('lo + (bin + 1) * w')} AS bin_hi, n,
       {r6('CASE WHEN w > 0 THEN n / (sum(n) OVER (PARTITION BY \"column\", dataset)) / w END')} AS density
FROM (SELECT '{col}' AS column, dataset,
             CAST(CASE WHEN w > 0 THEN least(19, floor((v - lo) / w)) ELSE 0 END AS INTEGER) AS bin,
             lo, w, count(*) AS n
      FROM (SELECT dataset, v, min(v) OVER () AS lo, (max(v) OVER () - min(v) OVER ()) / 20.0e0 AS w
            FROM (SELECT 'real' AS dataset, CAST({col} AS DOUBLE) AS v FROM real_rows
                  UNION ALL SELECT 'synthetic', CAST({col} AS DOUBLE) FROM synth_rows)
            WHERE v IS NOT NULL AND NOT isnan(v))
      GROUP BY ALL)"""


ORACLES.update({
    "distribution_tables": with_ctes(LABELED + "\n" + _union([_dist(c) for c in FEATURES6])),
    "scoring_request": with_ctes(f"""
SELECT transaction_id, terminal_id, velocity_1h, {r6('geo_jump_km')} AS geo_jump_km,
       {r6('bin_spend_rate')} AS bin_spend_rate, terminal_reversal_count, {r6('amount_ngn')} AS amount_ngn, timestamp,
       {r6('CASE WHEN bin_spend_rate <= 0 THEN 0.0e0 ELSE amount_ngn / bin_spend_rate END')} AS amount_vs_bin_avg_ratio
FROM features_r"""),
    "stream_scores": with_ctes("SELECT * FROM scores"),
})


def _dnnr() -> str:
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES6)
    z = ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in FEATURES6)
    dist = "sqrt(" + " + ".join(f"pow(a.z_{c} - b.z_{c}, 2)" for c in FEATURES6) + ")"
    return f"""
, st AS (SELECT {st} FROM real_rows),
zr AS (SELECT ev_id, {z} FROM real_rows, st),
zs AS (SELECT ev_id, {z} FROM synth_rows, st),
dsr AS (SELECT a.ev_id, min({dist}) AS d FROM zs a, zr b GROUP BY a.ev_id),
drr AS (SELECT a.ev_id, min({dist}) AS d FROM zr a, zr b WHERE a.ev_id <> b.ev_id GROUP BY a.ev_id),
med AS (SELECT (SELECT median(d) FROM dsr) AS sr, (SELECT median(d) FROM drr) AS rr)
SELECT {r6('sr')} AS median_d_sr, {r6('rr')} AS median_d_rr, {r6('sr / rr')} AS dnnr,
       CASE WHEN sr / rr > 1.5 THEN 'privacy_preserved' WHEN sr / rr > 1.0 THEN 'borderline'
            ELSE 'memorization_risk' END AS interpretation
FROM med"""


ORACLES["dnnr"] = with_ctes(LABELED + _dnnr())


def _eda() -> str:
    parts = ["SELECT 'rows' AS section, 'all' AS key, 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lab",
             "SELECT 'class_balance', CAST(is_fraud AS VARCHAR), 'n', CAST(count(*) AS DOUBLE) FROM lab GROUP BY is_fraud"]
    for c in FEATURES6:
        parts.append(f"SELECT 'missing', '{c}', 'n', CAST(count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS DOUBLE) "
                     f"FROM lab")
    for c in FEATURES6:
        for m, e in (("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
                     ("min", f"min({c})"), ("p25", f"quantile_cont({c}, 0.25)"), ("p50", f"quantile_cont({c}, 0.5)"),
                     ("p75", f"quantile_cont({c}, 0.75)"), ("max", f"max({c})")):
            parts.append(f"SELECT 'describe', '{c}', '{m}', {r6(e)} FROM lab")
    cols = FEATURES6 + ["is_fraud"]
    for a in cols:
        for b in cols:
            parts.append(f"SELECT 'correlation', '{a}|{b}', 'pearson', "
                         f"{r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} FROM lab")
    return "\n" + _union(parts)


ORACLES["eda_report"] = with_ctes(LABELED + _eda())


def _checks(level: str, metric: str, value: str, cols, one) -> list[str]:
    return [f"SELECT '{level}' AS level, q.\"column\" AS column, '{metric}' AS metric, CAST(q.{value} AS DOUBLE) AS value FROM ({one(c)}) q" for c in cols]


ORACLES.update({
    "alert_stream_read": with_ctes("SELECT * FROM alerts"),
    **{name: ORACLES["json_roundtrip"] for name in ("transactions_from_json", "transactions_from_table", "keyed_records", "stream_deduplicated")},
    "alerts_with_defaults": with_ctes("""
SELECT alert_id, transaction_id, terminal_id, merchant_id, card_bin, fraud_probability, alert_tier, CAST(NULL AS VARCHAR) AS state, true AS created_at
FROM alerts"""),
    "zero_jump_features": with_ctes(f"""{LABELED}
SELECT {", ".join(f"{r6(c)} AS {c}" for c in FEATURES6 if c != 'geo_jump_km')}, is_fraud,
       {r6('CASE WHEN ev_id % 3 = 0 THEN geo_jump_km ELSE 0.0e0 END')} AS geo_jump_km FROM lab"""),
    "forest_training_rows": with_ctes(f"""{LABELED}
SELECT CAST(velocity_1h AS BIGINT) AS velocity_1h, count(*) AS n, 0 AS n_fraud FROM lab WHERE is_fraud = 0 GROUP BY 1"""),
    # the rows; their seeded order is the engine's own
    "deterministic_shuffle": with_ctes(LABELED + "\nSELECT transaction_id, " + ", ".join(f"{r6(c)} AS {c}" for c in FEATURES6) + ", is_fraud FROM lab"),
    # per class, 20 % of the real rows, then 20 % of what is left and the synthetic ones
    "training_pools": with_ctes(f"""{LABELED}
, n AS (SELECT is_fraud, count(*) FILTER (WHERE ev_id % 2 = 0) AS r, count(*) FILTER (WHERE ev_id % 2 = 1) AS s FROM lab GROUP BY is_fraud),
t AS (SELECT *, CAST(floor(0.2e0 * r + 0.5e0) AS BIGINT) AS test FROM n),
v AS (SELECT *, r - test + s AS rest, CAST(floor(0.2e0 * (r - test + s) + 0.5e0) AS BIGINT) AS val FROM t)
SELECT pool, is_fraud, n, 0 AS n_synthetic_in_test FROM (
  SELECT 'test' AS pool, is_fraud, test AS n FROM v UNION ALL SELECT 'val', is_fraud, val FROM v UNION ALL SELECT 'train', is_fraud, rest - val FROM v)
WHERE n > 0"""),
    "stratified_split": with_ctes(f"""{LABELED}
, n AS (SELECT is_fraud, count(*) AS n, CAST(floor(0.2e0 * count(*) + 0.5e0) AS BIGINT) AS test FROM lab GROUP BY is_fraud)
SELECT is_fraud, is_test, n FROM (SELECT is_fraud, true AS is_test, test AS n FROM n UNION ALL SELECT is_fraud, false, n - test FROM n) WHERE n > 0"""),
    "fitted_scores": with_ctes("""
SELECT transaction_id, true AS same_probability, true AS same_blend, true AS same_tier, true AS same_score FROM transactions"""),
    "gate_document": with_ctes(LABELED + "\n" + _union(
        _checks("level1", "mean_pct_diff", "mean_pct_diff", FEATURES6, _mean_diff) + _checks("level3a", "ks_statistic", "ks", CONTINUOUS4, _ks)
        + _checks("level3c", "normalized_score", "normalized_score", CONTINUOUS4, _wasserstein)
        + _checks("level3b", "chi2_statistic", "chi2_statistic", CATEGORICAL3, _chi)
        + ["SELECT 'gate', 'all', 'approved', 0.0e0", "SELECT 'gate', 'all', 'rows', 0.0e0"])),
})
