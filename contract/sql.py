"""The same results in SQL over the given tables."""

from __future__ import annotations

from contract.queries import (
    EVENT_CUT,
    EVENT_TEST,
    FIXED_BIAS,
    FIXED_THRESHOLD,
    FIXED_WEIGHTS,
    ORDER_CUTS,
    STEP_SHARES,
)

HALF = "sin(radians({b} - {a}) / 2)"


def _km(lat_1: str, lon_1: str, lat_2: str, lon_2: str) -> str:
    lat, lon = HALF.format(a=lat_1, b=lat_2), HALF.format(a=lon_1, b=lon_2)
    chord = f"{lat}*{lat} + cos(radians({lat_1}))*cos(radians({lat_2}))*{lon}*{lon}"
    return f"(2 * 6371.0 * asin(sqrt(CASE WHEN {chord} > 1.0 THEN 1.0 ELSE {chord} END)))"


EVENTS = """
k_events AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
tx AS (
  SELECT user_id AS card_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS tx_id, ts,
    epoch_us(ts) // 1000000 AS epoch_s, value AS amount, event_type AS category,
    'm' || k AS merchant,
    CAST(25 + k % 24 AS DOUBLE) AS merch_lat, CAST(-120 + (k * 7) % 46 AS DOUBLE) AS merch_lon,
    CAST(25 + user_id % 24 AS DOUBLE) AS home_lat,
    CAST(-120 + (user_id * 11) % 46 AS DOUBLE) AS home_lon,
    DATE '1950-01-01' + CAST((user_id * 97) % 18000 AS INTEGER) AS birth_date,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    1000 + (user_id * 37) % 100000 AS city_pop,
    (event_type = 'error' AND value > 100) AS is_fraud, value / (value + 100.0) AS score
  FROM k_events)"""

ORDERS = """
tx AS (
  SELECT o_custkey AS card_id, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS tx_id,
    o_orderdate AS ts, epoch_us(o_orderdate) // 1000000 AS epoch_s, o_totalprice AS amount,
    o_orderpriority AS category, CAST(25 + o_orderkey % 24 AS DOUBLE) AS merch_lat,
    CAST(-120 + (o_orderkey * 7) % 46 AS DOUBLE) AS merch_lon,
    o_orderstatus = 'F' AS is_fraud
  FROM orders)"""

EVENT_WINDOWS = {"cnt_10m": 600, "cnt_1h": 3600, "cnt_24h": 86400}
DAY_WINDOWS = {"cnt_7d": 7 * 86400, "cnt_30d": 30 * 86400, "cnt_90d": 90 * 86400}


def _history(source: str, windows: dict[str, int], where: str = "true") -> str:
    counts = ", ".join(
        f"count(*) OVER (PARTITION BY card_id ORDER BY epoch_s "
        f"RANGE BETWEEN {s} PRECEDING AND 1 PRECEDING) AS {n}"
        for n, s in windows.items()
    )
    km = _km("p_lat", "p_lon", "merch_lat", "merch_lon")
    return f"""WITH {source}, h AS (
  SELECT *, {counts},
    sum(amount) OVER past AS prior_amount, avg(amount) OVER past AS prior_avg,
    row_number() OVER (PARTITION BY card_id, category ORDER BY epoch_s, tx_id) = 1
      AS is_new_category,
    lag(merch_lat) OVER seq AS p_lat, lag(merch_lon) OVER seq AS p_lon,
    epoch_s - lag(epoch_s) OVER seq AS gap
  FROM tx
  WINDOW past AS (PARTITION BY card_id ORDER BY epoch_s
                  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         seq AS (PARTITION BY card_id ORDER BY epoch_s, tx_id))
SELECT card_id, tx_id, {", ".join(windows)}, round(prior_amount, 3) AS prior_amount,
  round(amount / prior_avg, 5) AS amount_ratio, is_new_category,
  round({km}, 4) AS prev_distance_km,
  round(CASE WHEN gap > 0 THEN {km} / (gap / 3600.0) END, 3) AS implied_speed_kmh
FROM h WHERE {where}"""


def _state(source: str, retention: int) -> str:
    return f"""WITH {source},
m AS (SELECT card_id, max(epoch_s) AS newest FROM tx GROUP BY card_id),
recent AS (
  SELECT tx.card_id, epoch_s, count(*) AS n, sum(amount) AS amount
  FROM tx JOIN m ON tx.card_id = m.card_id WHERE epoch_s >= newest - {retention}
  GROUP BY tx.card_id, epoch_s),
lists AS (
  SELECT card_id, string_agg(CAST(epoch_s AS VARCHAR), ',' ORDER BY epoch_s) AS recent_epochs,
    string_agg(CAST(n AS VARCHAR), ',' ORDER BY epoch_s) AS recent_counts,
    string_agg(CAST(CAST(round(amount * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY epoch_s)
      AS recent_cents
  FROM recent GROUP BY card_id),
ends AS (
  SELECT card_id, epoch_s AS last_epoch, tx_id AS last_tx_id, merch_lat AS last_lat,
    merch_lon AS last_lon
  FROM tx QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch_s DESC, tx_id DESC) = 1),
totals AS (
  SELECT card_id, count(*) AS n_total, round(sum(amount), 2) AS amount_total,
    string_agg(DISTINCT category, ',' ORDER BY category) AS categories_seen
  FROM tx GROUP BY card_id)
SELECT * FROM totals JOIN lists USING (card_id) JOIN ends USING (card_id)"""


def _requests() -> str:
    counts = ", ".join(
        f"count(*) FILTER (h.epoch_s >= r.epoch_s - {s} AND h.epoch_s < r.epoch_s) AS {n}"
        for n, s in EVENT_WINDOWS.items()
    )
    km = _km("last_lat", "last_lon", "merch_lat", "merch_lon")
    shown = ", ".join(
        f"CASE WHEN status <> 'conflict' THEN {n} ELSE -1 END AS {n}" for n in EVENT_WINDOWS
    )
    return f"""WITH {EVENTS},
h AS (SELECT * FROM tx WHERE ts < TIMESTAMP '{EVENT_CUT}'),
ends AS (
  SELECT card_id, epoch_s AS last_epoch, merch_lat AS last_lat, merch_lon AS last_lon
  FROM h QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch_s DESC, tx_id DESC) = 1),
a AS (
  SELECT r.tx_id, {counts}, sum(h.amount) FILTER (h.epoch_s < r.epoch_s) AS before,
    count(*) FILTER (h.epoch_s < r.epoch_s) AS n_before,
    coalesce(bool_or(h.category = r.category), false) AS seen
  FROM tx r LEFT JOIN h ON h.card_id = r.card_id GROUP BY r.tx_id),
s AS (
  SELECT *, epoch_s - last_epoch AS gap, CASE WHEN last_epoch IS NULL THEN 'new'
    WHEN epoch_s < last_epoch THEN 'conflict' ELSE 'ok' END AS status
  FROM tx LEFT JOIN ends USING (card_id) JOIN a USING (tx_id))
SELECT card_id, tx_id, status, last_epoch IS NOT NULL AS has_history, {shown},
  round(CASE WHEN status = 'ok' AND n_before > 0 THEN before END, 3) AS prior_amount,
  round(CASE WHEN status = 'ok' AND n_before > 0 THEN amount / (before / n_before) END, 5)
    AS amount_ratio,
  CASE WHEN status <> 'conflict' THEN CAST(NOT seen AS BIGINT) ELSE CAST(-1 AS BIGINT) END
    AS is_new_category,
  round(CASE WHEN status = 'ok' THEN {km} END, 4) AS prev_distance_km,
  round(CASE WHEN status = 'ok' AND gap > 0 THEN {km} / (gap / 3600.0) END, 3)
    AS implied_speed_kmh
FROM s"""


def _probability(share: str = "1.0") -> str:
    """The fixed model over columns of tx."""
    terms = " + ".join(
        f"{share} * {w!r} * {x.replace('hour', 'hour(ts)')}" for x, w in FIXED_WEIGHTS.items()
    )
    return f"(1 / (1 + exp(-({FIXED_BIAS!r} + {terms}))))"


VALIDATION = f"ts >= TIMESTAMP '{EVENT_CUT}' AND ts < TIMESTAMP '{EVENT_TEST}'"
CANDIDATES = (
    "SELECT CAST(i AS INTEGER) AS i, 0.01::DOUBLE + (i - 1) * 0.01::DOUBLE AS threshold "
    "FROM range(1, 100) r(i)"
)
COST = "sum(CASE WHEN {score} >= {threshold} THEN 10.0 WHEN is_fraud THEN amount ELSE 0 END)"

BOUNDS = "least(greatest(CAST(floor((amount - lo) / (hi - lo) * 50) AS INTEGER), 0), 49)"

SWEEP = """
c AS (SELECT CAST(i AS INTEGER) AS i, {threshold} AS threshold FROM range(1, 100) t(i)),
b AS (
  SELECT i, threshold, sum(CASE WHEN {score} >= threshold THEN 10.0
    WHEN is_fraud THEN amount ELSE 0 END) AS cost
  FROM tx CROSS JOIN c GROUP BY i, threshold)"""
GRID = "0.01::DOUBLE + (i - 1) * 0.01::DOUBLE"
LEVELS = "[" + ", ".join(repr(0.01 + i * 0.01) for i in range(99)) + "]"
PERCENTILES = f"(SELECT quantile_cont(amount, {LEVELS}) FROM tx)[i]"
SCORE_SWEEP = SWEEP.format(threshold=GRID, score="score")
AMOUNT_SWEEP = SWEEP.format(threshold=PERCENTILES, score="amount")

MESSAGE = """'{"id_transaccion":"' || tx_id || '","numero_tarjeta":' || card_id
  || ',"fecha_hora_transaccion":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","monto":' || amount
  || ',"categoria":"' || category || '","comercio":"' || merchant || '","genero":"' || gender
  || '","fecha_nacimiento":"' || strftime(birth_date, '%Y-%m-%d') || 'T00:00:00'
  || '","latitud_cliente":' || home_lat || ',"longitud_cliente":' || home_lon
  || ',"latitud_comercio":' || merch_lat || ',"longitud_comercio":' || merch_lon
  || ',"poblacion_ciudad":' || city_pop || '}'"""


FEATURES = [
    *EVENT_WINDOWS,
    "prior_amount",
    "amount_ratio",
    "is_new_category",
    "prev_distance_km",
    "implied_speed_kmh",
]
STATE_CELLS = [
    "n_total",
    "amount_total",
    "categories_seen",
    "last_epoch",
    "last_tx_id",
    "last_lat",
    "last_lon",
    "recent_seconds",
    "recent_amount",
]


def _audit(table: str, columns: dict[str, str]) -> str:
    """What a clean audit of `table` says; `columns` maps reported to stored names."""
    return f"WITH f AS ({table})" + " UNION ALL".join(
        f"""
SELECT '{shown}' AS "column", count(*) AS rows, CAST(0 AS BIGINT) AS missing_left,
  CAST(0 AS BIGINT) AS missing_right, CAST(0 AS BIGINT) AS different,
  count(DISTINCT {stored}) > 2 AS varies FROM f"""
        for shown, stored in columns.items()
    )


_history_events = _history(EVENTS, EVENT_WINDOWS)

SQL: dict[str, str] = {
    "history_features": _history_events,
    "history_features_ties": _history(ORDERS, DAY_WINDOWS),
    "row_features": f"""WITH {EVENTS}
SELECT tx_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  round((CAST(ts AS DATE) - birth_date) / 365.25, 6) AS age,
  round({_km("home_lat", "home_lon", "merch_lat", "merch_lon")}, 4) AS home_merchant_km
FROM tx""",
    "first_k_per_card": f"""WITH {ORDERS}
SELECT card_id, tx_id, epoch_s FROM tx
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch_s, tx_id) <= 3""",
    "position_in_card": f"""WITH {ORDERS}
SELECT card_id, tx_id,
  row_number() OVER (PARTITION BY card_id ORDER BY epoch_s, tx_id) - 1 AS position FROM tx""",
    "top_cards_by_span": f"""WITH {ORDERS}
SELECT card_id, count(*) AS n, max(epoch_s) - min(epoch_s) AS span_s FROM tx GROUP BY card_id
HAVING count(*) >= 3 ORDER BY span_s, card_id LIMIT 20""",
    "first_transactions": f"""WITH {EVENTS}
SELECT tx_id, epoch_s FROM tx ORDER BY ts, tx_id LIMIT 100""",
    "split_summary": f"""WITH {EVENTS}
SELECT CASE WHEN ts >= TIMESTAMP '{EVENT_TEST}' THEN 'test'
    WHEN ts < TIMESTAMP '{EVENT_CUT}' THEN 'train' ELSE 'validation' END AS split,
  count(*) AS n, round(avg(CAST(is_fraud AS INTEGER)) * 100, 6) AS fraud_pct
FROM tx GROUP BY 1""",
    "fraud_rate_by_category": f"""WITH {EVENTS}
SELECT category, round(avg(CAST(is_fraud AS INTEGER)) * 100, 6) AS fraud_pct
FROM tx GROUP BY category""",
    "fraud_rate_by_hour": f"""WITH {EVENTS}
SELECT CAST(hour(ts) AS INTEGER) AS hour,
  round(avg(CAST(is_fraud AS INTEGER)) * 100, 6) AS fraud_pct
FROM tx GROUP BY 1""",
    "amount_histogram": f"""WITH {EVENTS},
r AS (SELECT *, min(amount) OVER (PARTITION BY is_fraud) AS lo,
  max(amount) OVER (PARTITION BY is_fraud) AS hi FROM tx)
SELECT is_fraud, {BOUNDS} AS bin, count(*) AS n FROM r GROUP BY 1, 2""",
    "transactions_per_card": f"""WITH {EVENTS}
SELECT card_id, count(*) AS n FROM tx GROUP BY card_id""",
    "card_activity_summary": f"""WITH {EVENTS},
c AS (SELECT card_id, count(*) AS n FROM tx GROUP BY card_id)
SELECT count(*) AS cards, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
  min(n) AS min, round(quantile_cont(n, 0.25), 4) AS p25, round(quantile_cont(n, 0.5), 4) AS p50,
  round(quantile_cont(n, 0.75), 4) AS p75, max(n) AS max FROM c""",
    "card_state": _state(ORDERS, 90 * 86400),
    "recent_transactions": f"""WITH {ORDERS},
m AS (SELECT card_id, max(epoch_s) AS newest FROM tx GROUP BY card_id)
SELECT tx.card_id, tx_id, epoch_s, amount FROM tx JOIN m ON tx.card_id = m.card_id
WHERE epoch_s >= newest - {90 * 86400}""",
    "state_fold": _state(ORDERS, 90 * 86400),
    "request_features": _requests(),
    "request_checks": f"""WITH {EVENTS}
SELECT tx_id, CASE WHEN amount - 5 <= 0 THEN 'amount not positive'
  WHEN city_pop - 1500 <= 0 THEN 'city_pop not positive'
  WHEN category = 'view' THEN 'missing gender' END AS reject_reason FROM tx""",
    "asof_features": f"""WITH {EVENTS},
l AS (SELECT * FROM tx WHERE category = 'purchase'),
r AS (SELECT * FROM tx WHERE category = 'click')
SELECT l.card_id, l.tx_id, r.tx_id AS click_id, r.amount AS click_amount
FROM l ASOF LEFT JOIN r ON l.card_id = r.card_id AND l.ts >= r.ts""",
    "asof_ties": f"""WITH {ORDERS}
SELECT l.card_id, l.tx_id, r.tx_id AS match_id
FROM tx l LEFT JOIN (SELECT * FROM tx WHERE is_fraud) r
  ON l.card_id = r.card_id AND r.ts <= l.ts
QUALIFY row_number() OVER (PARTITION BY l.card_id, l.tx_id ORDER BY r.ts DESC NULLS LAST,
  (r.ts = l.ts AND r.tx_id = l.tx_id) DESC, r.tx_id DESC) = 1""",
    "training_set": _history_events,
    "latest_per_card": f"""WITH {EVENTS}
SELECT card_id, tx_id, amount, category FROM tx WHERE ts < TIMESTAMP '{EVENT_TEST}'
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY ts DESC, tx_id DESC) = 1""",
    "semi_anti_cards": f"""WITH {ORDERS},
known AS (SELECT DISTINCT card_id FROM tx WHERE ts < TIMESTAMP '{ORDER_CUTS[0]}')
SELECT c_custkey AS card_id, 'with_state' AS kind FROM customer
WHERE EXISTS (SELECT 1 FROM known WHERE card_id = c_custkey)
UNION ALL SELECT c_custkey, 'without_state' FROM customer
WHERE NOT EXISTS (SELECT 1 FROM known WHERE card_id = c_custkey)
UNION ALL SELECT DISTINCT card_id, 'new' FROM tx
WHERE ts >= TIMESTAMP '{ORDER_CUTS[0]}' AND card_id NOT IN (SELECT card_id FROM known)""",
    "event_export": f"""WITH {EVENTS}
SELECT CAST(card_id AS VARCHAR) AS key, {MESSAGE} AS value FROM tx""",
    "message_parse": f"""WITH {EVENTS}
SELECT card_id, tx_id, epoch_s, amount, category, merch_lat, merch_lon FROM tx
WHERE category NOT IN ('view', 'signup', 'click')""",
    "message_rejects": f"""WITH {EVENTS}
SELECT count(*) AS n, count(*) FILTER (category IN ('view', 'signup', 'click')) AS rejected
FROM tx""",
    "business_cost": f"""WITH {EVENTS}
SELECT 'amount' AS rule, round(sum(CASE WHEN amount >= 150 THEN 10.0 WHEN is_fraud THEN amount
  ELSE 0 END), 2) AS cost FROM tx
UNION ALL SELECT 'score', round(sum(CASE WHEN score >= 0.4 THEN 10.0 WHEN is_fraud THEN amount
  ELSE 0 END), 2) FROM tx""",
    "threshold_sweep": f"""WITH {EVENTS}, {SCORE_SWEEP}
SELECT i, round(threshold, 6) AS threshold, round(cost, 2) AS cost FROM b""",
    "best_threshold": f"""WITH {EVENTS}, {SCORE_SWEEP}
SELECT round(threshold, 6) AS threshold, round(cost, 2) AS cost FROM b
ORDER BY b.cost, i LIMIT 1""",
    "amount_rule_sweep": f"""WITH {EVENTS}, {AMOUNT_SWEEP}
SELECT i, round(threshold, 6) AS threshold, round(cost, 2) AS cost FROM b""",
    "average_precision": f"""WITH {EVENTS},
g AS (SELECT score, sum(CAST(is_fraud AS INTEGER)) AS tp, count(*) AS n FROM tx GROUP BY score),
c AS (SELECT tp, sum(tp) OVER w AS cum_tp, sum(n) OVER w AS cum_n FROM g
  WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(tp * (cum_tp / cum_n)) / sum(tp), 9) AS average_precision FROM c""",
    "champion_report": f"""WITH {EVENTS},
s AS (WITH {SCORE_SWEEP} SELECT min(cost) AS cost FROM b),
a AS (WITH {AMOUNT_SWEEP} SELECT min(cost) AS cost FROM b),
f AS (SELECT sum(CASE WHEN amount >= 250 THEN 10.0 WHEN is_fraud THEN amount ELSE 0 END) AS cost
  FROM tx),
m AS (SELECT 'score' AS model, cost FROM s UNION ALL SELECT 'amount', cost FROM a)
SELECT m.model AS best_model, round(m.cost, 2) AS best_cost, 'fixed' AS champion_model,
  round(f.cost, 2) AS champion_cost, m.cost < f.cost AS promote
FROM m CROSS JOIN f ORDER BY m.cost, m.model LIMIT 1""",
    "class_weights": f"""WITH {EVENTS},
c AS (SELECT CAST(is_fraud AS INTEGER) AS label, count(*) AS n FROM tx GROUP BY 1)
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight,
  round((SELECT sum(n) FILTER (label = 0) / greatest(sum(n) FILTER (label = 1), 1) FROM c), 9)
    AS positive_ratio
FROM c""",
    "standardize": f"""WITH {EVENTS},
f AS (SELECT avg(amount) AS m1, stddev_pop(amount) AS s1, avg(city_pop) AS m2,
    stddev_pop(city_pop) AS s2, avg(merch_lat) AS m3, stddev_pop(merch_lat) AS s3
  FROM tx WHERE ts < TIMESTAMP '{EVENT_CUT}')
SELECT tx_id, round((amount - m1) / s1, 6) AS z_amount, round((city_pop - m2) / s2, 6) AS z_city_pop,
  round((merch_lat - m3) / s3, 6) AS z_merch_lat
FROM tx CROSS JOIN f""",
    "vocabulary_index": f"""WITH {EVENTS},
v AS (SELECT category, row_number() OVER (ORDER BY category) AS i FROM
  (SELECT DISTINCT category FROM tx WHERE NOT is_fraud AND category <> 'signup'))
SELECT tx_id, tx.category, CAST(coalesce(i, 0) AS INTEGER) AS category_index
FROM tx LEFT JOIN v ON tx.category = v.category""",
    "feature_parity_audit": _audit(_history_events, {c: c for c in FEATURES}),
    "request_parity_audit": _audit(
        _history(EVENTS, EVENT_WINDOWS, f"ts >= TIMESTAMP '{EVENT_CUT}'")
        + " QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch_s, tx_id) = 1",
        {c: c for c in FEATURES},
    ),
    "state_parity_audit": _audit(
        _state(ORDERS, 90 * 86400),
        {c: {"recent_seconds": "recent_epochs", "recent_amount": "recent_cents"}.get(c, c)
         for c in STATE_CELLS},
    ),
    "csv_load": f"""WITH {EVENTS}
SELECT tx_id, card_id, epoch_s, strftime(birth_date, '%Y-%m-%d') AS birth_date, amount,
  category, 'job, ' || card_id AS job, city_pop, merch_lon,
  CAST(is_fraud AS INTEGER) AS is_fraud FROM tx""",
    "feature_table": _history_events,
    "state_snapshot": _state(ORDERS, 90 * 86400),
    "stream_state": _state(EVENTS, 86400),
    "stream_small_batches": _state(EVENTS, 86400),
    "stream_features": _history(EVENTS, EVENT_WINDOWS, f"ts >= TIMESTAMP '{EVENT_CUT}'"),
    "stream_audit": f"""SELECT CAST(run AS BIGINT) AS run, count(*) AS rows,
  CAST(0 AS BIGINT) AS rejected,
  CASE WHEN run = 1 THEN CAST(0 AS BIGINT) ELSE count(*) END AS late_or_repeated
FROM events CROSS JOIN (VALUES (1), (2)) v(run)
WHERE ts >= TIMESTAMP '{EVENT_CUT}' GROUP BY run""",
    "stateful_states": _state(EVENTS, 86400),
    "model_matrix": f"""WITH {EVENTS}
SELECT amount, CAST(hour(ts) AS DOUBLE) AS hour, CAST(isodow(ts) - 1 AS DOUBLE) AS weekday,
  round((CAST(ts AS DATE) - birth_date) / 365.25, 6) AS age,
  round({_km("home_lat", "home_lon", "merch_lat", "merch_lon")}, 4) AS home_merchant_km,
  CAST(city_pop AS DOUBLE) AS city_pop, category, gender FROM tx""",
    "rule_baseline": f"""WITH {EVENTS},
v AS (SELECT * FROM tx WHERE {VALIDATION}),
t AS (SELECT i, (SELECT quantile_cont(amount, {LEVELS}) FROM v)[i] AS threshold
  FROM ({CANDIDATES})),
c AS (SELECT i, threshold, {COST.format(score="amount", threshold="threshold")} AS cost
  FROM v CROSS JOIN t GROUP BY i, threshold),
b AS (SELECT * FROM c ORDER BY cost, i LIMIT 1)
SELECT 'amount_rule' AS model, round(threshold, 6) AS threshold, round(cost, 2) AS validation_cost,
  round((SELECT {COST.format(score="amount", threshold="(SELECT threshold FROM b)")}
    FROM tx WHERE ts >= TIMESTAMP '{EVENT_TEST}'), 2) AS test_cost FROM b""",
    "candidate_metrics": f"""WITH {EVENTS},
p AS (SELECT *, {_probability()} AS p FROM tx),
c AS (SELECT i, threshold, {COST.format(score="p", threshold="threshold")} AS cost
  FROM (SELECT * FROM p WHERE {VALIDATION}) CROSS JOIN ({CANDIDATES}) GROUP BY i, threshold),
b AS (SELECT * FROM c ORDER BY cost, i LIMIT 1),
s AS (SELECT * FROM p WHERE ts >= TIMESTAMP '{EVENT_TEST}'),
g AS (SELECT p, sum(CAST(is_fraud AS INTEGER)) AS tp, count(*) AS n FROM s GROUP BY p),
w AS (SELECT tp, sum(tp) OVER o AS cum_tp, sum(n) OVER o AS cum_n FROM g
  WINDOW o AS (ORDER BY p DESC))
SELECT 'fixed' AS model, round(threshold, 6) AS threshold, round(cost, 2) AS validation_cost,
  round((SELECT {COST.format(score="p", threshold="(SELECT threshold FROM b)")} FROM s), 2)
    AS test_cost,
  round((SELECT sum(tp * (cum_tp / cum_n)) / sum(tp) FROM w), 9) AS pr_auc FROM b""",
    "choice_by_cost": f"""WITH {EVENTS},
steps AS (SELECT unnest({STEP_SHARES}) AS share, unnest(range(1, {len(STEP_SHARES) + 1})) AS step),
p AS (SELECT step, amount, is_fraud, {_probability("share")} AS p
  FROM tx CROSS JOIN steps WHERE {VALIDATION}),
c AS (SELECT step, i, threshold, {COST.format(score="p", threshold="threshold")} AS cost
  FROM p CROSS JOIN ({CANDIDATES}) GROUP BY step, i, threshold),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY step ORDER BY cost, i) = 1)
SELECT CAST(step AS INTEGER) AS step, round(threshold, 6) AS threshold, round(cost, 2) AS cost,
  row_number() OVER (ORDER BY cost, step) = 1 AS chosen FROM b""",
    "decision_records": f"""WITH {EVENTS},
known AS (SELECT card_id, max(epoch_s) AS last_epoch FROM tx
  WHERE ts < TIMESTAMP '{EVENT_TEST}' GROUP BY card_id),
s AS (SELECT *, {_probability()} AS p, CASE WHEN last_epoch IS NULL THEN 'new'
    WHEN epoch_s < last_epoch THEN 'conflict' ELSE 'ok' END AS status
  FROM tx LEFT JOIN known USING (card_id) WHERE ts >= TIMESTAMP '{EVENT_CUT}')
SELECT card_id, tx_id, status, last_epoch IS NOT NULL AS has_history,
  CASE WHEN status <> 'conflict' THEN round(p, 6) END AS probability,
  CASE WHEN status <> 'conflict' THEN p >= {FIXED_THRESHOLD} END AS decision,
  CAST({FIXED_THRESHOLD} AS DOUBLE) AS threshold, 'fixed-1' AS model_version FROM s""",
    "stream_scores": f"""WITH {EVENTS},
s AS (SELECT *, {_probability()} AS p,
    row_number() OVER (PARTITION BY card_id ORDER BY epoch_s, tx_id) > 1 AS has_history FROM tx)
SELECT card_id, tx_id, CASE WHEN has_history THEN 'ok' ELSE 'new' END AS status, has_history,
  CAST(NULL AS VARCHAR) AS reject_reason, round(p, 6) AS probability,
  p >= {FIXED_THRESHOLD} AS decision, CAST({FIXED_THRESHOLD} AS DOUBLE) AS threshold,
  'fixed-1' AS model_version
FROM s WHERE ts >= TIMESTAMP '{EVENT_CUT}'""",
    "batch_cards": f"""WITH {EVENTS},
w AS (SELECT 0 AS batch_id, * FROM tx WHERE {VALIDATION}
  UNION ALL SELECT b, tx.* FROM tx CROSS JOIN (VALUES (1), (2)) v(b)
  WHERE ts >= TIMESTAMP '{EVENT_TEST}')
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS rows, CAST(0 AS BIGINT) AS rejected,
  count(DISTINCT card_id) AS cards,
  CASE WHEN batch_id = 2 THEN count(*) ELSE CAST(0 AS BIGINT) END AS late_or_repeated,
  CASE WHEN batch_id = 2 THEN CAST(0 AS BIGINT) ELSE count(DISTINCT card_id) END AS cards_changed
FROM w GROUP BY batch_id""",
    "missing_states": "SELECT count(*) AS cards, true AS failed FROM customer",
}
