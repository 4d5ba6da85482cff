"""The whole jobs of ``job_queries`` as SQL over the given tables."""

from __future__ import annotations

from streamscreen.plans.oracle import (
    _ALERTS,
    _HOT_TX,
    _NEWEST,
    _NUM,
    _R1,
    _R1_RISK,
    _R2_RISK,
    _R4,
    _R5_RISK,
    _SCORED,
    _SCREENED,
    _TX,
    _WORDS,
    DAY,
    HOUR,
    _history,
    _round,
    _rule,
    _total,
    chained,
)


def _money(amount: str) -> str:
    return "format('${:,.2f}', " + amount + ")"


def _stamped(details: str) -> str:
    return f", {details} AS details, CAST(1700000000000 AS BIGINT) AS alert_time"


_COMPLETE = f"txc AS (SELECT * FROM tx WHERE merchant <> 'signup'), {_history(12 * HOUR).replace('FROM tx)', 'FROM txc)')}"
_SPEND = f"""spend AS (
  SELECT last(transaction_id ORDER BY t NULLS FIRST, transaction_id) AS transaction_id, customer_id,
         {_total('amount')} AS amount, last(city ORDER BY t NULLS FIRST, transaction_id) AS city, max(t) AS event_time,
         count(*) AS n, ms // {DAY} * {DAY} AS a
  FROM (SELECT *, event_time AS ms, CASE WHEN merchant <> 'signup' THEN event_time END AS t FROM tx)
  GROUP BY customer_id, ms // {DAY})"""


def _night(source: str) -> str:
    return _rule("R4", "Unusual Hour + High Amount", "CAST(70 AS DOUBLE)", source, "hour BETWEEN 1 AND 4 AND amount > 3000",
                 _stamped(_money("amount") + " || ' transaction at ' || format('{:02d}:00', hour)"))


_FRAUD = [
    _rule("R1", "High-Value Transaction", _R1_RISK, "txc", "amount > 10000",
          _stamped(f"'Amount ' || {_money('amount')} || ' exceeds $10,000 threshold'")),
    _rule("R2", "High Transaction Velocity", _R2_RISK, "hist", "recent_count > 5",
          _stamped("recent_count || ' transactions in the last 43200 seconds'")),
    _rule("R3", "High Aggregate Spend", f"least({_NUM}, 60 + (amount - 20000) / 1000)", "spend", "amount > 20000",
          _stamped(f"n || ' transactions totalling ' || {_money('amount')} || ' in 1 day window [' || a || ' - ' || (a + {DAY}) || ']'")),
    _night("txc"),
    _rule("R5", "Rapid Amount Escalation", _R5_RISK, "hist", "previous_amount > 0 AND amount / previous_amount > 3",
          _stamped(_money("amount") + " || ' is ' || format('{:.1f}', " + _round("amount / previous_amount", 1)
                   + ") || 'x previous ' || " + _money("previous_amount"))),
]
_JOB = (f"WITH {_TX}, {_COMPLETE}, {_SPEND} SELECT 'fraud-alerts' AS topic, CAST(NULL AS VARCHAR) AS key, * FROM ("
        + " UNION ALL ".join(_FRAUD) + ")")
_RECENT = f"WITH {_ALERTS}, recent AS ({_NEWEST} 500)"
_HALF = "half AS (SELECT min(epoch_us(ts) // 1000) AS a, max(epoch_us(ts) // 1000) AS z FROM events)"
_ODD = """odd AS (
  SELECT *, 'T' || event_id AS transaction_id, 'C' || user_id AS customer_id, epoch_us(ts) // 1000 AS ms,
    CASE event_type WHEN 'error' THEN 1e300 WHEN 'signup' THEN NULL ELSE value END AS amount FROM events)"""
_FILES = f"""{_SCORED}, numbered AS (
  SELECT id, row_number() OVER (PARTITION BY merchant_id ORDER BY id) + 1 AS row FROM pay)"""


_LIVE = f"""WITH {_TX}, alerts AS (SELECT *, event_time AS alert_time FROM ({_R1} UNION ALL {_R4})),
span AS (SELECT min(epoch_us(ts) // 1000) AS a, max(epoch_us(ts) // 1000) AS z FROM events),
so_far AS (
  SELECT CAST(p AS BIGINT) AS batch, alerts.*,
         row_number() OVER (PARTITION BY p ORDER BY alert_time DESC, transaction_id DESC, rule_id DESC) AS place
  FROM range(4) t(p), span, alerts WHERE p = 3 OR alert_time <= a + (z - a) * (p + 1) // 4),
newest AS (SELECT * FROM so_far WHERE place <= 500),
customers AS (
  SELECT batch, customer_id, count(*) AS alert_count, {_round('max(risk_score)', 1)} AS max_risk, {_round('avg(risk_score)', 1)} AS avg_risk,
         row_number() OVER (PARTITION BY batch ORDER BY {_round('max(risk_score)', 1)} DESC,
                            min((alert_time, transaction_id, rule_id)), customer_id) AS place
  FROM newest GROUP BY batch, customer_id),
grid AS (SELECT batch, (max(alert_time) // 60000 - i) * 60000 AS minute_ms FROM so_far, range(1, 31) t(i) GROUP BY batch, i),
minutes AS (SELECT grid.batch, minute_ms, count(alert_time) AS n FROM grid LEFT JOIN so_far
            ON grid.batch = so_far.batch AND alert_time // 60000 * 60000 = minute_ms GROUP BY grid.batch, minute_ms),
totals AS (SELECT batch, count(*) AS total, {_round('avg(risk_score)', 1)} AS risk, count(*) FILTER (WHERE risk_score >= 80) AS high,
                  count(DISTINCT customer_id) AS customers, count(DISTINCT rule_id) AS rules FROM newest GROUP BY batch)
SELECT batch, figure, key, CAST(value AS DOUBLE) AS value FROM (
  SELECT batch, 'total_alerts' AS figure, '' AS key, total AS value FROM totals
  UNION ALL SELECT batch, 'avg_risk_score', '', risk FROM totals UNION ALL SELECT batch, 'high_risk_count', '', high FROM totals
  UNION ALL SELECT batch, 'flagged_customers', '', customers FROM totals UNION ALL SELECT batch, 'rules_fired', '', rules FROM totals
  UNION ALL SELECT batch, 'alerts_of_rule', rule_id, count(*) FROM newest GROUP BY batch, rule_id
  UNION ALL SELECT batch, 'alerts_in_minute', CAST(minute_ms AS VARCHAR), n FROM minutes
  UNION ALL SELECT batch, 'customer_alert_count', customer_id, alert_count FROM customers WHERE place <= 10
  UNION ALL SELECT batch, 'customer_max_risk', customer_id, max_risk FROM customers WHERE place <= 10
  UNION ALL SELECT batch, 'customer_avg_risk', customer_id, avg_risk FROM customers WHERE place <= 10)"""


def job_sql() -> dict[str, str]:
    return {
        "fraud_job": _JOB,
        "streamed_fraud_job": _JOB,
        "hot_customer_counts":
            f"WITH {_HOT_TX}, {_history(HOUR)} SELECT transaction_id, customer_id, recent_count, previous_amount FROM hist",
        "odd_transactions": f"""WITH {_ODD} SELECT transaction_id, customer_id, event_type = 'signup' AS no_number, amount,
            CASE WHEN event_type = 'error' THEN 9000000000000000000 ELSE ms END AS event_time,
            event_type <> 'error' AS complete, ms AS event_ms FROM odd""",
        "odd_spend": f"""WITH {_ODD}, days AS (
            SELECT last(transaction_id ORDER BY ms, transaction_id) AS transaction_id, customer_id,
                   bool_or(event_type = 'signup') AS none, bool_or(event_type = 'error') AS huge,
                   {_total("CASE WHEN event_type NOT IN ('error', 'signup') THEN amount END")} AS total
            FROM odd GROUP BY customer_id, ms // {DAY})
            SELECT transaction_id, customer_id, CASE WHEN huge THEN {_NUM}
              ELSE {_round(f"least({_NUM}, 60 + (total - 100) / 1000)", 6)} END AS risk_score
            FROM days WHERE NOT none AND (huge OR total > 100)""",
        "odd_people": """SELECT event_id AS n,
            CASE WHEN event_type = 'error' THEN '''event_id'' does not fit 64 bits' END AS error,
            CASE event_type WHEN 'click' THEN event_id + 3000000000 WHEN 'view' THEN event_id + 9007199254740993
                            WHEN 'error' THEN NULL ELSE event_id + 1 END AS event_id,
            CASE WHEN event_type <> 'error' THEN 3000000000 END AS age FROM events""",
        "payment_file_rejects": f"""WITH {_FILES} SELECT event_id, row,
            '''channel'' is not one of [''POS'', ''ECOM'', ''ATM'']' AS error
            FROM pay JOIN numbered USING (id) WHERE merchant_id = '3-MEDIUM'""",
        "payment_job": f"""WITH {_FILES}
            SELECT topic, card_id AS key, event_id AS id, risk_score, reasons, amount, CAST(NULL AS VARCHAR) AS error,
                   CAST(NULL AS VARCHAR) AS from_topic, CAST(row AS VARCHAR) AS excel_row, 'payments' AS sheet,
                   'rules_v1' AS model, topic AS routed_to, 6 AS n_headers
            FROM routed JOIN numbered USING (id) WHERE merchant_id <> '3-MEDIUM'
            UNION ALL SELECT 'payments.dlq', NULL, event_id, NULL, NULL, NULL, '''amount'' is not of type number',
                   'payments.raw', '?', '?', '?', '?', 1 FROM pay WHERE merchant_id = '2-HIGH'""",
        "quoted_line_breaks": """WITH d AS (SELECT doc_id, n_chars, coalesce(text, '') AS text, coalesce(lang, 'none') AS file FROM documents)
            SELECT file, doc_id, n_chars, sha256(text) AS text_sha256, CAST(1 + coalesce(sum(
              1 + length(text) - length(replace(text, chr(10), ''))) OVER (
              PARTITION BY file ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS row FROM d""",
        "newest_alert_counts_by_rule": f"{_RECENT} SELECT rule_id, count(*) AS alert_count FROM recent GROUP BY rule_id",
        "newest_alert_minutes": f"""{_RECENT}, grid AS (
            SELECT (1706650230000 // 60000 - i) * 60000 AS minute_ms FROM range(1, 1441) t(i))
            SELECT minute_ms, strftime(make_timestamp(minute_ms * 1000), '%H:%M') AS time, count(alert_time) AS count
            FROM grid LEFT JOIN recent ON alert_time // 60000 * 60000 = minute_ms GROUP BY minute_ms""",
        "newest_top_risk_customers": f"""{_RECENT} SELECT customer_id, alert_count, max_risk, avg_risk FROM (
            SELECT customer_id, count(*) AS alert_count, {_round('max(risk_score)', 1)} AS max_risk,
                   {_round('avg(risk_score)', 1)} AS avg_risk, min((alert_time, transaction_id, rule_id)) AS first_seen
            FROM recent GROUP BY customer_id ORDER BY max_risk DESC, first_seen, customer_id LIMIT 10)""",
        "newest_fifty_of_newest": f"WITH {_ALERTS} {_NEWEST} 50",
        "newest_flagged_customers": f"{_RECENT} SELECT count(DISTINCT customer_id) AS flagged_customers FROM recent",
        "newest_rules_fired": f"{_RECENT} SELECT count(DISTINCT rule_id) AS rules_fired FROM recent",
        "stamped_alerts": f"WITH {_TX} {_night('tx')}",
        "topic_first_records": """SELECT CAST(event_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
            CAST(user_id AS VARCHAR) AS key, event_type AS kind FROM events ORDER BY 1, 2 LIMIT 10""",
        "records_dealt_by_key": "SELECT user_id, CAST(1 AS BIGINT) AS partitions, count(*) AS n FROM events GROUP BY user_id",
        "streamed_json_lines": "SELECT event_id, event_type, CASE WHEN value > 50 THEN value END AS value FROM events",
        "streamed_text_words": _WORDS,
        "declared_users": """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
            CAST(floor(c_acctbal / 100) AS INTEGER) AS age FROM customer WHERE floor(c_acctbal / 100) >= 17""",
        "snapshot_polls": """SELECT 'postgres-customer' AS topic, CAST(p AS BIGINT) AS poll, CAST(c_custkey AS VARCHAR) AS key,
            c_name AS said FROM customer, range(2) t(p)
            UNION ALL SELECT 'postgres-orders', p, CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders, range(2) t(p)""",
        "snapshots_on_ticks": """SELECT 'postgres-customer' AS topic, CAST(p AS BIGINT) AS poll, CAST(c_custkey AS VARCHAR) AS key,
            c_name || ' ' || p AS said FROM customer, range(3) t(p)""",
        "captured_customer_changes": """SELECT CAST(0 AS BIGINT) AS poll, c_custkey, 'insert' AS change, c_name FROM customer
            UNION ALL SELECT 1, c_custkey, 'delete', c_name FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT 1, c_custkey, 'update', c_name || ' 1' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
            UNION ALL SELECT 2, c_custkey, 'insert', c_name FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT 2, c_custkey, 'update', c_name FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'""",
        "lag_of_a_checkpoint": """WITH e AS (SELECT event_id, CAST(event_id % 3 AS INTEGER) AS p, epoch_us(ts) // 1000 AS ms FROM events),
            half AS (SELECT min(ms) + (max(ms) - min(ms)) // 2 AS m FROM e)
            SELECT 'events' AS topic, p AS "partition", max(event_id) AS last_offset,
                   coalesce(max(event_id) FILTER (WHERE ms <= m) + 1, 0) AS next_offset,
                   max(event_id) + 1 - coalesce(max(event_id) FILTER (WHERE ms <= m) + 1, 0) AS lag
            FROM e, half GROUP BY p""",
        "live_alert_figures": _LIVE,
        "streamed_chained_joins": chained(),
        "new_customers_sent": """SELECT CAST(CASE WHEN c_custkey <= m THEN 1 ELSE 2 END AS BIGINT) AS run,
            CAST(c_custkey AS VARCHAR) AS key, c_name AS name
            FROM customer, (SELECT (min(c_custkey) + max(c_custkey)) // 2 AS m FROM customer)""",
        "new_events_sent": """WITH b AS (SELECT min(epoch_us(ts) // 1000) AS a, max(epoch_us(ts) // 1000) AS z FROM events)
            SELECT CASE WHEN ms <= a + (z - a) // 3 THEN 0 WHEN ms <= a + (z - a) * 2 // 3 THEN 1 ELSE 2 END :: BIGINT AS run,
                   CAST(user_id AS VARCHAR) AS key, event_id FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM events), b""",
        "streamed_late_audit": f"""WITH {_HALF} SELECT event_id, epoch_us(ts) // 1000 <= a + (z - a) // 2
            AND epoch_us(ts) // 1000 < z - {HOUR} AS late FROM events, half""",
        "streamed_windows_without_late_rows": f"""WITH {_HALF}
            SELECT event_type, epoch_us(ts) // 1000 // {DAY} * {DAY} AS window_start, count(*) AS n
            FROM events, half WHERE epoch_us(ts) // 1000 > a + (z - a) // 2 GROUP BY 1, 2""",
        "streamed_windows_with_grace": f"""SELECT event_type, epoch_us(ts) // 1000 // {DAY} * {DAY} AS window_start,
            count(*) AS n FROM events GROUP BY 1, 2""",
        "streamed_history_with_expiry":
            f"WITH {_TX}, {_history(12 * HOUR)} SELECT transaction_id, customer_id, recent_count, previous_amount FROM hist",
        "streamed_bucket_counts": f"""WITH {_TX} SELECT customer_id AS key, event_time // {DAY} * {DAY} AS bucket_ms,
            count(*) AS bucket_count FROM tx GROUP BY 1, 2""",
        "streamed_payment_records": f"WITH {_SCREENED} SELECT topic, key, id, risk_score, error, routed_to FROM screened",
    }
