"""SQL oracles (DuckDB dialect) for the checked queries. Each text is self-contained: the
views V1-V6 are spelled out as CTEs over the registered test tables."""

from __future__ import annotations

_CTE = {
    "v1": """v1 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS tx_id,
         ' C ' || CAST(o_custkey AS VARCHAR) || ' ' AS sender_id,
         'R' || CAST(o_custkey % 50 AS VARCHAR) || ' ' AS receiver_id,
         CASE o_orderkey % 11 WHEN 0 THEN '-' || whole || '.' || frac WHEN 1 THEN NULL
              WHEN 2 THEN whole || ',' || frac WHEN 3 THEN '1,234.56' WHEN 4 THEN '0'
              WHEN 5 THEN '0,5' WHEN 6 THEN '25000000' ELSE whole || '.' || frac END AS amount,
         CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency,
         CASE o_orderkey % 13 WHEN 0 THEN 'N/A' WHEN 1 THEN ' NULL ' WHEN 2 THEN '  '
              WHEN 3 THEN NULL WHEN 4 THEN ' null' WHEN 5 THEN 'failed' WHEN 6 THEN ' pending '
              ELSE ' success ' END AS status,
         CASE o_orderkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -5
              ELSE CAST(floor(epoch(o_orderdate)) AS BIGINT) END AS "timestamp"
  FROM (SELECT *, CAST(cents // 100 AS VARCHAR) AS whole,
               lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS frac
        FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) o0) o1
)""",
    "v2": """v2 AS (
  SELECT trim(v1.tx_id) AS tx_id,
         regexp_replace(v1.sender_id, '\\s+', '', 'g') AS sender_id,
         regexp_replace(v1.receiver_id, '\\s+', '', 'g') AS receiver_id,
         TRY_CAST(replace(trim(v1.amount), ',', '.') AS DOUBLE) AS amount,
         trim(v1.currency) AS currency,
         CASE WHEN trim(v1.status) IN ('', 'N/A', 'NULL', 'null') THEN 'Unknown'
              ELSE trim(v1.status) END AS status,
         make_timestamp(v1."timestamp" * 1000000) AS "timestamp",
         v1.amount AS raw_amount, v1.status AS raw_status, v1."timestamp" AS raw_epoch
  FROM v1
)""",
    "v2t": """v2t AS (
  SELECT *, concat_ws(',',
      CASE WHEN raw_amount IS NULL OR trim(raw_amount) = '' THEN 'amount_missing' END,
      CASE WHEN NOT (raw_amount IS NULL OR trim(raw_amount) = '') AND amount IS NULL
           THEN 'amount_unparsable' END,
      CASE WHEN isnan(amount) OR isinf(amount) THEN 'amount_not_finite' END,
      CASE WHEN amount <= 0 THEN 'amount_not_positive' END,
      CASE WHEN status IS NULL THEN 'status_missing' END,
      CASE WHEN status = 'Unknown' THEN 'status_unknown' END,
      CASE WHEN "timestamp" IS NULL THEN 'timestamp_missing' END,
      CASE WHEN "timestamp" <= TIMESTAMP '1970-01-01 00:00:00' THEN 'timestamp_not_after_epoch' END
  ) AS reject_reasons
  FROM v2
)""",
    "v3": """v3 AS (
  SELECT tx_id, sender_id, receiver_id, amount, currency, status, "timestamp"
  FROM v2t WHERE reject_reasons = ''
)""",
    "v4": """v4 AS (
  SELECT CAST(event_id AS BIGINT) AS tx_id, event_type AS status, value AS amount,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
         'R' || CAST(user_id % 60 AS VARCHAR) AS receiver_id,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0 THEN 'USD' END AS currency
  FROM events
)""",
    "v5": """v5 AS (
  SELECT regexp_replace(receiver_id, '\\s+', '', 'g') AS receiver_id,
         first(currency ORDER BY "timestamp", tx_id) AS currency
  FROM v3 GROUP BY 1
)""",
    "enr": """enr AS (
  SELECT e.tx_id, e.status, e.amount, e."timestamp", e.receiver_id,
         coalesce(e.currency, d.currency) AS currency,
         make_timestamp(e."timestamp" * 1000000) AS event_time
  FROM v4 e LEFT JOIN v5 d ON e.receiver_id = d.receiver_id
)""",
    "stats": """stats AS (
  SELECT date_trunc('minute', event_time) - to_minutes(i) AS window_start,
         date_trunc('minute', event_time) - to_minutes(i) + INTERVAL 10 MINUTE AS window_end,
         status, currency,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sum,
         count(tx_id) AS tx_count
  FROM enr, range(10) t(i)
  WHERE event_time IS NOT NULL
  GROUP BY 1, 2, 3, 4
)""",
    "users": """users AS (SELECT c_custkey AS user_id, c_name AS name FROM customer)""",
    "transfers": """transfers AS (
  SELECT o_custkey AS user_id, o_totalprice AS amount, o_orderstatus AS status,
         CAST(o_orderkey % 25 AS INTEGER) AS currency_id FROM orders)""",
    "currencies": """currencies AS (
  SELECT n_nationkey AS currency_id, r_name AS currency_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "totals": """totals AS (
  SELECT u.name, CAST(sum(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
  FROM users u JOIN transfers t ON u.user_id = t.user_id GROUP BY u.name)""",
}

_DEPS = {
    "v2": ["v1"], "v2t": ["v2"], "v3": ["v2t"], "v5": ["v3"], "enr": ["v4", "v5"],
    "stats": ["enr"], "totals": ["users", "transfers"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(_CTE[n] for n in order) + "\n"


GOOD = 'tx_id, sender_id, receiver_id, amount, currency, status, "timestamp"'

ORACLE = {
    "csv_scan": _with("v1") + "SELECT * FROM v1",
    "json_decode": _with("v4") + "SELECT * FROM v4",
    "publish_events": _with("v1") + """
SELECT row_number() OVER (ORDER BY CAST(tx_id AS BIGINT)) AS tx_id,
       status,
       coalesce(TRY_CAST(trim(regexp_replace(replace(amount, ',', '.'), '^\\s+|\\s+$', '', 'g'), '"')
                         AS DOUBLE), 0.0) AS amount,
       CASE WHEN regexp_full_match(trim(CAST("timestamp" AS VARCHAR)), '[+-]?[0-9]+')
            THEN CAST(trim(CAST("timestamp" AS VARCHAR)) AS BIGINT) END AS "timestamp",
       regexp_replace(receiver_id, '^\\s+|\\s+$', '', 'g') AS receiver_id,
       currency, sender_id
FROM v1""",
    "clean_transfers": _with("v2") + "SELECT * FROM v2",
    "fill_missing_timestamp": _with("v2") + """
SELECT tx_id, sender_id, receiver_id, amount, currency, status,
       coalesce("timestamp", TIMESTAMP '1970-01-01 00:00:00') AS "timestamp",
       raw_amount, raw_status, raw_epoch
FROM v2""",
    "good_transfers": _with("v3") + "SELECT * FROM v3",
    "dlq_transfers": _with("v2t") + f"""
SELECT {GOOD}, raw_amount, raw_status, raw_epoch, reject_reasons
FROM v2t WHERE reject_reasons <> ''""",
    "reject_summary": _with("v2t") + """
SELECT reason, count(*) AS n_rows
FROM (SELECT unnest(string_split(reject_reasons, ',')) AS reason FROM v2t WHERE reject_reasons <> '') r
GROUP BY reason""",
    "reference_gap": _with("v2t") + """
SELECT * FROM (
  SELECT tx_id, raw_amount, raw_status, raw_epoch,
         CASE WHEN coalesce(amount > 0 AND rs IS NOT NULL AND rs <> 'Unknown' AND ts > TIMESTAMP '1970-01-01', false)
                   THEN 'good'
              WHEN coalesce(amount < 0 OR amount IS NULL OR rs IS NULL OR rs = 'Unknown'
                            OR ts < TIMESTAMP '1970-01-01' OR ts IS NULL, false) THEN 'dlq'
              ELSE 'lost' END AS reference_route,
         CASE WHEN reject_reasons = '' THEN 'good' ELSE 'dlq' END AS our_route
  FROM (SELECT *, CASE WHEN trim(raw_status) IN ('', 'N/A', 'NULL') THEN 'Unknown' ELSE trim(raw_status) END AS rs,
               coalesce("timestamp", TIMESTAMP '1970-01-01 00:00:00') AS ts
        FROM v2t) x
) y WHERE reference_route <> our_route""",
    "dedupe_transfers": _with("v3") + """
SELECT min(tx_id) AS tx_id, sender_id, receiver_id, amount, currency,
       first(status ORDER BY tx_id) AS status, "timestamp"
FROM v3 GROUP BY sender_id, receiver_id, amount, currency, "timestamp\"""",
    "receiver_dim": _with("v5") + "SELECT * FROM v5",
    "enriched_events": _with("enr") + "SELECT * FROM enr",
    "sliding_stats": _with("stats") + "SELECT * FROM stats",
    "serving_stats": _with("stats") + "SELECT * FROM stats ORDER BY window_start, status",
    "status_counts": _with("v3") + "SELECT status, count(*) AS count FROM v3 GROUP BY status",
    "large_usd": _with("v3") + "SELECT * FROM v3 WHERE amount > 10000 AND currency = 'USD'",
    "unknown_status": _with("v2") + f"SELECT {GOOD} FROM v2 WHERE status = 'Unknown'",
    "large_transfer_alerts": _with("v3") + "SELECT tx_id, receiver_id, amount FROM v3 WHERE amount > 50000",
    "transfers_view": _with("v3") + 'SELECT tx_id, amount, currency, status, "timestamp" FROM v3',
    "table_preview": _with("v3") + "SELECT * FROM v3 ORDER BY tx_id LIMIT 20",
    "sender_avg_diff": _with("v3") + """
SELECT v3.sender_id, tx_id, "timestamp", amount, a.user_avg_amount,
       amount - a.user_avg_amount AS diff_from_avg
FROM v3 JOIN (SELECT sender_id,
                     CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS user_avg_amount
              FROM v3 GROUP BY sender_id) a ON v3.sender_id = a.sender_id""",
    "sender_prev_amount": _with("v3") + """
SELECT sender_id, tx_id, "timestamp", amount,
       lag(amount) OVER (PARTITION BY sender_id ORDER BY "timestamp", tx_id) AS prev_tx_amount
FROM v3""",
    "user_totals": _with("totals") + "SELECT * FROM totals",
    "user_totals_all": _with("users", "transfers") + """
SELECT u.name, coalesce(CAST(sum(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS total_amount
FROM users u LEFT JOIN transfers t ON u.user_id = t.user_id AND t.status = 'F'
GROUP BY u.name""",
    "user_totals_having": _with("totals") + "SELECT * FROM totals WHERE total_amount > 2500000",
    "user_totals_success": _with("users", "transfers") + """
SELECT u.name, CAST(sum(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
FROM users u JOIN transfers t ON u.user_id = t.user_id
WHERE t.status = 'F'
GROUP BY u.name""",
    "user_currency_totals": _with("users", "transfers", "currencies") + """
SELECT u.name, c.currency_code, CAST(sum(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
FROM users u JOIN transfers t ON u.user_id = t.user_id
JOIN currencies c ON t.currency_id = c.currency_id
GROUP BY u.name, c.currency_code""",
    "top_users": _with("totals") + "SELECT * FROM totals ORDER BY total_amount DESC, name LIMIT 3",
    "sorted_transfers": _with("v2") + f"SELECT {GOOD} FROM v2 ORDER BY sender_id",
}

_LOADS = """loads AS (
  SELECT y AS load_id, count(*) AS n_rows,
         CASE WHEN y = min(y) OVER () OR y = 1998 THEN 'replace' ELSE 'append' END AS operation
  FROM (SELECT CAST(year("timestamp") AS BIGINT) AS y FROM v3) t GROUP BY y
)"""


def _state_as_of(year: int) -> str:
    return _with("v3") .rstrip("\n") + ",\n" + _LOADS + f"""
SELECT v3.* FROM v3
WHERE year("timestamp") <= {year}
  AND year("timestamp") >= (SELECT max(load_id) FROM loads WHERE operation = 'replace' AND load_id <= {year})"""


ORACLE.update({
    "load_replace": _with("v3") + "SELECT * FROM v3",
    "load_append": _with("v3") + "SELECT * FROM v3",
    "load_history": _with("v3").rstrip("\n") + ",\n" + _LOADS
    + "\nSELECT load_id, operation, n_rows FROM loads ORDER BY load_id DESC LIMIT 5",
    "table_as_of": _state_as_of(2000),
    "table_rollback": _state_as_of(1997),
    "stream_sliding_stats": _with("stats") + "SELECT * FROM stats",
    "stats_upsert": _with("stats") + "SELECT * FROM stats",
    "stream_dual_sink": _with("stats") + "SELECT * FROM stats",
    "stream_transfer_alerts": _with("v4") + "SELECT tx_id, receiver_id, amount FROM v4 WHERE amount > 200",
})

ORACLE.update({
    "landing_load": _with("v3") + "SELECT * FROM v3",
    "landing_dead_letters": ORACLE["dlq_transfers"],
})

ORACLE["table_partitions"] = _with("v3").rstrip("\n") + ",\n" + _LOADS + """
SELECT CAST(year("timestamp") AS BIGINT) AS load_id, status, count(*) AS record_count
FROM v3
WHERE year("timestamp") >= (SELECT max(load_id) FROM loads WHERE operation = 'replace')
GROUP BY 1, 2"""

ORACLE.update({
    "compact_files": _with("v3").rstrip("\n") + ",\n" + _LOADS + """
SELECT v3.* FROM v3
WHERE year("timestamp") >= (SELECT max(load_id) FROM loads WHERE operation = 'replace')""",
    "layout_by_status": _with("v3") + "SELECT * FROM v3",
    "layout_sorted": _with("v3") + "SELECT * FROM v3",
})

ORACLE["stream_sliding_stats_append"] = _with("stats") + """
SELECT * FROM stats
WHERE window_end <= (SELECT max(event_time) FROM enr) - INTERVAL 15 MINUTE"""

ORACLE["stream_late_drop"] = _with("enr") + """, span AS (
  SELECT min("timestamp") AS lo, max("timestamp") - min("timestamp") + 1 AS whole FROM v4
), on_time AS (
  SELECT enr.* FROM enr, span WHERE ("timestamp" - lo) * 4 // whole <> 1
)
SELECT date_trunc('minute', event_time) - to_minutes(i) AS window_start,
       date_trunc('minute', event_time) - to_minutes(i) + INTERVAL 10 MINUTE AS window_end,
       status, currency,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sum,
       count(tx_id) AS tx_count
FROM on_time, range(10) t(i)
WHERE event_time IS NOT NULL
GROUP BY 1, 2, 3, 4"""

ORACLE["stream_redelivery_dedupe"] = _with("stats") + "SELECT * FROM stats"

_MONTHS = """v4x AS (
  SELECT * FROM v4
  UNION ALL
  SELECT tx_id + 10000000000, status, amount, "timestamp" + 31 * 86400, receiver_id, currency FROM v4
),
enr AS ("""
_NO_SENDER = """v3n AS (
  SELECT tx_id, CASE WHEN CAST(tx_id AS BIGINT) % 3 <> 0 THEN sender_id END AS sender_id, receiver_id, amount,
         currency, status, "timestamp"
  FROM v3
)
"""

ORACLE.update({
    "stream_two_months": ORACLE["sliding_stats"].replace("enr AS (", _MONTHS, 1).replace("FROM v4 e LEFT", "FROM v4x e LEFT"),
    "stream_serving_json": ORACLE["sliding_stats"],
    "stream_restart": ORACLE["sliding_stats"],
    "json_decode_malformed": _with("v4") + "SELECT * FROM v4 WHERE tx_id % 10 <> 0",
    "csv_by_header": ORACLE["csv_scan"],
    "publish_capped": "SELECT * FROM (" + ORACLE["publish_events"] + ") p WHERE tx_id <= 10001",
    "sender_avg_diff_nulls": _with("v3").rstrip("\n") + ",\n" + _NO_SENDER + """
SELECT v3n.sender_id, tx_id, "timestamp", amount, a.user_avg_amount,
       amount - a.user_avg_amount AS diff_from_avg
FROM v3n JOIN (SELECT sender_id,
                      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS user_avg_amount
               FROM v3n GROUP BY sender_id) a ON v3n.sender_id IS NOT DISTINCT FROM a.sender_id""",
    "sender_prev_amount_nulls": _with("v3").rstrip("\n") + ",\n" + _NO_SENDER + """
SELECT sender_id, tx_id, "timestamp", amount,
       lag(amount) OVER (PARTITION BY sender_id ORDER BY "timestamp", tx_id) AS prev_tx_amount
FROM v3n""",
    "landing_all_bad": _with("v1") + "SELECT trim(tx_id) AS tx_id, 'dlq' AS route FROM v1 WHERE CAST(tx_id AS BIGINT) % 11 = 0",
    "landing_all_good": _with("v1") + """
SELECT trim(tx_id) AS tx_id, 'good' AS route FROM v1
WHERE CAST(tx_id AS BIGINT) % 11 > 6 AND CAST(tx_id AS BIGINT) % 13 > 6 AND CAST(tx_id AS BIGINT) % 17 > 2""",
    "dlq_append": ORACLE["dlq_transfers"],
    "catalog_tables": ORACLE["transfers_view"],
    "catalog_stats": ORACLE["sliding_stats"],
    "files_by_source_total": "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders",
    "table_files_total": "SELECT load_id, CAST(sum(record_count) AS BIGINT) AS record_count FROM ("
                         + ORACLE["table_partitions"] + ") p GROUP BY load_id",
})

ORACLE.update({
    "publish_by_tx": ORACLE["publish_events"],
    "stats_compact": ORACLE["sliding_stats"],
    "stream_hot_receiver": ORACLE["sliding_stats"].replace(
        "FROM v4 e LEFT", "FROM (SELECT * REPLACE (CASE WHEN tx_id % 3 = 0 THEN 'R7' ELSE receiver_id END AS receiver_id) FROM v4) e LEFT"),
    "stream_late_counts": _with("enr") + """, span AS (
  SELECT min("timestamp") AS lo, max("timestamp") - min("timestamp") + 1 AS whole FROM v4
), told AS (
  SELECT event_time, event_time IS NOT NULL AND ("timestamp" - lo) * 4 // whole = 1 AS late FROM enr, span
)
SELECT count(*) AS events, count(*) FILTER (WHERE late) AS late, count(*) FILTER (WHERE event_time IS NULL) AS no_event_time,
       count(*) FILTER (WHERE event_time IS NOT NULL AND NOT late) AS counted
FROM told""",
    "table_rollback_twice": "SELECT * FROM (" + ORACLE["table_rollback"] + ") a UNION ALL SELECT * FROM (" + _with("v3")
                            + "SELECT v3.* FROM v3 WHERE year(\"timestamp\") >= 2000) b",
    "landing_only_new": _with("v2t") + "SELECT tx_id, CASE WHEN reject_reasons = '' THEN 'good' ELSE 'dlq' END AS route FROM v2t",
    "load_sized": ORACLE["load_append"],
    "catalog_drop": _with("v3") + "SELECT count(*) AS n_rows, 'transfers,windowed_stats' AS tables FROM v3",
    "dlq_stamped": _with("v2t") + "SELECT count(*) AS stamped, true AS one_time, true AS recent FROM v2t WHERE reject_reasons <> ''",
})
