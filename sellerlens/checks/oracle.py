"""The registered queries once more, as plain SQL over the source tables.

Written from the rules, not from the Spark code: each statement derives raw, refined and
curated tables in CTEs and reads the one it needs.
"""

from __future__ import annotations

import hashlib

from sellerlens.checks.registry import MASK_KEYS, SELLER
from sellerlens.schemas import RAW_TABLES

_RAW = """
raw_orders AS (
  SELECT 'O' || l_orderkey || '-' || l_linenumber AS order_id,
         'S' || l_suppkey AS seller_id,
         'C' || o_custkey AS customer_id,
         l_extendedprice / 10 AS amount,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'P' THEN 'PENDING'
              ELSE ' cancelled' END AS status,
         upper(p_type) AS category
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
raw_returns AS (
  SELECT 'R' || l_orderkey || '-' || l_linenumber AS return_id,
         'O' || l_orderkey || '-' || l_linenumber AS order_id,
         'S' || (l_suppkey - CASE WHEN l_linestatus = 'O' AND l_suppkey % 4 IN (2, 3)
                                  THEN l_suppkey % 4 ELSE 0 END) AS seller_id,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         CASE l_linenumber % 5 WHEN 0 THEN 'DAMAGED_ITEM' WHEN 1 THEN 'WRONG_ITEM'
              WHEN 2 THEN 'NOT_AS_DESCRIBED' WHEN 3 THEN 'CHANGED_MIND'
              ELSE 'COUNTERFEIT' END AS reason,
         ' Approved' AS status
  FROM lineitem WHERE l_returnflag = 'R'),
raw_complaints AS (
  SELECT 'CMP' || event_id AS complaint_id,
         'S' || ((user_id - CASE WHEN user_id % 2 = 1 AND event_id % 50 <> 0
                                 THEN 1 ELSE 0 END)
                 % (SELECT count(*) FROM supplier)) AS seller_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         CASE WHEN value >= CASE WHEN user_id % 5 = 0 THEN 15 ELSE 70 END THEN 'HIGH'
              WHEN value >= 10 THEN 'Medium' ELSE 'low' END AS severity,
         CASE event_type WHEN 'error' THEN 'fraud' WHEN 'click' THEN 'poor_quality'
              WHEN 'view' THEN 'late_delivery' WHEN 'signup' THEN 'wrong_item'
              WHEN 'purchase' THEN 'counterfeit_claim' END AS category
  FROM events),
raw_sellers AS (
  SELECT 'S' || s_suppkey AS seller_id, s_name AS seller_name,
         CAST(DATE '2001-12-31' - CAST((s_suppkey * 37) % 2000 AS INTEGER) AS DATE)
             AS registration_date,
         r_name AS region,
         CASE s_suppkey % 4 WHEN 0 THEN 'electronics' WHEN 1 THEN 'clothing'
              WHEN 2 THEN 'home_goods' ELSE 'luxury' END AS category,
         CASE WHEN s_suppkey % 5 = 0 OR s_acctbal < 1000 THEN 'unverified'
              ELSE 'verified' END AS verification_status,
         CASE WHEN s_acctbal < 1000 THEN 'basic' WHEN s_acctbal < 4000 THEN 'silver'
              WHEN s_acctbal < 8000 THEN 'gold' ELSE 'platinum' END AS support_tier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""

_REFINED = """,
typed_orders AS (
  SELECT order_id, seller_id, customer_id, amount, CAST("timestamp" AS TIMESTAMP) AS event_ts,
         lower(trim(status)) AS status, lower(trim(category)) AS category
  FROM raw_orders),
ref_orders AS (
  SELECT * FROM typed_orders
  WHERE order_id IS NOT NULL AND seller_id IS NOT NULL AND amount > 0 AND amount < 10000
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY event_ts DESC NULLS LAST, seller_id NULLS FIRST, customer_id NULLS FIRST,
             amount NULLS FIRST, status NULLS FIRST, category NULLS FIRST) = 1),
ref_returns AS (
  SELECT * FROM (
    SELECT return_id, order_id, seller_id, CAST("timestamp" AS TIMESTAMP) AS event_ts,
           lower(trim(reason)) AS reason, lower(trim(status)) AS status
    FROM raw_returns)
  WHERE return_id IS NOT NULL AND seller_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY return_id
    ORDER BY event_ts DESC NULLS LAST, order_id NULLS FIRST, seller_id NULLS FIRST,
             reason NULLS FIRST, status NULLS FIRST) = 1),
ref_complaints AS (
  SELECT * FROM (
    SELECT complaint_id, seller_id, CAST("timestamp" AS TIMESTAMP) AS event_ts,
           lower(trim(severity)) AS severity, lower(trim(category)) AS category
    FROM raw_complaints)
  WHERE complaint_id IS NOT NULL AND seller_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY complaint_id
    ORDER BY event_ts DESC NULLS LAST, seller_id NULLS FIRST, severity NULLS FIRST,
             category NULLS FIRST) = 1),
ref_sellers AS (SELECT * FROM raw_sellers)
"""

_CORRECTED = """,
all_orders AS (
  SELECT * FROM raw_orders
  UNION ALL
  SELECT order_id, CASE WHEN order_id LIKE '%5' THEN 'S1' ELSE seller_id END, customer_id, amount / 2,
         '2' || substr("timestamp", 2), status, category
  FROM raw_orders WHERE order_id LIKE '%3' OR order_id LIKE '%5')
""" + _REFINED.replace("FROM raw_orders)", "FROM all_orders)")

_AGGREGATES = """,
om AS (SELECT seller_id, count(order_id) AS total_orders, avg(amount) AS avg_order_amount
       FROM ref_orders GROUP BY seller_id),
rm AS (SELECT seller_id, count(return_id) AS total_returns FROM ref_returns GROUP BY seller_id),
cm AS (SELECT seller_id, count(complaint_id) AS total_complaints,
              count(CASE WHEN severity = 'high' THEN 1 END) AS high_severity_complaints
       FROM ref_complaints GROUP BY seller_id),
filled AS (
  SELECT s.*, coalesce(total_orders, 0) AS total_orders,
         coalesce(avg_order_amount, 0) AS avg_order_amount,
         coalesce(total_returns, 0) AS total_returns,
         coalesce(total_complaints, 0) AS total_complaints,
         coalesce(high_severity_complaints, 0) AS high_severity_complaints
  FROM ref_sellers s LEFT JOIN om USING (seller_id) LEFT JOIN rm USING (seller_id)
       LEFT JOIN cm USING (seller_id)),
aggregates AS (
  SELECT *, CASE WHEN total_orders > 0 THEN total_returns / total_orders
                 ELSE CAST(0 AS DOUBLE) END AS return_rate
  FROM filled)
"""

_SCORED = """,
rates AS (
  SELECT *,
    CASE WHEN total_orders > 0 THEN total_complaints / total_orders
         ELSE CAST(0 AS DOUBLE) END AS complaint_rate,
    CASE WHEN total_complaints > 0 THEN high_severity_complaints / total_complaints
         ELSE CAST(0 AS DOUBLE) END AS high_severity_rate,
    CAST(datediff('day', registration_date, DATE '2002-01-01') AS INTEGER) AS days_active
  FROM aggregates),
components AS (
  SELECT *,
    return_rate * CAST(25 AS DOUBLE) AS return_component,
    least(complaint_rate, CAST(1 AS DOUBLE)) * CAST(35 AS DOUBLE) AS complaint_volume_component,
    high_severity_rate * CAST(25 AS DOUBLE) AS complaint_severity_component,
    CAST(CASE WHEN verification_status = 'unverified' THEN 10 ELSE 0 END AS DOUBLE)
        AS trust_component,
    CAST(CASE WHEN days_active < 180 THEN 5 WHEN days_active < 365 THEN 2.5 ELSE 0 END AS DOUBLE)
        AS new_seller_component
  FROM rates),
indexed AS (
  SELECT *,
    return_component + complaint_volume_component + complaint_severity_component
      + trust_component + new_seller_component AS risk_index,
    return_rate * CAST(40 AS DOUBLE) + high_severity_complaints * CAST(15 AS DOUBLE)
      + CAST(CASE WHEN verification_status = 'unverified' THEN 20 ELSE 0 END AS DOUBLE)
      + CAST(CASE WHEN total_complaints > 3 THEN 15 ELSE 0 END AS DOUBLE)
      + CAST(CASE WHEN total_orders > 100 THEN -10 ELSE 0 END AS DOUBLE) AS risk_score
  FROM components),
scored AS (
  SELECT *, CASE WHEN risk_index >= 55 THEN 'HIGH' WHEN risk_index >= 30 THEN 'MEDIUM'
                 ELSE 'LOW' END AS risk_label
  FROM indexed),
risk AS (
  SELECT seller_id, seller_name, region, verification_status, total_orders, total_returns,
         return_rate, total_complaints, high_severity_complaints,
         round(avg_order_amount, 2) AS avg_order_amount, risk_score, risk_index, risk_label
  FROM scored),
fraud AS (
  SELECT seller_id,
    CASE WHEN return_rate > 0.5 THEN 'HIGH_RETURN_RATE'
         WHEN high_severity_complaints >= 2 THEN 'REPEATED_HIGH_COMPLAINTS'
         ELSE 'UNVERIFIED_WITH_COMPLAINTS' END AS pattern_type,
    risk_score AS indicator_value, CAST(30 AS DOUBLE) AS threshold,
    TIMESTAMP '2002-01-01 00:00:00' AS flagged_at,
    CASE WHEN return_rate > 0.5 THEN 'Return rate exceeds 50% threshold'
         WHEN high_severity_complaints >= 2 THEN 'Multiple high severity complaints detected'
         ELSE 'Unverified seller with multiple complaints' END AS explanation
  FROM scored
  WHERE return_rate > 0.3 OR high_severity_complaints >= 2
     OR (verification_status = 'unverified' AND total_complaints > 2))
"""


def _raw(body: str) -> str:
    return f"WITH {_RAW} {body}"


def _refined(body: str) -> str:
    return f"WITH {_RAW}{_REFINED} {body}"


def _aggregated(body: str) -> str:
    return f"WITH {_RAW}{_REFINED}{_AGGREGATES} {body}"


def _curated(body: str) -> str:
    return f"WITH {_RAW}{_REFINED}{_AGGREGATES}{_SCORED} {body}"


_RISK_ROUNDED = """seller_id, seller_name, region, verification_status, total_orders, total_returns,
  return_rate, total_complaints, high_severity_complaints, avg_order_amount,
  round(risk_score, 4) AS risk_score, round(risk_index, 4) AS risk_index, risk_label"""
_RISK_EXACT = _RISK_ROUNDED.replace(
    "round(risk_score, 4) AS risk_score, round(risk_index, 4) AS risk_index",
    "risk_score, risk_index",
)
_FRAUD_ROUNDED = """seller_id, pattern_type, round(indicator_value, 4) AS indicator_value,
  threshold, flagged_at, explanation"""
_PROFILE = """r.seller_id, seller_name, region, verification_status, total_orders, total_returns,
  return_rate, total_complaints, high_severity_complaints, avg_order_amount,
  round(risk_score, 4) AS risk_score, risk_label, pattern_type, f.explanation
  FROM risk r LEFT JOIN fraud f ON f.seller_id = r.seller_id"""
_BRIEF = """seller_id, seller_name, region, round(risk_score, 4) AS risk_score, risk_label,
  return_rate, high_severity_complaints"""
_PLOT_COLOUR = """CASE risk_label WHEN 'HIGH' THEN 'red' WHEN 'MEDIUM' THEN 'orange'
  WHEN 'LOW' THEN 'green' END AS colour"""
_LABEL_COLOUR = """CASE {0} WHEN 'HIGH' THEN '#ef4444' WHEN 'MEDIUM' THEN '#f59e0b'
  WHEN 'LOW' THEN '#22c55e' ELSE '#94a3b8' END"""
_PUBLISHED = {
    "curated.seller_risk": "risk",
    "curated.fraud_patterns": "fraud",
    "refined.orders": "ref_orders",
    "refined.returns": "ref_returns",
    "refined.complaints": "ref_complaints",
    "refined.sellers": "ref_sellers",
}


def _hmac(text: str, secret: str) -> str:
    """HMAC-SHA256 by its definition, in SQL."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = ("'" + "".join(f"\\x{b ^ pad:02X}" for b in key) + "'::BLOB" for pad in (0x36, 0x5C))
    return f"sha256({outer} || unhex(sha256({inner} || encode({text}))))"


def _counts(named: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
        for name, cte in named.items()
    )


def _quality(name: str, cte: str, key: str, invalid: str) -> str:
    return f"""
    SELECT *, CASE WHEN invalid_rows = 0 AND duplicate_rows = 0 THEN 'PASSED'
                   ELSE 'FAILED' END AS status
    FROM (SELECT '{name}' AS table_name, count(*) AS total_rows,
                 count(CASE WHEN {invalid} THEN 1 END) AS invalid_rows,
                 count(*) - count(DISTINCT {key})
                   - CAST(count(*) > count({key}) AS BIGINT) AS duplicate_rows
          FROM {cte})"""


_QUALITY = {
    "quality_orders": (
        "refined.orders",
        "ref_orders",
        "order_id",
        "order_id IS NULL OR seller_id IS NULL OR amount <= 0",
    ),
    "quality_returns": (
        "refined.returns",
        "ref_returns",
        "return_id",
        "return_id IS NULL OR seller_id IS NULL",
    ),
    "quality_complaints": (
        "refined.complaints",
        "ref_complaints",
        "complaint_id",
        "complaint_id IS NULL OR seller_id IS NULL",
    ),
}
_ROLE_TABLES = {
    "curated.seller_risk": ("full", "limited"),
    "curated.fraud_patterns": ("full", "none"),
    "refined.orders": ("masked", "none"),
    "refined.returns": ("none", "none"),
    "refined.complaints": ("full", "none"),
    "refined.sellers": ("none", "none"),
    "raw.orders": ("none", "none"),
}
_SEEN = {
    ("curated.seller_risk", "full"): "seller_id,seller_name,region,verification_status,"
    "total_orders,total_returns,return_rate,total_complaints,high_severity_complaints,"
    "avg_order_amount,risk_score,risk_index,risk_label",
    ("curated.seller_risk", "limited"): "seller_id,seller_name,region,risk_label",
    ("curated.fraud_patterns", "full"): "seller_id,pattern_type,indicator_value,threshold,"
    "flagged_at,explanation",
    ("refined.orders", "masked"): "order_id,seller_id,amount,event_ts,status,category,"
    "customer_id_masked",
    ("refined.complaints", "full"): "complaint_id,seller_id,event_ts,severity,category",
}


def _access() -> str:
    rows = []
    for name, levels in _ROLE_TABLES.items():
        cte = _PUBLISHED.get(name, "raw_orders")
        for role, level in zip(("trust_safety_analyst", "business_analyst"), levels):
            rows.append(
                f"SELECT '{role}' AS role, '{name}' AS table_name, '{level}' AS access, "
                f"'{_SEEN.get((name, level), '')}' AS visible_columns, "
                + ("CAST(0 AS BIGINT)" if level == "none" else f"(SELECT count(*) FROM {cte})")
                + " AS visible_rows"
            )
    return " UNION ALL ".join(rows)


_UNTIDY = """
WITH lines AS (
  SELECT 'O' || l_orderkey || '-' || l_linenumber AS id, 'S' || l_suppkey AS seller,
         'C' || o_custkey AS customer, CAST(l_extendedprice / 10 AS VARCHAR) AS price,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS shipped,
         CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'P' THEN 'PENDING'
              ELSE ' cancelled' END AS st, upper(p_type) AS cat,
         l_orderkey + l_linenumber AS k, (l_orderkey + l_linenumber) % 71 = 0 AS broken
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
untidy AS (
  SELECT CASE WHEN NOT broken AND k % 97 <> 0 THEN id END AS order_id,
         CASE WHEN NOT broken AND k % 89 <> 0 THEN seller END AS seller_id,
         CASE WHEN NOT broken THEN customer END AS customer_id,
         CASE WHEN broken OR k % 79 = 0 THEN NULL WHEN k % 83 = 0 THEN 'n/a'
              WHEN k % 7 = 0 THEN '  ' || price || ' ' ELSE price END AS amount,
         CASE WHEN broken THEN NULL WHEN k % 73 = 0 THEN 'yesterday' ELSE shipped END AS "timestamp",
         CASE WHEN NOT broken THEN st END AS status, CASE WHEN NOT broken THEN cat END AS category,
         CASE WHEN broken THEN '{' || id END AS _corrupt_record
  FROM lines),
read AS (
  SELECT *, TRY_CAST(trim(amount) AS DOUBLE) AS number, TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts,
         order_id IS NOT NULL AND seller_id IS NOT NULL
           AND coalesce(number > 0 AND number < 10000, false) AS valid
  FROM untidy)
"""

_ACTIVITY = """
  SELECT o.seller_id, left(sha256(customer_id), 8) AS customer,
         sha256(customer_id) AS customer_id_masked,
         count(o.order_id) AS total_orders, round(sum(amount), 4) AS total_amount,
         count(CASE WHEN EXISTS (SELECT 1 FROM ref_returns r WHERE r.order_id = o.order_id
                                 AND r.seller_id = o.seller_id) THEN 1 END) AS total_returns
  FROM ref_orders o {where} GROUP BY o.seller_id, customer_id"""

_SPIKES = """,
daily AS (
  SELECT seller_id, CAST(event_ts AS DATE) AS d, count(*) AS n FROM ref_orders
  WHERE event_ts IS NOT NULL GROUP BY ALL),
begun AS (SELECT seller_id, min(d) AS f FROM daily GROUP BY seller_id),
before AS (
  SELECT a.seller_id, a.d, a.n, CAST(least(28, a.d - f) AS INTEGER) AS days,
         list(b.n) FILTER (b.n IS NOT NULL) AS sold
  FROM daily a JOIN begun USING (seller_id)
  LEFT JOIN daily b ON b.seller_id = a.seller_id AND b.d BETWEEN a.d - 28 AND a.d - 1
  GROUP BY ALL),
usual AS (
  SELECT *, list_concat(coalesce(sold, []), list_transform(range(days - len(coalesce(sold, []))), lambda i: 0::BIGINT))
              AS every
  FROM before WHERE days >= 7 AND n >= 2),
middle AS (SELECT *, CAST(list_median(every) AS DOUBLE) AS m FROM usual),
judged AS (SELECT *, CAST(list_median(list_transform(every, lambda x: abs(x - m))) AS DOUBLE) AS away FROM middle)
SELECT seller_id, d AS order_date, n AS daily_orders, days AS baseline_days, m AS median_orders,
       away AS median_deviation
FROM judged WHERE n - m > greatest(3 * away, 1)
"""

_RAW_ORDERS = 'order_id, seller_id, customer_id, amount, "timestamp", status, category'
_RAW_RETURNS = 'return_id, order_id, seller_id, "timestamp", reason, status'
_RAW_COMPLAINTS = 'complaint_id, seller_id, "timestamp", severity, category'


def all_sql() -> dict[str, str]:
    sql = {
        # sources and sinks
        "scan_raw_json": _raw(f"SELECT {_RAW_ORDERS} FROM raw_orders"),
        "parquet_roundtrip": _refined("SELECT * FROM ref_returns"),
        "raw_orders_by_name": _raw(f"SELECT {_RAW_ORDERS} FROM raw_orders"),
        "raw_tables_by_name": _raw(
            _counts({f"raw.{table}": f"raw_{table}" for table in RAW_TABLES})
        ),
        "tables_by_name": _curated(_counts(_PUBLISHED)),
        "publish_tables": _curated(_counts(_PUBLISHED)),
        "sellers_by_name": _curated(
            "SELECT seller_id, seller_name, risk_label, risk_score FROM risk "
            "ORDER BY risk_score DESC, seller_id"
        ),
        "land_files": _raw(f"SELECT {_RAW_COMPLAINTS} FROM raw_complaints"),
        "ingest_orders": _raw(f"SELECT {_RAW_ORDERS} FROM raw_orders"),
        "ingest_returns": _raw(f"SELECT {_RAW_RETURNS} FROM raw_returns"),
        "encode_events": _raw(
            """SELECT seller_id AS key, '{"complaint_id":"' || complaint_id || '","seller_id":"'
            || seller_id || '","timestamp":"' || "timestamp" || '","severity":"' || severity
            || '","category":"' || category || '"}' AS value FROM raw_complaints"""
        ),
        "encode_order_events": _raw(
            """SELECT '{"order_id":"' || order_id || '","seller_id":"' || seller_id
            || '","customer_id":"' || customer_id || '","amount":'
            || CASE WHEN amount >= 9000 THEN '"' || CAST(CAST(amount AS DOUBLE) AS VARCHAR) || ' EUR"'
                    WHEN amount >= 1000 THEN CAST(CAST(amount AS DOUBLE) AS VARCHAR) ELSE '0.0' END
            || ',"timestamp":"' || "timestamp" || '","status":"'
            || CASE WHEN trim(status) = 'PENDING' THEN 'completed' ELSE trim(status) END
            || '","category":"' || category || '"}' AS value FROM raw_orders"""
        ),
        "export_json_roundtrip": _curated(f"SELECT {_RISK_EXACT} FROM risk"),
        "publish_gate": _curated(
            "SELECT 'curated.seller_risk' AS table_name, true AS table_exists, "
            "count(*) AS row_count, true AS schema_ok FROM risk"
        ),
        # raw to refined
        "normalize_orders": _refined("SELECT * FROM ref_orders"),
        "normalize_returns": _refined("SELECT * FROM ref_returns"),
        "normalize_complaints": _refined("SELECT * FROM ref_complaints"),
        "normalize_sellers": _refined("SELECT * FROM ref_sellers"),
        "dedupe_orders": _refined(
            """SELECT * FROM typed_orders QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY event_ts DESC NULLS LAST, seller_id, customer_id, amount, status,
                     category) = 1"""
        ),
        "rejected_orders": _raw(
            f"""SELECT {_RAW_ORDERS}, 'amount_out_of_range' AS issue FROM raw_orders
            WHERE NOT (amount > 0 AND amount < 10000)"""
        ),
        "untidy_order_issues": _UNTIDY
        + f"""SELECT * FROM (
            SELECT {_RAW_ORDERS}, _corrupt_record,
              CASE WHEN _corrupt_record IS NOT NULL THEN 'corrupt_record'
                   WHEN order_id IS NULL THEN 'null_order_id'
                   WHEN seller_id IS NULL THEN 'null_seller_id'
                   WHEN number IS NULL THEN 'bad_amount'
                   WHEN number <= 0 OR number >= 10000 THEN 'amount_out_of_range'
                   WHEN "timestamp" IS NOT NULL AND event_ts IS NULL THEN 'bad_timestamp' END AS issue,
              NOT valid AS rejected
            FROM read) WHERE issue IS NOT NULL""",
        "normalize_untidy_orders": _UNTIDY
        + """SELECT order_id, seller_id, customer_id, number AS amount, event_ts,
              lower(trim(status)) AS status, lower(trim(category)) AS category
            FROM read WHERE valid
            QUALIFY row_number() OVER (PARTITION BY order_id
              ORDER BY event_ts DESC NULLS LAST, seller_id, customer_id NULLS FIRST, number,
                       lower(trim(status)) NULLS FIRST, lower(trim(category)) NULLS FIRST) = 1""",
        # kept up to date
        "incremental_orders": f"WITH {_RAW}{_CORRECTED} SELECT * FROM ref_orders",
        "incremental_aggregates": f"WITH {_RAW}{_CORRECTED}{_AGGREGATES} "
        "SELECT * REPLACE (round(avg_order_amount, 2) AS avg_order_amount) FROM aggregates",
        "streamed_orders": f"WITH {_RAW}{_CORRECTED} SELECT * FROM ref_orders",
        # metrics and joins
        "order_metrics": _aggregated(
            "SELECT seller_id, total_orders, round(avg_order_amount, 2) AS avg_order_amount FROM om"
        ),
        "return_metrics": _aggregated("SELECT * FROM rm"),
        "complaint_metrics": _aggregated("SELECT * FROM cm"),
        "seller_aggregates": _aggregated(
            "SELECT * REPLACE (round(avg_order_amount, 2) AS avg_order_amount) FROM aggregates"
        ),
        "orders_with_returns": _refined(
            """SELECT o.* FROM ref_orders o WHERE EXISTS (SELECT 1 FROM ref_returns r
            WHERE r.order_id = o.order_id AND r.seller_id = o.seller_id)"""
        ),
        # risk model
        "risk_components": _curated(
            """SELECT seller_id, complaint_rate, high_severity_rate, days_active,
            return_component, complaint_volume_component, complaint_severity_component,
            trust_component, new_seller_component FROM components"""
        ),
        "seller_risk": _curated(f"SELECT {_RISK_ROUNDED} FROM risk"),
        "fraud_patterns": _curated(f"SELECT {_FRAUD_ROUNDED} FROM fraud"),
        # investigations
        "q01_high_risk": _curated(
            """SELECT * EXCLUDE (avg_order_amount, risk_index)
            REPLACE (round(risk_score, 4) AS risk_score)
            FROM risk WHERE risk_label = 'HIGH' ORDER BY risk_score DESC, seller_id"""
        ),
        "q02_suspicious_returns": _curated(
            """SELECT seller_id, seller_name, total_orders, total_returns,
            round(return_rate * 100, 2) AS return_rate_pct, round(risk_score, 4) AS risk_score
            FROM risk WHERE return_rate > 0.4 ORDER BY return_rate DESC, seller_id"""
        ),
        "q03_high_severity": _curated(
            """SELECT seller_id, seller_name, region, total_complaints, high_severity_complaints,
            risk_label FROM risk WHERE high_severity_complaints >= 2
            ORDER BY high_severity_complaints DESC, seller_id"""
        ),
        "q04_fraud_patterns": _curated(
            f"SELECT {_FRAUD_ROUNDED} FROM fraud ORDER BY flagged_at DESC, seller_id"
        ),
        "q05_unverified_risky": _curated(
            """SELECT seller_id, seller_name, region, verification_status,
            round(risk_score, 4) AS risk_score, risk_label, total_complaints FROM risk
            WHERE verification_status = 'unverified' AND risk_label <> 'LOW'
            ORDER BY risk.risk_score DESC, seller_id"""
        ),
        "q06_complaint_breakdown": _refined(
            """SELECT seller_id, category, count(*) AS complaint_count,
            CAST(sum(CASE WHEN severity = 'high' THEN 1 ELSE 0 END) AS BIGINT)
                AS high_severity_count
            FROM ref_complaints GROUP BY ALL ORDER BY complaint_count DESC, seller_id, category"""
        ),
        "q06_by_name": _refined(
            """SELECT seller_id, category, count(*) AS complaint_count,
            CAST(sum(CASE WHEN severity = 'high' THEN 1 ELSE 0 END) AS BIGINT)
                AS high_severity_count
            FROM ref_complaints GROUP BY ALL ORDER BY complaint_count DESC, seller_id, category"""
        ),
        "q09_by_name": _curated(f"SELECT {_PROFILE} WHERE r.seller_id = '{SELLER}'"),
        "q07_daily_volume": _refined(
            """SELECT seller_id, CAST(event_ts AS DATE) AS order_date,
            count(order_id) AS daily_orders, round(sum(amount), 4) AS daily_revenue
            FROM ref_orders GROUP BY ALL ORDER BY daily_orders DESC, seller_id, order_date"""
        ),
        "q07_daily_spikes": f"WITH {_RAW}{_REFINED}{_SPIKES}",
        "q08_returns_and_complaints": _curated(
            """SELECT seller_id, seller_name, return_rate, total_complaints,
            high_severity_complaints, round(risk_score, 4) AS risk_score, risk_label FROM risk
            WHERE return_rate > 0.3 AND total_complaints >= 2
            ORDER BY risk.risk_score DESC, seller_id"""
        ),
        "q09_seller_profile": _curated(f"SELECT {_PROFILE} WHERE r.seller_id = '{SELLER}'"),
        "q09_all_profiles": _curated(f"SELECT {_PROFILE}"),
        "q10_top10": _curated(
            f"SELECT {_BRIEF} FROM risk ORDER BY risk.risk_score DESC, seller_id LIMIT 10"
        ),
        "nb_high_risk": _curated(f"SELECT {_BRIEF} FROM risk WHERE risk_label = 'HIGH'"),
        "nb_seller_risk": _curated(
            f"SELECT {_RISK_ROUNDED} FROM risk WHERE seller_id = '{SELLER}'"
        ),
        "nb_seller_fraud": _curated(
            f"SELECT {_FRAUD_ROUNDED} FROM fraud WHERE seller_id = '{SELLER}'"
        ),
        "nb_score_distribution": _curated(
            f"""SELECT seller_name, round(risk_score, 4) AS risk_score, risk_label, {_PLOT_COLOUR}
            FROM risk"""
        ),
        "nb_scatter": _curated(
            f"""SELECT seller_name, return_rate, total_complaints, risk_label, {_PLOT_COLOUR}
            FROM risk"""
        ),
        # reports and drill-downs
        "headline_kpis": _curated(
            """SELECT count(*) AS sellers,
            count(CASE WHEN risk_label = 'HIGH' THEN 1 END) AS high_risk,
            count(CASE WHEN risk_label = 'MEDIUM' THEN 1 END) AS medium_risk,
            count(CASE WHEN risk_label = 'LOW' THEN 1 END) AS low_risk,
            round(avg(risk_score), 4) AS avg_risk_score,
            CAST(sum(total_orders) AS BIGINT) AS total_orders FROM risk"""
        ),
        "region_cards": _curated(
            f"""SELECT region, sellers, riskiest_seller, round(total, 4) AS total_risk_index,
              round(mean, 4) AS mean_risk_index, region_label,
              {_LABEL_COLOUR.format("region_label")} AS region_colour
            FROM (
              SELECT *, CASE WHEN mean >= 70 THEN 'HIGH' WHEN mean >= 40 THEN 'MEDIUM'
                             ELSE 'LOW' END AS region_label
              FROM (SELECT region, count(*) AS sellers, sum(risk_index) AS total,
                           sum(risk_index) / count(*) AS mean,
                           first(seller_name ORDER BY risk_score DESC, seller_id) AS riskiest_seller
                    FROM risk GROUP BY region))
            ORDER BY mean DESC, region"""
        ),
        "region_members": _curated(
            """SELECT region, row_number() OVER (PARTITION BY region
                 ORDER BY risk_score DESC, seller_id) AS place, seller_id, seller_name FROM risk"""
        ),
        "priority_list": _curated(
            f"""SELECT row_number() OVER (ORDER BY risk_score DESC, seller_id) AS priority,
            seller_id, seller_name, region, verification_status,
            CASE WHEN verification_status = 'verified' THEN '#22c55e' ELSE '#ef4444' END
                AS verification_colour,
            total_orders, round(return_rate * 100, 1) AS return_rate_pct,
            CASE WHEN return_rate * 100 > 40 THEN '#ef4444'
                 WHEN return_rate * 100 > 20 THEN '#f59e0b' ELSE '#22c55e' END
                AS return_rate_colour,
            high_severity_complaints,
            CASE WHEN high_severity_complaints >= 5 THEN '#ef4444' ELSE '#64748b' END
                AS complaint_colour,
            round(risk_score, 1) AS risk_score, risk_label,
            {_LABEL_COLOUR.format("risk_label")} AS label_colour,
            CASE risk_label WHEN 'HIGH' THEN '#fee2e2' WHEN 'MEDIUM' THEN '#fef3c7'
                 ELSE '#dcfce7' END AS label_background,
            CASE risk_label WHEN 'HIGH' THEN '#b91c1c' WHEN 'MEDIUM' THEN '#92400e'
                 ELSE '#15803d' END AS label_text_colour
            FROM risk ORDER BY priority"""
        ),
        "fraud_table": _curated(
            """SELECT seller_id, pattern_type, explanation, round(indicator_value, 1) AS score,
            strftime(flagged_at, '%Y-%m-%d %H:%M:%S') AS flagged_at FROM fraud"""
        ),
        "chart_seller_scores": _curated(
            f"""SELECT seller_name, round(risk_score, 1) AS risk_score,
            {_LABEL_COLOUR.format("risk_label")} AS colour
            FROM risk ORDER BY risk.risk_score DESC, seller_id"""
        ),
        "chart_region_index": _curated(
            """SELECT region, round(sum(risk_index), 1) AS total_risk_index FROM risk
            GROUP BY region ORDER BY max(risk_score) DESC, region"""
        ),
        "customer_activity": _refined(_ACTIVITY.format(where="")),
        "customer_activity_seller": _refined(
            _ACTIVITY.format(where=f"WHERE o.seller_id = '{SELLER}'")
        ),
        "layer_counts": _curated(
            """SELECT "raw", refined, curated, "raw" - refined AS duplicates_removed,
            "raw" - valid AS rejected, valid - refined AS true_duplicates
            FROM (SELECT (SELECT count(*) FROM raw_orders) AS "raw",
                         (SELECT count(*) FROM raw_orders
                          WHERE amount > 0 AND amount < 10000) AS valid,
                         (SELECT count(*) FROM ref_orders) AS refined,
                         (SELECT count(*) FROM risk) AS curated)"""
        ),
        "event_counts": _raw(
            """SELECT orders + returns + complaints AS total, orders, returns, complaints
            FROM (SELECT (SELECT count(*) FROM raw_orders) AS orders,
                         (SELECT count(*) FROM raw_returns) AS returns,
                         (SELECT count(*) FROM raw_complaints) AS complaints)"""
        ),
        # governance
        **{name: _refined(_quality(*spec)) for name, spec in _QUALITY.items()},
        "quality_raw_orders": _refined(
            _quality(
                "refined.orders",
                "typed_orders",
                "order_id",
                "order_id IS NULL OR seller_id IS NULL OR amount <= 0",
            )
        ),
        "quality_report": _refined(
            " UNION ALL ".join(_quality(*spec) for spec in _QUALITY.values())
        ),
        "duplicates_across_runs": f"WITH {_RAW}{_CORRECTED} "
        "SELECT 'refined.orders' AS table_name, count(*) AS total_rows, "
        "count(*) - count(DISTINCT order_id) - CAST(count(*) > count(order_id) AS BIGINT) AS duplicate_rows, "
        "true AS estimate_within_bound FROM typed_orders",
        "rekeyed_customers": _refined(
            f"""SELECT {_hmac("customer_id", MASK_KEYS[1][1])} AS customer_id_masked, '{MASK_KEYS[1][0]}' AS mask_key_id,
            count(*) AS total_orders, round(sum(amount), 4) AS total_amount FROM ref_orders GROUP BY customer_id"""
        ),
        "mask_customers": _refined(
            """SELECT order_id, seller_id, amount, event_ts, status, category,
            sha256(customer_id) AS customer_id_masked FROM ref_orders"""
        ),
        "role_business_view": _curated(
            "SELECT seller_id, seller_name, region, risk_label FROM risk"
        ),
        "access_report": _curated(_access()),
        "catalog_listing": _curated(
            " UNION ALL ".join(
                f"SELECT '{n.split('.')[0]}' AS layer, '{n.split('.')[1]}' AS table_name, "
                f"count(*) AS row_count, true AS schema_ok FROM {cte}"
                for n, cte in _PUBLISHED.items()
            )
        ),
        # pipelines
        "pipeline_run": _curated(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, true AS table_exists, count(*) AS row_count, "
                f"true AS schema_ok FROM {_PUBLISHED[name]}"
                for name in ("curated.seller_risk", "curated.fraud_patterns")
            )
        ),
    }
    sql["role_ts_orders"] = sql["mask_customers"]
    sql["incremental_untidy_orders"] = sql["normalize_untidy_orders"]
    return sql
