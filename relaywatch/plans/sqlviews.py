"""SQL (DuckDB dialect) twins of the derived views, used by the oracle.

Each oracle query starts with ``WITH`` + one of the CTE blocks below, so it
reads only the driver's registered tables.
"""

from __future__ import annotations

from relaywatch.schema import INCIDENT_CONFIG, ITEM_PRICES, MODES, RESTAURANTS


def _values(rows) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _case(idx: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {whens} END"


INC_CFG = (f"inc_cfg(inc, incident, delay_pct, prep_lo, prep_hi, cancel_pct) AS "
           f"(VALUES {_values([(i, *r) for i, r in enumerate(INCIDENT_CONFIG)])})")
ITEM_CFG = (f"item_cfg(item_idx, item_name, price) AS "
            f"(VALUES {_values([(i, *r) for i, r in enumerate(ITEM_PRICES)])})")
MODE_CASE = _case("m", MODES)
REST_CASE = _case("CAST((k // 5) % 5 AS INT)", RESTAURANTS)

# Order receipts over ``orders`` (same rules as sources.orders).
RECEIPTS = f"""{INC_CFG},
{ITEM_CFG},
o_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderkey % 3 AS INT) AS m,
         o_orderkey // 3 + 1 AS seq, CAST((o_orderkey // 200) % 7 AS INT) AS inc
  FROM orders),
o_copies AS (
  SELECT *, CASE WHEN m = 0 AND (seq * 7919) % 100 < 20 THEN 0
                 WHEN m = 1 AND (seq * 104729) % 100 < 25 THEN 2 ELSE 1 END AS copies
  FROM o_base),
receipts AS (
  SELECT 'ORD-' || CAST(k AS VARCHAR) AS order_id,
         'cust_' || CAST(c AS VARCHAR) AS customer_id,
         {REST_CASE} AS restaurant_name,
         it.item_name,
         CAST(c % 5 + 1 AS INT) AS quantity,
         CAST(it.price AS INT) AS price_per_item,
         CAST((c % 5 + 1) * it.price AS INT) AS total_price,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(k), '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         {MODE_CASE} AS kafka_mode,
         CAST(seq AS INT) AS sent_sequence,
         CAST(k + 1704067200 AS DOUBLE) AS producer_sent_at,
         CAST(ic.prep_lo + (k * 17) % (ic.prep_hi - ic.prep_lo + 1) AS INT) AS prep_time_minutes,
         (k * 37 + 11) % 100 < ic.delay_pct AS is_delayed,
         (k * 61 + 7) % 100 < ic.cancel_pct AS is_cancelled,
         ic.incident AS incident_mode,
         k // 200 AS epoch,
         k * 2 + t.cp AS arrival,
         CAST(t.cp AS INT) AS copy_no,
         (k + 1704067200) * 1000000 + t.cp * 200000 AS kafka_ts_us
  FROM o_copies
  CROSS JOIN LATERAL (SELECT unnest(range(o_copies.copies)) AS cp) AS t
  JOIN inc_cfg ic ON ic.inc = o_copies.inc
  JOIN item_cfg it ON it.item_idx = CAST(k % 5 AS INT))"""

ATTEMPTS = f"""attempts AS (
  SELECT {MODE_CASE} AS kafka_mode, 'ORD-' || CAST(k AS VARCHAR) AS order_id,
         CASE WHEN m = 0 AND (seq * 7919) % 100 < 20 THEN 'dropped'
              WHEN m = 1 AND (seq * 104729) % 100 < 25 THEN 'duplicated'
              ELSE 'sent' END AS outcome
  FROM (SELECT o_orderkey AS k, CAST(o_orderkey % 3 AS INT) AS m, o_orderkey // 3 + 1 AS seq
        FROM orders))"""

# Raw topic values with the same deterministic faults as
# sources.orders.topic_records_from_receipts.
TOPIC = """topic_raw AS (
  SELECT r.*, arrival // 2 AS k FROM receipts r),
topic AS (
  SELECT order_id AS key_text, arrival, kafka_ts_us,
    CASE WHEN k % 59 = 0 THEN NULL
         WHEN k % 53 = 0 THEN '{"order_id": "ORD-' || CAST(k AS VARCHAR) || '", broken'
         ELSE '{"order_id":"' || order_id || '","customer_id":"' || customer_id
           || '","restaurant_name":"' || restaurant_name || '","item_name":"' || item_name
           || '","quantity":' || CAST(quantity AS VARCHAR)
           || ',"price_per_item":' || CAST(price_per_item AS VARCHAR)
           || ',"total_price":' || CAST(total_price AS VARCHAR)
           || ',"kafka_mode":"' || (CASE WHEN k % 37 = 0 THEN 'bogus_mode'
                                         WHEN k % 29 = 0 THEN upper(kafka_mode) ELSE kafka_mode END)
           || '","producer_sent_at":' || CAST(CAST(producer_sent_at AS BIGINT) AS VARCHAR)
           || ',"sent_sequence":' || (CASE WHEN k % 31 = 0 THEN '"x"' ELSE CAST(sent_sequence AS VARCHAR) END)
           || (CASE WHEN k % 41 = 0 THEN '' ELSE ',"prep_time_minutes":' || CAST(prep_time_minutes AS VARCHAR) END)
           || (CASE WHEN k % 47 = 0 THEN '' ELSE ',"is_delayed":' || CAST(is_delayed AS VARCHAR) END)
           || ',"is_cancelled":' || CAST(is_cancelled AS VARCHAR)
           || ',"incident_mode":"' || (CASE WHEN k % 43 = 0 THEN 'unknown_incident' ELSE incident_mode END)
           || '"}'
    END AS value_text
  FROM topic_raw)"""


def tfidf_ctes(docs_sql: str, queries_sql: str, p: str = "") -> str:
    """TF-IDF scoring CTEs (reference formulation: normalise both vectors,
    then sum products). ``docs_sql`` yields (doc_id, text), ``queries_sql``
    yields (qid, text); CTE names are prefixed with ``p``."""
    tok = "unnest(regexp_extract_all(lower(text), '[a-z0-9]+'))"
    return f"""{p}docs AS ({docs_sql}),
{p}occ AS (SELECT doc_id, {tok} AS token FROM {p}docs),
{p}tf AS (SELECT doc_id, token, count(*) AS tf FROM {p}occ GROUP BY doc_id, token),
{p}nd AS (SELECT count(*) AS n FROM {p}docs),
{p}dfq AS (SELECT token, count(*) AS df FROM {p}tf GROUP BY token),
{p}idf AS (SELECT token, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM {p}dfq, {p}nd),
{p}norms AS (SELECT doc_id, sqrt(sum(pow(tf * idf, 2))) AS norm
             FROM {p}tf JOIN {p}idf USING (token) GROUP BY doc_id),
{p}queries AS ({queries_sql}),
{p}qocc AS (SELECT qid, {tok} AS token FROM {p}queries),
{p}qtf AS (SELECT qid, token, count(*) AS qtf FROM {p}qocc GROUP BY qid, token),
{p}qk AS (SELECT qid, token, qtf, idf FROM {p}qtf JOIN {p}idf USING (token)),
{p}qn AS (SELECT qid, sqrt(sum(pow(qtf * idf, 2))) AS qnorm FROM {p}qk GROUP BY qid),
{p}qv AS (SELECT qid, token, qtf * idf / qnorm AS qw FROM {p}qk JOIN {p}qn USING (qid)),
{p}dv AS (SELECT doc_id, token, tf * idf / norm AS dw
          FROM {p}tf JOIN {p}idf USING (token) JOIN {p}norms USING (doc_id)),
{p}scores AS (SELECT qid, doc_id, sum(qw * dw) AS score FROM {p}qv JOIN {p}dv USING (token)
              GROUP BY qid, doc_id),
{p}ranked AS (
  SELECT q.qid, d.doc_id, round(coalesce(s.score, 0.0), 6) AS score,
         CAST(row_number() OVER (PARTITION BY q.qid
                                 ORDER BY round(coalesce(s.score, 0.0), 6) DESC, d.doc_id)
              AS INTEGER) AS rank
  FROM {p}queries q CROSS JOIN {p}docs d
  LEFT JOIN {p}scores s ON s.qid = q.qid AND s.doc_id = d.doc_id)"""
