"""Registered reliability, decode and encode queries over the receipt view."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.operators import decode as D
from relaywatch.operators import reliability as R
from relaywatch.plans.registry import register, rounded, sql_pct, table
from relaywatch.plans.sqlviews import ATTEMPTS, RECEIPTS, TOPIC
from relaywatch.schema import (FORWARDED_FIELDS, INCIDENTS, ITEM_PRICES, MODE_DESCRIPTIONS,
                               MODES, ORDER)
from relaywatch.sources.orders import (delivery_attempts_from_orders, receipts,
                                       topic_records_from_receipts)

W = "WITH " + RECEIPTS


def topic(spark, sf):
    return topic_records_from_receipts(receipts(spark, sf))


@register("a1_order_receipts", W + """
SELECT order_id, kafka_mode, count(*) AS receive_count,
       arg_min(customer_id, arrival) AS customer_id,
       arg_min(restaurant_name, arrival) AS restaurant_name,
       arg_min(item_name, arrival) AS item_name,
       arg_min(sent_sequence, arrival) AS sent_sequence,
       count(*) > 1 AS is_duplicate
FROM receipts GROUP BY order_id, kafka_mode""")
def a1_order_receipts(spark, sf):
    return R.order_receipts(receipts(spark, sf))


_SUMMARY_SQL = """
per_order AS (SELECT order_id, kafka_mode, count(*) AS receive_count,
                     max(sent_sequence) AS sent_sequence
              FROM {src} GROUP BY order_id, kafka_mode),
s AS (SELECT kafka_mode, count(*) AS unique_orders,
             CAST(sum(receive_count) AS BIGINT) AS total_orders_received,
             max(sent_sequence) AS sent_orders
      FROM per_order GROUP BY kafka_mode)"""

_SUMMARY_COLS = f"""kafka_mode, unique_orders, total_orders_received, sent_orders,
       total_orders_received - unique_orders AS duplicate_orders,
       {sql_pct('total_orders_received - unique_orders', 'total_orders_received')} AS duplicate_percentage,
       greatest(sent_orders - total_orders_received, 0) AS estimated_loss,
       {sql_pct('unique_orders', 'total_orders_received', '100.0')} AS accuracy,
       greatest(sent_orders - unique_orders, 0) AS missing_orders"""


@register("a2_delivery_summary", W + "," + _SUMMARY_SQL.format(src="receipts")
          + "\nSELECT " + _SUMMARY_COLS + " FROM s")
def a2_delivery_summary(spark, sf):
    return rounded(R.delivery_summary(receipts(spark, sf)))


@register("p5_duplicate_orders", W + """
SELECT order_id, kafka_mode, count(*) AS receive_count
FROM receipts GROUP BY order_id, kafka_mode HAVING count(*) > 1""")
def p5_duplicate_orders(spark, sf):
    return R.duplicate_orders(receipts(spark, sf))


@register("a4_exact_distinct", W + """
SELECT kafka_mode, count(*) AS total_orders_received,
       count(DISTINCT order_id) AS unique_orders
FROM receipts GROUP BY kafka_mode""")
def a4_exact_distinct(spark, sf):
    return R.exact_distinct(receipts(spark, sf))


def _within_bound(approx, exact, rsd: float = 0.05):
    """Whether each estimate lies within three standard deviations of the exact
    count (HyperLogLog++ registers differ between engines, the bound does not)."""
    e = exact.select("kafka_mode", F.col("unique_orders").alias("exact_unique"))
    return approx.join(e, "kafka_mode").select(
        "kafka_mode", "total_orders_received", "exact_unique",
        (F.abs(F.col("unique_orders") - F.col("exact_unique"))
         <= F.lit(3 * rsd) * F.col("exact_unique")).alias("within_bound"))


@register("a5_approx_distinct", W + """
SELECT kafka_mode, count(*) AS total_orders_received, count(DISTINCT order_id) AS exact_unique,
       true AS within_bound
FROM receipts GROUP BY kafka_mode""")
def a5_approx_distinct(spark, sf):
    r = receipts(spark, sf)
    return _within_bound(R.approx_distinct(r), R.exact_distinct(r))


@register("a8_latest_sequence", W + """
SELECT kafka_mode, max(sent_sequence) AS max_sent_sequence,
       round(max(producer_sent_at), 6) AS latest_producer_time
FROM receipts GROUP BY kafka_mode""")
def a8_latest_sequence(spark, sf):
    return rounded(R.latest_sequence(receipts(spark, sf)))


@register("a12_attempt_totals", "WITH " + ATTEMPTS + f"""
SELECT kafka_mode, count(*) AS attempts,
       CAST(count_if(outcome <> 'dropped') AS BIGINT) + CAST(count_if(outcome = 'duplicated') AS BIGINT) AS sent,
       CAST(count_if(outcome = 'failed') AS BIGINT) AS failed,
       CAST(count_if(outcome = 'dropped') AS BIGINT) AS dropped,
       CAST(count_if(outcome = 'duplicated') AS BIGINT) AS duplicated,
       {sql_pct("CAST(count_if(outcome <> 'dropped') AS BIGINT) + CAST(count_if(outcome = 'duplicated') AS BIGINT)", 'count(*)')}
         AS success_rate
FROM attempts GROUP BY kafka_mode""")
def a12_attempt_totals(spark, sf):
    return rounded(R.attempt_totals(delivery_attempts_from_orders(table(spark, sf, "orders"))))


@register("a13_loss_rate", W + "," + _SUMMARY_SQL.format(src="receipts") + f"""
SELECT kafka_mode, sent_orders, total_orders_received,
       {sql_pct('sent_orders - total_orders_received', 'sent_orders')} AS loss_rate
FROM s""")
def a13_loss_rate(spark, sf):
    return rounded(R.loss_rate(R.delivery_summary(receipts(spark, sf))))


_MODE_DESC_VALUES = ", ".join(
    "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")"
    for row in MODE_DESCRIPTIONS)


@register("j8_mode_descriptions", W + "," + _SUMMARY_SQL.format(src="receipts") + f""",
md(kafka_mode, name, description, impact) AS (VALUES {_MODE_DESC_VALUES}),
summ AS (SELECT {_SUMMARY_COLS} FROM s)
SELECT summ.*, md.name, md.description, md.impact
FROM summ LEFT JOIN md USING (kafka_mode)""")
def j8_mode_descriptions(spark, sf):
    return rounded(R.describe_modes(spark, R.delivery_summary(receipts(spark, sf))))


@register("w2_running_reliability", W + f""",
flagged AS (
  SELECT r.*, arrival = min(arrival) OVER (PARTITION BY kafka_mode, order_id) AS first_seen
  FROM receipts r),
run AS (
  SELECT kafka_mode, order_id, arrival, first_seen,
         count(*) OVER w AS total_orders,
         CAST(sum(CAST(first_seen AS BIGINT)) OVER w AS BIGINT) AS unique_orders,
         max(sent_sequence) OVER w AS max_sent_sequence
  FROM flagged
  WINDOW w AS (PARTITION BY kafka_mode ORDER BY arrival
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT *, total_orders - unique_orders AS duplicate_orders,
       {sql_pct('total_orders - unique_orders', 'total_orders')} AS duplicate_percentage,
       {sql_pct('unique_orders', 'total_orders', '100.0')} AS accuracy,
       greatest(coalesce(max_sent_sequence, 0) - total_orders, 0) AS estimated_loss
FROM run""")
def w2_running_reliability(spark, sf, bucket_width: int | None = None):
    kw = {"bucket_width": bucket_width} if bucket_width else {}
    return rounded(R.running_reliability(receipts(spark, sf), **kw))


# --------------------------------------------------------------------------
# Decode / encode / web-side records over the raw topic (with faults).
# --------------------------------------------------------------------------

WT = W + ",\n" + TOPIC

_NO_FIELD = " AND ".join(f"json_extract_string(j, '$.{f.name}') IS NULL" for f in ORDER.fields)

_WEB_SQL = f""",
parsed AS (
  SELECT key_text, arrival, value_text,
         CASE WHEN value_text IS NOT NULL AND json_valid(value_text) THEN value_text END AS j
  FROM topic),
f AS (
  SELECT arrival, value_text, j,
         json_extract_string(j, '$.order_id') AS order_id,
         json_extract_string(j, '$.kafka_mode') AS mode_raw,
         json_extract_string(j, '$.sent_sequence') AS seq_raw,
         json_extract_string(j, '$.prep_time_minutes') AS prep_raw,
         CASE json_extract_string(j, '$.is_delayed') WHEN 'true' THEN true WHEN 'false' THEN false END AS is_delayed,
         CASE json_extract_string(j, '$.is_cancelled') WHEN 'true' THEN true WHEN 'false' THEN false END AS is_cancelled,
         json_extract_string(j, '$.incident_mode') AS incident_raw,
         json_extract_string(j, '$.restaurant_name') AS restaurant_raw,
         json_extract_string(j, '$.item_name') AS item_raw,
         json_extract_string(j, '$.total_price') AS total_raw,
         json_extract_string(j, '$.quantity') AS quantity_raw,
         json_extract_string(j, '$.price_per_item') AS price_raw
  FROM parsed),
web AS (
  SELECT arrival, order_id,
         lower(coalesce(mode_raw, 'unknown')) AS kafka_mode,
         coalesce(TRY_CAST(seq_raw AS INT), 0) AS sent_sequence,
         coalesce(TRY_CAST(prep_raw AS INT), 15) AS prep_time_minutes,
         coalesce(is_delayed, false) AS is_delayed,
         coalesce(is_cancelled, false) AS is_cancelled,
         coalesce(incident_raw, 'normal') AS incident_mode,
         coalesce(restaurant_raw, 'N/A') AS restaurant_name,
         coalesce(item_raw, 'N/A') AS item_name,
         coalesce(TRY_CAST(total_raw AS INT), 0) AS total_price,
         TRY_CAST(quantity_raw AS INT) AS quantity,
         TRY_CAST(price_raw AS INT) AS price_per_item,
         CASE WHEN value_text IS NULL THEN 'null_value'
              WHEN j IS NULL OR ({_NO_FIELD}) THEN 'bad_json'
              WHEN seq_raw IS NOT NULL AND TRY_CAST(seq_raw AS INT) IS NULL THEN 'bad_sequence'
              WHEN lower(coalesce(mode_raw, 'unknown')) NOT IN ({", ".join(repr(m) for m in MODES)})
                THEN 'unknown_mode'
              WHEN prep_raw IS NOT NULL AND TRY_CAST(prep_raw AS INT) IS NULL THEN 'bad_prep'
         END AS reject_reason
  FROM f)"""


def web(spark, sf):
    return D.web_records(topic(spark, sf), keep=["arrival"])


@register("p10_web_records", WT + _WEB_SQL + "\nSELECT * FROM web")
def p10_web_records(spark, sf):
    return web(spark, sf)


@register("p10_rejects", WT + _WEB_SQL + """
SELECT reject_reason, count(*) AS n FROM web WHERE reject_reason IS NOT NULL
GROUP BY reject_reason""")
def p10_rejects(spark, sf):
    return D.rejected(web(spark, sf)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@register("a3_mode_reliability", WT + _WEB_SQL + ",\n"
          + _SUMMARY_SQL.format(src="(SELECT * FROM web WHERE reject_reason IS NULL)") + f""",
base(kafka_mode, mode_rank) AS (VALUES {", ".join(f"('{m}', {i})" for i, m in enumerate(MODES))})
SELECT base.kafka_mode, base.mode_rank,
       coalesce(total_orders_received, 0) AS total_orders,
       coalesce(unique_orders, 0) AS unique_orders,
       coalesce(total_orders_received - unique_orders, 0) AS duplicate_orders,
       coalesce({sql_pct('total_orders_received - unique_orders', 'total_orders_received')}, 0.0)
         AS duplicate_percentage,
       coalesce({sql_pct('unique_orders', 'total_orders_received', '100.0')}, 100.0) AS accuracy,
       coalesce(greatest(sent_orders - total_orders_received, 0), 0) AS estimated_loss,
       coalesce(sent_orders, 0) AS max_sent_sequence
FROM base LEFT JOIN s USING (kafka_mode)""")
def a3_mode_reliability(spark, sf):
    return rounded(R.mode_reliability(spark, D.accepted(web(spark, sf))))


@register("p8_mode_allow_list", WT + """,
modes AS (SELECT lower(json_extract_string(value_text, '$.kafka_mode')) AS kafka_mode
          FROM topic WHERE value_text IS NOT NULL AND json_valid(value_text))
SELECT kafka_mode, count(*) AS n FROM modes
WHERE kafka_mode IN (""" + ", ".join(f"'{m}'" for m in MODES) + """)
GROUP BY kafka_mode""")
def p8_mode_allow_list(spark, sf):
    dec = D.decode_orders(topic(spark, sf))
    return (D.allowed_modes(spark, dec).groupBy("kafka_mode")
            .agg(F.count(F.lit(1)).alias("n")))


@register("p9_incident_allow_list", WT + _WEB_SQL + """
SELECT incident_mode, lower(incident_mode) IN (""" + ", ".join(f"'{i}'" for i in INCIDENTS)
          + """) AS incident_allowed,
       count(*) AS n
FROM web WHERE reject_reason IS NULL GROUP BY 1, 2""")
def p9_incident_allow_list(spark, sf):
    acc = D.accepted(web(spark, sf))
    return (D.incident_allow_list(acc).groupBy("incident_mode", "incident_allowed")
            .agg(F.count(F.lit(1)).alias("n")))


@register("p1_decode_event_props", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INT) AS k FROM events""")
def p1_decode_event_props(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


def _json_field(name: str, kind: str) -> str:
    val = f"to_json({name})" if kind != "str" else f"to_json({name})"
    return f"CASE WHEN {name} IS NOT NULL THEN '\"{name}\":' || {val} END"


_FWD_KIND = {f.name: f.dataType.typeName() for f in ORDER.fields}


# Consumer-side decode of the topic (typed fields; a mistyped field is null).
DECODED_SQL = """,
parsed AS (
  SELECT key_text, arrival,
         CASE WHEN value_text IS NOT NULL AND json_valid(value_text) THEN value_text END AS j
  FROM topic),
dec AS (
  SELECT key_text AS event_key, arrival,
         json_extract_string(j, '$.order_id') AS order_id,
         json_extract_string(j, '$.customer_id') AS customer_id,
         json_extract_string(j, '$.restaurant_name') AS restaurant_name,
         json_extract_string(j, '$.item_name') AS item_name,
         CASE WHEN json_type(j, '$.quantity') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(j, '$.quantity') AS INT) END AS quantity,
         CASE WHEN json_type(j, '$.price_per_item') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(j, '$.price_per_item') AS INT) END AS price_per_item,
         CASE WHEN json_type(j, '$.total_price') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(j, '$.total_price') AS INT) END AS total_price,
         json_extract_string(j, '$.timestamp') AS "timestamp",
         json_extract_string(j, '$.kafka_mode') AS kafka_mode,
         CAST(json_extract(j, '$.producer_sent_at') AS DOUBLE) AS producer_sent_at,
         CASE WHEN json_type(j, '$.sent_sequence') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(j, '$.sent_sequence') AS INT) END AS sent_sequence,
         CASE WHEN json_type(j, '$.prep_time_minutes') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract(j, '$.prep_time_minutes') AS INT) END AS prep_time_minutes,
         CASE json_extract_string(j, '$.is_delayed') WHEN 'true' THEN true WHEN 'false' THEN false END AS is_delayed,
         CASE json_extract_string(j, '$.is_cancelled') WHEN 'true' THEN true WHEN 'false' THEN false END AS is_cancelled,
         json_extract_string(j, '$.incident_mode') AS incident_mode
  FROM parsed)"""

FORWARD_SELECT = """
SELECT order_id AS "key", arrival,
  '{' || array_to_string(list_filter([""" + ",\n    ".join(
    _json_field(n, _FWD_KIND[n]) for n in FORWARDED_FIELDS) + """,
    '"type":"received"'], lambda x: x IS NOT NULL), ',') || '}' AS "value"
FROM dec"""


@register("p1_p3_forward_encode", WT + DECODED_SQL + FORWARD_SELECT)
def p1_p3_forward_encode(spark, sf):
    dec = D.decode_orders(topic(spark, sf), keep=["arrival"])
    return D.encode_forwarded(dec, keep=["arrival"])


@register("p12_validate_amounts", W + """,
prices(item_name, list_price) AS (VALUES """
          + ", ".join(f"('{n}', {p})" for n, p in ITEM_PRICES) + """)
SELECT item_name, count(*) AS n_orders,
       CAST(sum(quantity * list_price) AS BIGINT) AS line_amount,
       CAST(count_if(quantity * list_price <> total_price) AS BIGINT) AS n_mismatch
FROM receipts LEFT JOIN prices USING (item_name) GROUP BY item_name""")
def p12_validate_amounts(spark, sf):
    v = D.validate_amounts(spark, receipts(spark, sf))
    return v.groupBy("item_name").agg(F.count(F.lit(1)).alias("n_orders"),
                                      F.sum("line_amount").alias("line_amount"),
                                      F.count_if(~F.col("amount_ok")).alias("n_mismatch"))


@register("p11_order_status", W + """
SELECT order_id, arrival,
       CASE WHEN is_cancelled THEN 'Cancelled' WHEN is_delayed THEN 'Delayed' ELSE 'Delivered' END AS status
FROM receipts""")
def p11_order_status(spark, sf):
    from relaywatch.functions.metrics import order_status
    return receipts(spark, sf).select("order_id", "arrival", order_status().alias("status"))


# A4 / A5 over the driver's ``events`` table (event_id is unique there).
@register("a4_events_exact_distinct", """
SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS unique_events,
       count(DISTINCT user_id) AS users
FROM events GROUP BY event_type""")
def a4_events_exact_distinct(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                        F.countDistinct("event_id").alias("unique_events"),
                                        F.countDistinct("user_id").alias("users"))


@register("a5_events_approx_distinct", """
SELECT event_type AS kafka_mode, count(*) AS total_orders_received,
       count(DISTINCT event_id) AS exact_unique, true AS within_bound
FROM events GROUP BY event_type""")
def a5_events_approx_distinct(spark, sf):
    """Approximate distinct ids with rsd 0.05; "duplicates" = count - estimate
    can go negative although every id is distinct (F4)."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "kafka_mode") \
        .withColumn("order_id", F.col("event_id").cast("string"))
    return _within_bound(R.approx_distinct(ev), R.exact_distinct(ev))
