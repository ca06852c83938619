"""Registered operations-KPI queries over the receipt view."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.operators import kpis as K
from relaywatch.operators import reliability as R
from relaywatch.plans.registry import register, rounded, sql_pct, table
from relaywatch.plans.sqlviews import RECEIPTS
from relaywatch.schema import MODES
from relaywatch.sources.orders import receipts

W = "WITH " + RECEIPTS

_BREACH = ("(total_orders >= 10 AND {inc} <> 'normal' AND "
           "(delay_rate > 20.0 OR cancellation_rate > 10.0 OR avg_prep_time > 22.0))")

_RATES = f"""{sql_pct('delayed_orders', 'total_orders')} AS delay_rate,
       {sql_pct('cancelled_orders', 'total_orders')} AS cancellation_rate,
       round(CASE WHEN total_orders - cancelled_orders > 0
                  THEN CAST(total_prep_time AS DOUBLE) / (total_orders - cancelled_orders)
                  ELSE 0.0 END, 6) AS avg_prep_time"""

# Unrounded rates (for the score and the breach test), then rounded output.
_RAW_RATES = """CASE WHEN total_orders > 0 THEN CAST(delayed_orders AS DOUBLE) * 100.0 / total_orders ELSE 0.0 END AS delay_rate,
       CASE WHEN total_orders > 0 THEN CAST(cancelled_orders AS DOUBLE) * 100.0 / total_orders ELSE 0.0 END AS cancellation_rate,
       CASE WHEN total_orders - cancelled_orders > 0
            THEN CAST(total_prep_time AS DOUBLE) / (total_orders - cancelled_orders) ELSE 0.0 END AS avg_prep_time"""

_SCORE = "greatest(100.0 - delay_rate * 0.4 - cancellation_rate * 2.0, 0.0)"

_KPI_SQL = f""",
agg AS (
  SELECT epoch, count(*) AS total_orders, CAST(count_if(is_delayed) AS BIGINT) AS delayed_orders,
         CAST(count_if(is_cancelled) AS BIGINT) AS cancelled_orders,
         CAST(sum(CASE WHEN NOT is_cancelled THEN prep_time_minutes ELSE 0 END) AS BIGINT) AS total_prep_time,
         arg_max(incident_mode, arrival) AS active_incident
  FROM {{src}} GROUP BY epoch),
kraw AS (SELECT *, {_RAW_RATES} FROM agg),
kpis AS (
  SELECT epoch, total_orders, delayed_orders, cancelled_orders, total_prep_time, active_incident,
         round(delay_rate, 6) AS delay_rate, round(cancellation_rate, 6) AS cancellation_rate,
         round(avg_prep_time, 6) AS avg_prep_time, round({_SCORE}, 6) AS reliability_score,
         {_BREACH.format(inc='active_incident')} AS breach
  FROM kraw)"""


@register("a6_operations_kpis", W + _KPI_SQL.format(src="receipts") + "\nSELECT * FROM kpis")
def a6_operations_kpis(spark, sf):
    return rounded(K.operations_kpis(receipts(spark, sf)))


@register("a6_operations_kpis_dedup", W + """,
firsts AS (SELECT * FROM receipts
           QUALIFY arrival = min(arrival) OVER (PARTITION BY kafka_mode, order_id))"""
          + _KPI_SQL.format(src="firsts") + "\nSELECT * FROM kpis")
def a6_operations_kpis_dedup(spark, sf):
    return rounded(K.operations_kpis(receipts(spark, sf), dedup=True))


_RUN_SQL = f""",
wsum AS (
  SELECT epoch, arrival, order_id, incident_mode,
         count(*) OVER w AS total_orders,
         CAST(sum(CAST(is_delayed AS BIGINT)) OVER w AS BIGINT) AS delayed_orders,
         CAST(sum(CAST(is_cancelled AS BIGINT)) OVER w AS BIGINT) AS cancelled_orders,
         CAST(sum(CASE WHEN NOT is_cancelled THEN prep_time_minutes ELSE 0 END) OVER w AS BIGINT)
           AS total_prep_time
  FROM receipts
  WINDOW w AS (PARTITION BY epoch ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rraw AS (SELECT *, {_RAW_RATES} FROM wsum),
run AS (
  SELECT epoch, arrival, order_id, incident_mode, total_orders, delayed_orders, cancelled_orders,
         total_prep_time, round(delay_rate, 6) AS delay_rate,
         round(cancellation_rate, 6) AS cancellation_rate, round(avg_prep_time, 6) AS avg_prep_time,
         round({_SCORE}, 6) AS reliability_score,
         {_BREACH.format(inc='incident_mode')} AS breach
  FROM rraw)"""

_RUN_COLS = ["epoch", "arrival", "order_id", "incident_mode", "total_orders", "delayed_orders",
             "cancelled_orders", "total_prep_time", "delay_rate", "cancellation_rate",
             "avg_prep_time", "reliability_score", "breach"]


@register("w1_running_kpis", W + _RUN_SQL + "\nSELECT * FROM run")
def w1_running_kpis(spark, sf, bucket_width: int | None = None):
    kw = {"bucket_width": bucket_width} if bucket_width else {}
    return rounded(K.running_kpis(receipts(spark, sf), **kw).select(*_RUN_COLS))


@register("w3_breach_events", W + _RUN_SQL + """,
kept AS (SELECT *, lag(incident_mode) OVER (PARTITION BY epoch ORDER BY arrival) AS prev
         FROM run WHERE breach)
SELECT epoch, arrival, order_id, incident_mode, total_orders, delay_rate, cancellation_rate,
       avg_prep_time, reliability_score
FROM kept WHERE prev IS NULL OR prev <> incident_mode""")
def w3_breach_events(spark, sf, bucket_width: int | None = None):
    kw = {"bucket_width": bucket_width} if bucket_width else {}
    run = K.running_kpis(receipts(spark, sf), **kw)
    ev = K.breach_events(run, **kw)
    return rounded(ev.select("epoch", "arrival", "order_id", "incident_mode", "total_orders",
                             "delay_rate", "cancellation_rate", "avg_prep_time",
                             "reliability_score"))


@register("w4_reset_epochs", W + """
SELECT epoch + 1 AS epoch_no, count(*) AS n_receipts, min(arrival) AS first_arrival,
       max(arrival) AS last_arrival, arg_max(incident_mode, arrival) AS incident_mode,
       min(incident_mode) AS epoch_incident
FROM receipts GROUP BY epoch""")
def w4_reset_epochs(spark, sf):
    r = receipts(spark, sf)
    resets = K.resets_from_orders(table(spark, sf, "orders"))
    e = K.assign_epochs(r, resets)
    return e.groupBy("epoch_no").agg(
        F.count(F.lit(1)).alias("n_receipts"), F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"),
        F.max_by("incident_mode", "arrival").alias("incident_mode"),
        F.min("epoch_incident").alias("epoch_incident"))


@register("l1_recent_orders", W + """
SELECT epoch, position, order_id, restaurant_name, item_name, total_price, kafka_mode, status,
       prep_time, arrival
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY epoch ORDER BY arrival DESC) AS INTEGER)
               AS position,
             CASE WHEN is_cancelled THEN 'Cancelled' WHEN is_delayed THEN 'Delayed'
                  ELSE 'Delivered' END AS status,
             prep_time_minutes AS prep_time
      FROM receipts)
WHERE position <= 12""")
def l1_recent_orders(spark, sf):
    return K.recent_orders(receipts(spark, sf), k=12)


FORWARD_FROM_ORDER = 300  # forwarding is switched on at this order number


def _topics(spark, sf):
    r = receipts(spark, sf)
    raw = r.select(F.lit("orders").alias("topic"), "order_id", "kafka_mode", "arrival")
    fwd = (r.filter(F.expr(f"arrival div 2 >= {FORWARD_FROM_ORDER}"))
           .select(F.lit("metrics").alias("topic"), "order_id", "kafka_mode",
                   (F.col("arrival") + 1).alias("arrival")))
    return fwd, raw


@register("u1_topic_merge", W + f""",
fwd AS (SELECT 'metrics' AS topic, order_id, kafka_mode, arrival + 1 AS arrival
        FROM receipts WHERE arrival // 2 >= {FORWARD_FROM_ORDER}),
raw AS (SELECT 'orders' AS topic, order_id, kafka_mode, arrival FROM receipts),
merged AS (SELECT * FROM fwd
           UNION ALL
           SELECT * FROM raw WHERE (SELECT min(arrival) FROM fwd) IS NULL
                                OR arrival < (SELECT min(arrival) FROM fwd))
SELECT topic, kafka_mode, count(*) AS n, min(arrival) AS first_arrival,
       max(arrival) AS last_arrival
FROM merged GROUP BY topic, kafka_mode""")
def u1_topic_merge(spark, sf):
    fwd, raw = _topics(spark, sf)
    m = K.merge_topics(fwd, raw)
    return m.groupBy("topic", "kafka_mode").agg(
        F.count(F.lit(1)).alias("n"), F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"))


@register("a9_latest_by_arrival", W + """
SELECT epoch, arg_max(incident_mode, arrival) AS active_incident,
       arg_max(kafka_mode, arrival) AS current_mode, max(arrival) AS last_update
FROM receipts GROUP BY epoch""")
def a9_latest_by_arrival(spark, sf):
    return K.latest_by_arrival(receipts(spark, sf))


@register("j7_kpi_vs_config", W + _KPI_SQL.format(src="receipts") + """
SELECT epoch, active_incident, ic.incident AS config_incident, delay_rate, cancellation_rate,
       avg_prep_time, CAST(ic.delay_pct AS DOUBLE) AS config_delay_rate,
       CAST(ic.cancel_pct AS DOUBLE) AS config_cancellation_rate,
       round((ic.prep_lo + ic.prep_hi) / 2.0, 6) AS config_prep_mean,
       round(delay_rate - ic.delay_pct, 6) AS delay_gap,
       round(cancellation_rate - ic.cancel_pct, 6) AS cancellation_gap
FROM kpis JOIN inc_cfg ic
  ON ic.incident = CASE WHEN active_incident IN (SELECT incident FROM inc_cfg)
                        THEN active_incident ELSE 'normal' END""")
def j7_kpi_vs_config(spark, sf):
    k = rounded(K.operations_kpis(receipts(spark, sf)))
    return rounded(K.kpi_vs_config(spark, k))


_LATEST_SQL = """,
latest AS (SELECT * FROM kpis ORDER BY epoch DESC LIMIT 1),
s11 AS (
  SELECT coalesce(l.delay_rate, 0.0) AS delay_rate, coalesce(l.avg_prep_time, 15.0) AS avg_prep_time,
         coalesce(l.cancellation_rate, 0.0) AS cancellation_rate,
         coalesce(l.reliability_score, 100.0) AS reliability_score,
         coalesce(l.active_incident, 'normal') AS active_incident
  FROM (VALUES (1)) AS one(x) LEFT JOIN latest l ON true)"""


@register("s11_latest_kpis", W + _KPI_SQL.format(src="receipts") + _LATEST_SQL
          + "\nSELECT * FROM s11")
def s11_latest_kpis(spark, sf):
    return rounded(K.latest_kpis(rounded(K.operations_kpis(receipts(spark, sf)))))


@register("s12_snapshot", W + _KPI_SQL.format(src="receipts") + _LATEST_SQL + f""",
per_order AS (SELECT order_id, kafka_mode, count(*) AS receive_count,
                     max(sent_sequence) AS sent_sequence
              FROM receipts GROUP BY order_id, kafka_mode),
s AS (SELECT kafka_mode, count(*) AS unique_orders,
             CAST(sum(receive_count) AS BIGINT) AS total_orders_received,
             max(sent_sequence) AS sent_orders
      FROM per_order GROUP BY kafka_mode),
base(kafka_mode, mode_rank) AS (VALUES {", ".join(f"('{m}', {i})" for i, m in enumerate(MODES))}),
modes AS (
  SELECT base.kafka_mode, base.mode_rank,
         coalesce(total_orders_received, 0) AS total_orders,
         coalesce(unique_orders, 0) AS unique_orders,
         coalesce(total_orders_received - unique_orders, 0) AS duplicate_orders,
         coalesce({sql_pct('total_orders_received - unique_orders', 'total_orders_received')}, 0.0)
           AS duplicate_percentage,
         coalesce({sql_pct('unique_orders', 'total_orders_received', '100.0')}, 100.0) AS accuracy,
         coalesce(greatest(sent_orders - total_orders_received, 0), 0) AS estimated_loss,
         coalesce(sent_orders, 0) AS max_sent_sequence
  FROM base LEFT JOIN s USING (kafka_mode)),
cur AS (SELECT arg_max(kafka_mode, arrival) AS current_mode FROM receipts)
SELECT modes.*, modes.kafka_mode = cur.current_mode AS is_active_mode,
       s11.delay_rate, s11.avg_prep_time, s11.cancellation_rate, s11.reliability_score,
       s11.active_incident
FROM modes, cur, s11""")
def s12_snapshot(spark, sf):
    r = receipts(spark, sf)
    modes = rounded(R.mode_reliability(spark, r))
    latest = K.latest_kpis(rounded(K.operations_kpis(r)))
    cur = r.agg(F.max_by("kafka_mode", "arrival").alias("current_mode"))
    return rounded(K.snapshot(modes, latest, cur))


@register("s12_snapshot_document", W + _KPI_SQL.format(src="receipts") + _LATEST_SQL + f""",
per_order AS (SELECT order_id, kafka_mode, count(*) AS receive_count,
                     max(sent_sequence) AS sent_sequence
              FROM receipts GROUP BY order_id, kafka_mode),
s AS (SELECT kafka_mode, count(*) AS unique_orders,
             CAST(sum(receive_count) AS BIGINT) AS total_orders_received,
             max(sent_sequence) AS sent_orders
      FROM per_order GROUP BY kafka_mode),
base(kafka_mode) AS (VALUES {", ".join(f"('{m}')" for m in MODES)}),
modes AS (
  SELECT base.kafka_mode,
         struct_pack(total_orders := coalesce(total_orders_received, 0),
           unique_orders := coalesce(unique_orders, 0),
           duplicate_orders := coalesce(total_orders_received - unique_orders, 0),
           duplicate_percentage := coalesce({sql_pct('total_orders_received - unique_orders',
                                                     'total_orders_received')}, 0.0),
           accuracy := coalesce({sql_pct('unique_orders', 'total_orders_received', '100.0')}, 100.0),
           estimated_loss := coalesce(greatest(sent_orders - total_orders_received, 0), 0),
           max_sent_sequence := coalesce(sent_orders, 0)) AS st
  FROM base LEFT JOIN s USING (kafka_mode)),
cur AS (SELECT arg_max(kafka_mode, arrival) AS current_mode, max(epoch) AS last_epoch
        FROM receipts),
recent AS (
  SELECT list(struct_pack(order_id := order_id, restaurant_name := restaurant_name,
                          item_name := item_name, total_price := total_price,
                          kafka_mode := kafka_mode,
                          status := CASE WHEN is_cancelled THEN 'Cancelled'
                                         WHEN is_delayed THEN 'Delayed' ELSE 'Delivered' END,
                          prep_time := prep_time_minutes) ORDER BY arrival DESC) AS r
  FROM (SELECT * FROM receipts WHERE epoch = (SELECT last_epoch FROM cur)
        ORDER BY arrival DESC LIMIT 12))
SELECT CAST(to_json(struct_pack(
  kafka_mode := (SELECT current_mode FROM cur),
  active := (SELECT st FROM modes WHERE kafka_mode = (SELECT current_mode FROM cur)),
  modes := (SELECT map_from_entries(list(struct_pack(k := kafka_mode, v := st)
                                         ORDER BY kafka_mode)) FROM modes),
  recent_orders := (SELECT r FROM recent),
  operational := (SELECT struct_pack(delay_rate := delay_rate, avg_prep_time := avg_prep_time,
                                     cancellation_rate := cancellation_rate,
                                     reliability_score := reliability_score,
                                     active_incident := active_incident) FROM s11)))
  AS VARCHAR) AS snapshot""")
def s12_snapshot_document(spark, sf):
    """The whole dashboard snapshot as one JSON document (byte-compared)."""
    r = receipts(spark, sf)
    modes = rounded(R.mode_reliability(spark, r))
    latest = K.latest_kpis(rounded(K.operations_kpis(r)))
    return K.snapshot_document(modes, latest, r)
