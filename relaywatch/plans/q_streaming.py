"""Registered streaming queries. Each stages the topic (derived from
``orders``) as four ordered files, replays it as a file stream with
``availableNow`` (one file per micro-batch), and returns the final state read
back in batch. Final states are checked against the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.operators import kpis as K
from relaywatch.plans.q_kpis import _BREACH, _RAW_RATES, _RUN_SQL, _SCORE, _topics
from relaywatch.plans.q_diagnose import _HIST_COLS, _FULL_HIST, _J9_BASE
from relaywatch.plans.q_reliability import DECODED_SQL, FORWARD_SELECT
from relaywatch.plans.registry import ORACLE, register, rounded, sql_pct, table
from relaywatch.plans.sqlviews import RECEIPTS, TOPIC
from relaywatch.session import work_dir
from relaywatch.sources.orders import receipts, topic_records_from_receipts
from relaywatch.schema import RESTAURANTS
from relaywatch.streaming import control as CT
from relaywatch.streaming import live as L
from relaywatch.streaming import run as RUN

W = "WITH " + RECEIPTS
WD = W + ",\n" + TOPIC + DECODED_SQL

N_BATCHES = 4


def _topic(spark, sf):
    return topic_records_from_receipts(receipts(spark, sf))


def _receipt_source(spark, sf):
    return receipts(spark, sf).select("epoch", "arrival", "order_id", "timestamp",
                                      "incident_mode", "is_delayed", "is_cancelled",
                                      "prep_time_minutes")


def _on_topic(spark, sf, name, op, output_mode="update"):
    """Run ``op(decoded stream)`` over the topic replayed in 4 micro-batches."""
    return RUN.replay(spark, _topic(spark, sf), lambda s: op(L.decoded(s, keep=["arrival"])),
                      name, output_mode, N_BATCHES)


@register("st5_live_totals", WD + """
SELECT kafka_mode, count(*) AS total_orders_received, max(sent_sequence) AS sent_orders
FROM dec GROUP BY kafka_mode""")
def st5_live_totals(spark, sf):
    out = _on_topic(spark, sf, "st5", L.live_totals)
    return RUN.final_state(spark, out, ["kafka_mode"])


@register("st6_live_unique", WD + f""",
per_order AS (SELECT order_id, kafka_mode, count(*) AS n FROM dec GROUP BY order_id, kafka_mode)
SELECT kafka_mode, CAST(sum(n) AS BIGINT) AS total_orders_received, count(*) AS unique_orders,
       CAST(sum(n) AS BIGINT) - count(*) AS duplicate_orders,
       {sql_pct('sum(n) - count(*)', 'sum(n)')} AS duplicate_percentage
FROM per_order GROUP BY kafka_mode""")
def st6_live_unique(spark, sf):
    out = _on_topic(spark, sf, "st6", L.live_unique)
    return rounded(RUN.final_state(spark, out, ["kafka_mode"]))


_UNIQUE_SQL = WD + """,
per_order AS (SELECT order_id, kafka_mode FROM dec GROUP BY order_id, kafka_mode)
SELECT kafka_mode, count(*) AS unique_orders FROM per_order GROUP BY kafka_mode"""


@register("st6_live_unique_jvm", _UNIQUE_SQL)
def st6_live_unique_jvm(spark, sf):
    out = _on_topic(spark, sf, "st6j", L.live_unique_jvm)
    return RUN.final_state(spark, out, ["kafka_mode"])


@register("st7_bounded_unique", _UNIQUE_SQL)
def st7_bounded_unique(spark, sf):
    """Copies arrive 200 ms apart, well inside the 1-minute horizon, so the bounded
    counts equal the exact ones; records without an id are one order of their mode."""
    out = _on_topic(spark, sf, "st7", L.bounded_unique)
    return RUN.final_state(spark, out, ["kafka_mode"])


@register("st8_live_receipts", WD + """
SELECT order_id, kafka_mode, count(*) AS receive_count, max(sent_sequence) AS sent_sequence
FROM dec GROUP BY order_id, kafka_mode""")
def st8_live_receipts(spark, sf):
    out = _on_topic(spark, sf, "st8", L.live_receipts)
    return RUN.final_state(spark, out, ["order_id", "kafka_mode"])


_PANES_OF = "unnest([(kafka_ts_us // 5000000) * 5, (kafka_ts_us // 5000000) * 5 - 5])"
_DEC_WINDOWS = WD + f""",
timed AS (SELECT dec.*, r.kafka_ts_us FROM dec JOIN receipts r USING (arrival)),
wins AS (SELECT *, {_PANES_OF} AS ws FROM timed)"""


@register("st2_sliding_windows", _DEC_WINDOWS + """
SELECT kafka_mode, ws AS window_start, ws + 10 AS window_end, count(*) AS total_orders_received,
       count(DISTINCT order_id) AS unique_orders,
       round(max(producer_sent_at), 6) AS latest_producer_time,
       count(*) - count(DISTINCT order_id) AS duplicate_orders, true AS within_bound
FROM wins GROUP BY kafka_mode, ws""")
def st2_sliding_windows(spark, sf):
    """Sliding windows over the faulty topic from one sketch per 5-second pane: all
    decoded rows count. A sketch of so few ids is still a list of them, so that its
    estimate is the exact count here; ``a5_rolled_up_sketches`` has large ones.
    ``within_bound``: the estimate lies within three standard errors (or one order)
    of the exact count."""
    out = _on_topic(spark, sf, "st2", L.pane_sketches)
    panes = RUN.final_state(spark, out, ["kafka_mode", "pane"])
    windows = L.windows_of_panes(panes)
    exact = L.windowed_exact(L.decoded(_topic(spark, sf))).select(
        F.col("kafka_mode").alias("m"), F.col("window_start").alias("s"),
        F.col("unique_orders").alias("exact"))
    near = F.abs(F.col("unique_orders") - F.col("exact")) <= F.greatest(
        F.lit(1.0), F.lit(0.05) * F.col("exact"))
    same = F.col("kafka_mode").eqNullSafe(F.col("m")) & (F.col("window_start") == F.col("s"))
    return rounded(windows.join(exact, same).withColumn("within_bound", near)
                   .drop("m", "s", "exact"))


@register("a5_rolled_up_sketches")
def a5_rolled_up_sketches(spark, sf):
    """A5 from the stored panes alone: distinct estimates per mode and over all
    modes, with the exact counts and the relative error beside them. Estimates of
    two engines differ, so there is no twin; a test bounds the error."""
    dec = L.decoded(_topic(spark, sf))
    panes = L.pane_sketches(dec)
    per = L.rolled_up(panes).unionByName(
        L.rolled_up(panes, []).withColumn("kafka_mode", F.lit("(all)")).select(
            "kafka_mode", "total_orders_received", "unique_orders", "duplicate_orders"))
    ids = dec.select("kafka_mode", "order_id")
    exact = (ids.unionByName(ids.withColumn("kafka_mode", F.lit("(all)"))).groupBy(
        F.col("kafka_mode").alias("m")).agg(F.countDistinct("order_id").alias("exact_unique")))
    out = per.join(exact, F.col("kafka_mode").eqNullSafe(F.col("m"))).drop("m")
    error = F.col("unique_orders") / F.col("exact_unique") - 1
    return rounded(out.withColumn("relative_error", F.when(F.col("exact_unique") > 0, error)))


ORACLE_WINDOWED = W + """
SELECT kafka_mode, ws AS window_start, count(*) AS total_orders_received,
       count(DISTINCT order_id) AS unique_orders,
       count(*) - count(DISTINCT order_id) AS duplicate_orders
FROM (SELECT kafka_mode, order_id,
             unnest([(kafka_ts_us // 5000000) * 5, (kafka_ts_us // 5000000) * 5 - 5]) AS ws
      FROM receipts)
GROUP BY kafka_mode, ws"""


@register("st2_windowed_exact", W + """
SELECT kafka_mode, ws AS window_start, count(*) AS total_orders_received,
       count(DISTINCT order_id) AS unique_orders,
       count(*) - count(DISTINCT order_id) AS duplicate_orders
FROM (SELECT kafka_mode, order_id,
             unnest([(kafka_ts_us // 5000000) * 5, (kafka_ts_us // 5000000) * 5 - 5]) AS ws
      FROM receipts)
GROUP BY kafka_mode, ws""")
def st2_windowed_exact(spark, sf):
    return L.windowed_exact(receipts(spark, sf))


@register("st2_windowed_exact_stream", ORACLE_WINDOWED)
def st2_windowed_exact_stream(spark, sf):
    """ST1 + ST2 exact, streamed: final state equals the batch windows."""
    src = receipts(spark, sf).drop("epoch")
    out = RUN.replay(spark, src, L.windowed_exact_stream, "st2x", "update", N_BATCHES)
    return RUN.final_state(spark, out, ["kafka_mode", "window_start"])


@register("st9_breach_stream", W + _RUN_SQL + """,
kept AS (SELECT *, lag(incident_mode) OVER (PARTITION BY epoch ORDER BY arrival) AS prev
         FROM run WHERE breach)
SELECT epoch, arrival, order_id, incident_mode, total_orders, delay_rate, cancellation_rate,
       avg_prep_time, reliability_score
FROM kept WHERE prev IS NULL OR prev <> incident_mode""")
def st9_breach_stream(spark, sf):
    out = RUN.replay(spark, _receipt_source(spark, sf), L.breach_trigger, "st9", "append",
                     N_BATCHES)
    return rounded(RUN.appended(spark, out).drop("timestamp"))


@register("st9_breach_stream_batches", W + _RUN_SQL + """,
kept AS (SELECT *, lag(incident_mode) OVER (PARTITION BY epoch ORDER BY arrival) AS prev
         FROM run WHERE breach)
SELECT epoch, arrival, order_id, incident_mode, total_orders, delay_rate, cancellation_rate,
       avg_prep_time, reliability_score
FROM kept WHERE prev IS NULL OR prev <> incident_mode""")
def st9_breach_stream_batches(spark, sf):
    """ST9 JVM-only: batch operators per micro-batch + a per-epoch state table."""
    state = work_dir(spark, "st9b") + "/state"
    out = RUN.replay(spark, _receipt_source(spark, sf), lambda s: s, "st9b", "append",
                     N_BATCHES,
                     sink=lambda q, name, ckpt, o: RUN.breach_trigger_batches(
                         spark, q, o, state, ckpt))
    return rounded(RUN.appended(spark, out).drop("timestamp"))


_TENANT_RUN = W + f""",
twsum AS (
  SELECT restaurant_name AS tenant, epoch, arrival, order_id, incident_mode,
         count(*) OVER w AS total_orders,
         CAST(sum(CAST(is_delayed AS BIGINT)) OVER w AS BIGINT) AS delayed_orders,
         CAST(sum(CAST(is_cancelled AS BIGINT)) OVER w AS BIGINT) AS cancelled_orders,
         CAST(sum(CASE WHEN NOT is_cancelled THEN prep_time_minutes ELSE 0 END) OVER w AS BIGINT)
           AS total_prep_time
  FROM receipts WINDOW w AS (PARTITION BY restaurant_name, epoch ORDER BY arrival)),
trates AS (SELECT *, {_RAW_RATES} FROM twsum),
tkept AS (
  SELECT *, lag(incident_mode) OVER (PARTITION BY tenant, epoch ORDER BY arrival) AS prev
  FROM trates WHERE {_BREACH.format(inc='incident_mode')})
SELECT tenant, epoch + 1 AS epoch, incident_mode AS epoch_incident, arrival, order_id, incident_mode,
       total_orders, round(delay_rate, 6) AS delay_rate,
       round(cancellation_rate, 6) AS cancellation_rate, round(avg_prep_time, 6) AS avg_prep_time,
       round({_SCORE}, 6) AS reliability_score
FROM tkept WHERE prev IS NULL OR prev <> incident_mode"""


def _tenant_events(spark, sf, late_seconds: int = 0):
    """Receipts per restaurant and the resets of the control topic (which hold for
    every restaurant), with ``seq`` as the order in which they are delivered: resets
    come ``late_seconds`` after their event time. The last record is a tick of the
    next day."""
    r = receipts(spark, sf)
    resets = (K.resets_from_orders(table(spark, sf, "orders"))
              .select(F.to_json(F.struct("incident")).alias("value"),
                      F.col("epoch_start").alias("timestamp")))
    last = r.agg(F.timestamp_seconds(F.unix_seconds(F.max("kafka_timestamp")) + 86400)
                 .alias("timestamp")).select(F.lit(None).cast("string").alias("value"), "timestamp")
    control = CT.reset_events(CT.control_resets(resets.unionByName(last)), RESTAURANTS)
    delay = F.when(F.col("kind") == CT.RESET_KIND, late_seconds).otherwise(0)
    events = CT.order_events(r, F.col("restaurant_name"), "kafka_timestamp").unionByName(control)
    return events.withColumn("seq", F.least(F.unix_millis("event_time") + delay * 1000,
                                            F.unix_millis(r.agg(F.max("kafka_timestamp")).scalar())
                                            + 1000))


@register("st9_reset_stream", _TENANT_RUN)
def st9_reset_stream(spark, sf):
    """ST9 + W4 live: receipts of five tenants and a control stream of resets, each
    reset delivered 30 s of event time late, in four micro-batches; the fired
    receipts equal the batch trigger over the reset epochs."""
    out = RUN.replay(spark, _tenant_events(spark, sf, 30), lambda s: CT.triggers_with_resets(s),
                     "st9r", "append", N_BATCHES, order_col="seq")
    return rounded(RUN.appended(spark, out).drop("timestamp"))


@register("st10_forward_stream", WD + FORWARD_SELECT)
def st10_forward_stream(spark, sf):
    out = RUN.replay(spark, _topic(spark, sf), lambda s: L.forward(s, keep=["arrival"]),
                     "st10", "append", N_BATCHES)
    return RUN.appended(spark, out)


@register("st12_diagnose_on_breach", _J9_BASE + _FULL_HIST + "\nSELECT id, "
          + ", ".join(f'"{c}"' for c in _HIST_COLS) + " FROM hist")
def st12_diagnose_on_breach(spark, sf):
    """ST9 (JVM trigger with per-epoch state) feeding J9 + S9 on each batch."""
    base = work_dir(spark, "st12")
    history = f"{base}/history"
    RUN.replay(spark, _receipt_source(spark, sf), lambda s: s, "st12", "append", N_BATCHES,
               sink=lambda q, name, ckpt, out: RUN.breach_trigger_batches(
                   spark, q, out, f"{base}/state", ckpt,
                   on_fired=RUN.diagnosis_handler(spark, history)))
    from relaywatch.operators.history import history_rows, open_history
    # Stored ids name the batch and the row; the id of the content is comparable.
    return history_rows(open_history(spark, history))


# --------------------------------------------------------------------------
# The driver's ``events`` table as a stream (event type as the group, user as
# the id); ``ts`` is TIMESTAMP_NTZ and is read as UTC before the watermark.
# --------------------------------------------------------------------------

@register("st1_st2_events_windows_stream", """
SELECT event_type, ws AS window_start, count(*) AS events, count(DISTINCT user_id) AS users,
       count(*) - count(DISTINCT user_id) AS repeat_events
FROM (SELECT event_type, user_id,
             unnest([(epoch_us(ts) // 5000000) * 5, (epoch_us(ts) // 5000000) * 5 - 5]) AS ws
      FROM events)
GROUP BY event_type, ws""")
def st1_st2_events_windows_stream(spark, sf):
    from relaywatch.operators.demand import ntz_as_utc
    ev = (table(spark, sf, "events").select("event_type", "user_id", "ts")
          .withColumn("event_time", ntz_as_utc("ts"))
          .withColumn("ts_us", F.unix_micros("event_time")).drop("ts"))

    def build(stream):
        return L.windowed_exact_stream(stream, ts_col="event_time", group_col="event_type",
                                       id_col="user_id", total_name="events",
                                       unique_name="users", dup_name="repeat_events")
    out = RUN.replay(spark, ev, build, "st1ev", "update", N_BATCHES, order_col="ts_us")
    return RUN.final_state(spark, out, ["event_type", "window_start"])


# --------------------------------------------------------------------------
# S2 + U1 live: both topics in one stream, cut over at the first forwarded record.
# --------------------------------------------------------------------------

@register("u1_live_cutover", ORACLE["u1_topic_merge"])
def u1_live_cutover(spark, sf):
    """The two topics as one stream of seven micro-batches; the persisted cutover
    gives the rows of the batch merge."""
    fwd, raw = _topics(spark, sf)
    path = work_dir(spark, "u1-cutover") + "/value"

    def sink(query, name, ckpt, out):
        # A new object per run: the value is read back from its folder.
        cut = CT.Cutover(spark, path)
        return (query.writeStream.queryName(name).outputMode("append")
                .option("checkpointLocation", ckpt).trigger(availableNow=True)
                .foreachBatch(cut.before(RUN.batch_writer(out))).start())

    out = RUN.replay(spark, fwd.unionByName(raw), lambda s: s, "u1", "append", 7, sink=sink)
    return RUN.appended(spark, out).groupBy("topic", "kafka_mode").agg(
        F.count(F.lit(1)).alias("n"), F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"))
