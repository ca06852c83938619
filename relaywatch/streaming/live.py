"""Streaming operators (ST1, ST2, ST5-ST10, ST12) over decoded order records.

Every query here is a plain streaming DataFrame; sinks and triggers are in
``relaywatch.streaming.run``. Final states equal the batch operators:

- ST5  ``live_totals``      one aggregation per mode (update mode)
- ST6  ``live_unique``      exact unique/duplicates in one JVM-only query:
                            receipts unioned with first receipts
                            (dropDuplicates) into one per-mode sum; the
                            chained-aggregation plan of the reference (F1)
                            is never built (``live_unique_keyed_state`` does
                            the same with applyInPandasWithState)
- ST6' ``live_unique_jvm``  JVM-only unique count: dropDuplicates + count
- ST7  ``bounded_unique``   dropDuplicatesWithinWatermark: bounded state;
                            repeats beyond the horizon count again, records
                            without an id are one order of their mode
- ST8  ``live_receipts``    receipts per order (update mode)
- ST1/ST2 ``pane_sketches`` watermark + one distinct-count sketch per pane of
                            5 s; ``windows_of_panes`` unites panes to windows
                            (parity, F4), ``rolled_up`` to totals;
                            ``sliding_windows`` the same in a single query
- ST9  ``breach_trigger``   the trigger state machine per key, vectorised
- ST10 ``forward``          stateless decode + tag + encode
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from relaywatch.functions.metrics import pct
from relaywatch.operators.decode import decode_orders, encode_forwarded
from relaywatch.schema import (BREACH_CANCEL_PCT, BREACH_DELAY_PCT, BREACH_MIN_ORDERS,
                               BREACH_PREP_MIN, DEFAULT_PREP, SCORE_CANCEL_WEIGHT,
                               SCORE_DELAY_WEIGHT)


def decoded(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P1 + P2 on a streaming (or batch) topic-record frame."""
    return decode_orders(records, keep=keep)


# --------------------------------------------------------------------------
# ST5 / ST8 / ST6 / ST7
# --------------------------------------------------------------------------

def live_totals(dec: DataFrame) -> DataFrame:
    """ST5: receipts and highest sequence per mode."""
    return dec.groupBy("kafka_mode").agg(
        F.count(F.lit(1)).alias("total_orders_received"),
        F.max("sent_sequence").alias("sent_orders"))


def live_receipts(dec: DataFrame) -> DataFrame:
    """ST8: receipts per (order, mode)."""
    return dec.groupBy("order_id", "kafka_mode").agg(
        F.count(F.lit(1)).alias("receive_count"),
        F.max("sent_sequence").alias("sent_sequence"))


_UNIQUE_OUT = "kafka_mode string, d_total long, d_unique long"
_UNIQUE_STATE = "seen long"


def _first_seen(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState):
    n = sum(len(p) for p in pdfs)
    first = 0 if state.exists else 1
    if first:
        state.update((1,))
    yield pd.DataFrame({"kafka_mode": [key[1]], "d_total": [n], "d_unique": [first]})


def _unique_columns(s: DataFrame) -> DataFrame:
    return s.select("kafka_mode", "total_orders_received", "unique_orders",
                    (F.col("total_orders_received") - F.col("unique_orders"))
                    .alias("duplicate_orders"),
                    pct(F.col("total_orders_received") - F.col("unique_orders"),
                        "total_orders_received").alias("duplicate_percentage"))


def live_unique(dec: DataFrame) -> DataFrame:
    """ST6: exact per-mode totals, unique orders and duplicates, one query,
    JVM only.

    Every receipt contributes (1, 0); the first receipt of each order (kept
    by ``dropDuplicates``, exact state in the state store) contributes
    (0, 1); one per-mode sum in update mode adds both. A null order id is one
    order, as in the batch operator.
    """
    pairs = dec.select("kafka_mode", "order_id")
    every = pairs.select("kafka_mode", F.lit(1).alias("d_total"), F.lit(0).alias("d_unique"))
    first = (pairs.dropDuplicates(["kafka_mode", "order_id"])
             .select("kafka_mode", F.lit(0).alias("d_total"), F.lit(1).alias("d_unique")))
    s = every.unionByName(first).groupBy("kafka_mode").agg(
        F.sum("d_total").alias("total_orders_received"),
        F.sum("d_unique").alias("unique_orders"))
    return _unique_columns(s)


def live_unique_keyed_state(dec: DataFrame) -> DataFrame:
    """ST6 with custom per-order state (applyInPandasWithState, append)
    feeding a per-mode sum (update). Same result as ``live_unique``; one
    Python call per order key and batch, so slower."""
    deltas = (dec.select("order_id", "kafka_mode").groupBy("order_id", "kafka_mode")
              .applyInPandasWithState(_first_seen, _UNIQUE_OUT, _UNIQUE_STATE, "append",
                                      GroupStateTimeout.NoTimeout))
    s = deltas.groupBy("kafka_mode").agg(F.sum("d_total").alias("total_orders_received"),
                                         F.sum("d_unique").alias("unique_orders"))
    return _unique_columns(s)


def live_unique_jvm(dec: DataFrame) -> DataFrame:
    """ST6 (JVM only): unique orders per mode via dropDuplicates + count."""
    return (dec.dropDuplicates(["kafka_mode", "order_id"]).groupBy("kafka_mode")
            .agg(F.count(F.lit(1)).alias("unique_orders")))


def bounded_unique(dec: DataFrame, ts_col: str = "kafka_timestamp",
                   horizon: str = "1 minute") -> DataFrame:
    """ST7: unique orders per mode with state bounded by the watermark; an order
    that comes again after the horizon counts again.

    Records without an order id are one order of their mode, as in the exact
    count: they would come again after every horizon, so each mode (null is one)
    keeps a single mark for them instead, which does not expire. The state is the
    orders of one horizon and one mark per mode.
    """
    marked = dec.withWatermark(ts_col, horizon)
    known = (marked.filter(F.col("order_id").isNotNull())
             .dropDuplicatesWithinWatermark(["kafka_mode", "order_id"]).select("kafka_mode"))
    without = marked.filter(F.col("order_id").isNull()).select("kafka_mode").dropDuplicates(["kafka_mode"])
    return known.unionByName(without).groupBy("kafka_mode").agg(
        F.count(F.lit(1)).alias("unique_orders"))


# --------------------------------------------------------------------------
# ST1 / ST2
# --------------------------------------------------------------------------

PANE_LG_K = 12  # 4096 registers: a relative standard error of about 1.6 %


def pane_sketches(dec: DataFrame, ts_col: str = "kafka_timestamp", watermark: str = "1 minute",
                  slide: str = "5 seconds", group_cols: list[str] | None = None,
                  id_col: str = "order_id", lg_k: int = PANE_LG_K) -> DataFrame:
    """ST1 + ST2 state: one row per group and pane of ``slide``, holding the
    receipts, a distinct-count sketch of the ids and the latest producer time. A
    record lies in one pane, whatever the window length, and late records (beyond
    the watermark) are dropped. Null ids take no part in the sketch."""
    g = group_cols or ["kafka_mode"]
    w = (dec.withWatermark(ts_col, watermark).groupBy(*g, F.window(ts_col, slide).alias("w"))
         .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(id_col, lg_k).alias("sketch"),
              F.max("producer_sent_at").alias("latest_producer_time")))
    return w.select(*g, F.unix_seconds("w.start").alias("pane"), "n", "sketch",
                    "latest_producer_time")


def windows_of_panes(panes: DataFrame, panes_per_window: int = 2, slide_seconds: int = 5,
                     group_cols: list[str] | None = None) -> DataFrame:
    """ST2: sliding windows as unions of consecutive panes. ``unique_orders`` is
    the sketch's estimate, ``duplicate_orders`` what it leaves of the receipts,
    which can be below 0 (F4)."""
    g = group_cols or ["kafka_mode"]
    starts = F.sequence(F.col("pane") - (panes_per_window - 1) * slide_seconds, F.col("pane"),
                        F.lit(slide_seconds).cast("long"))
    w = (panes.withColumn("window_start", F.explode(starts)).groupBy(*g, "window_start")
         .agg(F.sum("n").alias("total_orders_received"),
              F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_orders"),
              F.max("latest_producer_time").alias("latest_producer_time")))
    return w.select(*g, "window_start",
                    (F.col("window_start") + panes_per_window * slide_seconds).alias("window_end"),
                    "total_orders_received", "unique_orders", "latest_producer_time",
                    (F.col("total_orders_received") - F.col("unique_orders"))
                    .alias("duplicate_orders"))


def rolled_up(panes: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """A5 from stored panes: receipts and distinct estimate over all panes, per
    group or, with an empty list, over everything; no record is read again."""
    g = ["kafka_mode"] if group_cols is None else group_cols
    return (panes.groupBy(*g).agg(F.sum("n").alias("total_orders_received"),
                                  F.hll_sketch_estimate(F.hll_union_agg("sketch"))
                                  .alias("unique_orders"))
            .withColumn("duplicate_orders",
                        F.col("total_orders_received") - F.col("unique_orders")))


def sliding_windows(dec: DataFrame, ts_col: str = "kafka_timestamp",
                    watermark: str = "1 minute", length: str = "10 seconds",
                    slide: str = "5 seconds", rsd: float = 0.05) -> DataFrame:
    """ST1 + ST2 in one query, without panes: late rows (beyond the watermark) are
    dropped; each row lands in ``length / slide`` windows."""
    w = (dec.withWatermark(ts_col, watermark)
         .groupBy("kafka_mode", F.window(ts_col, length, slide).alias("w"))
         .agg(F.count(F.lit(1)).alias("total_orders_received"),
              F.approx_count_distinct("order_id", rsd).alias("unique_orders"),
              F.max("producer_sent_at").alias("latest_producer_time")))
    return w.select("kafka_mode", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "total_orders_received",
                    "unique_orders", "latest_producer_time",
                    (F.col("total_orders_received") - F.col("unique_orders"))
                    .alias("duplicate_orders"))


def windowed_exact_stream(dec: DataFrame, ts_col: str = "kafka_timestamp",
                          watermark: str = "1 minute", length: str = "10 seconds",
                          slide: str = "5 seconds", group_col: str = "kafka_mode",
                          id_col: str = "order_id", total_name: str = "total_orders_received",
                          unique_name: str = "unique_orders",
                          dup_name: str = "duplicate_orders") -> DataFrame:
    """ST2 exact, streaming: every row adds (1, 0) to its windows; the first
    row of an id in a window (dropDuplicatesWithinWatermark on group, id and
    window) adds (0, 1). State is bounded by the watermark; late rows are
    dropped (ST1)."""
    w = (dec.withWatermark(ts_col, watermark)
         .select(group_col, id_col, F.window(ts_col, length, slide).alias("w")))
    every = w.select(group_col, "w", F.lit(1).alias("d_total"), F.lit(0).alias("d_unique"))
    first = (w.dropDuplicatesWithinWatermark([group_col, id_col, "w"])
             .select(group_col, "w", F.lit(0).alias("d_total"), F.lit(1).alias("d_unique")))
    s = every.unionByName(first).groupBy(group_col, "w").agg(
        F.sum("d_total").alias(total_name), F.sum("d_unique").alias(unique_name))
    return s.select(group_col, F.unix_seconds(F.col("w.start")).alias("window_start"),
                    total_name, unique_name,
                    (F.col(total_name) - F.col(unique_name)).alias(dup_name))


def windowed_exact(dec: DataFrame, ts_col: str = "kafka_timestamp",
                   length: str = "10 seconds", slide: str = "5 seconds") -> DataFrame:
    """ST2 exact twin (batch): exact distinct per mode and sliding window."""
    w = (dec.groupBy("kafka_mode", F.window(ts_col, length, slide).alias("w"))
         .agg(F.count(F.lit(1)).alias("total_orders_received"),
              F.countDistinct("order_id").alias("unique_orders")))
    return w.select("kafka_mode", F.unix_seconds(F.col("w.start")).alias("window_start"),
                    "total_orders_received", "unique_orders",
                    (F.col("total_orders_received") - F.col("unique_orders"))
                    .alias("duplicate_orders"))


# --------------------------------------------------------------------------
# ST9: the trigger state machine per key
# --------------------------------------------------------------------------

BREACH_OUT = ("epoch long, arrival long, order_id string, timestamp string, incident_mode string, "
              "total_orders long, delay_rate double, cancellation_rate double, "
              "avg_prep_time double, reliability_score double")
BREACH_STATE = ("total long, delayed long, cancelled long, prep_sum long, "
                "last_fired string")


def _flags(column: pd.Series) -> np.ndarray:
    """A missing flag is false."""
    return column.astype("boolean").fillna(False).to_numpy(dtype=bool)


def advance(state: tuple, pdf: pd.DataFrame, part: np.ndarray | None = None,
            parts: int = 0) -> tuple[pd.DataFrame, tuple]:
    """The trigger over receipts in order, from ``state`` (total, delayed,
    cancelled, prep_sum, last_fired): the fired rows and the state after them.
    Missing values count as in the batch operators: a flag as false, preparation
    minutes as the default, an incident as none that could fire.

    ``part``: how often the trigger was reset before each receipt, ``parts``: in all.
    Receipts after a reset start from a fresh state."""
    if parts and not (part == 0).any():
        state = FRESH
    total, delayed, cancelled, prep_sum, last = state
    if not len(pdf):
        return _fired(pdf, np.zeros(0, int), [np.zeros(0)] * 5), state
    part = np.zeros(len(pdf), np.int64) if part is None else part
    start = np.searchsorted(part, part)  # the first receipt of each one's part

    def running(x: np.ndarray, before: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        return sums[1:] - sums[start] + np.where(start == 0, before, 0)

    d, c = _flags(pdf["is_delayed"]), _flags(pdf["is_cancelled"])
    prep = pd.to_numeric(pdf["prep_time_minutes"]).fillna(DEFAULT_PREP).to_numpy(dtype=np.int64)
    p = np.where(c, 0, prep)
    n = running(np.ones(len(pdf)), total)
    nd, nc, ps = running(d, delayed), running(c, cancelled), running(p, prep_sum)
    delay_rate, cancel_rate = nd * 100.0 / n, nc * 100.0 / n
    nonc = n - nc
    avg_prep = np.where(nonc > 0, ps / np.where(nonc > 0, nonc, 1), 0.0)
    score = np.maximum(100.0 - delay_rate * SCORE_DELAY_WEIGHT - cancel_rate * SCORE_CANCEL_WEIGHT,
                       0.0)
    inc = pdf["incident_mode"].to_numpy(dtype=object)
    known = ~pd.isna(inc)
    breach = ((n >= BREACH_MIN_ORDERS) & known & (inc != "normal")
              & ((delay_rate > BREACH_DELAY_PCT) | (cancel_rate > BREACH_CANCEL_PCT)
                 | (avg_prep > BREACH_PREP_MIN)))
    idx = np.flatnonzero(breach)
    kept = inc[idx]
    prev = np.concatenate([[last], kept[:-1]]).astype(object) if len(idx) else kept
    prev[start[idx] != np.concatenate([[0], start[idx[:-1]]])[:len(idx)]] = None
    fire = idx[np.array([a is None or a != b for a, b in zip(prev, kept)], bool)]
    out = _fired(pdf, fire, [x[fire] for x in (n, delay_rate, cancel_rate, avg_prep, score)])
    if part[-1] < parts:
        return out, FRESH
    at_end = len(idx) and start[idx[-1]] == start[-1]
    return out, (int(n[-1]), int(nd[-1]), int(nc[-1]), int(ps[-1]),
                 kept[-1] if at_end else last if start[-1] == 0 else None)


def _fired(pdf: pd.DataFrame, rows: np.ndarray, kpis: list) -> pd.DataFrame:
    names = ("total_orders", "delay_rate", "cancellation_rate", "avg_prep_time", "reliability_score")
    return pd.DataFrame({c: pdf[c].to_numpy()[rows] for c in
                         ("epoch", "arrival", "order_id", "timestamp", "incident_mode")}
                        | dict(zip(names, kpis)))


FRESH = (0, 0, 0, 0, None)  # a trigger that has seen nothing


def _breach_step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState):
    pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("arrival", kind="stable")
    out, new = advance(state.get if state.exists else FRESH, pdf)
    state.update(new)
    yield out


def breach_trigger(rcpt: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """ST9: fire a diagnosis at the first breaching receipt of each new
    incident, per key (default: the KPI epoch, so each reset starts a fresh
    state and different epochs run in parallel). Rows of a key are taken in
    arrival order within a micro-batch; micro-batches arrive in order.
    """
    keys = key_cols or ["epoch"]
    cols = ["epoch", "arrival", "order_id", "timestamp", "incident_mode", "is_delayed",
            "is_cancelled", "prep_time_minutes"]
    return (rcpt.select(*dict.fromkeys([*keys, *cols])).groupBy(*keys)
            .applyInPandasWithState(_breach_step, BREACH_OUT, BREACH_STATE, "append",
                                    GroupStateTimeout.NoTimeout))


# --------------------------------------------------------------------------
# ST10
# --------------------------------------------------------------------------

def forward(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """ST10: decode, tag ``type='received'`` and encode, row by row."""
    return encode_forwarded(decode_orders(records, keep=keep), keep=keep)

