"""Operations KPIs, running KPIs, breach events, epochs, recent orders
(A6, A9, W1, W3, W4, L1, U1, J7, S11, S12, P11-P14).

An *epoch* is the span between two KPI resets (each injected incident
clears the counters, the recent list and the trigger memory). Every
order-dependent operator is partitioned by epoch and bucketed by arrival,
so no single task holds a whole epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaywatch.functions.metrics import breach, order_status, pct, ratio, reliability_score
from relaywatch.operators.running import (DEFAULT_BUCKET_WIDTH, previous_value,
                                          running_aggregates)
from relaywatch.schema import DEFAULT_PREP, INCIDENT_CONFIG, KPI_DEFAULTS


def _flag(name: str):
    """A missing flag is false."""
    return F.coalesce(F.col(name), F.lit(False))


def _prep():
    """Preparation minutes that count: none of a cancelled order, the default
    of a missing value."""
    return F.when(_flag("is_cancelled"), 0).otherwise(
        F.coalesce(F.col("prep_time_minutes"), F.lit(DEFAULT_PREP))).cast("long")


def _kpi_columns(total, delayed, cancelled, prep_sum) -> list:
    non_cancelled = F.col(total) - F.col(cancelled)
    delay_rate = pct(delayed, total, 0.0)
    cancel_rate = pct(cancelled, total, 0.0)
    return [
        delay_rate.alias("delay_rate"),
        cancel_rate.alias("cancellation_rate"),
        ratio(prep_sum, non_cancelled, 0.0).alias("avg_prep_time"),
        reliability_score(delay_rate, cancel_rate).alias("reliability_score"),
    ]


def first_receipts(rcpt: DataFrame, order_col: str = "arrival") -> DataFrame:
    """Keep the first receipt of each order (F6 ``dedup`` option)."""
    first = rcpt.groupBy("kafka_mode", "order_id").agg(F.min(order_col).alias("_first"))
    return rcpt.alias("r").join(
        first.alias("f"),
        (F.col("r.kafka_mode") == F.col("f.kafka_mode"))
        & F.col("r.order_id").eqNullSafe(F.col("f.order_id"))
        & (F.col(f"r.{order_col}") == F.col("f._first")),
        "left_semi")


def operations_kpis(rcpt: DataFrame, group_cols: list[str] | None = None,
                    dedup: bool = False, order_col: str = "arrival") -> DataFrame:
    """A6 + P13 + P14: KPIs per epoch (plus any user grouping columns).

    Parity counts receipts, so a re-sent order counts twice (F6); set
    ``dedup=True`` to count each order once.
    """
    g = group_cols or ["epoch"]
    src = first_receipts(rcpt, order_col) if dedup else rcpt
    a = src.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if("is_delayed").alias("delayed_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.sum(_prep()).alias("total_prep_time"),
        F.max_by("incident_mode", order_col).alias("active_incident"))
    out = a.select(*g, "total_orders", "delayed_orders", "cancelled_orders",
                   "total_prep_time", "active_incident",
                   *_kpi_columns("total_orders", "delayed_orders", "cancelled_orders",
                                 "total_prep_time"))
    return out.withColumn("breach", breach("total_orders", "active_incident", "delay_rate",
                                           "cancellation_rate", "avg_prep_time"))


def running_kpis(rcpt: DataFrame, partition_cols: list[str] | None = None,
                 order_col: str = "arrival",
                 bucket_width: int = DEFAULT_BUCKET_WIDTH,
                 prior: DataFrame | None = None) -> DataFrame:
    """KPIs as they stood after each receipt, per epoch.

    ``prior`` (epoch, total, delayed, cancelled, prep_sum) adds counters
    carried from earlier micro-batches (streaming without keyed state).
    """
    p = partition_cols or ["epoch"]
    run = running_aggregates(
        rcpt, p, order_col,
        sums={"total_orders": F.lit(1),
              "delayed_orders": _flag("is_delayed").cast("long"),
              "cancelled_orders": _flag("is_cancelled").cast("long"),
              "total_prep_time": _prep()},
        bucket_width=bucket_width)
    if prior is not None:
        base = prior.select(*p, "total", "delayed", "cancelled", "prep_sum")
        run = (run.join(base, p, "left")
               .withColumns({
                   "total_orders": F.col("total_orders") + F.coalesce("total", F.lit(0)),
                   "delayed_orders": F.col("delayed_orders") + F.coalesce("delayed", F.lit(0)),
                   "cancelled_orders": F.col("cancelled_orders")
                   + F.coalesce("cancelled", F.lit(0)),
                   "total_prep_time": F.col("total_prep_time")
                   + F.coalesce("prep_sum", F.lit(0))})
               .drop("total", "delayed", "cancelled", "prep_sum"))
    out = run.select(*rcpt.columns, "_bucket", "total_orders", "delayed_orders",
                     "cancelled_orders", "total_prep_time",
                     *_kpi_columns("total_orders", "delayed_orders", "cancelled_orders",
                                   "total_prep_time"))
    return out.withColumn("breach", breach("total_orders", "incident_mode", "delay_rate",
                                           "cancellation_rate", "avg_prep_time"))


def breach_events(running: DataFrame, partition_cols: list[str] | None = None,
                  order_col: str = "arrival",
                  bucket_width: int = DEFAULT_BUCKET_WIDTH,
                  prior_last: DataFrame | None = None) -> DataFrame:
    """The receipts at which a diagnosis fires.

    Among breaching rows of an epoch, fire where the previous breaching row
    had a different incident (or there is none): the trigger memory holds
    the last incident fired and is cleared at each reset. ``prior_last``
    (epoch, last_fired) seeds that memory from earlier micro-batches.
    """
    p = partition_cols or ["epoch"]
    # Keep the running step's bucket column: the rows are already partitioned
    # by (epoch, bucket), so the lag window below needs no new shuffle.
    kept = running.filter(F.col("breach"))
    prev = previous_value(kept, p, order_col, "incident_mode", "_prev_incident",
                          bucket_width=bucket_width)
    if prior_last is not None:
        prev = (prev.join(prior_last.select(*p, "last_fired"), p, "left")
                .withColumn("_prev_incident", F.coalesce("_prev_incident", "last_fired"))
                .drop("last_fired"))
    return (prev.filter(F.col("_prev_incident").isNull()
                        | (F.col("_prev_incident") != F.col("incident_mode")))
            .drop("_prev_incident", "_bucket"))


def next_breach_state(prior: DataFrame, running: DataFrame, order_col: str = "arrival") -> DataFrame:
    """Per-epoch trigger state after a micro-batch: the counters before it plus
    the batch's own sums (so no row is lost however arrivals tie), and the
    incident of the last breaching row."""
    new = running.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_flag("is_delayed")).alias("d"),
        F.count_if(_flag("is_cancelled")).alias("c"), F.sum(_prep()).alias("p"),
        F.max_by(F.when(F.col("breach"), F.col("incident_mode")),
                 F.when(F.col("breach"), F.col(order_col))).alias("lf"))
    zero = F.lit(0).cast("long")
    return prior.join(new, "epoch", "full_outer").select(
        "epoch",
        *[(F.coalesce(F.col(a), zero) + F.coalesce(F.col(b), zero)).alias(a)
          for a, b in (("total", "n"), ("delayed", "d"), ("cancelled", "c"), ("prep_sum", "p"))],
        F.coalesce("lf", "last_fired").alias("last_fired"))


def resets_from_orders(orders: DataFrame, epoch_orders: int = 200) -> DataFrame:
    """Reset (incident injection) events implied by the receipt view:
    one at the first order of each epoch, carrying that epoch's incident."""
    k = F.col("o_orderkey")
    return (orders.select("o_orderkey").filter(k % epoch_orders == 0)
            .select(F.timestamp_micros((k + 1704067200) * 1_000_000).alias("epoch_start"),
                    F.element_at(F.array(*[F.lit(r[0]) for r in INCIDENT_CONFIG]),
                                 F.expr(f"int((o_orderkey div {epoch_orders}) % 7) + 1"))
                    .alias("incident")))


def assign_epochs(rcpt: DataFrame, resets: DataFrame, ts_col: str = "kafka_timestamp",
                  bucket_seconds: int = 3600) -> DataFrame:
    """Each receipt's epoch is the latest reset at or before it (an
    as-of join); ``epoch_no`` counts resets (1 = first reset, 0 = before any).

    Resets are control events, few per hour. Per hour bucket we keep that
    hour's reset times and carry in the last reset of earlier hours (a prefix
    maximum over the per-hour table, whose size is the number of hours, not
    of receipts). Receipts join that table on their hour and pick the latest
    reset not after them, row by row: no sort or window over the receipts.
    AQE broadcasts the hour table when its runtime size is small, otherwise
    the join is a shuffle join (a hot hour is split by AQE's skew handling).
    """
    us = 1_000_000 * bucket_seconds
    r = resets.select(F.unix_micros("epoch_start").alias("_start"),
                      F.col("incident").alias("epoch_incident"))
    numbered = running_aggregates(r, [], "_start", sums={"epoch_no": F.lit(1)},
                                  bucket_width=us).drop("_bucket")
    per_hour = numbered.groupBy(F.floor(F.col("_start") / us).alias("_hour")).agg(
        F.sort_array(F.collect_list(F.struct("_start", "epoch_no", "epoch_incident")))
        .alias("_resets"),
        F.max(F.struct("_start", "epoch_no", "epoch_incident")).alias("_last"))
    rc = rcpt.withColumns({"_ts": F.unix_micros(F.col(ts_col))}).withColumn(
        "_hour", F.floor(F.col("_ts") / us))
    hours = (rc.select("_hour").distinct().unionByName(per_hour.select("_hour")).distinct()
             .join(per_hour, "_hour", "left"))
    earlier = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    table = hours.select("_hour", "_resets", F.max("_last").over(earlier).alias("_carry"))
    # No hint: the hour table is a shuffle-stage output, so AQE knows its size
    # at runtime and broadcasts it under the adaptive threshold; beyond it the
    # join stays a shuffle join. A separate count would cost a receipts scan.
    j = rc.join(table, "_hour", "left")
    in_hour = F.filter(F.coalesce("_resets", F.array()), lambda x: x["_start"] <= F.col("_ts"))
    pick = F.when(F.size(in_hour) > 0, F.element_at(in_hour, -1)).otherwise(F.col("_carry"))
    return j.withColumn("_pick", pick).select(
        *rcpt.columns,
        F.coalesce(F.col("_pick.epoch_no"), F.lit(0)).alias("epoch_no"),
        F.timestamp_micros(F.col("_pick._start")).alias("epoch_start"),
        F.col("_pick.epoch_incident").alias("epoch_incident"))


def recent_orders(rcpt: DataFrame, k: int = 12, partition_cols: list[str] | None = None,
                  order_col: str = "arrival") -> DataFrame:
    """L1 + P11: the ``k`` newest receipts of each epoch, newest first.

    ``row_number() <= k`` plans as a WindowGroupLimit: each task keeps its
    own top ``k`` per epoch before the shuffle.
    """
    p = partition_cols or ["epoch"]
    w = Window.partitionBy(*p).orderBy(F.col(order_col).desc())
    return (rcpt.withColumn("position", F.row_number().over(w))
            .filter(F.col("position") <= k)
            .select(*p, "position", "order_id", "restaurant_name", "item_name", "total_price",
                    "kafka_mode", order_status().alias("status"),
                    F.col("prep_time_minutes").alias("prep_time"), order_col))


def merge_topics(forwarded: DataFrame, raw: DataFrame, order_col: str = "arrival") -> DataFrame:
    """Forwarded records win from their first arrival on.

    Raw records that arrived before the first forwarded one are kept (the
    overlap F7 documents); the cutoff is a one-row aggregate used as a
    scalar subquery.
    """
    cutoff = forwarded.agg(F.min(order_col)).scalar()
    early_raw = raw.filter(cutoff.isNull() | (F.col(order_col) < cutoff))
    return forwarded.unionByName(early_raw)


def latest_by_arrival(rcpt: DataFrame, group_cols: list[str] | None = None,
                      order_col: str = "arrival") -> DataFrame:
    """Latest incident, mode and arrival per epoch."""
    g = group_cols or ["epoch"]
    return rcpt.groupBy(*g).agg(
        F.max_by("incident_mode", order_col).alias("active_incident"),
        F.max_by("kafka_mode", order_col).alias("current_mode"),
        F.max(order_col).alias("last_update"))


def incident_config(spark: SparkSession) -> DataFrame:
    """J7 dimension: configured rates per incident (7 rows)."""
    return spark.createDataFrame(
        [(n, float(d), lo, hi, float(c)) for n, d, lo, hi, c in INCIDENT_CONFIG],
        "incident string, delay_pct double, prep_lo int, prep_hi int, cancel_pct double")


def kpi_vs_config(spark: SparkSession, kpis: DataFrame) -> DataFrame:
    """Observed KPIs next to the configured rates; unknown incidents
    are compared with ``normal``."""
    cfg = F.broadcast(incident_config(spark))
    known = F.when(F.col("active_incident").isin([r[0] for r in INCIDENT_CONFIG]),
                   F.col("active_incident")).otherwise(F.lit("normal"))
    k = kpis.withColumn("config_incident", known)
    j = k.join(cfg, k.config_incident == cfg.incident, "left")
    return j.select(
        "epoch", "active_incident", "config_incident", "delay_rate", "cancellation_rate",
        "avg_prep_time",
        F.col("delay_pct").alias("config_delay_rate"),
        F.col("cancel_pct").alias("config_cancellation_rate"),
        ((F.col("prep_lo") + F.col("prep_hi")) / 2.0).alias("config_prep_mean"),
        (F.col("delay_rate") - F.col("delay_pct")).alias("delay_gap"),
        (F.col("cancellation_rate") - F.col("cancel_pct")).alias("cancellation_gap"))


def latest_kpis(kpis: DataFrame | None, order_col: str = "epoch",
                spark: SparkSession | None = None) -> DataFrame:
    """The latest KPI row, or the defaults (0, 15, 0, 100, normal) when
    there is none or no KPI frame is given.

    A global aggregate always yields one row, so the defaults apply to an
    empty input without any join.
    """
    names = list(KPI_DEFAULTS)
    if kpis is None:
        row = (spark or SparkSession.getActiveSession()).range(1).select(
            F.lit(None).cast(f"struct<{', '.join(f'{n}: double' for n in names)}, "
                             "active_incident: string>").alias("k"))
    else:
        row = kpis.agg(F.max_by(F.struct(*names, "active_incident"), order_col).alias("k"))
    return row.select(
        *[F.coalesce(F.col(f"k.{n}"), F.lit(v)).alias(n) for n, v in KPI_DEFAULTS.items()],
        F.coalesce(F.col("k.active_incident"), F.lit("normal")).alias("active_incident"))


def snapshot(modes: DataFrame, kpis_latest: DataFrame, latest: DataFrame) -> DataFrame:
    """Per-mode reliability with the active-mode flag and latest KPIs.

    ``kpis_latest`` and ``latest`` are one-row frames; their values enter as
    scalar subqueries.
    """
    kpi = kpis_latest.select(F.struct(*kpis_latest.columns)).scalar()
    current = latest.select("current_mode").scalar()
    return modes.select(
        "*", (F.col("kafka_mode") == current).alias("is_active_mode"),
        kpi["delay_rate"].alias("delay_rate"),
        kpi["avg_prep_time"].alias("avg_prep_time"),
        kpi["cancellation_rate"].alias("cancellation_rate"),
        kpi["reliability_score"].alias("reliability_score"),
        kpi["active_incident"].alias("active_incident"))


def snapshot_document(modes: DataFrame, kpis_latest: DataFrame, rcpt: DataFrame,
                      recent_k: int = 12, order_col: str = "arrival") -> DataFrame:
    """S12 as one JSON document (one row): the active mode's numbers, every
    mode's numbers, the latest KPIs and the ``recent_k`` newest receipts of
    the latest epoch with their status. Every part is a bounded aggregate
    (3 modes, one KPI row, ``recent_k`` receipts) used as a scalar."""
    stats = [c for c in modes.columns if c not in ("kafka_mode", "mode_rank")]
    mode_map = modes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "kafka_mode", F.struct(*stats)))))).scalar()
    current = rcpt.agg(F.max_by("kafka_mode", order_col)).scalar()
    last_epoch = rcpt.agg(F.max("epoch")).scalar()
    recent = (rcpt.filter(F.col("epoch") == last_epoch)
              .orderBy(F.col(order_col).desc()).limit(recent_k)
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.col(order_col).alias("_order"), "order_id", "restaurant_name", "item_name",
                  "total_price", "kafka_mode", order_status().alias("status"),
                  F.col("prep_time_minutes").alias("prep_time"))), asc=False).alias("r"))
              .select(F.transform("r", lambda x: x.dropFields("_order"))).scalar())
    kpi = kpis_latest.select(F.struct(*kpis_latest.columns)).scalar()
    doc = F.struct(
        current.alias("kafka_mode"),
        mode_map[current].alias("active"),
        mode_map.alias("modes"),
        recent.alias("recent_orders"),
        kpi.alias("operational"))
    return kpis_latest.sparkSession.range(1).select(F.to_json(doc).alias("snapshot"))

