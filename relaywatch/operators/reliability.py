"""Delivery reliability per mode.

Input is a receipts frame with at least ``order_id, kafka_mode,
sent_sequence`` (and ``arrival`` where order matters). Group keys are the
order id first (well spread) and the mode second (three keys): the mode step
runs after partial aggregation, so each task ships at most three rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.functions.metrics import floored_diff, pct
from relaywatch.operators.running import DEFAULT_BUCKET_WIDTH, running_aggregates
from relaywatch.schema import MODE_DESCRIPTIONS, MODES


def mode_dim(spark: SparkSession) -> DataFrame:
    """The three delivery modes with descriptions (J8 dimension, 3 rows)."""
    return spark.createDataFrame(MODE_DESCRIPTIONS,
                                 "kafka_mode string, name string, description string, impact string")


def order_receipts(rcpt: DataFrame, order_col: str = "arrival",
                   run_cols: list[str] | None = None) -> DataFrame:
    """A1 + P4: receipts per ``(order_id, kafka_mode)``.

    The reference keeps ``first`` of four columns, which depends on arrival
    order; we take the value of the earliest arrival (``min_by``), which is
    deterministic. ``run_cols`` (F3) adds a producer-run key.
    """
    keys = ["order_id", "kafka_mode", *(run_cols or [])]
    return (rcpt.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("receive_count"),
        F.min_by("customer_id", order_col).alias("customer_id"),
        F.min_by("restaurant_name", order_col).alias("restaurant_name"),
        F.min_by("item_name", order_col).alias("item_name"),
        F.min_by("sent_sequence", order_col).alias("sent_sequence"))
        .withColumn("is_duplicate", F.col("receive_count") > 1))


def duplicate_orders(rcpt: DataFrame) -> DataFrame:
    """P5: orders received more than once (GROUP BY ... HAVING count > 1)."""
    return (rcpt.groupBy("order_id", "kafka_mode")
            .agg(F.count(F.lit(1)).alias("receive_count"))
            .filter(F.col("receive_count") > 1))


def summarise_receipts(per_order: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """A2 second level: per mode from per-order receipts."""
    g = group_cols or ["kafka_mode"]
    s = per_order.groupBy(*g).agg(
        F.count(F.lit(1)).alias("unique_orders"),
        F.sum("receive_count").alias("total_orders_received"),
        F.max("sent_sequence").alias("sent_orders"))
    return s.select(
        *g, "unique_orders", "total_orders_received", "sent_orders",
        (F.col("total_orders_received") - F.col("unique_orders")).alias("duplicate_orders"),
        pct(F.col("total_orders_received") - F.col("unique_orders"),
            "total_orders_received", 0.0).alias("duplicate_percentage"),
        floored_diff("sent_orders", "total_orders_received").alias("estimated_loss"),
        pct("unique_orders", "total_orders_received", 100.0).alias("accuracy"),
        floored_diff("sent_orders", "unique_orders").alias("missing_orders"))


def delivery_summary(rcpt: DataFrame, run_cols: list[str] | None = None) -> DataFrame:
    """A2: reliability per mode. A null order id counts as one order."""
    keys = ["order_id", "kafka_mode", *(run_cols or [])]
    per_order = rcpt.groupBy(*keys).agg(F.count(F.lit(1)).alias("receive_count"),
                                        F.max("sent_sequence").alias("sent_sequence"))
    return summarise_receipts(per_order, ["kafka_mode", *(run_cols or [])])


def mode_reliability(spark: SparkSession, rcpt: DataFrame) -> DataFrame:
    """A3 + J5: per-mode reliability on the three-mode base, zero defaults.

    Modes without receipts read total 0, duplicates 0 %, accuracy 100 %.
    """
    s = delivery_summary(rcpt)
    base = F.broadcast(spark.createDataFrame([(m, i) for i, m in enumerate(MODES)],
                                             "kafka_mode string, mode_rank int"))
    j = base.join(s, "kafka_mode", "left")
    return j.select(
        "kafka_mode", "mode_rank",
        F.coalesce("total_orders_received", F.lit(0)).alias("total_orders"),
        F.coalesce("unique_orders", F.lit(0)).alias("unique_orders"),
        F.coalesce("duplicate_orders", F.lit(0)).alias("duplicate_orders"),
        F.coalesce("duplicate_percentage", F.lit(0.0)).alias("duplicate_percentage"),
        F.coalesce("accuracy", F.lit(100.0)).alias("accuracy"),
        F.coalesce("estimated_loss", F.lit(0)).alias("estimated_loss"),
        F.coalesce("sent_orders", F.lit(0)).alias("max_sent_sequence"))


def exact_distinct(rcpt: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """A4: exact distinct order ids per group (nulls not counted)."""
    g = group_cols or ["kafka_mode"]
    return rcpt.groupBy(*g).agg(F.count(F.lit(1)).alias("total_orders_received"),
                                F.countDistinct("order_id").alias("unique_orders"))


def approx_distinct(rcpt: DataFrame, group_cols: list[str] | None = None,
                    rsd: float = 0.05) -> DataFrame:
    """A5: HyperLogLog++ distinct (parity with the windowed query; F4)."""
    g = group_cols or ["kafka_mode"]
    return (rcpt.groupBy(*g).agg(F.count(F.lit(1)).alias("total_orders_received"),
                                 F.approx_count_distinct("order_id", rsd).alias("unique_orders"))
            .withColumn("duplicate_orders",
                        F.col("total_orders_received") - F.col("unique_orders")))


def latest_sequence(rcpt: DataFrame) -> DataFrame:
    """Highest sequence and latest producer time per mode."""
    return rcpt.groupBy("kafka_mode").agg(
        F.max("sent_sequence").alias("max_sent_sequence"),
        F.max("producer_sent_at").alias("latest_producer_time"))


def attempt_totals(attempts: DataFrame) -> DataFrame:
    """Producer attempt totals per mode.

    ``sent`` counts broker acknowledgements, so an at-least-once re-send is
    acknowledged twice and the success rate can exceed 100 %.
    """
    o = F.col("outcome")
    s = attempts.groupBy("kafka_mode").agg(
        F.count(F.lit(1)).alias("attempts"),
        (F.count_if(o != "dropped") + F.count_if(o == "duplicated")).alias("sent"),
        F.count_if(o == "failed").alias("failed"),
        F.count_if(o == "dropped").alias("dropped"),
        F.count_if(o == "duplicated").alias("duplicated"))
    return s.withColumn("success_rate", pct("sent", "attempts", 0.0))


def loss_rate(summary: DataFrame) -> DataFrame:
    """Documented loss rate ``(sent - received) / sent`` over A2."""
    return summary.select(
        "kafka_mode", "sent_orders", "total_orders_received",
        pct(F.col("sent_orders") - F.col("total_orders_received"),
            "sent_orders", 0.0).alias("loss_rate"))


def describe_modes(spark: SparkSession, summary: DataFrame) -> DataFrame:
    """Attach the static mode descriptions (broadcast, 3 rows)."""
    return summary.join(F.broadcast(mode_dim(spark)), "kafka_mode", "left")


def running_reliability(rcpt: DataFrame, order_col: str = "arrival",
                        bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Reliability per mode as it stood after each receipt.

    The first-seen flag comes from the earliest arrival per order (an
    aggregate joined back null-safely: null ids form one order), not from a
    window over the order group, so a hot order id is partially aggregated.
    Running totals per mode are bucketed (see ``running``).
    """
    first = (rcpt.groupBy("kafka_mode", "order_id")
             .agg(F.min(order_col).alias("_first")))
    r = rcpt.alias("r").join(
        first.alias("f"),
        (F.col("r.kafka_mode") == F.col("f.kafka_mode"))
        & F.col("r.order_id").eqNullSafe(F.col("f.order_id")), "inner")
    flagged = r.select("r.*", (F.col(f"r.{order_col}") == F.col("f._first"))
                       .alias("first_seen"))
    run = running_aggregates(
        flagged, ["kafka_mode"], order_col,
        sums={"total_orders": F.lit(1), "unique_orders": F.col("first_seen").cast("long")},
        maxes={"max_sent_sequence": F.col("sent_sequence")},
        bucket_width=bucket_width)
    return run.select(
        "kafka_mode", "order_id", order_col, "first_seen",
        "total_orders", "unique_orders", "max_sent_sequence",
        (F.col("total_orders") - F.col("unique_orders")).alias("duplicate_orders"),
        pct(F.col("total_orders") - F.col("unique_orders"), "total_orders", 0.0)
        .alias("duplicate_percentage"),
        pct("unique_orders", "total_orders", 100.0).alias("accuracy"),
        floored_diff(F.coalesce("max_sent_sequence", F.lit(0)), "total_orders")
        .alias("estimated_loss"))
