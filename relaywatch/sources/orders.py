"""Order-event sources (S1, S2, S5) and the order-receipt view over ``orders``.

The receipt view turns the driver's ``orders`` table into delivery receipts
with integer arithmetic only, so every engine derives the same rows:

- mode ``k % 3``; sequence ``k div 3 + 1`` (dense per mode)
- at-most-once attempts with ``(seq*7919) % 100 < 20`` are lost (0 copies),
  at-least-once attempts with ``(seq*104729) % 100 < 25`` arrive twice
- incident ``(k div 200) % 7``; the KPI epoch resets every 200 orders
- delay / cancel flags and prep time from the incident's configured rates
- ``arrival = 2k + copy`` is the total arrival order of receipts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.schema import (INCIDENT_CONFIG, ITEM_PRICES, MODES, ORDER,
                               RESTAURANTS)

BASE_EPOCH_SECONDS = 1704067200  # 2024-01-01 00:00:00 UTC
EPOCH_ORDERS = 200


def _pick(values: list, idx: Column) -> Column:
    """Constant-array lookup (folded into the projection, no join)."""
    return F.array(*[F.lit(v) for v in values])[idx]


def receipts_from_orders(orders: DataFrame) -> DataFrame:
    """Order receipts (one row per arrived copy) derived from ``orders``."""
    base = orders.select(F.col("o_orderkey").alias("k"),
                         F.col("o_custkey").alias("c")).withColumns({
        "m": F.expr("int(k % 3)"),
        "seq": F.expr("k div 3 + 1"),
        "inc": F.expr(f"int((k div {EPOCH_ORDERS}) % 7)"),
        "item": F.expr("int(k % 5)"),
    })
    copies = (F.when((F.col("m") == 0) & ((F.col("seq") * 7919) % 100 < 20), 0)
              .when((F.col("m") == 1) & ((F.col("seq") * 104729) % 100 < 25), 2)
              .otherwise(1))
    rows = base.withColumn(
        "copy_no", F.explode(F.slice(F.array(F.lit(0), F.lit(1)), 1, copies)))
    delay_pct = _pick([r[1] for r in INCIDENT_CONFIG], F.col("inc"))
    prep_lo = _pick([r[2] for r in INCIDENT_CONFIG], F.col("inc"))
    prep_hi = _pick([r[3] for r in INCIDENT_CONFIG], F.col("inc"))
    cancel_pct = _pick([r[4] for r in INCIDENT_CONFIG], F.col("inc"))
    price = _pick([p for _, p in ITEM_PRICES], F.col("item"))
    quantity = (F.col("c") % 5 + 1).cast("int")
    k = F.col("k")
    return rows.select(
        F.concat(F.lit("ORD-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("cust_"), F.col("c").cast("string")).alias("customer_id"),
        _pick(RESTAURANTS, F.expr("int((k div 5) % 5)")).alias("restaurant_name"),
        _pick([n for n, _ in ITEM_PRICES], F.col("item")).alias("item_name"),
        quantity.alias("quantity"),
        price.cast("int").alias("price_per_item"),
        (quantity * price).cast("int").alias("total_price"),
        F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, k)"),
                      "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        _pick(MODES, F.col("m")).alias("kafka_mode"),
        F.col("seq").cast("int").alias("sent_sequence"),
        (k + BASE_EPOCH_SECONDS).cast("double").alias("producer_sent_at"),
        (prep_lo + (k * 17) % (prep_hi - prep_lo + 1)).cast("int").alias("prep_time_minutes"),
        ((k * 37 + 11) % 100 < delay_pct).alias("is_delayed"),
        ((k * 61 + 7) % 100 < cancel_pct).alias("is_cancelled"),
        _pick([r[0] for r in INCIDENT_CONFIG], F.col("inc")).alias("incident_mode"),
        F.expr(f"k div {EPOCH_ORDERS}").alias("epoch"),
        (k * 2 + F.col("copy_no")).alias("arrival"),
        F.col("copy_no").cast("int").alias("copy_no"),
        F.timestamp_micros((k + BASE_EPOCH_SECONDS) * 1_000_000 + F.col("copy_no") * 200_000)
         .alias("kafka_timestamp"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt view over ``{sf_dir}/orders.parquet`` (reads two columns)."""
    return receipts_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))


def delivery_attempts_from_orders(orders: DataFrame) -> DataFrame:
    """Producer-side attempt log: one row per attempt with its outcome.

    Outcomes follow the receipt view: ``dropped`` (at-most-once loss),
    ``duplicated`` (an at-least-once re-send), else ``sent``.
    """
    r = orders.select(F.col("o_orderkey").alias("k")).withColumns({
        "m": F.expr("int(k % 3)"), "seq": F.expr("k div 3 + 1")})
    outcome = (F.when((F.col("m") == 0) & ((F.col("seq") * 7919) % 100 < 20), "dropped")
               .when((F.col("m") == 1) & ((F.col("seq") * 104729) % 100 < 25), "duplicated")
               .otherwise("sent"))
    return r.select(_pick(MODES, F.col("m")).alias("kafka_mode"),
                    F.concat(F.lit("ORD-"), F.col("k").cast("string")).alias("order_id"),
                    outcome.alias("outcome"))


# --------------------------------------------------------------------------
# Topic records. A broker source yields (key, value, timestamp[, topic]).
# --------------------------------------------------------------------------

def _corrupt_value(r: Column) -> Column:
    """JSON text of a receipt with deterministic faults, by ``k``:

    k%59==0 null value; k%53==0 bad JSON; k%31==0 mistyped sequence;
    k%29==0 upper-case mode; k%37==0 unknown mode; k%41==0 prep missing;
    k%43==0 unknown incident; k%47==0 delay flag missing.
    """
    k = F.col("k")
    mode = (F.when(k % 37 == 0, F.lit("bogus_mode"))
            .when(k % 29 == 0, F.upper("kafka_mode")).otherwise(F.col("kafka_mode")))
    seq = F.when(k % 31 == 0, F.lit('"x"')).otherwise(F.col("sent_sequence").cast("string"))
    prep = F.when(k % 41 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"prep_time_minutes":'), F.col("prep_time_minutes").cast("string")))
    delayed = F.when(k % 47 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"is_delayed":'), F.col("is_delayed").cast("string")))
    incident = F.when(k % 43 == 0, F.lit("unknown_incident")).otherwise(F.col("incident_mode"))
    text = F.concat(
        F.lit('{"order_id":"'), F.col("order_id"),
        F.lit('","customer_id":"'), F.col("customer_id"),
        F.lit('","restaurant_name":"'), F.col("restaurant_name"),
        F.lit('","item_name":"'), F.col("item_name"),
        F.lit('","quantity":'), F.col("quantity").cast("string"),
        F.lit(',"price_per_item":'), F.col("price_per_item").cast("string"),
        F.lit(',"total_price":'), F.col("total_price").cast("string"),
        F.lit(',"kafka_mode":"'), mode,
        F.lit('","producer_sent_at":'), F.col("producer_sent_at").cast("long").cast("string"),
        F.lit(',"sent_sequence":'), seq, prep, delayed,
        F.lit(',"is_cancelled":'), F.col("is_cancelled").cast("string"),
        F.lit(',"incident_mode":"'), incident, F.lit('"}'))
    return (F.when(k % 59 == 0, F.lit(None).cast("string"))
            .when(k % 53 == 0, F.concat(F.lit('{"order_id": "ORD-'), k.cast("string"), F.lit('", broken')))
            .otherwise(text))


def topic_records_from_receipts(rcpt: DataFrame, topic: str = "orders") -> DataFrame:
    """Raw topic records (with faults) carrying each receipt as JSON."""
    with_k = rcpt.withColumn("k", F.expr("arrival div 2"))
    return with_k.select(
        F.lit(topic).alias("topic"),
        F.encode("order_id", "UTF-8").alias("key"),
        F.encode(_corrupt_value(with_k), "UTF-8").alias("value"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.col("arrival"),
    )


# --------------------------------------------------------------------------
# Broker sources. S5: JSON-lines batch source.
# --------------------------------------------------------------------------

def read_orders_stream(spark: SparkSession, source: str = "kafka",
                       options: dict[str, str] | None = None,
                       path: str | None = None) -> DataFrame:
    """Streaming topic records.

    ``source="kafka"`` needs the Kafka connector on the classpath; options
    are passed through (``kafka.bootstrap.servers``, ``subscribe`` ...). We
    default to ``startingOffsets=latest`` and ``kafka.isolation.level=
    read_committed`` so aborted transactions are never read. Any other
    source (``parquet``/``json``) reads files with the topic-record columns,
    which is what the tests use.
    """
    opts = dict(options or {})
    if source == "kafka":
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("kafka.isolation.level", "read_committed")
        return spark.readStream.format("kafka").options(**opts).load()
    reader = spark.readStream.format(source).options(**opts)
    if source != "rate":
        reader = reader.schema(opts.pop("_schema", None) or _topic_file_schema())
    return reader.load(path) if path else reader.load()


def _topic_file_schema():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("arrival", T.LongType()),
    ])


def read_topics(spark: SparkSession, topics: list[str], source: str = "kafka",
                options: dict[str, str] | None = None, path: str | None = None) -> DataFrame:
    """Several topics in one stream; the ``topic`` column tells them apart.

    Consumer offsets live in the query checkpoint, not in a consumer group.
    """
    opts = dict(options or {})
    if source == "kafka":
        opts["subscribe"] = ",".join(topics)
        return read_orders_stream(spark, "kafka", opts)
    return read_orders_stream(spark, source, opts, path).filter(F.col("topic").isin(topics))


def read_order_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines orders with the fixed order schema; blank lines skipped."""
    # The JSON reader skips blank lines itself; malformed lines become
    # all-null rows (PERMISSIVE), which the decoder's reject rule catches.
    return spark.read.schema(ORDER).option("mode", "PERMISSIVE").json(path)
