"""Schemas and the fixed dimension values the engine's results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Order event as carried in the topic value (JSON), 15 nullable fields.
ORDER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("restaurant_name", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price_per_item", T.IntegerType()),
    T.StructField("total_price", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("kafka_mode", T.StringType()),
    T.StructField("sent_sequence", T.IntegerType()),
    T.StructField("producer_sent_at", T.DoubleType()),
    T.StructField("prep_time_minutes", T.IntegerType()),
    T.StructField("is_delayed", T.BooleanType()),
    T.StructField("is_cancelled", T.BooleanType()),
    T.StructField("incident_mode", T.StringType()),
])

# Fields forwarded downstream (producer_sent_at is dropped), then a type tag.
FORWARDED_FIELDS = [f.name for f in ORDER.fields if f.name != "producer_sent_at"]

# Topic record as a broker source yields it.
TOPIC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

HISTORY = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("incident", T.StringType(), False),
    T.StructField("solution", T.StringType(), False),
    T.StructField("improvement", T.IntegerType(), False),
    T.StructField("confidence", T.DoubleType(), False),
    T.StructField("timestamp", T.StringType(), False),
])

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference application's constants for
# results to agree; they are data, listed in their natural order.
# ---------------------------------------------------------------------------

# Delivery modes, in the order the per-mode base table lists them.
MODES = ["at_most_once", "at_least_once", "exactly_once"]

# Mode descriptions: (mode, name, description, impact).
MODE_DESCRIPTIONS = [
    ("at_most_once", "At-Most-Once",
     "Fast delivery, but some food orders may be lost",
     "Customer may never receive placed order"),
    ("at_least_once", "At-Least-Once",
     "No order loss, but duplicate order processing may happen",
     "Restaurant may prepare same order twice"),
    ("exactly_once", "Exactly-Once",
     "No loss and no duplicate orders",
     "Correct for payments and inventory pipelines"),
]

# Incident configuration: (incident, delay %, prep lo, prep hi, cancel %).
INCIDENT_CONFIG = [
    ("normal", 5, 12, 18, 2),
    ("kitchen_delay", 45, 25, 38, 5),
    ("courier_delay", 55, 12, 18, 15),
    ("weather_surge", 65, 15, 22, 25),
    ("staff_shortage", 35, 24, 32, 10),
    ("festival_rush", 40, 28, 38, 8),
    ("inventory_shortage", 15, 15, 20, 30),
]
INCIDENTS = [row[0] for row in INCIDENT_CONFIG]

RESTAURANTS = ["Dominos", "KFC", "Biryani House", "Pizza Hut", "Local Dhaba"]

# Item price list: (item, price).
ITEM_PRICES = [
    ("Burger", 129),
    ("Pizza", 249),
    ("Biryani", 219),
    ("Fried Rice", 179),
    ("Rolls", 149),
]

# Breach thresholds and the reliability-score weights.
BREACH_MIN_ORDERS = 10
BREACH_DELAY_PCT = 20.0
BREACH_CANCEL_PCT = 10.0
BREACH_PREP_MIN = 22.0
SCORE_DELAY_WEIGHT = 0.4
SCORE_CANCEL_WEIGHT = 2.0

# Defaults for a missing field in the web-side decoder.
DEFAULT_MODE = "unknown"
DEFAULT_SEQUENCE = 0
DEFAULT_PREP = 15
DEFAULT_INCIDENT = "normal"

# KPI defaults when no KPI row exists.
KPI_DEFAULTS = {"delay_rate": 0.0, "avg_prep_time": 15.0,
                "cancellation_rate": 0.0, "reliability_score": 100.0}

# History seed rows: (incident, solution, improvement, confidence, timestamp).
HISTORY_SEEDS = [
    ("Kitchen Bottleneck",
     "Added one cook to Station B (Prep/Assembly Line) and paused low-demand items.",
     28, 0.91, "2026-06-15T12:00:00"),
    ("Courier Shortage",
     "Increased rider payout multiplier to 1.5x and stacked up to 2 orders per courier.",
     22, 0.88, "2026-06-16T18:30:00"),
    ("Weather Surge",
     "Restricted delivery operations to 2.5km and enabled weather surcharge payout.",
     30, 0.94, "2026-06-17T20:15:00"),
    ("Staff Shortage",
     "Reassigned floor staff to packing tables and authorized overtime bonuses.",
     20, 0.89, "2026-06-18T14:45:00"),
    ("Inventory Shortage",
     "Marked out-of-stock items as unavailable and directed express supplier restocking.",
     35, 0.93, "2026-06-19T09:00:00"),
]
