"""Decode, encode, normalise and coerce order records.

Two decoders exist because the reference has two readers:

- ``decode_orders`` (consumer side, P1/P2): typed ``from_json``; a bad
  record gives all-null fields and is still counted (null key group).
- ``web_records`` (web side, P8-P10): parses each value once with numeric
  fields as text, applies the defaults of §1.3 and tags every row with a
  ``reject_reason`` (null when accepted), so accepted and rejected rows come
  from the same scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaywatch.schema import (DEFAULT_INCIDENT, DEFAULT_MODE, DEFAULT_PREP,
                               DEFAULT_SEQUENCE, FORWARDED_FIELDS, INCIDENTS,
                               ITEM_PRICES, MODES, ORDER)

_NUMERIC = {"quantity", "price_per_item", "total_price", "sent_sequence",
            "prep_time_minutes", "producer_sent_at"}

# Same fields as ORDER, numbers kept as their JSON text.
_RAW = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in _NUMERIC else f.dataType)
    for f in ORDER.fields])


def parse_once(text, schema):
    """``from_json`` as a generator (``inline`` of a one-element array).

    Filters on the parsed fields cannot be pushed below a Generate, so each
    record is parsed exactly once; as a plain projection the optimizer would
    substitute the parse into every pushed-down predicate and split it per
    field. Null or malformed text yields one all-null row.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def decode_orders(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P1 + P2: ``key`` as text, broker time as ``kafka_timestamp``, value
    decoded with the fixed order schema. ``keep`` passes extra columns."""
    keep = [c for c in (keep or []) if c in records.columns]
    return records.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        *keep,
        parse_once(F.col("value").cast("string"), ORDER))


def encode_forwarded(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """key = order id, value = JSON of 14 fields plus ``type='received'``.

    ``to_json`` drops null fields, as a JSON encoder of the decoded record
    would for missing ones.
    """
    keep = [c for c in (keep or []) if c in decoded.columns]
    return decoded.select(
        F.col("order_id").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in FORWARDED_FIELDS],
                           F.lit("received").alias("type"))).alias("value"),
        *keep)


def web_records(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P8 + P10 + §1.3: decode with defaults and tag rejects.

    Reasons, in the reference's order of checks: ``null_value``,
    ``bad_json`` (value present, every field null), ``bad_sequence``
    (present but not an integer), ``unknown_mode`` (after lower-casing and
    the ``unknown`` default), ``bad_prep``.
    """
    keep = [c for c in (keep or []) if c in records.columns]
    text = F.col("value").cast("string")
    p = records.select(*keep, text.alias("_text"), parse_once(text, _RAW))
    any_field = reduce(lambda a, b: a | b, [F.col(f.name).isNotNull() for f in _RAW.fields])
    seq = F.col("sent_sequence").try_cast("int")
    prep = F.col("prep_time_minutes").try_cast("int")
    mode = F.lower(F.coalesce(F.col("kafka_mode"), F.lit(DEFAULT_MODE)))
    reason = (F.when(F.col("_text").isNull(), "null_value")
              .when(~any_field, "bad_json")
              .when(F.col("sent_sequence").isNotNull() & seq.isNull(), "bad_sequence")
              .when(~mode.isin(MODES), "unknown_mode")
              .when(F.col("prep_time_minutes").isNotNull() & prep.isNull(), "bad_prep"))
    return p.select(
        *keep,
        F.col("order_id"),
        mode.alias("kafka_mode"),
        F.coalesce(seq, F.lit(DEFAULT_SEQUENCE)).alias("sent_sequence"),
        F.coalesce(prep, F.lit(DEFAULT_PREP)).alias("prep_time_minutes"),
        F.coalesce(F.col("is_delayed"), F.lit(False)).alias("is_delayed"),
        F.coalesce(F.col("is_cancelled"), F.lit(False)).alias("is_cancelled"),
        F.coalesce(F.col("incident_mode"), F.lit(DEFAULT_INCIDENT)).alias("incident_mode"),
        F.coalesce(F.col("restaurant_name"), F.lit("N/A")).alias("restaurant_name"),
        F.coalesce(F.col("item_name"), F.lit("N/A")).alias("item_name"),
        F.coalesce(F.col("total_price").try_cast("int"), F.lit(0)).alias("total_price"),
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("price_per_item").try_cast("int").alias("price_per_item"),
        reason.alias("reject_reason"))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNotNull())


def allowed_modes(spark: SparkSession, df: DataFrame, col: str = "kafka_mode") -> DataFrame:
    """Lower-case the mode and keep only the three known modes
    (left semi join with the broadcast 3-row mode dimension)."""
    dim = F.broadcast(spark.createDataFrame([(m,) for m in MODES], f"{col} string"))
    return df.withColumn(col, F.lower(F.col(col))).join(dim, col, "left_semi")


def incident_allow_list(df: DataFrame, col: str = "incident_mode") -> DataFrame:
    """Tag each row as an allowed or rejected incident name."""
    return df.withColumn("incident_allowed", F.lower(F.col(col)).isin(INCIDENTS))


def validate_amounts(spark: SparkSession, rcpt: DataFrame) -> DataFrame:
    """Recompute quantity x list price and compare with ``total_price``."""
    prices = F.broadcast(spark.createDataFrame(ITEM_PRICES, "item_name string, list_price int"))
    j = rcpt.join(prices, "item_name", "left")
    return j.withColumns({
        "line_amount": (F.col("quantity") * F.col("list_price")).cast("int"),
        "amount_ok": F.col("quantity") * F.col("list_price") == F.col("total_price"),
    })
