"""The streaming consumer as one program (ST3, ST4, ST11 over ST2-ST12).

``start_consumer`` reads the order topic once per query (each query keeps
its own offsets in its own checkpoint) and starts:

- ``summary``   exact per-mode totals, unique orders, duplicates (ST6) and
                highest sequence (ST5), update mode, per-batch folders
- ``windows``   exact per-mode sliding windows with a watermark (ST1, ST2)
- ``forward``   decode + tag + encode to a keyed sink (ST10, S3)
- ``merge``     only with ``topics``: the forwarded and the raw topic as one, cut
                over at the first forwarded record (S2, U1), staged as files
- ``diagnose``  the trigger (ST9) feeding the diagnosis and the history append
                (ST12): batch operators per micro-batch with a per-epoch state
                table, or, with ``control``, keyed state that the resets of a
                control topic clear (W4)

``run_all`` then waits for them (any failure stops all), or ``run_supervised``
starts one that fails or stalls again from its checkpoint. With a broker,
pass ``source="kafka"`` and its options; tests use a file source.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relaywatch.operators.decode import accepted, web_records
from relaywatch.sources.orders import read_orders_stream, read_topics
from relaywatch.streaming import live as L
from relaywatch.streaming import run as RUN
from relaywatch.streaming.control import (Cutover, control_resets, order_events, reset_events,
                                          triggers_with_resets)
from relaywatch.streaming.supervise import run_supervised


# Columns a broker source orders and identifies its records by.
_ORDER = ["timestamp", "topic", "partition", "offset"]
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def consumer_queries(spark: SparkSession, base: str, source: str = "kafka",
                     options: dict | None = None, path: str | None = None,
                     trigger: dict | None = None, forward_topic: str | None = None,
                     epoch_col: str | None = None, keyed_state: bool = False,
                     state_partitions: int | None = None, topics: tuple[str, str] | None = None,
                     control: dict | None = None, watermark: str = "1 minute",
                     session: SparkSession | None = None
                     ) -> dict[str, Callable[[], StreamingQuery]]:
    """How to start each consumer query under ``base`` (a shared folder): outputs
    in ``base/<query>/out``, checkpoints in ``base/<query>/checkpoint``,
    history in ``base/history``. ``trigger`` defaults to the reference's
    10-second micro-batches. ``epoch_col`` names a KPI-epoch column when the
    records carry one; otherwise the trigger runs over a single epoch.
    The queries run in a session of their own with ``state_partitions`` state
    stores per stateful operator (default: the default parallelism).

    The diagnose query follows the web side's rules (P8, P10): rejected records
    do not count and missing fields take their defaults. Its trigger runs
    JVM-only per micro-batch with a per-epoch state table (a hot epoch is spread
    over many tasks); ``keyed_state=True`` uses the applyInPandasWithState
    version instead.

    ``topics=(forwarded, raw)``: the diagnose query reads both topics under the
    two-topic rule, the other queries the raw one. ``control`` (source, options,
    path of a control topic) starts a new KPI epoch at each reset read from it;
    receipts and resets are then taken in event time, and either may come
    ``watermark`` late. With ``availableNow`` the merged topic is complete before
    the diagnose query starts.
    """
    trig = trigger or {"processingTime": "10 seconds"}
    session = session or RUN.stream_session(spark, state_partitions)

    def counted(r: DataFrame) -> DataFrame:
        # Broker records carry no arrival counter: show the broker's time.
        return r if "arrival" in r.columns else r.withColumn("arrival",
                                                              F.unix_micros("timestamp"))

    def records() -> DataFrame:
        if topics:
            return counted(read_topics(session, [topics[1]], source, dict(options or {}), path))
        return counted(read_orders_stream(session, source, dict(options or {}), path))

    def dec() -> DataFrame:
        keep = [c for c in ["arrival", epoch_col] if c]
        return L.decoded(records(), keep=keep)

    queries: dict[str, Callable[[], StreamingQuery]] = {}
    queries["summary"] = partial(
        RUN.start, L.live_unique(dec()), "summary", f"{base}/summary/checkpoint", "update", trig,
        out=f"{base}/summary/out", keys=["kafka_mode"])
    queries["sequence"] = partial(
        RUN.start, L.live_totals(dec()), "sequence", f"{base}/sequence/checkpoint", "update", trig,
        out=f"{base}/sequence/out", keys=["kafka_mode"])
    queries["windows"] = partial(
        RUN.start, L.windowed_exact_stream(dec()), "windows", f"{base}/windows/checkpoint", "update",
        trig, out=f"{base}/windows/out", keys=["kafka_mode", "window_start"])
    fwd = L.forward(records(), keep=["arrival"])
    if forward_topic:
        # The sink takes producer settings only (no subscribe/offset options).
        sink_opts = {k: v for k, v in (options or {}).items()
                     if k.startswith("kafka.") and k != "kafka.isolation.level"}
        queries["forward"] = partial(
            RUN.keyed_json_sink, fwd, "key", f"{base}/forward/checkpoint", topic=forward_topic,
            options=sink_opts, trigger=trig, name="forward")
    else:
        queries["forward"] = partial(RUN.start, fwd, "forward", f"{base}/forward/checkpoint",
                                     "append", trig, out=f"{base}/forward/out")
    if topics:
        both = counted(read_topics(session, list(topics), source, dict(options or {}), path))
        staged = f"{base}/merge/out"
        session.createDataFrame([], both.schema).write.mode("ignore").parquet(f"{staged}/batch-none")
        cut = Cutover(session, f"{base}/merge/cutover", forwarded=topics[0])
        queries["merge"] = (both.writeStream.queryName("merge").trigger(**trig)
                            .option("checkpointLocation", f"{base}/merge/checkpoint")
                            .foreachBatch(cut.staged(staged)).start)
        raw = (session.readStream.schema(both.schema).option("recursiveFileLookup", "true")
               .parquet(staged))
    else:
        raw = records()
    place = [c for c in _ORDER if c in raw.columns and c != "timestamp"]
    web = accepted(web_records(raw.withColumn("_time", F.col("timestamp")),
                               keep=["arrival", "_time", *place, *([epoch_col] if epoch_col else [])]))
    events = web.select(
        (F.col(epoch_col) if epoch_col else F.lit(0).cast("long")).alias("epoch"), "arrival",
        "order_id", F.date_format("_time", _ISO).alias("timestamp"),
        "incident_mode", "is_delayed", "is_cancelled", "prep_time_minutes", *place)
    if control:
        resets = control_resets(read_orders_stream(session, **control))
        receipts = web.withColumn("timestamp", F.date_format("_time", _ISO))
        fired = triggers_with_resets(
            order_events(receipts, F.lit("all"), "_time").unionByName(reset_events(resets, ["all"])),
            watermark)
        queries["diagnose"] = partial(
            RUN.diagnose_on_breach, session, fired, f"{base}/history",
            f"{base}/diagnose/checkpoint", trig, out=f"{base}/diagnose/out")
    elif keyed_state:
        queries["diagnose"] = partial(
            RUN.diagnose_on_breach, session, L.breach_trigger(events.drop(*place)),
            f"{base}/history", f"{base}/diagnose/checkpoint", trig)
    else:
        queries["diagnose"] = partial(
            RUN.breach_trigger_batches, session, events, f"{base}/diagnose/out",
            f"{base}/diagnose/state", f"{base}/diagnose/checkpoint", trig,
            on_fired=RUN.diagnosis_handler(session, f"{base}/history",
                                           RUN.run_name(f"{base}/diagnose/checkpoint")),
            order=["arrival", *place])
    return queries


def start_consumer(spark: SparkSession, base: str, **options) -> dict[str, StreamingQuery]:
    """Start every query of ``consumer_queries`` (same options)."""
    started = {}
    for name, begin in consumer_queries(spark, base, **options).items():
        started[name] = begin()
        if name == "merge" and (options.get("trigger") or {}).get("availableNow"):
            RUN.run_all(spark, [started[name]])
    return started


def run_consumer(spark: SparkSession, base: str, supervised: bool = False,
                 **kwargs) -> dict[str, str]:
    """Run the consumer until every query ends (with ``trigger={"availableNow":
    True}``) or one fails. ``supervised`` starts a query that fails or stalls again
    from its checkpoint instead, and raises only when one keeps failing. Returns
    output folders."""
    if supervised:
        finite = bool((kwargs.get("trigger") or {}).get("availableNow"))
        session = RUN.stream_session(spark, kwargs.get("state_partitions"))
        starts = consumer_queries(session, base, session=session, **kwargs)
        merge = {n: s for n, s in starts.items() if n == "merge" and finite}
        run_supervised(session, merge, finite=finite)
        run_supervised(session, {n: s for n, s in starts.items() if n not in merge}, finite=finite)
        names = list(starts)
    else:
        queries = start_consumer(spark, base, **kwargs)
        RUN.run_all(spark, list(queries.values()))
        names = list(queries)
    return {name: f"{base}/{name}/out" for name in names} | {"history": f"{base}/history"}
