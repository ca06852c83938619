"""Running streaming queries: staging, sinks, supervision (S3, S4, ST3, ST4,
ST11, ST12).

- every query gets its own checkpoint folder (under the shared work folder)
- update-mode results go through ``foreachBatch`` into one folder per batch
  id, overwritten on replay, so a re-run batch never duplicates output; with
  their keys given, the folders are merged into a state every few batches. The
  final state is a batch aggregate over the newest state and the batches after
  it (latest batch per key), never collected through the driver
- ``run_all`` starts several queries and waits on *any* termination, so a
  failing query is noticed at once (F15)
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from relaywatch.session import work_dir


def _range_bounds(df: DataFrame, order_col: str, n_batches: int):
    """``n_batches`` contiguous [a, b) ranges of ``order_col`` (only the two
    bounds reach the driver)."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return []
    step = (hi - lo) // n_batches + 1
    return [(lo + i * step, lo + (i + 1) * step) for i in range(n_batches)]


def stage_batches(df: DataFrame, folder: str, n_batches: int = 4,
                  order_col: str = "arrival") -> str:
    """Write ``df`` as ``n_batches`` ordered range folders (each written in
    parallel). Used for static replays and tests; ``replay`` turns each range
    into exactly one micro-batch."""
    bounds = _range_bounds(df, order_col, n_batches)
    if not bounds:
        df.limit(0).write.mode("overwrite").parquet(f"{folder}/part-0000")
    for i, (a, b) in enumerate(bounds):
        (df.filter((F.col(order_col) >= a) & (F.col(order_col) < b))
         .write.mode("overwrite").parquet(f"{folder}/part-{i:04d}"))
    return folder


def replay(spark: SparkSession, source: DataFrame, build: Callable[[DataFrame], DataFrame],
           name: str, output_mode: str = "update", n_batches: int = 4,
           order_col: str = "arrival", state_partitions: int | None = None,
           sink: Callable[[DataFrame, str, str, str], StreamingQuery] | None = None) -> str:
    """Replay ``source`` as a stream of ``n_batches`` micro-batches in
    ``order_col`` order and run ``build(stream)`` into a fresh folder.

    The rows are dealt to their ranges in one pass; each range is then moved
    into the source folder and the query re-run from its checkpoint with
    ``availableNow``, so every range is exactly one micro-batch and batches
    arrive in order, however many files a range has. This also exercises
    restart from the checkpoint. Stateful shuffles get ``state_partitions``
    (default: the cluster's default parallelism) in a session of their own. ``sink(query, name, checkpoint, out)``
    replaces the default per-batch folder writer. Returns the output folder.
    """
    base = work_dir(spark, f"stream-{name}")
    folder, out, ckpt = f"{base}/source", f"{base}/out", f"{base}/checkpoint"
    tag = base.rstrip("/").rsplit("-", 1)[-1]  # unique per call: concurrent runs never clash
    bounds = _range_bounds(source, order_col, n_batches) or [(0, 0)]
    lo, step = bounds[0][0], max(1, bounds[0][1] - bounds[0][0])
    session = stream_session(spark, state_partitions)
    # One pass deals the rows to their ranges; each range is one micro-batch.
    part = F.floor((F.col(order_col) - F.lit(lo)) / F.lit(step)).cast("int")
    source.withColumn("_range", part).write.partitionBy("_range").parquet(folder)
    jvm = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    fs = jvm(base).getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    fs.mkdirs(jvm(f"{base}/feed"))
    query = build(session.readStream.schema(source.schema)
                  .option("recursiveFileLookup", "true").parquet(f"{base}/feed"))
    for i in range(len(bounds)):
        done = jvm(f"{folder}/_range={i}")
        if i and not fs.exists(done):
            continue
        if fs.exists(done):
            fs.rename(done, jvm(f"{base}/feed/part-{i:04d}"))
        q = (sink(query, f"{name}-{tag}-{i}", ckpt, out) if sink
             else start(query, f"{name}-{tag}-{i}", ckpt, output_mode, out=out))
        run_all(spark, [q])
    return out


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streaming queries, with their state partition count set:
    state stores are fixed in a checkpoint at the first start and not coalesced,
    so a cluster's batch shuffle count would open that many of them per stateful
    operator. Other sessions keep their settings."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.streaming.stateStore.providerClass",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"):
        value = spark.conf.get(key, None)
        if value is not None:
            session.conf.set(key, value)
    parts = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    return session


def file_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Read a staged folder as a file stream (stands in for the broker source)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").parquet(folder))


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system and path class for a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    return p(path).getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def _numbered(spark: SparkSession, out: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``out/<prefix><n>``, ascending."""
    fs, path = _fs(spark, out)
    if not fs.exists(path(out)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(out))]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix)
                  and fs.exists(path(f"{out}/{n}/_SUCCESS")))


def batch_writer(out: str, keys: list[str] | None = None, compact_every: int = 16
                 ) -> Callable[[DataFrame, int], None]:
    """Idempotent foreachBatch: batch ``n`` overwrites ``out/batch_id=n``.

    With ``keys`` (an update-mode result) every ``compact_every`` batches the last
    state and the batches since then are merged into ``out/_state-n``, one row per
    key, and what the state before covered is removed. A read then costs the live
    keys and a few batches, however long the query has run. A batch that runs again
    writes its own folders again; a state counts once it is complete, and the one
    before stays until then.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if keys and (batch_id + 1) % compact_every == 0:
            compact(df.sparkSession, out, keys, batch_id, df.schema)
    return write


def compact(spark: SparkSession, out: str, keys: list[str], upto: int, schema) -> None:
    """Merge the update-mode result up to batch ``upto`` into one state folder."""
    fs, path = _fs(spark, out)
    earlier = [n for n in _numbered(spark, out, "_state-") if n < upto]
    rows = _updates(spark, out, upto, schema)
    rows.groupBy(*keys).agg(F.max_by(F.struct("*"), "batch_id").alias("s")).select("s.*").write.mode(
        "overwrite").parquet(f"{out}/_state-{upto}")
    # The state just written holds all of these; the previous one is kept for
    # readers that have begun with it.
    for n in earlier[:-1]:
        fs.delete(path(f"{out}/_state-{n}"), True)
    for n in [n for n in _numbered(spark, out, "batch_id=") if earlier and n <= earlier[-1]]:
        fs.delete(path(f"{out}/batch_id={n}"), True)


def _updates(spark: SparkSession, out: str, upto: int | None = None, schema=None) -> DataFrame:
    """Rows of the newest state (below ``upto``) and of the batches after it, with
    their batch_id."""
    states = [n for n in _numbered(spark, out, "_state-") if upto is None or n < upto]
    base = states[-1] if states else -1
    batches = [n for n in _numbered(spark, out, "batch_id=")
               if n > base and (upto is None or n <= upto)]
    if schema is None:  # a reader's: any batch has it
        last = batches[-1:] or [base]
        at = f"{out}/batch_id={last[0]}" if batches else f"{out}/_state-{base}"
        schema = spark.read.parquet(at).drop("batch_id").schema
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    reader = spark.read.schema(full)
    parts = []
    if batches:
        parts.append(reader.option("basePath", out).parquet(*[f"{out}/batch_id={n}" for n in batches]))
    if states:
        parts.append(spark.read.schema(full).parquet(f"{out}/_state-{base}"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def start(df: DataFrame, name: str, checkpoint: str, output_mode: str = "update",
          trigger: dict | None = None, out: str | None = None, sink: str = "batches",
          options: dict | None = None, keys: list[str] | None = None,
          compact_every: int = 16) -> StreamingQuery:
    """Start one query (ST3 output mode, ST4 trigger, own checkpoint).

    ``sink``: ``batches`` (foreachBatch per batch id, any output mode; with the
    ``keys`` of an update-mode result it is compacted every ``compact_every``
    batches),
    ``parquet``/``json`` (append-only file sinks), ``kafka`` (S3, needs the
    connector), ``console`` (S4).
    """
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if sink == "batches":
        w = w.foreachBatch(batch_writer(out, keys, compact_every))
    elif sink == "console":
        w = w.format("console").option("truncate", False).option("numRows", 20)
    else:
        w = w.format(sink).options(**(options or {}))
        if out:
            w = w.option("path", out)
    return w.start()


def run_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """ST11: wait until every query ends; stop all and raise on the first
    failure, whichever session a query belongs to."""
    def failed() -> None:
        for q in queries:
            if q.exception() is not None:
                raise RuntimeError(f"query {q.name} failed: {q.exception()}")

    try:
        while any(q.isActive for q in queries):
            failed()
            time.sleep(0.1)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    failed()


def final_state(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Latest row per key of an update-mode result: its newest state, if it is
    compacted, and the batches after it."""
    df = _updates(spark, out)
    cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch_id").alias("s"))
    return last.select(*keys, *[F.col(f"s.{c}").alias(c) for c in cols])


def appended(spark: SparkSession, out: str) -> DataFrame:
    """All rows of an append-mode result written by ``batch_writer``."""
    return spark.read.parquet(out).drop("batch_id")


def run_to_folder(spark: SparkSession, df: DataFrame, name: str,
                  output_mode: str = "update") -> str:
    """Run ``df`` to completion (availableNow) into a fresh folder."""
    base = work_dir(spark, f"stream-{name}")
    q = start(df, f"{name}-{base.rsplit('-', 1)[-1]}", f"{base}/checkpoint", output_mode,
              out=f"{base}/out")
    run_all(spark, [q])
    return f"{base}/out"


def display_sink(df: DataFrame, name: str, checkpoint: str, num_rows: int = 10,
                 trigger: dict | None = None, output_mode: str = "update") -> StreamingQuery:
    """Console display of an update-mode result, ``num_rows`` rows per
    batch, no truncation, 10 s trigger by default."""
    return (df.writeStream.queryName(name).outputMode(output_mode).format("console")
            .option("truncate", False).option("numRows", num_rows)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def keyed_json_sink(df: DataFrame, key_col: str, checkpoint: str, topic: str | None = None,
                    options: dict | None = None, path: str | None = None,
                    trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """S3: (key, JSON value) rows, append mode, every 5 seconds unless a
    ``trigger`` is given. ``topic`` writes to Kafka (needs the connector);
    ``path`` writes JSON files instead."""
    out = df.select(F.col(key_col).cast("string").alias("key"), F.col("value"))
    w = (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "5 seconds"})))
    if name:
        w = w.queryName(name)
    if topic:
        return w.format("kafka").option("topic", topic).options(**(options or {})).start()
    return w.format("json").option("path", path).start()


def run_name(checkpoint: str) -> str:
    """The name under which a query's batches are stored: that of its checkpoint,
    since batch numbers start again with a new one."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def diagnosis_handler(spark: SparkSession, history_path: str, run: str = "stream"
                      ) -> Callable[[DataFrame, int], None]:
    """J9 + S9 for one batch of fired events: diagnose against the history as it
    stands before the batch, then store every outcome as batch ``batch_id`` of
    ``run``, which a replay does not add again. The procedures are indexed once; a
    batch without events does nothing."""
    from relaywatch.operators import diagnose as G
    from relaywatch.operators import history as H
    from relaywatch.sources.procedures import procedure_documents

    known: list[DataFrame] = []
    H.open_history(spark, history_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch.limit(1).count() == 0:
            return
        if not known:
            known.append(G.fixed(session, G.issue_documents(session, procedure_documents(session))))
        # A replayed batch must not see its own outcomes of the first attempt.
        mine = f"{run}-{batch_id}-"
        history = H.open_history(session, history_path).filter(~F.col("id").startswith(mine))
        diag = G.diagnose(session, batch, procedure_documents(session), history,
                          documents=known[0])
        H.record_incidents(session, G.outcomes(diag).drop("id"), history_path,
                           ts_col="timestamp", batch_id=batch_id, run=run)
    return handle


def diagnose_on_breach(spark: SparkSession, fired: DataFrame, history_path: str,
                       checkpoint: str, trigger: dict | None = None,
                       out: str | None = None) -> StreamingQuery:
    """ST12: for each micro-batch of fired events, run the batch diagnosis
    against the history as it stands, then store the outcomes (S9). With ``out``
    the events of a batch are written there first and read back, so that the
    stateful part of the query runs once."""
    diagnose = diagnosis_handler(spark, history_path, run_name(checkpoint))

    def handle(batch: DataFrame, batch_id: int) -> None:
        if out:
            batch_writer(out)(batch, batch_id)
            batch = batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/batch_id={batch_id}")
        diagnose(batch, batch_id)
    return (fired.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(handle).start())


BREACH_STATE_SCHEMA = ("epoch long, total long, delayed long, cancelled long, prep_sum long, "
                       "last_fired string")


def breach_trigger_batches(spark: SparkSession, stream: DataFrame, out: str, state_dir: str,
                           checkpoint: str, trigger: dict | None = None,
                           bucket_width: int | None = None,
                           on_fired: Callable[[DataFrame, int], None] | None = None,
                           order: list[str] | None = None) -> StreamingQuery:
    """ST9 without keyed Python state: each micro-batch runs the batch
    operators (bucketed running KPIs and bucketed lag, so a hot epoch is
    spread over many tasks) starting from per-epoch state (counters and the
    last fired incident) written by the previous batch. Fired rows go to
    ``out/batch_id=n`` and the new state to ``state_dir/batch_id=n``; a
    replayed batch re-reads batch ``n-1``'s state, so replays are idempotent.
    ``on_fired(fired, batch_id)`` runs on each batch's fired rows (ST12).

    ``order`` (default ``arrival``) is a total order of the rows, for a broker
    its time, topic, partition and offset: a batch is sorted by it, numbered
    and written once (``state_dir/rows``), so ties in arrival cannot merge rows
    and both the fired rows and the state come from one numbering. The number is
    dense within a sorted partition, which keeps the buckets bounded.
    """
    from relaywatch.operators import kpis as K
    from relaywatch.operators.running import DEFAULT_BUCKET_WIDTH

    width = bucket_width or DEFAULT_BUCKET_WIDTH
    by = order or ["arrival"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id > 0:
            prior = session.read.schema(BREACH_STATE_SCHEMA).parquet(
                f"{state_dir}/state/batch_id={batch_id - 1}")
        else:
            prior = session.createDataFrame([], BREACH_STATE_SCHEMA)
        rows = f"{state_dir}/rows/batch_id={batch_id}"
        (batch.orderBy(*by).withColumn("_at", F.monotonically_increasing_id())
         .write.mode("overwrite").parquet(rows))
        run = K.running_kpis(session.read.parquet(rows), order_col="_at", bucket_width=width,
                             prior=prior).persist()
        fired = K.breach_events(run, order_col="_at", bucket_width=width, prior_last=prior)
        fired.select("epoch", "arrival", "order_id", "timestamp", "incident_mode",
                     "total_orders", "delay_rate", "cancellation_rate", "avg_prep_time",
                     "reliability_score").write.mode("overwrite").parquet(
                         f"{out}/batch_id={batch_id}")
        K.next_breach_state(prior, run, order_col="_at").write.mode("overwrite").parquet(
            f"{state_dir}/state/batch_id={batch_id}")
        run.unpersist()
        if on_fired is not None:
            on_fired(session.read.parquet(f"{out}/batch_id={batch_id}"), batch_id)

    return (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(handle).start())
