"""Live control: resets that clear a running trigger (ST9 with W4), and the
cutover from the raw to the forwarded topic (S2, U1).

``triggers_with_resets`` keeps one state per tenant over the union of two streams,
receipts and resets, and takes both in event time: rows wait in the state until
the watermark has passed them, then they are taken in order, a reset before the
receipts of its instant. So the result does not depend on how the two streams are
cut into micro-batches, and equals the batch trigger (W3) over the epochs of the
resets (W4). A reset clears the counters and the memory of the last incident fired
and starts the tenant's next epoch. Rows that come after the watermark has passed
them are late and dropped, as in ST1. Ticks, control records without a reset, only
move the time on: they release waiting rows when the orders pause.

``Cutover`` applies the two-topic rule batch by batch: raw records count until the
first forwarded record, forwarded ones from then on. The arrival of that record is
kept in a folder of the query and holds after a restart.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from relaywatch.schema import INCIDENTS
from relaywatch.session import ROCKSDB
from relaywatch.streaming.live import FRESH, advance

ORDER_KIND, RESET_KIND, TICK_KIND = "order", "reset", "tick"

_ROW = ["kind", "event_us", "arrival", "order_id", "timestamp", "incident_mode", "is_delayed",
        "is_cancelled", "prep_time_minutes"]
FIRED = ("tenant string, epoch long, epoch_incident string, arrival long, order_id string, "
         "timestamp string, incident_mode string, total_orders long, delay_rate double, "
         "cancellation_rate double, avg_prep_time double, reliability_score double")
_KPIS = ("total long, delayed long, cancelled long, prep_sum long, last_fired string, epoch long, "
         "epoch_incident string")


# Waiting rows of a tenant that a task sorts at once, and those stored in one value.
RUN_ROWS, PAGE_ROWS = 50_000, 1_000


def _packed(pdf: pd.DataFrame) -> bytes:
    sink = io.BytesIO()
    table = pa.Table.from_pandas(pdf[_ROW], preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _pairs(data: bytes) -> list[list[int]]:
    return np.frombuffer(data, np.int64).reshape(-1, 2).tolist() if len(data) else []


def run_events(state: tuple, rows: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
    """The fired receipts of one tenant's events, taken in order of event time,
    and the state after them: (total, delayed, cancelled, prep_sum, last_fired,
    epoch, epoch_incident)."""
    rows = rows[rows["kind"] != TICK_KIND]
    first = (rows["kind"] != RESET_KIND).to_numpy()
    order = np.lexsort((rows["arrival"].fillna(-1).to_numpy(), first, rows["event_us"].to_numpy()))
    rows, first = rows.iloc[order].reset_index(drop=True), first[order]
    kpis, (epoch, incident) = tuple(state[:5]), state[5:]
    incidents = np.array([incident, *rows["incident_mode"][~first]], dtype=object)
    part = np.cumsum(~first)[first]  # resets before each order
    fired, kpis = advance(kpis, rows[first].assign(epoch=epoch + part), part, len(incidents) - 1)
    found = fired.assign(epoch_incident=incidents[fired["epoch"] - epoch]) if len(fired) else None
    return found, (*kpis, epoch + len(incidents) - 1, incidents[-1])


class ResettableTrigger(StatefulProcessor):
    """Per tenant: the trigger's counters, and the rows that wait for the watermark.

    New rows are sorted by event time, ``RUN_ROWS`` at a time, and stored in pages of
    ``PAGE_ROWS``; an index has the first instant of each page. Due pages are read in
    the order of these instants, and their rows are taken as soon as no unread page
    can hold an earlier one. So a task holds a run, and a page of each run whose times
    overlap, not the rows of a micro-batch; rows of one instant are taken together."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kpis = handle.getValueState("kpis", _KPIS)
        self.index = handle.getValueState("index", "pages binary")
        self.pages = handle.getMapState("pages", "page long", "rows binary")
        # Checkpoints from before the pages: all waiting rows of a tenant in one value.
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, [], timerValues.getCurrentWatermarkInMs())

    def _settle(self, key, new: Iterable[pd.DataFrame], watermark_ms: int) -> Iterator[pd.DataFrame]:
        until = watermark_ms * 1000
        index = dict(_pairs(self.index.get()[0])) if self.index.exists() else {}
        known = dict(index)
        if self.waiting.exists():
            self._keep(index, (_unpacked(r[0]) for r in self.waiting.get()))
            self.waiting.clear()
        self._keep(index, new)
        if any(at <= until for at in index.values()):
            state = tuple(self.kpis.get()) if self.kpis.exists() else (*FRESH, 0, None)
            for due in self._due(index, until):
                fired, state = run_events(state, due)
                if fired is not None:
                    fired.insert(0, "tenant", key[0])
                    yield fired[[c.split()[0] for c in FIRED.split(", ")]]
            self.kpis.update(state)
        if index != known:
            self.index.update((np.array(list(index.items()), np.int64).tobytes(),))
        if index:
            self.handle.registerTimer(min(index.values()) // 1000 + 1)

    def _keep(self, index: dict[int, int], frames: Iterable[pd.DataFrame]) -> None:
        """Stores rows in pages, a sorted run at a time. A row without a time never
        falls due."""
        n, run = max(index, default=-1) + 1, []

        def store() -> None:
            nonlocal n
            rows = pd.concat(run, ignore_index=True)
            rows = rows[rows["event_us"].notna()].sort_values("event_us", kind="stable")
            for a in range(0, len(rows), PAGE_ROWS):
                page = rows.iloc[a:a + PAGE_ROWS]
                self.pages.updateValue((n,), (_packed(page),))
                index[n] = int(page["event_us"].iloc[0])
                n += 1
            run.clear()

        for f in frames:
            for a in range(0, len(f), RUN_ROWS):
                part = f.iloc[a:a + RUN_ROWS][_ROW]
                if run and sum(map(len, run)) + len(part) > RUN_ROWS:
                    store()
                run.append(part)
        if run:
            store()

    def _due(self, index: dict[int, int], until: int) -> Iterator[pd.DataFrame]:
        """The rows up to ``until`` in parts, each of them before those of the next
        part. Pages that are read leave the index; later rows in them are stored anew."""
        pages = sorted((at, n) for n, at in index.items() if at <= until)
        ahead = [at for at, _ in pages[1:]] + [until + 1]
        held, left = [], 0
        for (_, n), before in zip(pages, ahead):
            held.append(_unpacked(self.pages.getValue((n,))[0]))
            self.pages.removeKey((n,))
            del index[n]
            if before > until or sum(map(len, held)) >= 2 * left + RUN_ROWS:
                rows = pd.concat(held, ignore_index=True)
                due = (rows["event_us"] < before).to_numpy()
                held, left = [rows[~due]], int((~due).sum())
                if due.any():
                    yield rows[due]
        self._keep(index, held)

    def close(self) -> None:
        pass


def control_resets(records: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """(kind, tenant, event_time, incident_mode) of a control topic's JSON values
    ``{"incident": ..., "tenant": ...}``. The incident is lower-cased; an unknown or
    missing one is no reset (P9) but a tick, and so is an unreadable value."""
    body = F.from_json(F.col("value").cast("string"), "incident string, tenant string")
    incident = F.lower(body["incident"])
    known = F.coalesce(incident.isin(INCIDENTS), F.lit(False))
    return records.select(
        F.when(known, RESET_KIND).otherwise(TICK_KIND).alias("kind"),
        body["tenant"].alias("tenant"), F.col(time_col).alias("event_time"),
        F.when(known, incident).alias("incident_mode"))


def order_events(receipts: DataFrame, tenant, time_col: str) -> DataFrame:
    """Receipts as events of a tenant (a column)."""
    return receipts.select(
        F.lit(ORDER_KIND).alias("kind"), tenant.cast("string").alias("tenant"),
        F.col(time_col).alias("event_time"),
        *[F.col(c) for c in ("arrival", "order_id", "timestamp", "incident_mode", "is_delayed",
                             "is_cancelled", "prep_time_minutes")])


def reset_events(resets: DataFrame, tenants: list[str] | None = None) -> DataFrame:
    """Control events (kind, tenant, event_time, incident_mode) in the columns of
    ``order_events``. One without a tenant holds for each of ``tenants``."""
    r = resets
    if tenants:
        r = r.withColumn("tenant", F.explode(F.when(
            F.col("tenant").isNull(), F.array(*[F.lit(t) for t in tenants]))
            .otherwise(F.array("tenant"))))
    none = F.lit(None)
    return r.select("kind", "tenant", "event_time", none.cast("long").alias("arrival"),
                    none.cast("string").alias("order_id"), none.cast("string").alias("timestamp"),
                    "incident_mode", none.cast("boolean").alias("is_delayed"),
                    none.cast("boolean").alias("is_cancelled"),
                    none.cast("int").alias("prep_time_minutes"))


def triggers_with_resets(events: DataFrame, watermark: str = "1 minute") -> DataFrame:
    """ST9 over the union of ``order_events`` and ``reset_events`` (a streaming
    frame): the receipts at which a diagnosis fires, per tenant and reset epoch.

    One watermark covers the union, so neither stream can hold the other up; a
    record of either may come ``watermark`` later than the newest event time seen.
    The state of a tenant is its counters and the rows within the watermark, in pages
    of which a task holds a few at a time.

    ``transformWithState`` keeps each state variable in a column family of its own,
    which only the RocksDB provider has: the stream's session is set to it, whatever
    the session's own choice.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    e = (events.withWatermark("event_time", watermark)
         .withColumn("event_us", F.unix_micros("event_time")))
    return e.groupBy("tenant").transformWithStateInPandas(
        statefulProcessor=ResettableTrigger(), outputStructType=FIRED, outputMode="append",
        timeMode="EventTime")


# --------------------------------------------------------------------------
# S2 + U1: the two-topic rule
# --------------------------------------------------------------------------

class Cutover:
    """The arrival of a query's first forwarded record, in the folder ``path``.

    ``apply`` is called with each micro-batch, in order. The batch that holds the
    first forwarded record sets the value before any of its rows is written; when
    that batch is run again it finds its own number there and sets the same value.
    Only the value reaches the driver; rows are filtered where they are.
    """

    def __init__(self, spark: SparkSession, path: str, forwarded: str = "metrics",
                 topic_col: str = "topic", order_col: str = "arrival"):
        self.path, self.forwarded = path, forwarded
        self.topic_col, self.order_col = topic_col, order_col
        self._known = self._stored(spark)

    def _stored(self, spark: SparkSession) -> tuple[int, int] | None:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_SUCCESS")  # noqa: SLF001
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):  # noqa: SLF001
            return None
        r = spark.read.schema("batch_id long, arrival long").parquet(self.path).first()
        return (r.batch_id, r.arrival)

    def apply(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a micro-batch that count."""
        mine = F.col(self.topic_col) == self.forwarded
        if self._known is None or self._known[0] >= batch_id:
            first = batch.filter(mine).agg(F.min(self.order_col)).first()[0]
            if first is not None:
                self._known = (batch_id, int(first))
                batch.sparkSession.createDataFrame(
                    [self._known], "batch_id long, arrival long").coalesce(1).write.mode(
                        "overwrite").parquet(self.path)
        if self._known is None:
            return batch
        return batch.filter(mine | (F.col(self.order_col) < self._known[1]))

    def staged(self, out: str) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that writes the rows that count to a folder per
        batch under ``out``, as a file source for other queries. A batch whose
        folder is complete is left as it is when it runs again: its files may have
        been read."""
        def write(batch: DataFrame, batch_id: int) -> None:
            rows = self.apply(batch, batch_id)
            folder = f"{out}/batch-{batch_id}"
            spark = batch.sparkSession
            done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")  # noqa: SLF001
            if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):  # noqa: SLF001
                rows.write.mode("overwrite").parquet(folder)
        return write

    def before(self, handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that passes the rows that count to ``handle``."""
        return lambda batch, batch_id: handle(self.apply(batch, batch_id), batch_id)
