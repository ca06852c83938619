"""ST11 by progress: queries that fail, stall or are stopped start again alone."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from relaywatch import work_dir
from relaywatch.operators import reliability as R
from relaywatch.streaming import live as L
from relaywatch.streaming import run as RUN
from relaywatch.streaming.supervise import run_supervised


def _folder(spark, parts=4):
    df = spark.range(400).select(F.col("id").alias("arrival"), (F.col("id") % 7).alias("k"))
    folder = RUN.stage_batches(df, work_dir(spark, "supervised-src"), parts)
    return folder, df


def _counts(spark, folder, base, name, sink=None, trigger=None):
    s = (spark.readStream.schema("arrival long, k long").option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(folder).groupBy("k").count())
    write = RUN.batch_writer(f"{base}/{name}/out", ["k"])

    def both(df, n):
        if sink:
            sink(df, n)
        write(df, n)
    return lambda: (s.writeStream.outputMode("update").queryName(f"{name}-{time.time_ns()}")
                    .option("checkpointLocation", f"{base}/{name}/checkpoint")
                    .trigger(**(trigger or {"availableNow": True})).foreachBatch(both).start())


def _state(spark, base, name):
    return {r.k: r["count"] for r in RUN.final_state(spark, f"{base}/{name}/out", ["k"]).collect()}


def test_one_failing_query_leaves_the_others_complete(spark):
    folder, df = _folder(spark)
    base, fails = work_dir(spark, "supervised"), []

    def shaky(batch, n):
        if n == 2 and len(fails) < 2:
            fails.append(n)
            raise ValueError("lost")
    starts = {n: _counts(spark, folder, base, n) for n in ("a", "b", "c")}
    starts["shaky"] = _counts(spark, folder, base, "shaky", shaky)
    got = run_supervised(spark, starts, finite=True, pause=0.1)
    want = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    for name in starts:
        assert _state(spark, base, name) == want
    assert fails == [2, 2] and got["shaky"].restarts == 2
    assert all(got[n].restarts == 0 for n in "abc") and "lost" in got["shaky"].reasons[0]


def test_a_query_that_keeps_failing_is_raised(spark):
    folder, _ = _folder(spark, 1)

    def broken(batch, n):
        raise ValueError("always")
    starts = {"x": _counts(spark, folder, work_dir(spark, "supervised"), "x", broken)}
    with pytest.raises(RuntimeError, match="given up after 1 restarts"):
        run_supervised(spark, starts, finite=True, pause=0.1, max_restarts=1)


def test_stopped_and_stalled_queries_start_again(spark):
    """One query is stopped from outside, one hangs in a batch: both come back and
    catch up, a third never restarts."""
    folder, df = _folder(spark, 3)
    base, state = work_dir(spark, "supervised"), {"hung": False, "killed": False}

    def hang(batch, n):
        if n == 1 and not state["hung"]:
            state["hung"] = True
            time.sleep(45)
    fast = {"processingTime": "200 milliseconds"}
    starts = {"plain": _counts(spark, folder, base, "plain", trigger=fast),
              "stopped": _counts(spark, folder, base, "stopped", trigger=fast),
              "hung": _counts(spark, folder, base, "hung", hang, trigger=fast)}
    running = {}
    starts = {n: (lambda n=n, s=s: running.setdefault(n, []).append(s()) or running[n][-1])
              for n, s in starts.items()}
    want = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    ends = time.monotonic() + 240

    def kill():
        while not running.get("stopped") or not running["stopped"][0].recentProgress:
            time.sleep(0.1)
        running["stopped"][0].stop()
    threading.Thread(target=kill, daemon=True).start()

    def going():
        try:
            done = all(_state(spark, base, n) == want for n in starts)
        except Exception:
            done = False
        return time.monotonic() < ends and not (
            done and all(len(running[n]) > 1 for n in ("stopped", "hung")))
    got = run_supervised(spark, starts, pause=0.1, stall_seconds=20, keep_going=going, poll=0.5)
    assert all(_state(spark, base, n) == want for n in starts)
    assert got["stopped"].reasons[0].endswith("was stopped")
    assert "made no progress" in got["hung"].reasons[0]
    assert got["plain"].restarts == 0


def test_supervised_consumer(spark, sf_dir):
    from relaywatch.sources.orders import receipts, topic_records_from_receipts
    from relaywatch.streaming.app import run_consumer
    rec = topic_records_from_receipts(receipts(spark, sf_dir)).filter("arrival < 900")
    folder = RUN.stage_batches(rec, work_dir(spark, "consumer-src"), 2)
    base = work_dir(spark, "consumer")
    outs = run_consumer(spark, base, supervised=True, source="parquet", path=folder,
                        options={"recursiveFileLookup": "true"}, trigger={"availableNow": True})
    want = {r.kafka_mode: (r.total_orders_received, r.unique_orders) for r in R.exact_distinct(
        L.decoded(rec).fillna({"order_id": "<null>"})).collect()}
    got = {r.kafka_mode: (r.total_orders_received, r.unique_orders)
           for r in RUN.final_state(spark, outs["summary"], ["kafka_mode"]).collect()}
    assert got == want and RUN.appended(spark, outs["forward"]).count() == rec.count()
