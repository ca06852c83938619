"""Live resets (ST9 + W4) and the live topic cutover (S2 + U1)."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from relaywatch import work_dir
from relaywatch.operators import kpis as K
from relaywatch.streaming import control as CT
from relaywatch.streaming import live as L
from relaywatch.streaming import run as RUN

T0 = 1_704_067_200
INCIDENTS = ["normal", "kitchen_delay", "courier_delay", None]


def stamp(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc)


def trace(seed, n=300, tenants=("a", "b")):
    """(kind, tenant, second, arrival, incident, delayed, cancelled, prep) with
    nulls in every field, several events in some seconds."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t, sec = rnd.choice(tenants), i // 2
        if rnd.random() < 0.03:
            out.append(("reset", t, sec, None, rnd.choice(INCIDENTS[:3]), None, None, None))
        out.append(("order", t, sec, i, rnd.choice(INCIDENTS), rnd.choice([True, False, False, None]),
                    rnd.choice([True, *[False] * 8, None]), rnd.choice([10, 20, 40, None])))
    return out


def machine(events):
    """(tenant, epoch, arrival, total) fired by a plain loop over the events in
    order: by second, resets before orders, orders by arrival."""
    state, fired = {}, []
    for kind, t, _, arr, inc, d, c, p in sorted(
            events, key=lambda e: (e[2], e[0] == "order", -1 if e[3] is None else e[3])):
        s = state.setdefault(t, {"epoch": 0, "n": 0, "d": 0, "c": 0, "p": 0, "last": None})
        if kind == "reset":
            state[t] = {"epoch": s["epoch"] + 1, "n": 0, "d": 0, "c": 0, "p": 0, "last": None}
        if kind != "order":
            continue
        s["n"] += 1
        s["d"] += bool(d)
        s["c"] += bool(c)
        s["p"] += 0 if c else (15 if p is None else p)
        rate, cancel = s["d"] * 100.0 / s["n"], s["c"] * 100.0 / s["n"]
        prep = s["p"] / (s["n"] - s["c"]) if s["n"] > s["c"] else 0.0
        if (s["n"] >= 10 and inc not in (None, "normal") and s["last"] != inc
                and (rate > 20 or cancel > 10 or prep > 22)):
            s["last"] = inc
            fired.append((t, s["epoch"], arr, s["n"]))
    return sorted(fired)


def as_rows(events):
    return [(k, t, s * 1_000_000, arr, f"o{arr}", f"t{s}", inc, d, c, p)
            for k, t, s, arr, inc, d, c, p in events]


@pytest.mark.parametrize("seed", range(12))
def test_events_equal_state_machine_however_cut(seed):
    """One call, or many calls that carry the state, give the plain loop's result."""
    events = [e for e in trace(seed) if e[1] == "a"]
    rows = pd.DataFrame(as_rows(events), columns=["kind", "tenant", *CT._ROW[1:]])
    rows = rows.sample(frac=1, random_state=seed)
    want = [f[1:] for f in machine(events)]
    whole, _ = CT.run_events((*L.FRESH, 0, None), rows)
    assert list(zip(whole.epoch, whole.arrival, whole.total_orders)) == want
    state, got, step = (*L.FRESH, 0, None), [], random.Random(seed).randint(1, 40)
    for a in range(0, 151, step):
        due = rows[(rows.event_us >= a * 1_000_000) & (rows.event_us < (a + step) * 1_000_000)]
        fired, state = CT.run_events(state, due)
        got += [] if fired is None else list(zip(fired.epoch, fired.arrival, fired.total_orders))
    assert got == want and len(want) > 3


EVENT = ("kind string, tenant string, event_time timestamp, arrival long, order_id string, "
         "timestamp string, incident_mode string, is_delayed boolean, is_cancelled boolean, "
         "prep_time_minutes int, seq long")


def test_stream_equals_state_machine_for_displaced_records(spark):
    """Records of both kinds come up to 40 s of event time out of order, in six
    micro-batches with a restart after each; a tick at the end releases the rest."""
    events = trace(3)
    rnd = random.Random(5)
    rows = [(k, t, stamp(T0 + s), arr, f"o{arr}", f"t{s}", inc, d, c, p,
             s + rnd.randint(0, 40)) for k, t, s, arr, inc, d, c, p in events]
    rows += [("tick", t, stamp(T0 + 90_000), *[None] * 7, 191) for t in "ab"]
    df = spark.createDataFrame(rows, EVENT)
    out = RUN.replay(spark, df, CT.triggers_with_resets, "resets", "append", 6, order_col="seq")
    got = sorted((r.tenant, r.epoch, r.arrival, r.total_orders)
                 for r in RUN.appended(spark, out).collect())
    assert got == machine(events) and len(got) > 5


def test_stream_runs_in_a_session_with_another_state_provider(spark):
    """A plain Spark session keeps state in the HDFS-backed provider, which has no
    column families: the trigger sets what it needs for its own stream."""
    key, other = "spark.sql.streaming.stateStore.providerClass", (
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    plain = spark.newSession()
    plain.conf.set(key, other)
    events = trace(4, 60)
    rows = [(k, t, stamp(T0 + s), arr, f"o{arr}", f"t{s}", inc, d, c, p, s)
            for k, t, s, arr, inc, d, c, p in events]
    rows += [("tick", t, stamp(T0 + 90_000), *[None] * 7, 31) for t in "ab"]
    out = RUN.replay(plain, plain.createDataFrame(rows, EVENT), CT.triggers_with_resets, "plain",
                     "append", 2, order_col="seq")
    got = sorted((r.tenant, r.epoch, r.arrival, r.total_orders)
                 for r in RUN.appended(plain, out).collect())
    assert got == machine(events) and got
    assert plain.conf.get(key) == other


class Handle:
    """State variables of one tenant in memory, with the calls the trigger uses."""

    class Value:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        put = update

        def clear(self):
            self.value = None

    class Map(dict):
        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            self[key] = value

        def removeKey(self, key):
            del self[key]

    def getValueState(self, name, schema):
        return self.__dict__.setdefault(name, self.Value())

    getListState = getValueState

    def getMapState(self, name, keys, values):
        return self.__dict__.setdefault(name, self.Map())

    def registerTimer(self, at):
        self.timer = at


class Times:
    def __init__(self, seconds):
        self.ms = seconds * 1000

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("seed", range(6))
def test_waiting_rows_are_taken_in_parts(seed, monkeypatch):
    """However the rows come, none of the values in the state and none of the calls
    that take rows holds many of them, and the result is that of the plain loop. Rows
    that a checkpoint of before has in one value are taken too."""
    monkeypatch.setattr(CT, "RUN_ROWS", 40)
    monkeypatch.setattr(CT, "PAGE_ROWS", 5)
    events = [e for e in trace(seed, 1500) if e[1] == "a"]
    rows = pd.DataFrame(as_rows(events), columns=["kind", "tenant", *CT._ROW[1:]])
    rnd, sizes, pages, got = random.Random(seed), [], [], []
    run_events = CT.run_events

    def seen(state, part):
        sizes.append(len(part))
        return run_events(state, part)
    monkeypatch.setattr(CT, "run_events", seen)
    handle, trigger = Handle(), CT.ResettableTrigger()
    trigger.init(handle)

    def settle(part, until):
        frames = [part.iloc[a:a + 7] for a in range(0, len(part), 7)]
        found = [*trigger.handleInputRows(("a",), iter(frames), Times(until))] if frames else [
            *trigger.handleExpiredTimer(("a",), Times(until), None)]
        for f in found:
            got.extend(zip(f.tenant, f.epoch, f.arrival, f.total_orders))
        pages.extend(len(CT._unpacked(v[0])) for v in handle.pages.values())
        assert len(handle.pages) == len(CT._pairs(handle.index.get()[0]))
    early = rows[rows.event_us < 50_000_000]
    handle.waiting.put([(CT._packed(early),)])
    last = 0
    for until in (100, 420, 600, 751):
        late = rows[(rows.event_us >= max(last, 50) * 1_000_000) & (rows.event_us < until * 1_000_000)]
        settle(late.sample(frac=1, random_state=seed), max(last - 1, 0))
        settle(late[:0], until - 1 - rnd.randint(0, 20))
        last = until
    settle(rows[:0], 10_000)
    assert sorted(got) == [f for f in machine(events)] and len(got) > 5
    assert max(pages) <= 5 and not handle.pages and not handle.waiting.exists()
    assert max(sizes) < 200 < len(rows) / 3


def test_batch_and_keyed_trigger_share_null_rules(spark):
    events = [e for e in trace(8, 400) if e[0] == "order"]
    rows = [(0, arr, f"o{arr}", "t", inc, d, c, p) for _, _, _, arr, inc, d, c, p in events]
    df = spark.createDataFrame(rows, "epoch long, arrival long, order_id string, timestamp string, "
                                     "incident_mode string, is_delayed boolean, "
                                     "is_cancelled boolean, prep_time_minutes int")
    batch = sorted((r.arrival, r.total_orders, r.avg_prep_time)
                   for r in K.breach_events(K.running_kpis(df, bucket_width=50)).collect())
    fired, _ = L.advance(L.FRESH, df.toPandas())
    assert batch == sorted(zip(fired.arrival, fired.total_orders, fired.avg_prep_time))
    assert len(batch) > 5


def test_control_records(spark):
    df = spark.createDataFrame([('{"incident":"Kitchen_Delay"}',), ('{"incident":"bogus"}',), (None,),
                                ("broken",), ('{"incident":"normal","tenant":"x"}',)], "value string")
    got = [(r.kind, r.tenant, r.incident_mode) for r in CT.reset_events(CT.control_resets(
        df.withColumn("timestamp", F.current_timestamp())), ["a", "b"]).collect()]
    assert got.count(("reset", "x", "normal")) == 1 and len(got) == 9
    assert [g for g in got if g[0] == "reset" and g[1] in "ab"] == [
        ("reset", "a", "kitchen_delay"), ("reset", "b", "kitchen_delay")]


@pytest.mark.parametrize("cuts", [[], [40], [10, 20, 30, 39, 40, 41, 42, 60]])
def test_cutover_equals_batch_merge_for_any_split(spark, cuts):
    """Each batch is applied twice (a replay) by a new object (a restart)."""
    raw = [("orders", i, 2 * i) for i in range(50)]
    fwd = [("metrics", i, 2 * i + 1) for i in range(20, 50)]
    df = spark.createDataFrame(raw + fwd, "topic string, k long, arrival long")
    path = work_dir(spark, "cutover") + "/value"
    got, edges = [], [0, *cuts, 1000]
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        for _ in range(2):
            batch = df.filter((F.col("arrival") >= a) & (F.col("arrival") < b))
            rows = [tuple(r) for r in CT.Cutover(spark, path).apply(batch, n).collect()]
        got += rows
    topic = F.col("topic") == "metrics"
    want = K.merge_topics(df.filter(topic), df.filter(~topic)).collect()
    assert sorted(got) == sorted(map(tuple, want)) and len(want) == 51
    assert spark.read.parquet(path).first().arrival == 41


def test_cutover_without_forwarded_records(spark):
    df = spark.createDataFrame([("orders", 1), ("orders", 2)], "topic string, arrival long")
    path = work_dir(spark, "cutover") + "/value"
    assert CT.Cutover(spark, path).apply(df, 0).count() == 2
    assert CT.Cutover(spark, path)._known is None


def test_consumer_reads_both_topics_and_resets(spark, sf_dir):
    """The diagnose query over forwarded and raw records, cut over once, with a
    control topic: fired events equal the batch trigger over merged rows and epochs."""
    from relaywatch.operators import decode as D
    from relaywatch.sources.orders import receipts, topic_records_from_receipts
    from relaywatch.streaming.app import run_consumer
    rec = topic_records_from_receipts(receipts(spark, sf_dir)).filter("arrival < 1600")
    fwd = (rec.filter("arrival >= 900").withColumn("topic", F.lit("metrics"))
           .withColumn("arrival", F.col("arrival") + 1))
    folder = RUN.stage_batches(rec.unionByName(fwd), work_dir(spark, "two-topics"), 2)
    at = [100, 400, 555]
    control = spark.createDataFrame(
        [(f'{{"incident":"{i}"}}', T0 + s) for s, i in zip(at, ["normal", "kitchen_delay", "normal"])]
        + [(None, T0 + 90_000)], "v string, s long").select(
            F.lit("control").alias("topic"), F.lit(None).cast("binary").alias("key"),
            F.col("v").cast("binary").alias("value"), F.timestamp_seconds("s").alias("timestamp"),
            F.lit(0).cast("long").alias("arrival"))
    steps = work_dir(spark, "control-topic")
    control.write.mode("overwrite").parquet(steps)
    base = work_dir(spark, "consumer2")
    outs = run_consumer(spark, base, source="parquet", path=folder, topics=("metrics", "orders"),
                        options={"recursiveFileLookup": "true"}, trigger={"availableNow": True},
                        control={"source": "parquet", "path": steps})
    both = K.merge_topics(fwd, rec)
    web = D.accepted(D.web_records(both.withColumn("_time", F.col("timestamp")),
                                   keep=["arrival", "_time"])).withColumn(
        "epoch", F.size(F.filter(F.array(*[F.lit(T0 + s) for s in at]),
                                 lambda x: x <= F.unix_micros("_time") / 1_000_000)).cast("long"))
    want = sorted((r.epoch, r.arrival, r.total_orders)
                  for r in K.breach_events(K.running_kpis(web)).collect())
    got = sorted((r.epoch, r.arrival, r.total_orders)
                 for r in RUN.appended(spark, outs["diagnose"]).collect())
    assert got == want and len(want) > 3
    from relaywatch.operators import history as H
    assert H.open_history(spark, outs["history"]).count() == len(want) + 5
