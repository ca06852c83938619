"""Property and edge tests."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relaywatch import work_dir
from relaywatch.operators import kpis as K
from relaywatch.operators import history as H
from relaywatch.operators import reliability as R
from relaywatch.operators import search as S
from relaywatch.operators.running import running_aggregates, previous_value
from relaywatch.streaming import live as L
from relaywatch.streaming import run as RUN

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 20)), min_size=1, max_size=60),
       width=st.integers(1, 9))
def test_running_aggregates_match_numpy(spark, vals, width):
    rows = [(g, i * 3, v) for i, (g, v) in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, pos long, v long")
    out = running_aggregates(df, ["g"], "pos", sums={"s": F.col("v")}, maxes={"m": F.col("v")},
                             bucket_width=width).toPandas().sort_values("pos")
    p = pd.DataFrame(rows, columns=["g", "pos", "v"]).sort_values("pos")
    p["s"] = p.groupby("g")["v"].cumsum()
    p["m"] = p.groupby("g")["v"].cummax()
    assert out["s"].tolist() == p["s"].tolist()
    assert out["m"].tolist() == p["m"].tolist()
    prev = previous_value(df, ["g"], "pos", "v", "prev", bucket_width=width).toPandas()
    prev = prev.sort_values("pos")
    p["prev"] = p.groupby("g")["v"].shift(1)
    assert [None if pd.isna(x) else int(x) for x in prev["prev"]] == \
        [None if pd.isna(x) else int(x) for x in p["prev"]]


@SETTINGS
@given(trace=st.lists(st.tuples(st.sampled_from(["normal", "kitchen_delay", "courier_delay"]),
                                st.booleans(), st.booleans(), st.integers(10, 40)),
                      min_size=1, max_size=80),
       epochs=st.integers(1, 3), width=st.integers(1, 16))
def test_breach_events_equal_state_machine(spark, trace, epochs, width):
    rows = [(i * epochs // len(trace), i, f"o{i}", inc, d, c, p)
            for i, (inc, d, c, p) in enumerate(trace)]
    df = spark.createDataFrame(rows, "epoch long, arrival long, order_id string, "
                                     "incident_mode string, is_delayed boolean, "
                                     "is_cancelled boolean, prep_time_minutes int")
    ev = K.breach_events(K.running_kpis(df, bucket_width=width), bucket_width=width)
    got = sorted(r.arrival for r in ev.select("arrival").collect())
    fired, state = [], {}
    for e, a, _, inc, d, c, p in rows:
        s = state.setdefault(e, {"n": 0, "d": 0, "c": 0, "p": 0, "last": None})
        s["n"] += 1
        s["d"] += d
        s["c"] += c
        s["p"] += 0 if c else p
        dr, cr = s["d"] * 100.0 / s["n"], s["c"] * 100.0 / s["n"]
        ap = s["p"] / (s["n"] - s["c"]) if s["n"] > s["c"] else 0.0
        if s["n"] >= 10 and inc != "normal" and s["last"] != inc:
            if dr > 20 or cr > 10 or ap > 22:
                s["last"] = inc
                fired.append(a)
    assert got == fired


@SETTINGS
@given(ids=st.lists(st.one_of(st.none(), st.sampled_from(list("abcdefg"))), min_size=1,
                    max_size=40), parts=st.integers(1, 5))
def test_summary_is_shuffle_invariant(spark, ids, parts):
    rows = [(o, "at_least_once" if i % 2 else "exactly_once", i % 7 + 1)
            for i, o in enumerate(ids)]
    df = spark.createDataFrame(rows, "order_id string, kafka_mode string, sent_sequence int")
    a = sorted(R.delivery_summary(df).collect())
    b = sorted(R.delivery_summary(df.repartition(parts)).collect())
    assert a == b
    for r in a:
        assert r.duplicate_orders == r.total_orders_received - r.unique_orders >= 0


def test_cosine_bounds(spark, sf_dir):
    idx = S.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    q = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), "text")
    qv, small = S.query_vectors(idx, q)
    s = S.sparse_dot(idx, qv, small).agg(F.min("score"), F.max("score")).first()
    assert 0 < s[0] and s[1] <= 1 + 1e-9


def test_all_cancelled_prep_is_zero(spark):
    rows = [(0, i, f"o{i}", "kitchen_delay", False, True, 30) for i in range(12)]
    df = spark.createDataFrame(rows, "epoch long, arrival long, order_id string, "
                                     "incident_mode string, is_delayed boolean, "
                                     "is_cancelled boolean, prep_time_minutes int")
    k = K.operations_kpis(df).collect()[0]
    assert k.avg_prep_time == 0.0 and k.cancellation_rate == 100.0
    assert k.reliability_score == 0.0 and k.breach


def test_epoch_split_then_union_equals_whole(spark, sf_dir):
    from relaywatch.sources.orders import receipts
    r = receipts(spark, sf_dir)
    whole = {x.kafka_mode: x.total_orders_received for x in R.delivery_summary(r).collect()}
    parts = R.delivery_summary(r.filter("epoch % 2 = 0")).unionByName(
        R.delivery_summary(r.filter("epoch % 2 = 1")))
    summed = {x.kafka_mode: x.t for x in
              parts.groupBy("kafka_mode").agg(F.sum("total_orders_received").alias("t")).collect()}
    assert whole == summed


def test_late_row_past_watermark_is_dropped(spark):
    t0 = 1704067200
    rows = [("a", "exactly_once", 1, 1.0, t0 + 600, 0), ("b", "exactly_once", 2, 1.0, t0 + 700, 1),
            ("late", "exactly_once", 3, 1.0, t0 + 100, 2)]
    df = spark.createDataFrame(rows, "order_id string, kafka_mode string, sent_sequence int, "
                                     "producer_sent_at double, ts long, arrival long")
    df = df.withColumn("kafka_timestamp", F.timestamp_seconds("ts")).drop("ts")
    out = RUN.replay(spark, df, L.sliding_windows, "late", n_batches=3)
    total = RUN.final_state(spark, out, ["kafka_mode", "window_start"]).agg(
        F.sum("total_orders_received")).first()[0]
    assert total == 4  # a and b land in two windows each; the late row is dropped


def test_read_topics_and_keyed_sink(spark, sf_dir):
    from relaywatch.sources.orders import read_topics, receipts, topic_records_from_receipts
    rec = topic_records_from_receipts(receipts(spark, sf_dir))
    other = rec.withColumn("topic", F.lit("metrics"))
    folder = work_dir(spark, "topics")
    RUN.stage_batches(rec.unionByName(other), folder, 2)
    s = read_topics(spark, ["metrics"], source="parquet", path=folder,
                    options={"maxFilesPerTrigger": "1", "recursiveFileLookup": "true"})
    fwd = L.forward(s)
    base = work_dir(spark, "sink")
    q = RUN.keyed_json_sink(fwd, "key", f"{base}/ck", path=f"{base}/out")
    q.processAllAvailable()
    q.stop()
    back = spark.read.json(f"{base}/out")
    assert back.count() == rec.count()
    assert set(back.columns) == {"key", "value"}


def test_latest_kpis_defaults_without_input(spark):
    r = K.latest_kpis(None, spark=spark).collect()[0]
    assert (r.delay_rate, r.avg_prep_time, r.cancellation_rate, r.reliability_score) == \
        (0.0, 15.0, 0.0, 100.0)
    empty = spark.createDataFrame([], "epoch long, delay_rate double, avg_prep_time double, "
                                      "cancellation_rate double, reliability_score double, "
                                      "active_incident string")
    assert K.latest_kpis(empty).collect()[0].avg_prep_time == 15.0


def test_snapshot_document_and_display_sink(spark, sf_dir):
    import json
    from relaywatch.plans import QUERIES
    doc = json.loads(QUERIES["s12_snapshot_document"](spark, sf_dir).collect()[0][0])
    assert set(doc["modes"]) == {"at_most_once", "at_least_once", "exactly_once"}
    assert len(doc["recent_orders"]) == 12 and doc["active"] == doc["modes"][doc["kafka_mode"]]
    rows = [("a", "exactly_once", 1, 0)]
    df = spark.createDataFrame(rows, "order_id string, kafka_mode string, sent_sequence int, "
                                     "arrival long")
    folder = RUN.stage_batches(df, work_dir(spark, "disp"), 1)
    q = RUN.display_sink(L.live_totals(RUN.file_stream(spark, folder, df.schema)), "display",
                         work_dir(spark, "disp-ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


@SETTINGS
@given(resets=st.lists(st.integers(0, 20_000), min_size=0, max_size=25, unique=True),
       receipts=st.lists(st.integers(0, 20_000), min_size=1, max_size=60),
       bucket=st.sampled_from([60, 600, 3600]))
def test_assign_epochs_equals_asof(spark, resets, receipts, bucket):
    r = spark.createDataFrame([(i, t) for i, t in enumerate(receipts)], "arrival long, ts long") \
        .withColumn("kafka_timestamp", F.timestamp_seconds("ts"))
    z = spark.createDataFrame([(t, f"inc{t}") for t in resets], "t long, incident string") \
        .withColumn("epoch_start", F.timestamp_seconds("t"))
    got = {x.arrival: (x.epoch_no, x.epoch_incident)
           for x in K.assign_epochs(r, z, bucket_seconds=bucket).collect()}
    rs = sorted(resets)
    for i, t in enumerate(receipts):
        before = [s for s in rs if s <= t]
        want = (len(before), f"inc{before[-1]}" if before else None)
        assert got[i] == want


def test_hot_order_id_holding_a_third_of_rows(spark):
    """One order id (and a null id) hold a third of all receipts: results
    equal brute force, and no window runs over the order group."""
    import random
    rnd = random.Random(5)
    rows = []
    for a in range(3000):
        r = rnd.random()
        oid = "HOT" if r < 0.34 else (None if r < 0.40 else f"o{rnd.randint(0, 700)}")
        mode = rnd.choice(["at_least_once", "exactly_once"])
        rows.append((oid, mode, rnd.randint(1, 900), a, a // 1000, "kitchen_delay",
                     rnd.random() < 0.3, rnd.random() < 0.1, rnd.randint(10, 40)))
    schema = ("order_id string, kafka_mode string, sent_sequence int, arrival long, epoch long, "
              "incident_mode string, is_delayed boolean, is_cancelled boolean, "
              "prep_time_minutes int")
    df = spark.createDataFrame(rows, schema)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    pdf["oid"] = pdf["order_id"].fillna("<null>")
    got = {r.kafka_mode: (r.total_orders_received, r.unique_orders, r.sent_orders)
           for r in R.delivery_summary(df).collect()}
    want = {m: (len(g), g["oid"].nunique(), int(g["sent_sequence"].max()))
            for m, g in pdf.groupby("kafka_mode")}
    assert got == want
    run = R.running_reliability(df, bucket_width=256)
    flags = {r.arrival: (r.first_seen, r.unique_orders) for r in run.collect()}
    seen, uniq = {}, {}
    for row in pdf.sort_values("arrival").itertuples():
        key = (row.kafka_mode, row.oid)
        first = key not in seen
        seen[key] = True
        uniq[row.kafka_mode] = uniq.get(row.kafka_mode, 0) + first
        assert flags[row.arrival] == (first, uniq[row.kafka_mode])
    import re
    plan = run._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert specs and all("order_id" not in part for part, _ in specs)
    dedup = {r.epoch: r.total_orders for r in K.operations_kpis(df, dedup=True).collect()}
    firsts = pdf.sort_values("arrival").drop_duplicates(["kafka_mode", "oid"])
    assert dedup == firsts.groupby("epoch").size().to_dict()


WORDS = ["kitchen", "delay", "courier", "rain", "stock", "staff", "rush", "the", "a1", "b2"]


@SETTINGS
@given(docs=st.lists(st.lists(st.sampled_from(WORDS), min_size=0, max_size=12), min_size=1,
                     max_size=7),
       queries=st.lists(st.lists(st.sampled_from(WORDS + ["zzz"]), min_size=0, max_size=4),
                        min_size=1, max_size=4),
       k=st.integers(1, 4))
def test_top_documents_equal_brute_force(spark, docs, queries, k):
    import math
    import re as _re
    texts = {i: " ".join(d).upper() for i, d in enumerate(docs)}
    tok = {i: _re.findall(r"[a-z0-9]+", t.lower()) for i, t in texts.items()}
    n = len(texts)
    vocab = {t for ts in tok.values() for t in ts}
    idf = {t: math.log((1 + n) / (1 + sum(1 for ts in tok.values() if t in ts))) + 1
           for t in vocab}

    def vec(ts):
        v = {}
        for t in ts:
            if t in vocab:
                v[t] = v.get(t, 0) + 1
        v = {t: c * idf[t] for t, c in v.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm > 0 else {}

    dvec = {i: vec(ts) for i, ts in tok.items()}
    want = {}
    for q, words in enumerate(queries):
        qv = vec(words)
        scores = [(round(sum(w * dvec[i].get(t, 0.0) for t, w in qv.items()), 6), i) for i in dvec]
        ranked = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
        want[q] = [(i, s) for s, i in ranked]
    ddf = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    qdf = spark.createDataFrame([(q, " ".join(w)) for q, w in enumerate(queries)],
                                "qid long, text string")
    got = {}
    for r in S.top_documents(S.build_index(ddf), qdf, k=k).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((r.doc_id, r.score))
    assert got == want


@SETTINGS
@given(hist=st.lists(st.tuples(st.sampled_from(["Kitchen Bottleneck", "Courier Shortage",
                                                "Staff Shortage", "Rain 50%", "kitchen"]),
                               st.integers(0, 50)), min_size=1, max_size=12),
       queries=st.lists(st.sampled_from(["Courier Shortage", "General Operational Anomaly",
                                         "KITCHEN", "50%", "a b", "Staff", "%%%%", "______",
                                         "_______________", "%", "ch", "hor%ge"]),
                        min_size=1, max_size=4, unique=True))
def test_find_similar_equals_brute_force(spark, hist, queries):
    rows = [(f"id{i:02d}", inc, "s", 1, 0.5, f"2026-01-01T00:00:{ts:02d}")
            for i, (inc, ts) in enumerate(hist)]
    h = spark.createDataFrame(rows, "id string, incident string, solution string, "
                                    "improvement int, confidence double, timestamp string")
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    got = {}
    for r in H.find_similar(h, q, k=2).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append(r.id)

    def like(text, word):  # SQL LIKE '%word%', case-insensitive, % and _ wildcards
        import re as _re
        pat = "".join(".*" if c == "%" else "." if c == "_" else _re.escape(c) for c in word)
        return _re.search(pat, text, _re.IGNORECASE | _re.DOTALL) is not None

    newest = sorted(rows, key=lambda r: (r[5], r[0]), reverse=True)
    want = {}
    for x in queries:
        words = [w for w in x.split() if len(w) > 3] or [x]
        hits = [r for r in newest if any(like(r[1], w) for w in words)][:2]
        want[x] = [r[0] for r in (hits or newest[:2])]
    assert got == want


# Messages and what the web-side decode makes of them, by hand:
# (mode, sequence, prep, delayed, cancelled, incident) or the reject reason.
WEB_CASES = [
    (None, "null_value"),
    ('{"order_id": "x", broken', "bad_json"),
    ("{}", "bad_json"),
    ('{"order_id": "o1"}', "unknown_mode"),
    ('{"order_id": "o1", "kafka_mode": "at_most_once"}',
     ("at_most_once", 0, 15, False, False, "normal")),
    ('{"kafka_mode": "AT_LEAST_ONCE", "sent_sequence": 7}',
     ("at_least_once", 7, 15, False, False, "normal")),
    ('{"kafka_mode": "Exactly_Once", "sent_sequence": "7", "prep_time_minutes": "12"}',
     ("exactly_once", 7, 12, False, False, "normal")),
    ('{"kafka_mode": "at_most_once", "sent_sequence": "x"}', "bad_sequence"),
    ('{"kafka_mode": "pigeon", "sent_sequence": "x"}', "bad_sequence"),
    ('{"kafka_mode": "pigeon", "prep_time_minutes": "slow"}', "unknown_mode"),
    ('{"kafka_mode": "at_most_once", "prep_time_minutes": "slow"}', "bad_prep"),
    ('{"kafka_mode": "at_most_once", "is_delayed": true, "is_cancelled": true, '
     '"incident_mode": "kitchen_delay", "prep_time_minutes": 31}',
     ("at_most_once", 0, 31, True, True, "kitchen_delay")),
]


def test_web_decoder_cases(spark):
    from relaywatch.operators import decode as D
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(WEB_CASES)], "i long, value string")
    for r in D.web_records(df, keep=["i"]).collect():
        got = r.reject_reason or (r.kafka_mode, r.sent_sequence, r.prep_time_minutes, r.is_delayed,
                                  r.is_cancelled, r.incident_mode)
        assert got == WEB_CASES[r.i][1], WEB_CASES[r.i][0]


@SETTINGS
@given(drop=st.sets(st.sampled_from(["sent_sequence", "prep_time_minutes", "is_delayed",
                                     "is_cancelled", "incident_mode"])))
def test_missing_fields_take_their_defaults(spark, drop):
    """A missing field decodes as a message that spells its default out."""
    import json
    from relaywatch.operators import decode as D
    full = {"order_id": "o", "kafka_mode": "exactly_once", "sent_sequence": 0,
            "prep_time_minutes": 15, "is_delayed": False, "is_cancelled": False,
            "incident_mode": "normal"}
    part = {k: v for k, v in full.items() if k not in drop}
    df = spark.createDataFrame([(json.dumps(full),), (json.dumps(part),)], "value string")
    assert D.web_records(df).distinct().count() == 1


# (delay %, prep min, cancel %, hint) and the label of the coded ladder, by hand.
LADDER_CASES = [
    (0.0, 0.0, 0.0, "normal", "General Operational Anomaly"),
    (0.0, 22.0, 0.0, "normal", "General Operational Anomaly"),
    (0.0, 22.1, 0.0, "normal", "Kitchen Bottleneck"),
    (0.0, 0.0, 0.0, "kitchen_delay", "Kitchen Bottleneck"),
    (90.0, 0.0, 90.0, "kitchen_delay", "Kitchen Bottleneck"),
    (20.0, 20.0, 0.0, "normal", "General Operational Anomaly"),
    (20.1, 20.0, 0.0, "normal", "Courier Shortage"),
    (20.1, 20.1, 0.0, "normal", "General Operational Anomaly"),
    (0.0, 21.0, 0.0, "courier_delay", "Courier Shortage"),
    (0.0, 23.0, 0.0, "courier_delay", "Kitchen Bottleneck"),
    (0.0, 0.0, 0.0, "weather_surge", "Weather Surge"),
    (21.0, 10.0, 0.0, "weather_surge", "Courier Shortage"),
    (0.0, 0.0, 50.0, "staff_shortage", "Staff Shortage"),
    (0.0, 0.0, 50.0, "festival_rush", "Festival Rush"),
    (0.0, 0.0, 15.0, "normal", "General Operational Anomaly"),
    (0.0, 0.0, 15.1, "normal", "Inventory Shortage"),
    (0.0, 0.0, 0.0, "inventory_shortage", "Inventory Shortage"),
    (0.0, 0.0, 0.0, "unknown_thing", "General Operational Anomaly"),
]


def test_classifier_ladder_cases(spark):
    from relaywatch.functions import reports as X
    df = spark.createDataFrame(
        [(i, d, p, c, 50.0, h) for i, (d, p, c, h, _) in enumerate(LADDER_CASES)],
        "i long, delay_rate double, avg_prep_time double, cancellation_rate double, "
        "reliability_score double, incident_mode string")
    prompted = df.withColumn("prompt", X.kpi_prompt("delay_rate", "avg_prep_time",
                                                    "cancellation_rate", "reliability_score",
                                                    "incident_mode"))
    got = {r.i: r.cls.issue for r in X.classify(prompted, "prompt").collect()}
    assert got == {i: case[-1] for i, case in enumerate(LADDER_CASES)}


def test_one_decimal_boundary(spark):
    """Exact binary ties go to even, other values whose decimal form ends in
    5 round up (README)."""
    from relaywatch.functions.text import fmt1
    cases = {0.15: "0.2", 0.25: "0.2", 0.75: "0.8", 2.5: "2.5", 99.95: "100.0", 0.04: "0.0",
             33.333: "33.3"}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    assert {r.v: r.t for r in df.select("v", fmt1(F.col("v")).alias("t")).collect()} == cases


# Report texts with issue, confidence and evidence, by hand.
REPORT_CASES = [
    ("", ("General Operational Anomaly", "75%", ["Metrics deviate from normal thresholds."])),
    ("**Issue**: Kitchen Bottleneck\n**Confidence**: 91%",
     ("Kitchen Bottleneck", "91%", ["Metrics deviate from normal thresholds."])),
    ("Issue: Staff Shortage\r\nconfidence: 7%\n- Prep time is 31.5 min.\n* Couriers are late\r",
     ("Staff Shortage", "7%", ["Prep time is 31.5 min.", "Couriers are late"])),
    ("Confidence: high\n- the issue is here\n-\n*  \n\t- tab indented item",
     ("is here", "75%", ["tab indented item"])),
]
# Plan texts with procedure, improvement and actions.
PLAN_CASES = [
    ("", ("SOP-General", "25%", ["Activate general incident response protocols."])),
    ("**Retrieved SOP**: SOP-OPS-001 (Kitchen Delay SOP)\n"
     "Expected Recovery Improvement: **28%**\n1. Add one cook.\n2.   **Pause** items\r",
     ("SOP-OPS-001 (Kitchen Delay SOP)", "28%", ["Add one cook.", "Pause items"])),
    ("10.x\n3.\n  4. spaced action  \nplain text line",
     ("SOP-General", "25%", ["x", "spaced action"])),
]


def test_report_and_plan_parser_cases(spark):
    from relaywatch.functions import reports as X
    df = spark.createDataFrame([(t,) for t, _ in REPORT_CASES + PLAN_CASES], "t string")
    rows = df.select(X.parse_report("t").alias("r"), X.parse_plan("t").alias("p")).collect()
    for row, (_, want) in zip(rows, REPORT_CASES):
        assert (row.r.issue, row.r.confidence, list(row.r.evidence)) == want
    for row, (_, want) in zip(rows[len(REPORT_CASES):], PLAN_CASES):
        assert (row.p.sop, row.p.improvement, list(row.p.actions)) == want


RECEIPTS = ("epoch long, arrival long, order_id string, kafka_mode string, sent_sequence int, "
            "prep_time_minutes int, is_delayed boolean, is_cancelled boolean, incident_mode string")


def test_running_numbers_by_hand(spark):
    """Six receipts of two epochs; the KPIs after each, worked out by hand."""
    m = "at_least_once"
    rows = [(0, 0, "a", m, 1, 10, True, False, "k"), (0, 1, "a", m, 1, 10, False, True, "k"),
            (0, 2, None, m, 4, 20, False, False, "k"), (1, 3, "b", m, 5, 30, None, None, "k"),
            (1, 4, "b", m, 5, None, True, False, "k"), (1, 5, None, m, 9, 40, False, False, "k")]
    want_ops = {0: (1, 100.0, 0.0, 10.0, 60.0), 1: (2, 50.0, 50.0, 10.0, 0.0),
                2: (3, 33.333333, 33.333333, 15.0, 20.0), 3: (1, 0.0, 0.0, 30.0, 100.0),
                4: (2, 50.0, 0.0, 22.5, 80.0), 5: (3, 33.333333, 0.0, 28.333333, 86.666667)}
    # total, unique (a null id counts once), duplicates, estimated loss
    want_mode = {0: (1, 1, 0, 0), 1: (2, 1, 1, 0), 2: (3, 2, 1, 1), 3: (4, 3, 1, 1),
                 4: (5, 3, 2, 0), 5: (6, 3, 3, 3)}
    df = spark.createDataFrame(rows, RECEIPTS)
    for width in (1, 2, 100):
        got = {r.arrival: (r.total_orders, round(r.delay_rate, 6), round(r.cancellation_rate, 6),
                           round(r.avg_prep_time, 6), round(r.reliability_score, 6))
               for r in K.running_kpis(df, bucket_width=width).collect()}
        assert got == want_ops
        got = {r.arrival: (r.total_orders, r.unique_orders, r.duplicate_orders, r.estimated_loss)
               for r in R.running_reliability(df, bucket_width=width).collect()}
        assert got == want_mode


@SETTINGS
@given(flags=st.lists(st.tuples(st.booleans(), st.booleans(), st.integers(5, 40)), min_size=1,
                      max_size=30), width=st.integers(1, 8))
def test_running_numbers_do_not_depend_on_buckets(spark, flags, width):
    """Any bucket width gives what one window over the whole epoch gives, and the
    last row equals the batch aggregate."""
    df = spark.createDataFrame([(0, i, str(i), "exactly_once", i, p, d, c, "k")
                                for i, (d, c, p) in enumerate(flags)], RECEIPTS)
    cols = ["arrival", "total_orders", "delay_rate", "cancellation_rate", "avg_prep_time"]
    one = K.running_kpis(df, bucket_width=1 << 40).select(*cols).collect()
    many = K.running_kpis(df, bucket_width=width).select(*cols).collect()
    assert sorted(one) == sorted(many)
    last, batch = max(many), K.operations_kpis(df).collect()[0]
    assert (last.total_orders, last.delay_rate, last.avg_prep_time) == (
        batch.total_orders, batch.delay_rate, batch.avg_prep_time)
