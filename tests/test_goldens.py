"""Golden cases from SURVEY §5 and FIXTURES §4."""


from relaywatch.functions import reports as X
from relaywatch.functions.metrics import reliability_score
from relaywatch.operators import diagnose as G
from relaywatch.operators import history as H
from relaywatch.operators import search as S
from relaywatch.sources.procedures import procedure_documents

# incident, delay %, mean prep, cancel %, expected score, coded label
TABLE = [
    ("kitchen_delay", 45.0, 31.5, 5.0, 72.0, "Kitchen Bottleneck"),
    ("courier_delay", 55.0, 15.0, 15.0, 48.0, "Courier Shortage"),
    ("weather_surge", 65.0, 18.5, 25.0, 24.0, "Courier Shortage"),
    ("staff_shortage", 35.0, 28.0, 10.0, 66.0, "Kitchen Bottleneck"),
    ("festival_rush", 40.0, 33.0, 8.0, 68.0, "Kitchen Bottleneck"),
    ("inventory_shortage", 15.0, 17.5, 30.0, 34.0, "Inventory Shortage"),
]


def test_classification_table(spark):
    df = spark.createDataFrame([t[:4] for t in TABLE], "incident_mode string, delay_rate double, "
                               "avg_prep_time double, cancellation_rate double")
    df = df.withColumn("reliability_score", reliability_score("delay_rate", "cancellation_rate"))
    got = {r.incident_mode: (r.reliability_score, r.issue)
           for r in G.classify_events(df).collect()}
    for inc, _, _, _, score, label in TABLE:
        assert got[inc] == (score, label), inc
    hint_first = G.classify_events(df, policy="hint_first").collect()
    assert {r.incident_mode: r.issue for r in hint_first}["weather_surge"] == "Weather Surge"
    assert {r.incident_mode: r.issue for r in hint_first}["staff_shortage"] == "Staff Shortage"


def test_report_round_trip_keeps_status_line(spark):
    df = spark.createDataFrame([("normal", 5.0, 15.0, 2.0, 94.0)],
                               "incident_mode string, delay_rate double, avg_prep_time double, "
                               "cancellation_rate double, reliability_score double")
    r = G.classify_events(df).collect()[0]
    assert r.issue == "General Operational Anomaly" and r.confidence == "75%"
    assert r.evidence[-1] == "Status: Active Anomaly Detected"  # F11
    assert r.evidence[0] == "Elevated delay rate (5.0%) and cancellation rate (2.0%) detected."


def test_plan_round_trip_and_defaults(spark):
    df = spark.createDataFrame([("Weather Surge",), ("Something Else",)], "issue string")
    p = {r.issue: r for r in G.plan_events(spark, df).collect()}
    assert p["Weather Surge"].sop == "SOP-OPS-006 (Weather Surge SOP)"
    assert p["Weather Surge"].improvement == "30%" and len(p["Weather Surge"].actions) == 3
    assert p["Something Else"].sop == "SOP-OPS-General"  # general playbook row
    empty = spark.createDataFrame([("no plan here",)], "t string").select(
        X.parse_plan("t").alias("p")).collect()[0].p
    assert (empty.sop, empty.improvement, empty.actions) == (
        "SOP-General", "25%", ["Activate general incident response protocols."])


def test_history_goldens(spark):
    q = spark.createDataFrame([("Courier Shortage",), ("General Operational Anomaly",)],
                              "query string")
    rows = H.find_similar(H.seed_rows(spark), q).orderBy("query", "rank").collect()
    got = {(r.query, r.rank): (r.incident, r.matched) for r in rows}
    assert got[("Courier Shortage", 1)] == ("Inventory Shortage", True)  # F10
    assert got[("Courier Shortage", 2)] == ("Staff Shortage", True)
    assert got[("General Operational Anomaly", 1)] == ("Inventory Shortage", False)
    assert got[("General Operational Anomaly", 2)] == ("Staff Shortage", False)


def test_each_issue_retrieves_its_procedure(spark):
    idx = S.build_index(procedure_documents(spark), id_col="doc_name", text_col="content")
    labels = {"Kitchen Bottleneck": "kitchen_delay", "Courier Shortage": "courier_delay",
              "Weather Surge": "weather_surge", "Staff Shortage": "staff_shortage",
              "Festival Rush": "festival_rush", "Inventory Shortage": "inventory_shortage"}
    q = spark.createDataFrame([(k, k) for k in labels], "qid string, text string")
    top = {r.qid: r.doc_id for r in S.top_documents(idx, q, k=1).collect()}
    assert top == labels
    score = S.top_documents(idx, spark.createDataFrame(
        [("g", "General Operational Anomaly")], "qid string, text string"), k=1).first()
    assert score.score == 0.0 and score.doc_id == "courier_delay"  # first name, score 0
