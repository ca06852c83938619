"""Registered diagnosis queries: classification, report and plan text,
playbook, per-breach diagnosis and the incident history built from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.functions import reports as X
from relaywatch.operators import diagnose as G
from relaywatch.operators import history as H
from relaywatch.operators import kpis as K
from relaywatch.plans.q_kpis import _KPI_SQL, _LATEST_SQL, _RUN_SQL
from relaywatch.plans.registry import register, rounded
from relaywatch.plans.sqlviews import RECEIPTS, tfidf_ctes
from relaywatch.schema import HISTORY_SEEDS
from relaywatch.sources.orders import receipts
from relaywatch.sources.procedures import PROCEDURES, procedure_documents

W = "WITH " + RECEIPTS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _fill_sql(template: str) -> str:
    out, i, lit = [], 0, ""
    keys = {"{delay}": "delay_t", "{prep}": "prep_t", "{cancel}": "cancel_t"}
    while i < len(template):
        for k, col in keys.items():
            if template.startswith(k, i):
                out += [_q(lit), col]
                lit, i = "", i + len(k)
                break
        else:
            lit += template[i]
            i += 1
    out.append(_q(lit))
    return " || ".join(p for p in out if p != "''") or "''"


def _f1(col: str) -> str:
    return f"printf('%.1f', round_even({col}, 1))"


def classify_sql(src: str, hint: str, policy: str = "coded", p: str = "") -> str:
    """CTEs ``{p}c_m`` and ``{p}cls`` (adds issue, confidence, evidence list)."""
    h = f"lower(coalesce({hint}, 'normal'))"
    numeric = {"kitchen_delay": "pv > 22.0", "courier_delay": "(dv > 20.0 AND pv <= 20.0)",
               "inventory_shortage": "cv > 15.0"}
    if policy == "coded":
        steps = [(f"contains({h}, '{s[2]}')" + (f" OR {numeric[s[2]]}" if s[2] in numeric else ""),
                  s[0]) for s in X.LADDER]
    else:
        steps = ([(f"contains({h}, '{s[2]}')", s[0]) for s in X.LADDER]
                 + [(numeric[s[2]], s[0]) for s in X.LADDER if s[2] in numeric])
    issue = "CASE " + " ".join(f"WHEN {c} THEN {_q(l)}" for c, l in steps) + \
        f" ELSE {_q(X.GENERAL[0])} END"
    steps_all = [*X.LADDER, X.GENERAL]
    conf = "CASE issue " + " ".join(f"WHEN {_q(s[0])} THEN {_q(s[1])}" for s in steps_all) + " END"
    ev = "CASE issue " + " ".join(
        f"WHEN {_q(s[0])} THEN [" + ", ".join(_fill_sql(e) for e in s[3]) + "]"
        for s in steps_all) + " END"
    return f""",
{p}c_m AS (
  SELECT *, {_f1('delay_rate')} || '%' AS delay_t, {_f1('avg_prep_time')} || ' min' AS prep_t,
         {_f1('cancellation_rate')} || '%' AS cancel_t,
         CAST({_f1('delay_rate')} AS DOUBLE) AS dv, CAST({_f1('avg_prep_time')} AS DOUBLE) AS pv,
         CAST({_f1('cancellation_rate')} AS DOUBLE) AS cv
  FROM {src}),
{p}c_i AS (SELECT *, {issue} AS issue FROM {p}c_m),
{p}cls AS (SELECT *, {conf} AS confidence, {ev} AS evidence FROM {p}c_i)"""


_PB_VALUES = ", ".join(
    f"({_q(i)}, {_q(s)}, {_q(imp)}, [" + ", ".join(_q(a) for a in acts) + "])"
    for i, s, imp, acts in X.PLAYBOOK)
_PB_DEFAULT_ACTS = "[" + ", ".join(_q(a) for a in X.PLAYBOOK_DEFAULT[2]) + "]"

PLAYBOOK_SQL = f""",
pb(pb_issue, pb_sop, pb_improvement, pb_actions) AS (VALUES {_PB_VALUES}),
planned AS (
  SELECT cls.*, coalesce(pb_sop, {_q(X.PLAYBOOK_DEFAULT[0])}) AS sop,
         coalesce(pb_improvement, {_q(X.PLAYBOOK_DEFAULT[1])}) AS improvement,
         coalesce(pb_actions, {_PB_DEFAULT_ACTS}) AS actions
  FROM cls LEFT JOIN pb ON pb.pb_issue = cls.issue)"""

_EV_OUT = "array_to_string(list_concat(evidence, ['Status: Active Anomaly Detected']), ' || ')"
_IMP_VAL = "coalesce(TRY_CAST(regexp_extract(improvement, '(\\d+)', 1) AS INT), 25)"
_CONF_VAL = ("coalesce(TRY_CAST(nullif(regexp_extract(confidence, '(\\d+)', 1), '') AS DOUBLE)"
             " / 100.0, 0.9)")

_KPI_EPOCH = W + _KPI_SQL.format(src="receipts") + """,
ek AS (SELECT epoch, active_incident AS incident_mode, delay_rate, avg_prep_time,
              cancellation_rate, reliability_score FROM kpis)"""


def _epoch_kpis(spark, sf):
    k = rounded(K.operations_kpis(receipts(spark, sf)))
    return k.select("epoch", F.col("active_incident").alias("incident_mode"), "delay_rate",
                    "avg_prep_time", "cancellation_rate", "reliability_score")


@register("x10_x11_kpi_prompt", _KPI_EPOCH + f"""
SELECT epoch, 'Please analyze these current operational metrics:' || chr(10)
  || 'Delay Rate = ' || {_f1('delay_rate')} || '%' || chr(10)
  || 'Prep Time = ' || {_f1('avg_prep_time')} || ' min' || chr(10)
  || 'Cancellation Rate = ' || {_f1('cancellation_rate')} || '%' || chr(10)
  || 'Reliability Score = ' || {_f1('reliability_score')} || '%' || chr(10)
  || 'Incident Mode Hint = ' || coalesce(incident_mode, 'normal') || chr(10) AS prompt
FROM ek""")
def x10_x11_kpi_prompt(spark, sf):
    k = _epoch_kpis(spark, sf)
    return k.select("epoch", X.kpi_prompt("delay_rate", "avg_prep_time", "cancellation_rate",
                                          "reliability_score", "incident_mode").alias("prompt"))


@register("x5_x6_metric_extract", _KPI_EPOCH + classify_sql("ek", "incident_mode") + """
SELECT epoch, delay_t AS delay_text, dv AS delay_value, prep_t AS prep_text, pv AS prep_value,
       cancel_t AS cancel_text, cv AS cancel_value
FROM c_m""")
def x5_x6_metric_extract(spark, sf):
    k = _epoch_kpis(spark, sf).withColumn("prompt", X.kpi_prompt(
        "delay_rate", "avg_prep_time", "cancellation_rate", "reliability_score", "incident_mode"))
    m = X.with_metric_texts(k, "prompt")
    return m.select("epoch", F.col("_delay_t").alias("delay_text"),
                    F.col("_delay_v").alias("delay_value"), F.col("_prep_t").alias("prep_text"),
                    F.col("_prep_v").alias("prep_value"), F.col("_cancel_t").alias("cancel_text"),
                    F.col("_cancel_v").alias("cancel_value"))


def _classified(spark, sf, policy):
    k = _epoch_kpis(spark, sf).withColumn("prompt", X.kpi_prompt(
        "delay_rate", "avg_prep_time", "cancellation_rate", "reliability_score", "incident_mode"))
    c = X.classify(k, "prompt", policy, "cls")
    return c.select("epoch", "incident_mode", F.col("cls.issue").alias("issue"),
                    F.col("cls.confidence").alias("confidence"),
                    F.array_join("cls.evidence", " || ").alias("evidence"))


_CLS_OUT = """
SELECT epoch, incident_mode, issue, confidence, array_to_string(evidence, ' || ') AS evidence
FROM cls"""


@register("x12_classify", _KPI_EPOCH + classify_sql("ek", "incident_mode") + _CLS_OUT)
def x12_classify(spark, sf):
    return _classified(spark, sf, "coded")


@register("x12_classify_hint_first",
          _KPI_EPOCH + classify_sql("ek", "incident_mode", "hint_first") + _CLS_OUT)
def x12_classify_hint_first(spark, sf):
    return _classified(spark, sf, "hint_first")


@register("x7_parse_report", _KPI_EPOCH + classify_sql("ek", "incident_mode") + f"""
SELECT epoch, issue, confidence, {_EV_OUT} AS evidence FROM cls""")
def x7_parse_report(spark, sf):
    c = G.classify_events(_epoch_kpis(spark, sf))
    return c.select("epoch", "issue", "confidence",
                    F.array_join("evidence", " || ").alias("evidence"))


@register("j6_playbook", _KPI_EPOCH + classify_sql("ek", "incident_mode") + PLAYBOOK_SQL + """
SELECT epoch, issue, sop, improvement, array_to_string(actions, ' | ') AS actions FROM planned""")
def j6_playbook(spark, sf):
    c = G.classify_events(_epoch_kpis(spark, sf))
    p = G.with_playbook(spark, c)
    return p.select("epoch", "issue", "sop", "improvement",
                    F.array_join("actions", " | ").alias("actions"))


@register("x8_x9_parse_plan", _KPI_EPOCH + classify_sql("ek", "incident_mode") + PLAYBOOK_SQL + f"""
SELECT epoch, sop, improvement, array_to_string(actions, ' | ') AS solution,
       {_IMP_VAL} AS improvement_value, {_CONF_VAL} AS confidence_value
FROM planned""")
def x8_x9_parse_plan(spark, sf):
    p = G.plan_events(spark, G.classify_events(_epoch_kpis(spark, sf)))
    return p.select("epoch", "sop", "improvement", F.array_join("actions", " | ").alias("solution"),
                    X.improvement_value("improvement").alias("improvement_value"),
                    X.confidence_value("confidence").alias("confidence_value"))


# --------------------------------------------------------------------------
# Per breach event, with procedure search and history lookup.
# --------------------------------------------------------------------------

_PROC_VALUES = ", ".join(f"({_q(n)}, {_q(t)})" for n, t in sorted(PROCEDURES.items()))
_SEED_VALUES = ", ".join(
    f"({_q(i)}, {_q(s)}, {imp}, CAST({c} AS DOUBLE), {_q(ts)})"
    for i, s, imp, c, ts in HISTORY_SEEDS)

_HIST_ID = ("sha256(concat_ws(chr(31), incident, solution, CAST(improvement AS VARCHAR), "
            "CAST(confidence AS VARCHAR), \"timestamp\"))")


def _similar_sql(hist: str, queries: str, k: int = 2, p: str = "") -> str:
    """CTEs ending in ``{p}sim_rows``: J3 keyword matches, top-k newest,
    with the J4 fallback (brute force; the oracle needs no efficiency)."""
    return f""",
{p}hq AS ({queries}),
{p}hw AS (SELECT query, list_filter(regexp_split_to_array(query, '[ \\t\\n\\r\\f\\v]+'),
                                     lambda w: length(w) >= 4) AS w0 FROM {p}hq),
{p}hwu AS (SELECT query, unnest(CASE WHEN len(w0) = 0 THEN [query] ELSE w0 END) AS w FROM {p}hw),
{p}hm AS (SELECT DISTINCT q.query, h.* FROM {p}hwu q JOIN {hist} h
          ON h.incident ILIKE '%' || q.w || '%'),
{p}htop AS (SELECT *, CAST(row_number() OVER (PARTITION BY query
                                        ORDER BY "timestamp" DESC, id DESC) AS INTEGER)
                   AS rank, true AS matched
            FROM {p}hm QUALIFY rank <= {k}),
{p}hfb AS (SELECT q.query, h.*, CAST(row_number() OVER (PARTITION BY q.query
                  ORDER BY h."timestamp" DESC, h.id DESC) AS INTEGER) AS rank, false AS matched
           FROM {p}hq q CROSS JOIN {hist} h WHERE q.query NOT IN (SELECT query FROM {p}htop)
           QUALIFY rank <= {k}),
{p}sim_rows AS (SELECT * FROM {p}htop UNION ALL SELECT * FROM {p}hfb)"""


def _diagnosis_sql(src: str) -> str:
    """Classification, playbook, procedure search and history lookup over the
    KPI rows in CTE ``src`` (columns as in ``diagnose``), ending in ``diag``."""
    return classify_sql(src, "incident_mode") + PLAYBOOK_SQL + ",\n" + tfidf_ctes(
        f"SELECT * FROM (VALUES {_PROC_VALUES}) AS t(doc_id, text)",
        "SELECT DISTINCT issue AS qid, issue AS text FROM cls", "p_") + f""",
seeds(incident, solution, improvement, confidence, "timestamp") AS (VALUES {_SEED_VALUES}),
seed_hist AS (SELECT {_HIST_ID} AS id, * FROM seeds)""" + _similar_sql(
        "seed_hist", "SELECT DISTINCT issue AS query FROM cls") + f""",
past AS (SELECT query AS issue, string_agg(incident || ' @ ' || "timestamp", ' | ' ORDER BY rank)
                AS past_incidents
         FROM sim_rows GROUP BY query),
diag AS (
  SELECT pl.*, {_EV_OUT} AS evidence_text,
         array_to_string(pl.actions, ' | ') AS solution, d.doc_id AS doc_name, d.score AS doc_score,
         pdoc.text AS sop_content,
         past.past_incidents, {_IMP_VAL} AS improvement_value, {_CONF_VAL} AS confidence_value
  FROM planned pl
  LEFT JOIN (SELECT * FROM p_ranked WHERE rank = 1) d ON d.qid = pl.issue
  LEFT JOIN p_docs pdoc ON pdoc.doc_id = d.doc_id
  LEFT JOIN past ON past.issue = pl.issue)"""


_J9_BASE = W + _RUN_SQL + """,
kept AS (SELECT r.*, rc."timestamp",
                lag(r.incident_mode) OVER (PARTITION BY r.epoch ORDER BY r.arrival) AS prev
         FROM run r JOIN receipts rc USING (arrival) WHERE r.breach),
ev AS (SELECT * FROM kept WHERE prev IS NULL OR prev <> incident_mode)""" + _diagnosis_sql("ev")

_J9_COLS = ["epoch", "arrival", "incident_mode", "issue", "confidence", "evidence", "sop",
            "improvement", "solution", "doc_name", "doc_score", "sop_content", "past_incidents",
            "improvement_value", "confidence_value"]


def _diagnoses(spark, sf):
    run = K.running_kpis(receipts(spark, sf))
    ev = rounded(K.breach_events(run))
    return G.diagnose(spark, ev, procedure_documents(spark), H.seed_rows(spark))


_J9_SELECT = "\nSELECT " + ", ".join(
    "evidence_text AS evidence" if c == "evidence" else c for c in _J9_COLS) + " FROM diag"


@register("j9_diagnose", _J9_BASE + _J9_SELECT)
def j9_diagnose(spark, sf):
    d = _diagnoses(spark, sf).withColumn("evidence", F.array_join("evidence", " || "))
    return d.select(*_J9_COLS)


_FULL_HIST = f""",
hist AS (
  SELECT {_HIST_ID} AS id, *
  FROM (SELECT * FROM seeds
        UNION ALL
        SELECT issue AS incident, solution, improvement_value AS improvement,
               confidence_value AS confidence, "timestamp" FROM diag))"""

_HIST_COLS = ["incident", "solution", "improvement", "confidence", "timestamp"]


def _history(spark, sf):
    return H.seed_rows(spark).unionByName(G.outcomes(_diagnoses(spark, sf)))


@register("s9_history_rows", _J9_BASE + _FULL_HIST + "\nSELECT id, "
          + ", ".join(f'"{c}"' for c in _HIST_COLS) + " FROM hist")
def s9_history_rows(spark, sf):
    return _history(spark, sf)


@register("j3_similar_incidents", _J9_BASE + _FULL_HIST
          + _similar_sql("hist", "SELECT DISTINCT issue AS query FROM diag", p="j3_") + """
SELECT query, rank, matched, incident, solution, improvement, confidence, "timestamp"
FROM j3_sim_rows""")
def j3_similar_incidents(spark, sf):
    hist = _history(spark, sf)
    q = _diagnoses(spark, sf).select(F.col("issue").alias("query")).distinct()
    return H.find_similar(hist, q, k=2).select("query", "rank", "matched", *_HIST_COLS)


@register("l3_newest_history", _J9_BASE + _FULL_HIST + """
SELECT incident, solution, improvement, confidence, "timestamp"
FROM hist ORDER BY "timestamp" DESC, id DESC LIMIT 2""")
def l3_newest_history(spark, sf):
    return H.newest(_history(spark, sf), 2).select(*_HIST_COLS)


@register("s8_seed_if_empty", _J9_BASE + _FULL_HIST + """,
nonempty AS (SELECT count(*) AS n FROM hist)
SELECT incident, "timestamp" FROM seed_hist, nonempty WHERE n = 0""")
def s8_seed_if_empty(spark, sf):
    """Seeds are skipped because the history built from the data is not empty."""
    return H.seeded(spark, _history(spark, sf)).select("incident", "timestamp")



@register("j3_j4_epoch_issue_lookup", _J9_BASE + _FULL_HIST + _KPI_SQL.format(src="receipts") + """,
ek AS (SELECT epoch, active_incident AS incident_mode, delay_rate, avg_prep_time,
              cancellation_rate, reliability_score FROM kpis)"""
          + classify_sql("ek", "incident_mode", p="e_")
          + _similar_sql("hist", "SELECT DISTINCT issue AS query FROM e_cls", p="e_") + """
SELECT query, rank, matched, incident, solution, improvement, confidence, "timestamp"
FROM e_sim_rows""")
def j3_j4_epoch_issue_lookup(spark, sf):
    """J3 + J4 with the per-epoch issues as queries; normal epochs classify
    as 'General Operational Anomaly', which matches nothing and falls back
    to the newest rows."""
    hist = _history(spark, sf)
    q = _classified(spark, sf, "coded").select(F.col("issue").alias("query")).distinct()
    return H.find_similar(hist, q, k=2).select("query", "rank", "matched", *_HIST_COLS)


_MANUAL_COLS = ["incident_mode", "issue", "confidence", "evidence", "sop", "improvement",
                "solution", "doc_name", "doc_score", "sop_content", "past_incidents",
                "improvement_value", "confidence_value"]


@register("j9_manual_diagnose", W + _KPI_SQL.format(src="receipts") + _LATEST_SQL + """,
manual AS (SELECT delay_rate, avg_prep_time, cancellation_rate, reliability_score,
                  active_incident AS incident_mode
           FROM s11 WHERE active_incident <> 'normal')""" + _diagnosis_sql("manual")
          + "\nSELECT " + ", ".join("evidence_text AS evidence" if c == "evidence" else c
                                    for c in _MANUAL_COLS) + " FROM diag")
def j9_manual_diagnose(spark, sf):
    """J9 on demand over the latest epoch's KPIs (none while normal)."""
    latest = K.latest_kpis(rounded(K.operations_kpis(receipts(spark, sf))))
    d = G.diagnose_latest(spark, latest, procedure_documents(spark), H.seed_rows(spark))
    return d.withColumn("evidence", F.array_join("evidence", " || ")).select(*_MANUAL_COLS)


# --------------------------------------------------------------------------
# X11: the three texts, the twins with literals of their own.
# --------------------------------------------------------------------------

_NL = "chr(10)"


@register("x11_report_text", _KPI_EPOCH + classify_sql("ek", "incident_mode") + f"""
SELECT epoch, '### INCIDENT ANALYSIS REPORT' || {_NL} || {_NL} || '**Issue**: ' || issue || {_NL}
  || '**Confidence**: ' || confidence || {_NL} || {_NL} || '**Evidence**:' || {_NL}
  || array_to_string(list_transform(evidence, lambda e: '- ' || e), {_NL}) || {_NL} || {_NL}
  || '**Status**: Active Anomaly Detected' || {_NL} AS report
FROM cls""")
def x11_report_text(spark, sf):
    c = _classified_raw(spark, sf)
    return c.select("epoch", X.report_text("cls.issue", "cls.confidence", "cls.evidence")
                    .alias("report"))


def _classified_raw(spark, sf):
    k = _epoch_kpis(spark, sf).withColumn("prompt", X.kpi_prompt(
        "delay_rate", "avg_prep_time", "cancellation_rate", "reliability_score", "incident_mode"))
    return X.classify(k, "prompt")


@register("x11_plan_text", _KPI_EPOCH + classify_sql("ek", "incident_mode") + PLAYBOOK_SQL + f"""
SELECT epoch, '### STRATEGIC ACTION PLAN' || {_NL} || {_NL} || '**Retrieved SOP**: ' || sop || {_NL}
  || '**Expected Recovery Improvement**: ' || improvement || {_NL} || {_NL}
  || '**Recommended Corrective Actions**:' || {_NL}
  || array_to_string(list_transform(actions, lambda a, i: i || '. ' || a), {_NL}) || {_NL} || {_NL}
  || '**Strategic Rationale**:' || {_NL}
  || 'The corrective actions align with standard operating procedures and target the specific '
  || 'constraints identified. Execution of these steps will relieve bottleneck congestion and '
  || 'restore service metrics to baseline levels.' || {_NL} AS plan
FROM planned""")
def x11_plan_text(spark, sf):
    p = G.with_playbook(spark, G.classify_events(_epoch_kpis(spark, sf)))
    return p.select("epoch", X.plan_text("sop", "improvement", "actions").alias("plan"))


@register("x11_context_text", _KPI_EPOCH + _diagnosis_sql("ek") + f""",
memory AS (SELECT query AS issue, string_agg('Past Incident ' || rank || ':' || {_NL}
    || '  Incident: ' || incident || {_NL} || '  Solution Applied: ' || solution || {_NL}
    || '  Improvement: ' || improvement || '%' || {_NL} || '  Confidence: ' || confidence
    || {_NL} || {_NL}, '' ORDER BY rank) AS records FROM sim_rows GROUP BY query)
SELECT epoch, '=== INCIDENT REPORT ===' || {_NL} || 'Issue: ' || issue || {_NL} || 'Confidence: '
  || confidence || {_NL} || 'Evidence:' || {_NL} || array_to_string(list_transform(list_concat(
     evidence, ['Status: Active Anomaly Detected']), lambda e: '- ' || e), {_NL}) || {_NL} || {_NL}
  || '=== RETRIEVED SOP ===' || {_NL} || sop_content || {_NL} || {_NL}
  || '=== PAST MEMORY RECORDS ===' || {_NL} || records || {_NL} AS context
FROM diag JOIN memory USING (issue)""")
def x11_context_text(spark, sf):
    documents = G.issue_documents(spark, procedure_documents(spark))
    c = G.planner_context(spark, _epoch_kpis(spark, sf), documents, H.seed_rows(spark))
    return c.select("epoch", "context")


@register("s8_seed_empty_history", f"""
WITH seeds(incident, solution, improvement, confidence, "timestamp") AS (VALUES {_SEED_VALUES})
SELECT incident, solution, improvement, confidence, "timestamp" FROM seeds
WHERE (SELECT count(*) FROM orders WHERE o_orderkey < 0) = 0""")
def s8_seed_empty_history(spark, sf):
    """A history without rows (no receipt has a negative key) gets the seeds."""
    empty = _history(spark, sf).join(
        receipts(spark, sf).filter("arrival < 0").select(F.col("order_id").alias("id")), "id",
        "left_semi")
    return H.seeded(spark, empty).select(*_HIST_COLS)
