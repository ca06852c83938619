"""Diagnosis per breach event (J6, J9, X7-X12), feeding the history.

For each event: classify the KPIs (X12), write and re-read the report
(X11, X7), look up the playbook (J6), write and re-read the plan (X8),
retrieve the best procedure document (TF-IDF, L2) and the most similar past
incidents (J3/J4), and produce the outcome row to append to history.

The parsed issue is always one of the classifier's labels, so the document
and history lookups run once over that fixed label set (7 rows, a proven
bound) and are broadcast-joined to the events; they never re-read the
events themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.functions import reports as X
from relaywatch.functions.text import join_actions
from relaywatch.operators import history as H
from relaywatch.operators import search as S


def playbook(spark: SparkSession) -> DataFrame:
    """J6 dimension: issue -> (sop, improvement, actions)."""
    return spark.createDataFrame(
        [(i, s, imp, acts) for i, s, imp, acts in X.PLAYBOOK],
        "issue string, sop string, improvement string, actions array<string>")


def with_playbook(spark: SparkSession, df: DataFrame, issue_col: str = "issue") -> DataFrame:
    """Broadcast left join on the issue; unmatched issues take the
    general row."""
    pb = F.broadcast(playbook(spark).withColumnRenamed("issue", "_pb_issue"))
    d_sop, d_imp, d_acts = X.PLAYBOOK_DEFAULT
    j = df.join(pb, F.col(issue_col) == F.col("_pb_issue"), "left")
    return j.select(
        *df.columns,
        F.coalesce("sop", F.lit(d_sop)).alias("sop"),
        F.coalesce("improvement", F.lit(d_imp)).alias("improvement"),
        F.coalesce("actions", F.array(*[F.lit(a) for a in d_acts])).alias("actions"))


def classify_events(events: DataFrame, policy: str = "coded") -> DataFrame:
    """X10-X12 + X11 + X7: classify KPI rows and read the report back.

    Each stage is its own projection so the prompt and report texts are
    computed once per row and then referenced.
    """
    cols = events.columns
    prompted = events.withColumn("prompt", X.kpi_prompt(
        "delay_rate", "avg_prep_time", "cancellation_rate", "reliability_score", "incident_mode"))
    cls = X.classify(prompted, "prompt", policy, "cls")
    rep = cls.withColumn("report", X.report_text("cls.issue", "cls.confidence", "cls.evidence"))
    parsed = rep.withColumn("parsed", X.parse_report("report"))
    return parsed.select(*cols, F.col("parsed.issue").alias("issue"),
                         F.col("parsed.confidence").alias("confidence"),
                         F.col("parsed.evidence").alias("evidence"))


def plan_events(spark: SparkSession, reported: DataFrame) -> DataFrame:
    """J6 + X11 + X8: playbook plan, written out and parsed back."""
    pb = with_playbook(spark, reported)
    written = pb.withColumn("plan", X.plan_text("sop", "improvement", "actions"))
    parsed = written.withColumn("parsed", X.parse_plan("plan"))
    return parsed.select(*reported.columns, F.col("parsed.sop").alias("sop"),
                         F.col("parsed.improvement").alias("improvement"),
                         F.col("parsed.actions").alias("actions"))


def issue_labels(spark: SparkSession) -> DataFrame:
    """Every label the classifier can emit."""
    return spark.createDataFrame([(s[0],) for s in [*X.LADDER, X.GENERAL]], "issue string")


def issue_documents(spark: SparkSession, procedures: DataFrame, k_docs: int = 1) -> DataFrame:
    """Per label: the best procedure document (TF-IDF). Builds an index, so a
    stream does this once, not in each batch (``fixed`` keeps the result)."""
    issues = issue_labels(spark).select(F.col("issue").alias("qid"), F.col("issue").alias("text"))
    index = S.build_index(procedures, id_col="doc_name", text_col="content")
    top = S.attach_content(S.top_documents(index, issues, k=k_docs), procedures,
                           id_col="doc_name", text_col="content")
    return (top.groupBy("qid")
            .agg(F.min_by(F.struct("doc_id", "score", "content"), "rank").alias("d"))
            .select(F.col("qid").alias("issue"), F.col("d.doc_id").alias("doc_name"),
                    F.col("d.score").alias("doc_score"), F.col("d.content").alias("sop_content")))


def fixed(spark: SparkSession, lookup: DataFrame) -> DataFrame:
    """A lookup with a row per label, held as a local table."""
    return spark.createDataFrame(lookup.limit(len(X.LADDER) + 1).collect(), lookup.schema)


def issue_lookups(spark: SparkSession, documents: DataFrame, history: DataFrame,
                  k_history: int = 2) -> DataFrame:
    """Per label: its document (``issue_documents``) and past incidents."""
    labels = issue_labels(spark)
    past = (H.find_similar(history, labels.select(F.col("issue").alias("query")), k=k_history)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct(
                "rank", F.concat_ws(" @ ", "incident", "timestamp").alias("item")))).alias("p"))
            .select(F.col("query").alias("issue"),
                    F.array_join(F.col("p.item"), " | ").alias("past_incidents")))
    return labels.join(documents, "issue", "left").join(past, "issue", "left")


def diagnose(spark: SparkSession, events: DataFrame, procedures: DataFrame,
             history: DataFrame, policy: str = "coded", k_docs: int = 1,
             k_history: int = 2, documents: DataFrame | None = None) -> DataFrame:
    """One diagnosis row per event.

    ``events`` carries ``delay_rate, avg_prep_time, cancellation_rate,
    reliability_score, incident_mode``; ``procedures`` is ``(doc_name,
    content)``; ``history`` has the history schema (looked up before any
    outcome of this batch is appended). ``documents`` (``issue_documents``)
    saves building the index of the procedures again.
    """
    planned = plan_events(spark, classify_events(events, policy))
    if documents is None:
        documents = issue_documents(spark, procedures, k_docs)
    lookups = issue_lookups(spark, documents, history, k_history)
    out = planned.join(F.broadcast(lookups), "issue", "left")
    return out.withColumns({
        "solution": join_actions("actions"),
        "improvement_value": X.improvement_value("improvement"),
        "confidence_value": X.confidence_value("confidence"),
    })


def planner_context(spark: SparkSession, events: DataFrame, documents: DataFrame,
                    history: DataFrame, policy: str = "coded", k_history: int = 2) -> DataFrame:
    """X11: ``events`` with ``context``, the text the planner reads: parsed report,
    procedure (``issue_documents``) and the past incidents of the issue."""
    past = (H.find_similar(history, issue_labels(spark).select(F.col("issue").alias("query")),
                           k=k_history)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct(
                "rank", "incident", "solution", "improvement", "confidence"))).alias("past")))
    known = documents.join(past.withColumnRenamed("query", "issue"), "issue", "full_outer")
    return classify_events(events, policy).join(F.broadcast(known), "issue", "left").withColumn(
        "context", X.context_text("issue", "confidence", "evidence", "sop_content", "past"))


def diagnose_latest(spark: SparkSession, kpis_latest: DataFrame, procedures: DataFrame,
                    history: DataFrame, policy: str = "coded") -> DataFrame:
    """J9 on demand (the manual trigger): diagnose the latest KPI row (S11);
    nothing is diagnosed while the active incident is normal."""
    row = (kpis_latest.withColumnRenamed("active_incident", "incident_mode")
           .filter(F.col("incident_mode") != "normal"))
    return diagnose(spark, row, procedures, history, policy)


def outcomes(diagnoses: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """S9 input: the history row each diagnosis appends."""
    return H.history_rows(diagnoses.select(
        F.col("issue").alias("incident"), F.col("solution"),
        F.col("improvement_value").alias("improvement"),
        F.col("confidence_value").alias("confidence"), F.col(ts_col).alias("timestamp")))
