"""Incident history: keyword match, fallback, newest rows
and the history table itself (S7, S8, S9).

A history row is ``(id, incident, solution, improvement, confidence,
timestamp)``; ``timestamp`` is ISO text, which sorts correctly as text. The
table is a commit log (``sources.commits``): a batch is there once its manifest is
written, and only once, however equal the rows are. Stored ids name the batch and
the row in it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaywatch.functions.text import contains_word, keywords
from relaywatch.schema import HISTORY, HISTORY_SEEDS
from relaywatch.sources.commits import CommitLog, stamped

GRAM = 4  # characters of a keyword that are matched by equality


def content_id(incident, solution, improvement, confidence, timestamp):
    return F.sha2(F.concat_ws("\u001f", incident, solution, improvement.cast("string"),
                              confidence.cast("string"), timestamp), 256)


def history_rows(df: DataFrame, ts_col: str | None = "timestamp") -> DataFrame:
    """Cast to the history schema and stamp id (and time when ``ts_col`` is
    None: the current time as ISO text)."""
    ts = (F.col(ts_col) if ts_col else
          F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    rows = df.select(F.col("incident").cast("string").alias("incident"),
                     F.col("solution").cast("string").alias("solution"),
                     F.col("improvement").cast("int").alias("improvement"),
                     F.col("confidence").cast("double").alias("confidence"),
                     ts.cast("string").alias("timestamp"))
    return rows.select(content_id(F.col("incident"), F.col("solution"), F.col("improvement"),
                                  F.col("confidence"), F.col("timestamp")).alias("id"),
                       *[c for c in rows.columns])


def seed_rows(spark: SparkSession) -> DataFrame:
    seeds = spark.createDataFrame(
        HISTORY_SEEDS, "incident string, solution string, improvement int, "
                       "confidence double, timestamp string")
    return history_rows(seeds)


def seeded(spark: SparkSession, history: DataFrame) -> DataFrame:
    """The seed rows, kept only when ``history`` is empty (a scalar
    count, so the seeds are added at most once)."""
    n = history.agg(F.count(F.lit(1))).scalar()
    return seed_rows(spark).filter(n == 0)


# --- S7 / S8 / S9: the history table on storage ----------------------------

def history_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, HISTORY)


def open_history(spark: SparkSession, path: str) -> DataFrame:
    """S7 + S8: read the table as of now; one that is missing or empty gets the
    seeds, once. Opening lists the manifests, whatever the number of batches; a
    table that has rows is not written to."""
    log = history_log(spark, path)
    if not any(f[1] for f in log.current()[1]["folders"]):
        log.append(seed_rows(spark).coalesce(1), "seed", 0)
    return log.read()


def record_incidents(spark: SparkSession, outcomes: DataFrame, path: str,
                     ts_col: str | None = None, batch_id: int | None = None,
                     run: str = "manual") -> bool:
    """Append outcomes (incident, solution, improvement, confidence), every
    row. Missing times become the current time.

    Batch ``batch_id`` of ``run`` (a query's checkpoint) is added once: a replay adds
    nothing, and a batch whose writer was lost before its commit has left nothing.
    Without a batch id each call adds a batch of its own. True if rows were added.
    """
    log = history_log(spark, path)
    if batch_id is not None and log.has(run, batch_id):
        return False
    batch = uuid.uuid4().hex if batch_id is None else str(batch_id)
    rows = history_rows(outcomes, ts_col)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = stamped(rows.withColumn("timestamp", F.coalesce("timestamp", now)), f"{run}-{batch}-")
    return log.append(rows, None if batch_id is None else run, batch_id)


# --- J3 / J4 / L3: lookups -------------------------------------------------

def newest(history: DataFrame, k: int = 2) -> DataFrame:
    """L3: the ``k`` newest rows (timestamp desc, id desc for ties)."""
    return history.orderBy(F.col("timestamp").desc(), F.col("id").desc()).limit(k)


def _by_gram(incidents: DataFrame, words: DataFrame) -> DataFrame:
    """(query, incident, word) matches of words that have a literal: the first
    min(4, length) characters of the longest literal piece are among the
    incident's grams of that length (an equi-join), and ``ilike`` confirms."""
    low = incidents.select("incident", F.lower("incident").alias("_l"))
    grams = low.select("incident", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(GRAM)),
        lambda n: F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.length("_l") - n + 1, F.lit(1))),
                     lambda i: i + n - 1 <= F.length("_l")),
            lambda i: F.substring("_l", i, n))))).alias("_gram")).distinct()
    keyed = words.withColumn("_gram", F.substring(F.lower("_literal"), 1, GRAM))
    return (keyed.join(grams, "_gram")
            .filter(contains_word(F.col("incident"), F.col("word")))
            .select("query", "incident", "word"))


def _by_length(history: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """(query, incident, word) for words of wildcards alone, which match every
    incident of at least as many characters as they have ``_``: the incidents of
    the ``k`` newest rows for each such length."""
    newest_first = [F.col("timestamp").desc(), F.col("id").desc()]
    per = (history.withColumn("_n", F.length("incident"))
           .withColumn("_r", F.row_number().over(Window.partitionBy("_n").orderBy(*newest_first)))
           .filter(F.col("_r") <= k))
    atleast = (per.withColumn("_min", F.explode(F.sequence(F.lit(0), "_n")))
               .withColumn("_r", F.row_number().over(
                   Window.partitionBy("_min").orderBy(*newest_first)))
               .filter(F.col("_r") <= k).select("_min", "incident").distinct())
    need = F.length("word") - F.length(F.replace(F.col("word"), F.lit("_"), F.lit("")))
    return (words.withColumn("_min", need).join(atleast, "_min")
            .select("query", "incident", "word"))


def find_similar(history: DataFrame, queries: DataFrame, k: int = 2,
                 query_col: str = "query", rank: str = "newest") -> DataFrame:
    """J3 + J4: for each query text, the ``k`` newest history rows whose
    incident contains any keyword (X2) of the query, case-insensitively
    (X3); queries without any match get the ``k`` newest rows overall.
    ``rank='overlap'`` puts incidents that contain more of the query's keywords
    first (F10).

    One path for any number of queries, keywords and rows: only the k newest
    rows of each distinct incident can be results, keywords meet the distinct
    incidents by an equi-join on a gram of up to four characters, and the few
    keywords of wildcards alone meet them by length. Rows are never compared by
    id, so equal rows stay apart.
    """
    if rank not in ("newest", "overlap"):
        raise ValueError("rank is 'newest' or 'overlap'")
    words = (queries.select(F.col(query_col).alias("query"),
                            F.explode(F.array_distinct(keywords(query_col))).alias("word"))
             .distinct())
    pieces = F.split("word", r"\\.|[%_\\]")
    longest = F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"),
                                                                 p.alias("p"))))["p"]
    words = words.withColumn("_literal", longest)
    newest_first = [F.col("timestamp").desc(), F.col("id").desc()]
    per = Window.partitionBy("incident").orderBy(*newest_first)
    recent = (history.withColumn("_r", F.row_number().over(per)).filter(F.col("_r") <= k)
              .drop("_r"))
    matched = _by_gram(recent.select("incident").distinct(), words.filter("_literal <> ''")
                       ).unionByName(_by_length(history, words.filter("_literal = ''"), k))
    matched = matched.groupBy("query", "incident").agg(
        F.count_distinct("word").alias("_overlap"))
    if rank == "overlap":  # wildcards alone match whatever is long enough
        free = words.filter("_literal = ''").groupBy("query").agg(F.collect_list(
            F.length("word") - F.length(F.replace(F.col("word"), F.lit("_"), F.lit("")))).alias("_f"))
        solid = words.filter("_literal <> ''")
        counted = _by_gram(recent.select("incident").distinct(), solid).groupBy(
            "query", "incident").agg(F.count_distinct("word").alias("_solid"))
        matched = (matched.join(counted, ["query", "incident"], "left").join(free, "query", "left")
                   .withColumn("_overlap", F.coalesce("_solid", F.lit(0)) + F.size(F.filter(
                       F.coalesce("_f", F.array().cast("array<int>")),
                       lambda n: n <= F.length("incident"))))
                   .drop("_solid", "_f"))
    order = ([F.col("_overlap").desc()] if rank == "overlap" else []) + newest_first
    w = Window.partitionBy("query").orderBy(*order)
    top = (matched.join(recent, "incident").withColumn("rank", F.row_number().over(w))
           .filter(F.col("rank") <= k).withColumn("matched", F.lit(True)))
    # The k newest rows overall, as one array (scalar subquery), for
    # queries with no match.
    fields = ["timestamp", "id", "incident", "solution", "improvement", "confidence"]
    fallback = (newest(history, k)
                .select(F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("a"))
                .scalar())
    qs = queries.select(F.col(query_col).alias("query")).distinct()
    unmatched = qs.join(matched.select("query"), "query", "left_anti")
    fb = (unmatched.select("query", F.posexplode(fallback).alias("pos", "row"))
          .select("query", (F.col("pos") + 1).alias("rank"), "row.*")
          .withColumn("matched", F.lit(False)))
    cols = ["query", "rank", "matched", *history.columns]
    return top.select(*cols).unionByName(fb.select(*cols))
