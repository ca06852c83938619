"""Mixing sources to target weights by iterative proportional fitting
(operator 9, DataFrame only).

Documents fall into cells (source, language, topic). Raking multiplies the
cells' token weights by target / current of one margin after the other until
all margins hold; if weights stand still before (targets that contradict each other)
or ``rounds`` are over, a warning gives the error left in each margin; a cell's ratio of weight to tokens, scaled to the token budget
and capped at one, is the probability with which its documents stay. Capped
cells give up what they cannot supply, so the scale is solved with the caps.

Targets are shares in proportion to tokens ** ``alpha`` of a margin (1 keeps the
corpus mix, 0 levels it), or a given table (value, share) over the same values.
A document's draw is a hash of its id and text, so a run repeated, or a task
retried, keeps the same documents; equal rows share their draw.

Only cells (the product of the margins' values at most) are aggregated and
joined; texts are never shuffled, and a hot source adds one row per task to the
first aggregation. Null sources and languages are values of their own; a null
text has no words and the topic ``short``; documents without words are kept
with their cell's probability; texts of any length count whole; other columns may
have any name and are kept; an empty table gives no rows.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaywatch.llm import common as C

MARGINS = ("source", "lang", "topic")
ALPHA = {"source": 0.7, "lang": 0.8, "topic": 1.0}
BUDGET, ROUNDS, CLOSE, SEED = 0.6, 30, 1e-6, 11
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by marks in the text, the first that holds."""
    words = F.regexp_count(text, F.lit(WORD))
    return (F.when(text.contains("icense"), "licence").when(text.contains("@"), "contact")
            .when(text.contains(" | "), "table").when(words < 100, "short")
            .when(words < 1000, "middle").otherwise("long"))


def keyed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", seed: int = SEED) -> list[Column]:
    """Columns t_id, t_source, t_lang, t_topic, t_words, t_draw of each row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1)), text)
    return [F.col(f"`{id_col}`").cast("long").alias("t_id"),
            F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("(null)")).alias("t_source"),
            F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("(null)")).alias("t_lang"),
            topic_of(text).alias("t_topic"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("t_words"),
            (F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))).alias("t_draw")]


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("t_source", "t_lang", "t_topic").agg(
        F.sum("t_words").cast("double").alias("tokens"))


def _targets(cells: DataFrame, margin: str, alpha: float, given: DataFrame | None) -> DataFrame:
    """Target tokens of each value that the corpus has, adding up to its tokens."""
    per = cells.groupBy(f"t_{margin}").agg(F.sum("tokens").alias("have")).filter("have > 0")
    if given is not None:
        per = per.join(given.select(F.col("value").alias(f"t_{margin}"), "share"), f"t_{margin}")
        per = per.withColumn("wish", F.col("share").cast("double"))
    else:
        per = per.withColumn("wish", F.pow("have", F.lit(alpha)))
    wish, have = per.agg(F.sum("wish"), F.sum("have")).first()
    return per.select(f"t_{margin}", (F.col("wish") * F.lit((have or 0.0) / (wish or 1.0)))
                      .alias("target"))


def margin_errors(out: DataFrame) -> dict[str, float]:
    """The largest relative difference of each margin's weights from its targets."""
    return {m: out.groupBy(f"t_{m}").agg(F.sum("weight").alias("now"), F.first(f"goal_{m}").alias("goal"))
            .filter("goal > 0").agg(F.max(F.abs(F.col("now") / F.col("goal") - 1))).first()[0]
            for m in MARGINS}


def raked(cells: DataFrame, *, alpha: dict[str, float] | None = None,
          targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
          close: float = CLOSE) -> DataFrame:
    """``cells`` with ``weight``: tokens raked to the target margins. A value
    without tokens, or one that a given table lacks, gets no weight."""
    alpha, targets = alpha or ALPHA, targets or {}
    keys = [f"t_{m}" for m in MARGINS]
    out = cells.withColumn("weight", F.col("tokens"))
    for m in MARGINS:  # each cell carries the targets of its margins
        goal = _targets(cells, m, alpha[m], targets.get(m)).withColumnRenamed("target", f"goal_{m}")
        out = out.join(goal, f"t_{m}", "left")
    out = C.stored(out.fillna(0.0, [f"goal_{m}" for m in MARGINS]), "raking")
    for _ in range(rounds):
        before = out.select(*keys, F.col("weight").alias("old"))
        for m in MARGINS * 2:  # two turns in one plan
            now = out.groupBy(f"t_{m}").agg(F.sum("weight").alias("now"))
            factor = F.when(F.col("now") > 0, F.col(f"goal_{m}") / F.col("now")).otherwise(0.0)
            out = out.join(now, f"t_{m}").withColumn("weight", F.col("weight") * factor).drop("now")
        out = C.stored(out, "raking")
        moved = out.join(before, keys).agg(
            F.max(F.abs(F.col("weight") - F.col("old")) / F.greatest("weight", F.lit(1e-9)))).first()[0]
        if moved is None or moved < close:
            break
    # Contradicting targets come to a standstill too: the margins tell.
    errors = margin_errors(out)
    if any((e or 0.0) > close for e in errors.values()):
        logging.getLogger(__name__).warning("raking ended with these relative errors of the "
                                            "margins: %s", errors)
    return out.select(*keys, "tokens", "weight")


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``probability`` of each cell: weight / tokens, scaled so that the expected
    tokens are ``budget`` of all, with cells capped at one."""
    rate = cells.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
                            .otherwise(0.0))
    total = rate.agg(F.sum("tokens")).first()[0] or 0.0
    scale, capped = budget, -1.0
    while True:  # each turn caps more cells; ends when none is new
        full = F.col("rate") * scale >= 1
        row = rate.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0.0)),
                       F.sum(F.when(full, 0.0).otherwise(F.col("rate") * F.col("tokens")))).first()
        now, open_ = row[0] or 0.0, row[1] or 0.0
        if now <= capped or open_ <= 0 or budget * total <= now:
            break
        capped, scale = now, (budget * total - now) / open_
    return rate.withColumn("probability", F.least(F.lit(1.0), F.col("rate") * scale))


def mixed(docs: DataFrame, *, budget: float = BUDGET, alpha: dict[str, float] | None = None,
          targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
          **columns) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_words, probability, kept."""
    rows = C.stored(docs.select(*keyed(docs, **columns)), "mix-rows")
    cells = C.stored(cells_of(rows), "cells")
    odds = C.stored(probabilities(raked(cells, alpha=alpha, targets=targets, rounds=rounds), budget), "odds")
    odds = odds.select("t_source", "t_lang", "t_topic", "probability")
    return rows.join(odds, ["t_source", "t_lang", "t_topic"]).select(
        F.col("t_id").alias("doc_id"), F.col("t_source").alias("source"),
        F.col("t_lang").alias("lang"), F.col("t_topic").alias("topic"),
        F.col("t_words").alias("n_words"), F.round("probability", 9).alias("probability"),
        (F.col("t_draw") < F.col("probability")).alias("kept"))


def sampled(docs: DataFrame, *, budget: float = BUDGET, alpha: dict[str, float] | None = None,
            targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
            **columns) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` keeps, with all their columns."""
    keys = keyed(docs, **columns)
    rows = docs.select(*keys[1:5])
    cells = C.stored(cells_of(rows), "cells")
    odds = C.stored(probabilities(raked(cells, alpha=alpha, targets=targets, rounds=rounds), budget), "odds")
    odds = odds.select("t_source", "t_lang", "t_topic", "probability")
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("t_row"),
                        *[keys[k] for k in (1, 2, 3, 5)])
    kept = whole.join(odds, ["t_source", "t_lang", "t_topic"]).filter("t_draw < probability")
    return kept.select(*[F.col("t_row").getField(c).alias(c) for c in names])
