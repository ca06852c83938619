"""Licence scan by a trained paragraph classifier (operator 8, DataFrame only).

Paragraphs are the lines of a text, and its blocks (lines up to the next one without
a word): a notice wrapped over lines or inside a long line is found in overlapping
word windows of its block (``WINDOWS``: words, step). Before anything is scored, an
exact bound leaves out what could not be confirmed: a line, window or block has to
hold the ``confirm`` share of some template's grams itself, and no text does that
without one of a few words (``needed_words``), so most texts are only searched for
these. No result depends on the bound. Of overlapping windows those that agree best count, and a
block counts for a family only if none of its lines does. Comment marks are no words.

A multinomial logistic regression over
hashed word 1- and 2-grams tells the licence families from ``unknown``; it is
trained here on notices in the wording of ``NOTICES``, each in ``VARIANTS``
disturbed forms (case, words put before and behind, words dropped), and on a sample
of the corpus's whole lines as the unknown class: at most ``NEGATIVES`` of all lines
and at most ``NEAR`` of those that hold a needed word but no template's share, such
as prose about licences. Lines made mostly of one notice's grams are left out. The
sample is bounded, the scan is not.

The unknown class is calibrated on held-out paragraphs: a family needs a
probability above the ``1 - false_rate`` quantile of what held-out unknown
paragraphs reach. A prediction then has to be confirmed by template comparison:
the share of the family's best template's 2-grams that stand in the paragraph
must reach ``confirm``.

Every paragraph of every text is tested, row by row, without a shuffle; only
paragraphs with a confirmed licence are grouped by document. The templates are a
constant of the code. A null text has no paragraphs; blank lines are none
either; very long texts and lines are handled whole; rows that share a doc_id and
all other columns share one result row per row; other columns may have any name; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaywatch.llm import common as C

# Common short notices of each family: fixed values.
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
               "file except in compliance with the License."],
    "bsd": ["Use of this source code is governed by a BSD-style license.",
            "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met."],
    "cc-by": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License."],
    "cc0": ["Released into the public domain under CC0 1.0 Universal.",
            "To the extent possible under law, the author has waived all copyright and related "
            "rights to this work."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms "
            "of the GNU General Public License as published by the Free Software Foundation."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms "
             "of the GNU Lesser General Public License."],
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved. No part of this work may be reproduced without permission.",
                    "Copyright. All rights reserved."],
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *sorted(NOTICES)]
VARIANTS, NEGATIVES, NEAR, FEATURES = 24, 4000, 1000, 1 << 14
FALSE_RATE, CONFIRM = 0.001, 0.6
# Words of the notices that much other prose has, too.
FREQUENT = ("a and any are be by in is it no not of or part person that the this to under use with "
            "without work you following").split()
# Words and step of the windows: a notice of size - step + 1 words lies whole in one.
WINDOWS = ((12, 4), (24, 6), (40, 8))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it: a
    filter is pushed below the projection that names the value and would repeat it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _text_grams(text: Column) -> Column:
    return _once(_words(text), _grams)


def _grams(words: Column) -> Column:
    """Distinct words and word pairs."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                       F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a word: doc_id, row key, number and text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       C.row_key(docs).alias("k_row"),
                       F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))
    return rows.filter(F.col("line").rlike(r"[\p{L}\p{N}]"))


def needed_words(confirm: float) -> list[str]:
    """Words of which any text with the ``confirm`` share of some notice's grams
    holds one: without these words of a notice, and the pairs that they stand in,
    fewer of its grams are left than that. Frequent words are taken late, numbers and
    words that stand in many others last."""
    out: set[str] = set()
    for grams in _template_grams():
        left = [g.split(" ") for g in grams]
        while len(left) >= confirm * len(grams):
            words = {w for g in left for w in g}
            best = min(words, key=lambda w: (w.isdigit(), len(w) < 3, w in FREQUENT, w not in out,
                                             -sum(w in g for g in left), -len(w), w))
            out.add(best)
            left = [g for g in left if best not in g]
    # A text that holds a word holds its parts.
    return sorted(w for w in out if not any(v != w and v in w for v in out))


def _may_hold(text: Column, confirm: float) -> Column:
    """Whether a text holds a needed word, as part of a word at least."""
    if confirm <= 0:
        return F.lit(True)
    return F.exists(F.array(F.lower(text)), lambda t: reduce(
        lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in needed_words(confirm)]))


def held_texts(docs: DataFrame, id_col: str, text_col: str, confirm: float) -> DataFrame:
    """(doc_id, k_row, text) of the documents that hold a needed word."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.filter(_may_hold(text, confirm)).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), C.row_key(docs).alias("k_row"),
        text.alias("text"))


def candidate_lines(held: DataFrame, confirm: float) -> DataFrame:
    """The paragraphs of held texts that hold a needed word."""
    lines = held.select("doc_id", "k_row", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.filter(_may_hold(F.col("line"), confirm))


def _featured(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("grams", _text_grams(F.col("line")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams",
                     outputCol="features").transform(rows)


def _template_grams() -> list[list[str]]:
    """The distinct words and word pairs of each notice, as ``_grams`` makes them."""
    out = []
    for n in (n for ns in NOTICES.values() for n in ns):
        w = re.findall(r"[^\W_]+", n.lower())
        out.append(sorted({*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}))
    return out


def _fragment(grams: Column) -> Column:
    """Whether more than half of the grams are those of one notice."""
    return _once(grams, lambda g: reduce(lambda a, b: a | b, [
        2 * F.size(F.array_intersect(g, F.array(*[F.lit(x) for x in t])))
        > F.size(F.array_distinct(g)) for t in _template_grams()]))


def _chosen(lines: DataFrame, classes: int, name: str) -> DataFrame:
    """The line with the smallest hash in each of ``classes`` hash classes: distinct
    lines, however often one is repeated, and no text is shuffled to find them."""
    h = F.xxhash64("line")
    least = C.stored(lines.select(h.alias("h")).groupBy(F.pmod("h", F.lit(classes)).alias("c"))
                     .agg(F.min("h").alias("n_h")).select("n_h"), name)
    return (lines.select("line").join(F.broadcast(least), h == F.col("n_h"))
            .groupBy("n_h").agg(F.first("line").alias("line")))


def training_rows(spark: SparkSession, lines: DataFrame, near: DataFrame) -> DataFrame:
    """(line, label, held): disturbed notices and a bounded sample of the corpus's
    paragraphs, and of those ``near`` a notice, as the unknown class."""
    notices = spark.createDataFrame(
        [(FAMILIES.index(f), n) for f, ns in NOTICES.items() for n in ns], "label int, notice string")
    sample = _chosen(lines, NEGATIVES, "negatives").unionByName(
        _chosen(near, NEAR, "near-negatives")).dropDuplicates(["n_h"])
    # A line out of a wrapped notice is no unknown: most of its grams are a template's.
    sample = sample.filter(~_fragment(_text_grams(F.col("line"))))
    sample = C.stored(sample.select("line", F.row_number().over(Window.orderBy("n_h")).alias("n")),
                      "sample")
    filler = sample.filter(F.col("n") <= VARIANTS).select("n", F.split("line", " ").alias("w"))
    bare = notices.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(VARIANTS))))
    made = bare.join(filler, "n", "left").select(
        "label", (F.col("n") % 4 == 0).alias("held"),
        F.when(F.col("n") % 3 == 0, F.upper("notice")).when(F.col("n") % 3 == 1, F.lower("notice"))
        .otherwise(F.col("notice")).alias("text"),
        F.when(F.col("n") % 2 == 0, F.concat_ws(" ", F.slice("w", 1, 4))).otherwise("").alias("a"),
        F.when(F.col("n") % 5 < 2, F.concat_ws(" ", F.slice("w", 5, 6))).otherwise("").alias("b"))
    made = made.select(F.trim(F.concat_ws(" ", "a", "text", "b")).alias("line"), "label", "held")
    plain = notices.select(F.col("notice").alias("line"), "label", F.lit(False).alias("held"))
    other = sample.select("line", F.lit(0).alias("label"), (F.col("n") % 4 == 0).alias("held"))
    return made.unionByName(plain).unionByName(other)


def trained(spark: SparkSession, lines: DataFrame, near: DataFrame,
            false_rate: float = FALSE_RATE) -> tuple[LogisticRegressionModel, float]:
    """The classifier and the least probability of a family."""
    rows = C.stored(_featured(training_rows(spark, lines, near)).select("label", "held", "features"),
                    "training")
    model = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40, labelCol="label"
                               ).fit(rows.filter(~F.col("held")))
    held = model.transform(rows.filter("held AND label = 0"))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1))
    cut = held.agg(F.percentile(best, F.lit(1 - false_rate))).first()[0]
    return model, max(0.5, float(cut or 0.0))


def _confirmation(spark: SparkSession) -> DataFrame:
    """Each template's word pairs: (family, pairs)."""
    rows = spark.createDataFrame([(f, n) for f, ns in NOTICES.items() for n in ns],
                                 "family string, notice string")
    words = _words(F.col("notice"))
    return rows.select("family", F.array_distinct(_grams(words)).alias("t_grams"))


def _classified(rows: DataFrame, model: LogisticRegressionModel, least: float, confirm: float,
                keys: list[str]) -> DataFrame:
    """The rows of ``rows`` (keys, line) with a confirmed family, its probability and
    agreement."""
    scored = model.transform(_featured(rows))
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("prediction").cast("int") + 1)
    found = scored.filter("prediction > 0").select(
        *keys, "line", "grams", family.alias("family"),
        F.array_max(vector_to_array("probability")).alias("probability")
    ).filter(F.col("probability") >= least)
    templates = F.broadcast(_confirmation(rows.sparkSession))  # the constant notices
    share = F.size(F.array_intersect("t_grams", "grams")) / F.size("t_grams")
    best = found.join(templates, "family").withColumn("agreement", share)
    return best.groupBy(*keys, "line", "family", "probability").agg(
        F.max("agreement").alias("agreement")).filter(F.col("agreement") >= confirm)


def _may_match(text: Column, confirm: float) -> Column:
    """Whether a text's grams hold the ``confirm`` share of some template's."""
    templates = _template_grams()
    known = F.array(*[F.lit(g) for g in sorted({g for t in templates for g in t})])
    return _once(F.array_intersect(_text_grams(text), known), lambda hit: reduce(
        lambda a, b: a | b,
        [F.size(F.array_intersect(hit, F.array(*[F.lit(g) for g in t]))) / F.lit(len(t))
         >= confirm for t in templates]))


def windows(held: DataFrame, confirm: float) -> DataFrame:
    """Word windows of the blocks of held texts that may hold a notice: doc_id,
    k_row, block number and text, first word, size and the words as ``line``."""
    blocks = held.select("doc_id", "k_row", F.posexplode(F.split("text", r"\n[^\p{L}\p{N}]*\n"))
                         .alias("block", "b_text"))
    blocks = blocks.filter(_may_hold(F.col("b_text"), confirm)).filter(
        _may_match(F.col("b_text"), confirm)).withColumn("words", _words(F.col("b_text")))

    def cuts(size: int, step: int) -> Column:
        last = F.greatest(F.size("words") - (size - step) - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last, F.lit(step)),
                           lambda k: F.struct(k.alias("start"), F.lit(size).alias("size")))

    starts = F.flatten(F.array(*[cuts(*w) for w in WINDOWS]))
    cut = blocks.select("*", F.inline(starts))
    return cut.select("doc_id", "k_row", "block", "b_text", "start", "size",
                      F.array_join(F.slice("words", F.col("start") + 1, F.col("size")), " ").alias("line"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         confirm: float = CONFIRM, false_rate: float = FALSE_RATE) -> DataFrame:
    """One row per licence paragraph: doc_id, k_row, paragraph, line, family,
    probability and agreement with its best template. A block has the number
    -1 - (its number in the text) and its best window as line."""
    spark = docs.sparkSession
    held = C.stored(held_texts(docs, id_col, text_col, confirm), "held-texts")
    lines = C.stored(candidate_lines(held, confirm).withColumn(
        "may", _may_match(F.col("line"), confirm)), "candidates")
    model, least = trained(spark, paragraphs(docs, id_col, text_col), lines.filter("NOT may"),
                           false_rate)
    single = C.stored(_classified(lines.filter("may"), model, least, confirm,
                                  ["doc_id", "k_row", "paragraph"]), "licence-lines")
    keys = ["doc_id", "k_row", "block", "b_text", "start", "size"]
    cut = C.stored(windows(held, confirm).filter(
        _may_match(F.col("line"), confirm)), "windows")
    found = _classified(cut, model, least, confirm, keys)
    # The best agreement among the windows that overlap.
    place = Window.partitionBy("doc_id", "k_row", "block").orderBy("start")
    best = reduce(lambda a, b: F.when(F.col("size") == b[0], b[1]).otherwise(a), [
        (own, F.greatest(*[F.max(F.when(F.col("size") == other, F.col("agreement")))
                           .over(place.rangeBetween(1 - other, own - 1)) for other, _ in WINDOWS]))
        for own, _ in WINDOWS], F.lit(None).cast("double"))
    found = found.withColumn("best", best).filter("agreement >= best")
    # A line that holds the family alone stands for its block.
    own = single.select(F.col("doc_id").alias("l_id"), F.col("k_row").alias("l_row"),
                        F.col("family").alias("l_family"), F.col("line").alias("l_line"))
    feed = F.lit("\n")
    wrapped = found.join(own, F.col("doc_id").eqNullSafe(F.col("l_id"))
                         & (F.col("k_row") == F.col("l_row")) & (F.col("family") == F.col("l_family"))
                         & F.concat(feed, "b_text", feed).contains(F.concat(feed, "l_line", feed)),
                         "left_anti")
    wrapped = wrapped.groupBy("doc_id", "k_row", "block", "family").agg(
        F.max_by(F.struct("line", "probability", "agreement"), F.struct("agreement", "probability"))
        .alias("b")).select("doc_id", "k_row", (-1 - F.col("block")).alias("paragraph"), "b.line",
                            "family", "b.probability", "b.agreement")
    return single.unionByName(wrapped)


def document_licences(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_licensed and the families
    found, in order, joined by ``|`` (empty if none)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = scan(docs, **options).groupBy("doc_id", "k_row").agg(
        F.count_distinct("paragraph").alias("n"),
        F.array_join(F.array_sort(F.collect_set("family")), "|").alias("f"))
    found = C.stored(found, "licences").toDF("f_id", "f_row", "n", "f")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       C.row_key(docs).alias("k_row"),
                       F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")))
                       .cast("long").alias("n_paragraphs"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id"))
                     & (F.col("k_row") == F.col("f_row")), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_licensed"),
        F.coalesce("f", F.lit("")).alias("families"))
