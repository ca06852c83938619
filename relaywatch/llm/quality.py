"""Quality rules by robust multivariate outliers (operator 5, DataFrame only).

Each document gets counts of words, characters in words, symbols, repeated lines
and words in repeated three-word windows. Base rules reject documents with fewer
than ``min_words`` words or with more than half of their words in repeated
windows. The others become vectors

    mean word length, and the square roots of symbols per character in words,
    repeated lines per word and repeated words per word

and the minimum-covariance-determinant estimate of each (language, source) group
judges them: starting from medians and median absolute deviations, concentration
steps refit mean and covariance on the half of the rows that lie nearest
(``support``; Mahalanobis distance, by the inverse Cholesky factor) until a
group's determinant stops falling, and rows beyond the chi-squared quantile
``quantile`` are rejected. So up to nearly half of a group may be equal outliers. Every feature has a
smallest spread (``FLOORS``), so that a group in which nearly all documents have
a count of zero does not reject the first document that has one.

Documents of a group with fewer than ``min_group`` rows are judged by the estimate
of their whole language, large groups included, and where the language has fewer
rows, by that of the whole table, of any size. Each covariance is shrunk towards a
wide prior (``PRIOR``), which weighs as much as ``PRIOR_ROWS`` rows: next to nothing
in a large group, most of it in a table of a few documents, where only gross
outliers go. Cut points come from percentile
sketches of bounded size, means and covariances from partial aggregates, so a
source with a third of all rows is never gathered in a task.

A null text has no words (base rules reject it); null languages and sources form
groups of their own; documents are judged row by row, so repeated rows get equal
verdicts; an empty table gives no rows.

Three-word windows meet by hash and are compared word by word, so none counts by
chance; one is missed only if another with the same 47 bits or more stands between
two equal ones. Very long texts are counted whole. Other columns may have any name.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaywatch.llm import common as C

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50  # words; percent of words in repeated windows
SUPPORT, STEPS, QUANTILE, MIN_GROUP = 0.5, 50, 1 - 1e-6, 200  # STEPS: at most so many
FALL = 1e-3  # a smaller fall of the log determinant is none (the cut points are sketches)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FLOORS = (0.35, 0.04, 0.08, 0.12)  # smallest spread of each feature
PRIOR, PRIOR_ROWS = (1.0, 0.1, 0.2, 0.3), 20  # spread and weight of the prior
P = len(FLOORS)


def chi2_cdf(x: float, df: float) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, z = df / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_quantile(p: float, df: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < p else (lo, mid)
    return hi


def text_counts(text: Column) -> dict[str, Column]:
    """The five counts of a text, without leaving its row."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


LONG_TEXT = 1 << 16  # words from which window hashes are kept whole


def repeated_words(words: str) -> Column:
    """Words covered by three-word windows that the array ``words`` has twice.

    Windows are sorted by hash, so that equal ones stand together; neighbours with
    an equal hash are compared word by word. The places of those with an equal
    neighbour, sorted again, each add up to three words. Up to ``LONG_TEXT`` words a
    window becomes one long, its hash above and its place in the low ``b`` bits; in
    longer texts too few bits of the hash would be left, so it is a pair."""
    b = f"length(bin(size({words})))"
    one_hash = f"xxhash64({words}[i], {words}[i + 1], {words}[i + 2])"
    packed = (f"shiftleft({one_hash}, {b}) | i", lambda x: f"shiftright({x}, z.b)",
              lambda x: f"CAST({x} & (shiftleft(1L, z.b) - 1) AS INT)")
    paired = (f"struct({one_hash} AS h, i AS p)", lambda x: f"{x}.h", lambda x: f"{x}.p")

    def covered(key: str, hash_of, place_of) -> str:
        def equal(y: str) -> str:
            same = " AND ".join(f"{words}[{place_of('x')} + {j}] = {words}[{place_of(y)} + {j}]"
                                for j in range(3))
            return f"{hash_of('x')} = {hash_of(y)} AND {same}"
        before, after = "z.k[greatest(i - 1, 0)]", "z.k[least(i + 1, size(z.k) - 1)]"
        return f"""
        aggregate(
          array_sort(transform(filter(
            transform(array(struct(
              sort_array(transform(sequence(0, size({words}) - 3), i -> {key})) AS k, {b} AS b)), z ->
              transform(z.k, (x, i) -> IF(
                (i > 0 AND {equal(before)}) OR (i + 1 < size(z.k) AND {equal(after)}),
                CAST({place_of('x')} AS BIGINT), -1L)))[0], x -> x >= 0), x -> x)),
          struct(0L AS n, -3L AS last),
          (s, p) -> struct(s.n + least(3L, p - s.last) AS n, p AS last), s -> s.n)"""

    return F.expr(f"""
        CASE WHEN size({words}) < 4 THEN 0L
             WHEN size({words}) <= {LONG_TEXT} THEN {covered(*packed)}
             ELSE {covered(*paired)} END""")


def counted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", source_col: str = "source",
            min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """doc_id, row key, language, source, counts and base verdict of each row."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       C.row_key(docs).alias("k_row"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{source_col}`").cast("string").alias("source"),
                       *[c.alias(n) for n, c in text_counts(text).items()],
                       F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE),
                                      "").alias("words"))
    rows = rows.withColumn("n_repeat_words", repeated_words("words").cast("long")).drop("words")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def features() -> list[Column]:
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    return [F.col("word_chars") / words, F.sqrt(F.col("n_symbols") / chars),
            F.sqrt(F.col("n_dup_lines") / words), F.sqrt(F.col("n_repeat_words") / words)]


def _whitened(fit: DataFrame) -> DataFrame:
    """The inverse Cholesky factor w_ij of the covariance c_ij, column by column;
    a conditional variance below the squared floor counts as that."""
    def total(terms: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, terms, F.lit(0.0))

    for i in range(P):
        for j in range(i):
            rest = total([F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)])
            fit = fit.withColumn(f"l{i}{j}", (F.col(f"c{j}{i}") - rest) / F.col(f"l{j}{j}"))
        rest = total([F.col(f"l{i}{k}") * F.col(f"l{i}{k}") for k in range(i)])
        fit = fit.withColumn(f"l{i}{i}", F.sqrt(F.greatest(F.col(f"c{i}{i}") - rest,
                                                           F.lit(FLOORS[i] ** 2))))
    for i in range(P):
        for j in range(i):
            rest = total([F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)])
            fit = fit.withColumn(f"w{i}{j}", -rest / F.col(f"l{i}{i}"))
        fit = fit.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
    return fit.select("g", *[f"m{i}" for i in range(P)],
                      *[f"w{i}{j}" for i in range(P) for j in range(i + 1)])


def grouped(rows: DataFrame, min_group: int) -> DataFrame:
    """Vectors of the rows that pass the base rules, once for each group ``g`` that
    they help to estimate; ``own`` marks the group that judges them."""
    sure = rows.filter(~F.col("base_failed")).select(
        "doc_id", "k_row", "lang", "source", *[x.alias(f"x{i}") for i, x in enumerate(features())])
    sizes = sure.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.groupBy(F.col("lang").alias("wl")).agg(F.sum("n").alias("wn"),
                                                         F.min("n").alias("least"))
    large, enough = F.col("n") >= min_group, F.col("wn") >= min_group
    levels = C.stored(sizes.join(whole, F.col("lang").eqNullSafe(F.col("wl"))).select(
        F.col("lang").alias("l"), F.col("source").alias("s"),
        F.when(large, 0).when(enough, 1).otherwise(2).alias("level"),
        (enough & (F.col("least") < min_group)).alias("by_lang")), "levels")
    by_table = not levels.filter("level = 2").isEmpty()

    def member(level: int, *key: Column) -> Column:
        return F.struct(F.xxhash64(F.lit(level), *key, *[c.isNull() for c in key]).alias("g"),
                        (F.col("level") == level).alias("own"))

    members = F.array_compact(F.array(
        F.when(F.col("level") == 0, member(0, F.col("lang"), F.col("source"))),
        F.when(F.col("by_lang"), member(1, F.col("lang"))),
        F.when(F.lit(by_table), member(2))))
    return (sure.join(levels, F.col("lang").eqNullSafe(F.col("l"))
                      & F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "k_row", *[f"x{i}" for i in range(P)], F.inline(members)))


def mcd_distances(vectors: DataFrame, *, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """``vectors`` (g, x0..x3, ...) with the squared robust distance ``d2`` to the
    centre of their group."""
    mids = C.stored(vectors.groupBy("g").agg(
        *[F.percentile_approx(f"x{i}", 0.5, 2000).alias(f"m{i}") for i in range(P)]), "mcd-mid")
    # Medians give the first centre, absolute deviations from them the spread.
    spread = vectors.join(mids, "g").groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 2000).alias(f"s{i}")
          for i in range(P)])
    first = _whitened(spread.select(
        "g", *[f"m{i}" for i in range(P)],
        *[(F.lit(0.0) if i != j else F.pow(F.lit(1.4826) * F.col(f"s{i}"), 2))
          .alias(f"c{i}{j}") for i in range(P) for j in range(i, P)]))
    # The start is no core's determinant: the first step always counts as a fall.
    fit = C.stored(first.withColumn("ld", F.lit(math.inf)).withColumn("open", F.lit(True)), "mcd-0")
    alpha = chi2_quantile(support, P)
    scale = support / chi2_cdf(alpha, P + 2)  # makes the covariance consistent
    numbers = [c for c in first.columns if c != "g"]
    log_det = reduce(lambda a, b: a + b, [-2 * F.log(f"w{i}{i}") for i in range(P)])
    for k in range(steps):
        near = _with_distance(vectors, fit.filter("open").select("g", *numbers))
        # Stored, its size is known: the rows of a large group are not sorted for the join.
        cut = C.stored(near.groupBy("g").agg(F.percentile_approx("d2", support, 2000).alias("cut")),
                       "mcd-cut")
        core = near.join(cut, "g").filter("d2 <= cut")
        sums = core.groupBy("g").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(P)],
            *[(F.covar_pop(f"x{i}", f"x{j}") * scale).alias(f"c{i}{j}")
              for i in range(P) for j in range(i, P)])
        prior = F.lit(float(PRIOR_ROWS)) / (F.col("n") + PRIOR_ROWS)
        now = _whitened(sums.withColumns(
            {f"c{i}{j}": F.col(f"c{i}{j}") * (1 - prior)
             + (prior * PRIOR[i] ** 2 if i == j else F.lit(0.0))
             for i in range(P) for j in range(i, P)})).withColumn("ld", log_det)
        now = now.select("g", *[F.col(c).alias(f"n_{c}") for c in [*numbers, "ld"]])
        lower = F.coalesce(F.col("n_ld") < F.col("ld"), F.lit(False))
        falls = F.coalesce(F.col("n_ld") < F.col("ld") - FALL, F.lit(False))
        fit = C.stored(fit.join(now, "g", "left").select(
            "g", *[F.when(lower, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in numbers],
            F.when(lower, F.col("n_ld")).otherwise(F.col("ld")).alias("ld"),
            falls.alias("open")), f"mcd-{k + 1}")
        if fit.filter("open").isEmpty():
            break
    else:
        logging.getLogger(__name__).warning("groups unsettled after %d steps: %d", steps,
                                            fit.filter("open").count())
    return _with_distance(vectors, fit.select("g", *numbers), "left")


def _with_distance(vectors: DataFrame, fit: DataFrame, how: str = "inner") -> DataFrame:
    z = [reduce(lambda a, b: a + b, [F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}"))
                                     for j in range(i + 1)]) for i in range(P)]
    d2 = reduce(lambda a, b: a + b, [v * v for v in z])
    return vectors.join(fit, "g", how).withColumn("d2", d2).select(*vectors.columns, "d2")


def judged(docs: DataFrame, *, quantile: float = QUANTILE, min_group: int = MIN_GROUP,
           **columns) -> DataFrame:
    """One row per document: the counts, base_failed, d2 and kept."""
    rows = C.stored(counted(docs, **columns), "counts")
    vectors = C.stored(grouped(rows, min_group), "vectors")
    limit = chi2_quantile(quantile, P)
    far = mcd_distances(vectors).filter(F.col("own") & (F.col("d2") > limit))
    # Equal rows have equal distances: one verdict for each row key.
    far = far.groupBy(F.col("doc_id").alias("f_id"), F.col("k_row").alias("f_row")).agg(
        F.max("d2").alias("d2"))
    kept = ~F.col("base_failed") & F.col("f_row").isNull()
    return rows.join(far, F.col("doc_id").eqNullSafe(F.col("f_id"))
                     & (F.col("k_row") == F.col("f_row")), "left").select(
        "doc_id", "k_row", *COUNTS, "base_failed", kept.alias("kept"), "d2")


def good_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    found = C.stored(judged(docs, **options), "judged")
    bad = found.filter(~F.col("kept")).select(F.col("doc_id").alias("b_id"),
                                              F.col("k_row").alias("b_row")).distinct()
    rows = C.carried(docs, options.get("id_col", "doc_id"))
    return rows.join(bad, (F.col("c_key") == F.col("b_row"))
                     & F.col("c_id").eqNullSafe(F.col("b_id")), "left_anti").select("c_row.*")
