"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.llm import common as C
from relaywatch.llm import (exact_dedup, lexical, licences, line_dedup, mixing, packing, quality,
                            simhash, simple8b, suffix_dedup, token_counts, vector_codes,
                            window_dedup)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark, sf_dir):
            C.share_code(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_window_dedup")
def op1_window_dedup(spark, sf_dir):
    return window_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@register("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


@register("op3_packing")
def op3_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@register("op5_quality")
def op5_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents")).drop("k_row", "d2")


@register("op6_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op6_exact_dedup(spark, sf_dir):
    index = exact_dedup.DigestIndex(spark, C.scratch(spark, "digest-index"))
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), index, batch="documents").drop("k_row")


@register("op7_simhash")
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@register("op8_licences")
def op8_licences(spark, sf_dir):
    return licences.document_licences(table(spark, sf_dir, "documents"))


@register("op9_mixing")
def op9_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


@register("op10_simple8b")
def op10_simple8b(spark, sf_dir):
    path = C.scratch(spark, "token-files")
    simple8b.write_token_files(table(spark, sf_dir, "documents"), path,
                               public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return simple8b.read_token_files(spark, path)


_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@register("op11_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_FOLD.format('text'))} AS ts
           FROM documents),
size AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM size),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
           FROM tf, whole GROUP BY term, nn),
asked AS (SELECT DISTINCT q, item_id, term
          FROM (SELECT row_number() OVER () AS q, item_id,
                       unnest({_TERMS.format(_FOLD.format('text'))}) AS term FROM benchmark)),
hit AS (SELECT q, item_id, r, CAST(sum(w * ((1000000000 * tf)
               // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
        FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (r), whole
        GROUP BY q, item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER)
       AS rank, doc_id, score
FROM hit JOIN size USING (r) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) <= 50""")
def op11_lexical_search(spark, sf_dir):
    index = lexical.build_index(table(spark, sf_dir, "documents"), C.scratch(spark, "lexical-index"))
    found = lexical.search(index, table(spark, sf_dir, "benchmark"), k=50)
    return found.withColumnRenamed("query_id", "item_id")


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds as one chain of tables: parts, codebooks, assignments."""
    def near(book: str) -> str:
        return f"""SELECT v, p, arg_min(e, (dist, e)) AS e, min(dist) AS dist
            FROM (SELECT x.v, x.p, b.e, list_sum(list_transform(list_zip(x.c, b.c),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
                  FROM parts x JOIN {book} b USING (p)) GROUP BY v, p"""
    sql = f"""
WITH ints AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS v, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT v, p, c[p * (len(c) // {parts}) + 1:(p + 1) * (len(c) // {parts})] AS c
  FROM ints, range({parts}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, v AS e, c FROM parts WHERE v < {entries})"""
    for k in range(rounds):
        sql += f""",
near{k} AS MATERIALIZED ({near(f'book{k}')}),
mean{k} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT p, e, i, CAST(sum(x.c[i]) AS BIGINT) AS s, count(*) AS n
        FROM parts x JOIN near{k} USING (v, p), range(1, 1 + (SELECT max(len(c)) FROM parts)) AS t(i)
        GROUP BY p, e, i)
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))"""
    return sql + f""",
last AS MATERIALIZED ({near(f'book{rounds}')}),
coded AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                 CAST(sum(dist) AS BIGINT) AS error FROM last GROUP BY v),
flat AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS sha
         FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha AS codebooks_sha256
FROM coded JOIN ints USING (v), flat"""


@register("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


_KEY = r"translate(trim(line, e' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op13_line_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
           FROM documents),
lines AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
keyed AS (SELECT *, {_KEY} AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
         FROM keyed WHERE key NOT IN (SELECT key FROM common) GROUP BY r)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""")
def op13_line_dedup(spark, sf_dir):
    out = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
