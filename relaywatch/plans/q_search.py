"""Registered TF-IDF search queries: ``documents`` is the corpus and the
``benchmark`` texts are the queries (whole texts on both sides)."""

from __future__ import annotations

from pyspark.sql import functions as F

from relaywatch.functions.text import tokenize
from relaywatch.operators import pruned as P
from relaywatch.operators import search as S
from relaywatch.plans.registry import ORACLE, register, rounded, table

TOP_K = 3

_INDEX_SQL = """WITH
occ AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM occ GROUP BY doc_id, token),
nd AS (SELECT count(*) AS n FROM documents),
dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
idf AS (SELECT token, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM dfq, nd),
norms AS (SELECT doc_id, sqrt(sum(pow(tf * idf, 2))) AS norm
          FROM tf JOIN idf USING (token) GROUP BY doc_id)"""

_SCORE_SQL = _INDEX_SQL + """,
qocc AS (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token
         FROM benchmark),
qtf AS (SELECT qid, token, count(*) AS qtf FROM qocc GROUP BY qid, token),
qk AS (SELECT qid, token, qtf, idf FROM qtf JOIN idf USING (token)),
qn AS (SELECT qid, sqrt(sum(pow(qtf * idf, 2))) AS qnorm FROM qk GROUP BY qid),
qv AS (SELECT qid, token, qtf * idf / qnorm AS qw FROM qk JOIN qn USING (qid)),
dv AS (SELECT doc_id, token, tf * idf / norm AS dw FROM tf JOIN idf USING (token) JOIN norms USING (doc_id)),
scores AS (SELECT qid, doc_id, sum(qw * dw) AS score FROM qv JOIN dv USING (token)
           GROUP BY qid, doc_id)"""


def _index(spark, sf):
    return S.build_index(table(spark, sf, "documents"))


def _queries(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")


@register("x1_tokenize", """
SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS INT) AS n_tokens
FROM documents""")
def x1_tokenize(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.size(tokenize("text")).alias("n_tokens"))


@register("a10_term_frequency", _INDEX_SQL + "\nSELECT doc_id, token, tf FROM tf")
def a10_term_frequency(spark, sf):
    return S.term_frequency(table(spark, sf, "documents"))


@register("a11_document_frequency", _INDEX_SQL + "\nSELECT token, df FROM dfq")
def a11_document_frequency(spark, sf):
    return _index(spark, sf).idf.select("token", "df")


@register("u2_vocabulary", _INDEX_SQL + "\nSELECT DISTINCT token FROM occ")
def u2_vocabulary(spark, sf):
    return S.token_occurrences(table(spark, sf, "documents")).select("token").distinct()


@register("x13_idf", _INDEX_SQL + "\nSELECT token, df, round(idf, 6) AS idf FROM idf")
def x13_idf(spark, sf):
    return rounded(_index(spark, sf).idf)


@register("x14_doc_norms", _INDEX_SQL + "\nSELECT doc_id, round(norm, 6) AS norm FROM norms")
def x14_doc_norms(spark, sf):
    return rounded(_index(spark, sf).norms)


@register("j1_sparse_dot", _SCORE_SQL + """
SELECT qid, doc_id, round(score, 6) AS score FROM scores""")
def j1_sparse_dot(spark, sf):
    idx = _index(spark, sf)
    qvec, small = S.query_vectors(idx, _queries(spark, sf))
    return rounded(S.sparse_dot(idx, qvec, small))


@register("l2_top_documents", _SCORE_SQL + f""",
ranked AS (
  SELECT b.item_id AS qid, d.doc_id, round(coalesce(s.score, 0.0), 6) AS score
  FROM benchmark b CROSS JOIN documents d
  LEFT JOIN scores s ON s.qid = b.item_id AND s.doc_id = d.doc_id)
SELECT qid, doc_id, score, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS INTEGER)
             AS rank
      FROM ranked)
WHERE rank <= {TOP_K}""")
def l2_top_documents(spark, sf):
    return S.top_documents(_index(spark, sf), _queries(spark, sf), k=TOP_K)


@register("l2_pruned_top_documents", ORACLE["l2_top_documents"])
def l2_pruned_top_documents(spark, sf):
    """L2 through block postings with largest weights: documents that cannot enter
    the top k are not scored."""
    return P.top_documents(P.build_blocks(_index(spark, sf)), _queries(spark, sf), k=TOP_K)


@register("j2_top_documents_with_text", _SCORE_SQL + f""",
ranked AS (
  SELECT b.item_id AS qid, d.doc_id, round(coalesce(s.score, 0.0), 6) AS score
  FROM benchmark b CROSS JOIN documents d
  LEFT JOIN scores s ON s.qid = b.item_id AND s.doc_id = d.doc_id),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS INTEGER)
               AS rank
        FROM ranked QUALIFY rank <= {TOP_K})
SELECT top.qid, top.doc_id, top.score, top.rank, CAST(length(documents.text) AS INTEGER) AS content_chars,
       md5(documents.text) AS content_md5
FROM top JOIN documents USING (doc_id)""")
def j2_top_documents_with_text(spark, sf):
    """Top-k with each document's whole text attached (checked by its
    length and MD5)."""
    docs = table(spark, sf, "documents")
    top = S.attach_content(S.top_documents(_index(spark, sf), _queries(spark, sf), k=TOP_K), docs)
    return top.select("qid", "doc_id", "score", "rank",
                      F.length("content").alias("content_chars"),
                      F.md5("content").alias("content_md5"))


@register("x2_keywords", """
SELECT doc_id,
       CAST(CASE WHEN n = 0 THEN 1 ELSE n END AS INT) AS n_keywords
FROM (SELECT doc_id,
             len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'),
                             lambda w: length(w) >= 4)) AS n
      FROM documents)""")
def x2_keywords(spark, sf):
    """X2 over whole document texts: number of keywords per document (the
    whole text counts as one when no word is long enough)."""
    from relaywatch.functions.text import keywords
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.size(keywords("text")).alias("n_keywords"))
