"""TF-IDF document search.

Index over a corpus ``(doc_id, text)``:

- ``terms``   (doc_id, token, tf)  term counts, computed once and written as a
                                   table bucketed by doc_id: the texts are dealt
                                   by doc_id, so only they are shuffled, and what
                                   is added up per document later needs no shuffle
- ``idf``     (token, df, idf)     smoothed ``ln((1+N)/(1+df)) + 1``
- ``norms``   (doc_id, norm)       L2 norm of the tf*idf vector
- ``weights`` (doc_id, token, wn)  tf*idf / norm

Terms meet their idf in two parts: the most frequent tokens, as many as may be
broadcast, where the terms are; the terms of all other tokens (few each) in a
shuffle join. Both parts together are all terms.

Search with queries ``(qid, text)``: query tokens outside the vocabulary are
dropped before the query norm; ``score(q, d) = sum_t qn(q,t) * wn(d,t)``.
The query vectors are broadcast only after a row-count check (they grow with
the number of queries); beyond the limit the join is a shuffle join and AQE
splits skewed (common) tokens. Only the terms of query tokens are weighted; the
per-(query, doc) sum after the broadcast join runs on the buckets, and top-k uses
a WindowGroupLimit that ships at most k rows per query from each partition: the
(query, doc) pairs themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaywatch.functions.text import tokenize
from relaywatch.session import work_dir

# Query-vector rows (qid, token) and their token bytes above which they are not
# broadcast but joined by shuffle.
MAX_BROADCAST_QUERY_TOKENS, MAX_BROADCAST_QUERY_BYTES = 500_000, 16 << 20
# Tokens of the vocabulary, and their bytes, that are broadcast with their idf.
MAX_BROADCAST_TOKENS, MAX_BROADCAST_TOKEN_BYTES = 200_000, 8 << 20
# Text bytes in a bucket of the term table, and the number of buckets at most.
BUCKET_BYTES, MAX_BUCKETS = 16 << 20, 50_000
# Results of a search up to which their texts are picked by a broadcast of their ids.
MAX_BROADCAST_RESULTS = 500_000


@dataclass
class TfidfIndex:
    docs: DataFrame     # (doc_id) the corpus, for corpus size and fillers
    terms: DataFrame    # (doc_id, token, tf)
    idf: DataFrame      # (token, df, idf)
    norms: DataFrame    # (doc_id, norm)
    weights: DataFrame  # (doc_id, token, wn)
    null_ids: bool = False  # some row has no doc_id: joins by it are null-safe


def token_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per token occurrence (whole texts, no prefix)."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.explode(tokenize(text_col)).alias("token"))


def term_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A10: ``(doc_id, token, tf)``. A document's occurrences sit in one
    input row, so the partial aggregate is already complete per task."""
    return (token_occurrences(docs, id_col, text_col)
            .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf")))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_tokens: int = MAX_BROADCAST_TOKENS) -> TfidfIndex:
    """Build the index. The term table is computed in one pass over the
    texts and written as Parquet under the shared checkpoint folder (lineage
    is cut, it survives executor loss, later reads are columnar and pruned);
    norms and weights stay lazy. ``docs`` keeps every row: empty documents
    count toward N, as in the reference. ``max_tokens``: the tokens that may be
    broadcast."""
    spark = docs.sparkSession
    corpus = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    path = work_dir(spark, "tfidf-terms")
    n_docs, size, null_ids = corpus.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.count_if(F.col("doc_id").isNull())).first()
    parts = min(MAX_BUCKETS, max(1, math.ceil(size / BUCKET_BYTES)))
    terms = _bucketed(term_frequency(corpus.repartition(parts, "doc_id")), parts, path)
    df = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = df.withColumn("idf", F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df")))
                        + 1.0)
    idf.write.mode("overwrite").parquet(f"{path}-idf")  # one aggregation for all its uses
    idf = spark.read.schema(idf.schema).parquet(f"{path}-idf")
    weighted = _weighted(terms, idf, max_tokens)
    squares = _union([w.select("doc_id", (F.col("w") * F.col("w")).alias("w2")) for w in weighted])
    norms = squares.groupBy("doc_id").agg(F.sqrt(F.sum("w2")).alias("norm"))
    weights = _union([_per_norm(w, norms, "w", "wn", bool(null_ids)).select("doc_id", "token", "wn")
                      for w in weighted])
    return TfidfIndex(corpus.select("doc_id"), terms, idf, norms, weights, bool(null_ids))


def _bucketed(rows: DataFrame, buckets: int, path: str) -> DataFrame:
    """``rows`` written as a table bucketed and sorted by doc_id, and read back."""
    name = _table_of(path)
    (rows.write.mode("overwrite").bucketBy(buckets, "doc_id").sortBy("doc_id")
     .option("path", path).saveAsTable(name))
    return rows.sparkSession.table(name)


def _weighted(terms: DataFrame, idf: DataFrame, max_tokens: int) -> list[DataFrame]:
    """(doc_id, token, w) with w = tf*idf of all terms: those of the most frequent
    tokens, whose idf is broadcast (the terms keep their buckets), and the others.

    The least document frequency of the first part comes from a histogram, so the
    driver gets a few hundred rows at most.
    """
    steps = (idf.groupBy(F.floor(F.log2("df") * 8).alias("step"))
             .agg(F.min("df").alias("least"), F.count(F.lit(1)).alias("tokens"),
                  F.sum(F.octet_length("token") + 16).alias("size"))
             .orderBy(F.col("step").desc()).collect())
    least, tokens, size = None, 0, 0
    for s in steps:
        tokens, size = tokens + s.tokens, size + s.size
        if tokens > max_tokens or size > MAX_BROADCAST_TOKEN_BYTES:
            break
        least = s.least
    weight = (F.col("tf") * F.col("idf")).alias("w")
    known = idf.select("token", "idf", "df")
    parts = []
    rest = terms
    if least is not None:
        often = F.broadcast(known.filter(F.col("df") >= least))
        parts.append(terms.join(often, "token").select("doc_id", "token", weight))
        rest, known = terms.join(often, "token", "left_anti"), known.filter(F.col("df") < least)
    if not parts or least > steps[-1].least:
        parts.append(rest.join(known, "token").select("doc_id", "token", weight))
    return parts


def _union(parts: list[DataFrame]) -> DataFrame:
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _per_norm(rows: DataFrame, norms: DataFrame, value: str, out: str, null_ids: bool) -> DataFrame:
    """``rows`` with ``value`` over the document's norm as ``out``. Rows in doc_id's
    buckets stay where they are: one norm per document is dealt to them."""
    n = norms.hint("shuffle_hash")
    if null_ids:
        n = n.withColumnRenamed("doc_id", "_id")
        joined = rows.join(n, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    else:
        joined = rows.join(n, "doc_id")
    return joined.withColumn(out, F.col(value) / F.col("norm"))


def query_vectors(index: TfidfIndex, queries: DataFrame, id_col: str = "qid",
                  text_col: str = "text",
                  max_broadcast: int = MAX_BROADCAST_QUERY_TOKENS) -> tuple[DataFrame, bool]:
    """``(qid, token, qn)``: normalised tf*idf query weights; tokens outside
    the vocabulary are dropped before the norm.

    Returns the vectors and whether they are small enough to broadcast. The
    check counts the query-side term rows (bounded by ``max_broadcast`` + 1)
    and their bytes, which bounds the vectors too, so no corpus pass is
    triggered.
    """
    occ = queries.select(F.col(id_col).alias("qid"), F.explode(tokenize(text_col)).alias("token"))
    qtf = occ.groupBy("qid", "token").agg(F.count(F.lit(1)).alias("qtf"))
    rows, size = qtf.limit(max_broadcast + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()
    small = rows <= max_broadcast and size <= MAX_BROADCAST_QUERY_BYTES
    known = index.idf.select("token", "idf").join(F.broadcast(qtf) if small else qtf, "token")
    qw = F.col("qtf") * F.col("idf")
    qnorm = F.sqrt(F.sum(qw * qw).over(Window.partitionBy("qid")))
    return known.select("qid", "token", (qw / qnorm).alias("qn")), small


def sparse_dot(index: TfidfIndex, qvec: DataFrame, broadcast_queries: bool) -> DataFrame:
    """Cosine score of every (query, document) pair sharing a token."""
    dot = F.sum(F.col("wn") * F.col("qn"))
    if index.terms is None:  # a loaded index: its weights are stored
        q = F.broadcast(qvec) if broadcast_queries else qvec
        return index.weights.join(q, "token").groupBy("qid", "doc_id").agg(dot.alias("score"))
    # Only the terms of query tokens are weighted; the norm is divided out of the sum.
    idf = index.idf.select("token", "idf")
    q = idf.join(F.broadcast(qvec) if broadcast_queries else qvec, "token").select(
        "qid", "token", (F.col("qn") * F.col("idf")).alias("qw"))
    sums = (index.terms.join(F.broadcast(q) if broadcast_queries else q, "token")
            .groupBy("qid", "doc_id").agg(F.sum(F.col("tf") * F.col("qw")).alias("dot")))
    return _per_norm(sums, index.norms, "dot", "score", index.null_ids).select(
        "qid", "doc_id", "score")


def top_documents(index: TfidfIndex, queries: DataFrame, k: int = 1, id_col: str = "qid",
                  text_col: str = "text", places: int = 6,
                  max_broadcast: int = MAX_BROADCAST_QUERY_TOKENS) -> DataFrame:
    """J2 + L2 + W6: the ``k`` best documents per query, score descending,
    ties by doc_id. When fewer than ``k`` documents share a token with the
    query (or none do), zero-score documents fill up in doc_id order.

    Scores are rounded to ``places`` before ranking so ties are stable.
    """
    qvec, small = query_vectors(index, queries, id_col, text_col, max_broadcast)
    scored = sparse_dot(index, qvec, small).withColumn("score", F.round("score", places))
    return ranked(index, scored, queries, k, id_col)


def ranked(index: TfidfIndex, scored: DataFrame, queries: DataFrame, k: int,
           id_col: str = "qid") -> DataFrame:
    """The ``k`` best of scored (qid, doc_id, score) pairs per query, filled up
    with zero-score documents in doc_id order."""
    rank = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("doc_id"))
    best = scored.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    # Fillers: the k lowest doc ids, each at score 0, for every query.
    first_k = (index.docs.orderBy("doc_id").limit(k)
               .agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).scalar())
    filler = queries.select(F.col(id_col).alias("qid"),
                            F.explode(first_k).alias("doc_id"), F.lit(0.0).alias("score"))
    cand = (best.drop("rank").unionByName(filler)
            .groupBy("qid", "doc_id").agg(F.max("score").alias("score")))
    return (cand.withColumn("rank", F.row_number().over(rank))
            .filter(F.col("rank") <= k))


def attach_content(top: DataFrame, docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Add each result's document text. The results are written first (k rows
    per query); their ids are broadcast when few, so the texts are read once and
    only those of results are shuffled."""
    spark = top.sparkSession
    path = work_dir(spark, "top-documents")
    top.write.mode("overwrite").parquet(path)
    top = spark.read.schema(top.schema).parquet(path)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("content"))
    if top.count() <= MAX_BROADCAST_RESULTS:
        texts = texts.join(F.broadcast(top.select("doc_id").distinct()), "doc_id", "left_semi")
    return top.join(texts, "doc_id", "left")


def save_index(index: TfidfIndex, path: str, buckets: int) -> None:
    """Persist an index under ``path`` (a shared folder) for later searches.

    ``weights`` is written as files bucketed and sorted by doc_id, so a
    later search reads it with its doc_id partitioning (the per-(query, doc)
    sum still needs no shuffle); ``idf`` and the document ids are plain
    Parquet. ``buckets`` sets the weights' partition count (size it to about
    256 MB per bucket). The table's name in the session is derived from the
    path, so two indexes never share one.
    """
    spark = index.weights.sparkSession
    name = _table_of(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (index.weights.repartition(buckets, "doc_id").write.mode("overwrite")
     .bucketBy(buckets, "doc_id").sortBy("doc_id").option("path", f"{path}/weights")
     .saveAsTable(name))
    index.idf.write.mode("overwrite").parquet(f"{path}/idf")
    index.norms.write.mode("overwrite").parquet(f"{path}/norms")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs")
    kind = index.weights.schema["doc_id"].dataType.simpleString()
    spark.createDataFrame([(buckets, kind)], "buckets int, id_type string").write.mode(
        "overwrite").parquet(f"{path}/meta")


def _table_of(path: str) -> str:
    return "tfidf_weights_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def load_index(spark, path: str) -> TfidfIndex:
    """Re-attach an index written by ``save_index`` (also from a new session: the
    bucketed weights table is declared over its files, with its own id type)."""
    meta = spark.read.parquet(f"{path}/meta").first()
    table = _table_of(path)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} (doc_id {meta['id_type']}, token STRING, wn DOUBLE) "
                  f"USING parquet CLUSTERED BY (doc_id) SORTED BY (doc_id) "
                  f"INTO {meta['buckets']} BUCKETS LOCATION '{path}/weights'")
    idf = spark.read.parquet(f"{path}/idf")
    return TfidfIndex(spark.read.parquet(f"{path}/docs"), None, idf,
                      spark.read.parquet(f"{path}/norms"), spark.table(table))
