"""Top-k search without scoring every sharing pair (J1, L2): an inverted index in
blocks that know their largest weights.

The index keeps, for each block of documents and token, the block's postings
(doc_id, weight), numbered with the largest weight first. A search bounds what a
query can score before it scores anything:

1. The postings lists with the largest possible contributions give each query
   ``k`` documents; their full scores give a threshold that the k-th best document
   reaches at least.
2. In every block, a query's tokens are ordered by ``query weight * largest weight
   in the block``. The weakest of them, as long as these products add up to less than
   ``SHARE`` of the threshold, are left aside: what they can add to a document is
   known without reading their postings. A block with no other token is left out
   whole. The postings of the other tokens give each of their documents a partial
   score; with what the tokens left aside can add, it has to reach the threshold.
3. Only these documents are scored in full, from the same postings.

Steps 2 and 3 run block by block: a block's postings of query tokens meet the
queries' tokens of that block in one task as two matrices of bounded size, so
neither postings nor (query, document) pairs are repeated per query and shuffled.

Blocks are hash classes of doc_id with about ``block_docs`` documents, so a token
that all documents hold has one bounded list per block. The result equals
``search.top_documents`` on the same index: scores are rounded before ranking, so
bounds leave room for a tie after rounding.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaywatch.operators import search as S
from relaywatch.session import work_dir

BLOCK_DOCS = 1024
SHARE = 0.2  # of the threshold: what the tokens left aside may add up to


QUERY_STEP, DOC_STEP = 256, 4096  # queries and documents that a task scores at once


@dataclass
class BlockIndex:
    base: S.TfidfIndex
    postings: DataFrame  # (block, token, doc_id, wn, pos): pos = 1 has the largest wn
    n_blocks: int


def block_of(n_blocks: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")


def build_blocks(index: S.TfidfIndex, block_docs: int = BLOCK_DOCS) -> BlockIndex:
    """Write the block postings of ``index`` once under the shared folder."""
    spark = index.weights.sparkSession
    path = work_dir(spark, "block-index")
    n = max(1, math.ceil(index.docs.count() / block_docs))
    largest = Window.partitionBy("block", "token").orderBy(F.col("wn").desc(), F.col("doc_id").desc())
    postings = (index.weights.filter(F.col("doc_id").isNotNull())
                .select(block_of(n).alias("block"), "token", "doc_id", "wn")
                .withColumn("pos", F.row_number().over(largest)))
    postings.write.mode("overwrite").parquet(path)
    return BlockIndex(index, spark.read.schema(postings.schema).parquet(path), n)


def _asked(rows: DataFrame, qvec: DataFrame, broadcast_queries: bool) -> DataFrame:
    """The ``rows`` of the queries' tokens."""
    tokens = qvec.select("token").distinct()
    return rows.join(F.broadcast(tokens) if broadcast_queries else tokens, "token", "left_semi")


def full_scores(index: BlockIndex, pairs: DataFrame, qvec: DataFrame,
                broadcast_queries: bool = True) -> DataFrame:
    """(qid, doc_id, score) of the given (qid, doc_id) pairs. Of the postings only
    those of the queries' tokens move."""
    q = F.broadcast(qvec) if broadcast_queries else qvec
    return (pairs.join(_asked(index.postings, qvec, broadcast_queries), "doc_id")
            .join(q, ["qid", "token"])
            .groupBy("qid", "doc_id").agg(F.sum(F.col("wn") * F.col("qn")).alias("score")))


def _matrix(shape: tuple[int, int], rows, cols, values) -> np.ndarray:
    m = np.zeros(shape)
    m[rows, cols] = values
    return m


def _score_block(asked: pa.Table, postings: pa.Table) -> pa.Table:
    """(qid, doc_id, score) of a block's documents that may enter the top of a query.

    ``asked``: (qid, token, qn, aside, rest, least), ``postings``: (token, doc_id, wn).
    Postings of other tokens are passed over: the queries that hold them leave this
    block out.
    """
    out = []
    tokens = pc.unique(asked["token"])
    postings = postings.filter(pc.is_in(postings["token"], value_set=tokens))
    qids, docs = asked["qid"].combine_chunks().dictionary_encode("encode"), postings[
        "doc_id"].combine_chunks().dictionary_encode()
    qt = pc.index_in(asked["token"].combine_chunks(), tokens).to_numpy()
    dt = pc.index_in(postings["token"].combine_chunks(), tokens).to_numpy()
    qi, di = qids.indices.to_numpy(), docs.indices.to_numpy()
    qn, wn, aside, rest, least = (c.to_numpy() for c in (
        asked["qn"], postings["wn"], asked["aside"], asked["rest"], asked["least"]))
    for q0 in range(0, len(qids.dictionary), QUERY_STEP):
        of_q = np.flatnonzero((qi >= q0) & (qi < q0 + QUERY_STEP))
        used, local = np.unique(qt[of_q], return_inverse=True)
        n = min(QUERY_STEP, len(qids.dictionary) - q0)
        weights = _matrix((len(used), n), local, qi[of_q] - q0, qn[of_q])
        read = _matrix((len(used), n), local, qi[of_q] - q0, np.where(aside[of_q], 0.0, qn[of_q]))
        may, need = np.zeros(n), np.zeros(n)
        may[qi[of_q] - q0], need[qi[of_q] - q0] = rest[of_q], least[of_q]
        place = np.full(len(tokens), -1)
        place[used] = np.arange(len(used))
        for d0 in range(0, len(docs.dictionary), DOC_STEP):
            of_d = np.flatnonzero((di >= d0) & (di < d0 + DOC_STEP) & (place[dt] >= 0))
            m = min(DOC_STEP, len(docs.dictionary) - d0)
            held = _matrix((m, len(used)), di[of_d] - d0, place[dt[of_d]], wn[of_d])
            part = held @ read
            found = (part > 0) & (part + may >= need)
            for q in np.flatnonzero(found.any(axis=0)):
                d = np.flatnonzero(found[:, q])
                out.append((np.full(len(d), q + q0), d + d0, held[d] @ weights[:, q]))
    q, d, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 3
    return pa.table({"qid": qids.dictionary.take(pa.array(q)), "doc_id": docs.dictionary.take(pa.array(d)),
                     "score": pa.array(score, pa.float64())})


def scored(index: BlockIndex, qvec: DataFrame, k: int, places: int = 6,
           broadcast_queries: bool = True) -> DataFrame:
    """(qid, doc_id, score), each pair once, of the documents that may enter the top
    ``k`` of a query."""
    spark = qvec.sparkSession
    q = F.broadcast(qvec) if broadcast_queries else qvec
    path = work_dir(spark, "block-hits")
    bound = F.col("qn") * F.col("wn")
    (index.postings.filter("pos = 1").select("block", "token", "wn").join(q, "token")
     .select("block", "qid", "token", "qn", bound.alias("bound")).write.mode("overwrite").parquet(path))
    hits = spark.read.parquet(path)

    # 1. Documents at the head of the k lists with the largest contributions.
    strongest = Window.partitionBy("qid").orderBy(F.col("bound").desc(), "block", "token")
    firsts = hits.withColumn("r", F.row_number().over(strongest)).filter(F.col("r") <= max(k, 8))
    heads = _asked(index.postings.filter(F.col("pos") <= k).select("block", "token", "doc_id"), qvec,
                   broadcast_queries)
    seeds = firsts.join(heads, ["block", "token"]).select("qid", "doc_id").distinct()
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id")
    threshold = (full_scores(index, seeds, qvec, broadcast_queries)
                 .withColumn("r", F.row_number().over(best))
                 .filter(F.col("r") == k).select("qid", F.col("score").alias("least")))

    # 2. Tokens left aside in each block. Room for ties after rounding on both sides.
    weakest = Window.partitionBy("qid", "block").orderBy("bound", "token")
    slack = 2.0 * 10.0 ** -places
    least = F.coalesce(F.col("least"), F.lit(0.0)) - slack
    ranked = (hits.withColumn("reach", F.sum("bound").over(
        weakest.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(threshold, "qid", "left").withColumn("least", least))
    aside = F.col("reach") < SHARE * F.col("least")
    in_block = Window.partitionBy("qid", "block")
    asked = (ranked.withColumn("rest", F.coalesce(F.max(F.when(aside, F.col("reach"))).over(in_block),
                                                  F.lit(0.0)))
             .withColumn("aside", aside)
             .withColumn("read", F.max((~aside).cast("int")).over(in_block)).filter("read = 1")
             .select("block", "qid", "token", "qn", "aside", "rest", "least"))

    # 3. Block by block: partial scores of all documents, full ones of the candidates.
    lists = _asked(index.postings, qvec, broadcast_queries).select("block", "token", "doc_id", "wn")
    types = {f.name: f.dataType.simpleString() for f in [*qvec.schema, *lists.schema]}
    return (asked.groupBy("block").cogroup(lists.groupBy("block"))
            .applyInArrow(_score_block,
                          f"qid {types['qid']}, doc_id {types['doc_id']}, score double"))


def candidates(index: BlockIndex, qvec: DataFrame, k: int, places: int = 6,
               broadcast_queries: bool = True) -> DataFrame:
    """(qid, doc_id), each once, that may enter the top ``k`` of their query."""
    return scored(index, qvec, k, places, broadcast_queries).select("qid", "doc_id")


def top_documents(index: BlockIndex, queries: DataFrame, k: int = 1, id_col: str = "qid",
                  text_col: str = "text", places: int = 6) -> DataFrame:
    """L2 + W6: the ``k`` best documents per query, as ``search.top_documents``."""
    spark = queries.sparkSession
    qvec, small = S.query_vectors(index.base, queries, id_col, text_col)
    path = work_dir(spark, "query-vectors")
    qvec.write.mode("overwrite").parquet(path)
    qvec = spark.read.schema(qvec.schema).parquet(path)
    found = scored(index, qvec, k, places, small).withColumn("score", F.round("score", places))
    return S.ranked(index.base, found, queries, k, id_col)
