"""Block postings: the same results as full scoring, for fewer pairs."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relaywatch.operators import pruned as P
from relaywatch.operators import search as S


def corpus(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rnd.choices(words, weight, k=rnd.randint(0, 25)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, docs[3][1]), (n + 3, docs[3][1])]  # ties
    queries = [(q, " ".join(rnd.choices(words, k=6))) for q in range(8)]
    return docs, queries + [(100, "unknown words"), (101, ""), (102, "w59 w58"), (103, docs[3][1])]


@pytest.mark.parametrize("seed,k,block", [(1, 1, 16), (2, 3, 16), (3, 50, 40), (4, 3, 10 ** 6)])
def test_pruned_equals_full_scoring(spark, seed, k, block):
    docs, queries = corpus(seed)
    index = S.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    q = spark.createDataFrame(queries, "qid long, text string")
    full = S.top_documents(index, q, k=k).collect()
    fast = P.top_documents(P.build_blocks(index, block_docs=block), q, k=k).collect()
    assert sorted(map(tuple, (r.asDict().items() for r in fast))) == sorted(
        map(tuple, (r.asDict().items() for r in full)))


def test_fewer_pairs_are_scored(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = S.build_index(docs)
    q = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    qvec, small = S.query_vectors(index, q)
    every = S.sparse_dot(index, qvec, small).count()
    some = P.candidates(P.build_blocks(index, block_docs=64), qvec, 1).count()
    assert 0 < some < 0.5 * every


def test_pairs_are_scored_in_their_block(spark, monkeypatch):
    """Steps of queries and documents give the same pairs; neither the postings nor the
    pairs are shuffled once per query."""
    docs, queries = corpus(7)
    index = S.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    qvec, small = S.query_vectors(index, spark.createDataFrame(queries, "qid long, text string"))
    blocks = P.build_blocks(index, block_docs=80)
    found = P.scored(blocks, qvec, 3, broadcast_queries=small)
    want = {(r.qid, r.doc_id): r.score for r in S.sparse_dot(index, qvec, small).collect()}
    got = {(r.qid, r.doc_id): r.score for r in found.collect()}
    assert got and all(abs(want[p] - x) < 1e-9 for p, x in got.items())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "inline(" not in plan
    asked = pa.table({"qid": [1, 1, 2, 3], "token": list("abba"), "qn": [0.5, 0.5, 1.0, 1.0],
                      "aside": [False, True, False, False], "rest": [0.1, 0.1, 0.0, 0.0],
                      "least": [0.2, 0.2, 0.9, -1.0]})
    lists = pa.table({"token": list("abab"), "doc_id": [10, 10, 11, 12], "wn": [0.4, 0.6, 0.1, 0.9]})
    whole = P._score_block(asked, lists).to_pylist()
    assert {(r["qid"], r["doc_id"]): round(r["score"], 9) for r in whole} == {
        (1, 10): 0.5, (2, 12): 0.9, (3, 10): 0.4, (3, 11): 0.1}
    monkeypatch.setattr(P, "QUERY_STEP", 2)
    monkeypatch.setattr(P, "DOC_STEP", 1)
    steps = P._score_block(asked, lists).to_pylist()
    assert sorted(map(str, steps)) == sorted(map(str, whole))


@pytest.mark.parametrize("block", [8, 10 ** 6])
def test_blocks_that_every_query_of_a_token_leaves_out(spark, block):
    """``alpha`` alone cannot bring a long text near the best ones, so its only query
    leaves most blocks out, though their postings hold it. A query without an id is
    found like any other."""
    docs = [(i, "common " * 40 + f"x{i} alpha") for i in range(60)] + [
        (100 + i, "alpha beta gamma") for i in range(4)]
    index = S.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    q = spark.createDataFrame([(1, "alpha beta gamma"), (2, "x7 x8"), (None, "x9 gamma")],
                              "qid long, text string")
    full = S.top_documents(index, q, k=2).collect()
    fast = P.top_documents(P.build_blocks(index, block_docs=block), q, k=2).collect()
    assert sorted(map(str, fast)) == sorted(map(str, full)) and len(full) == 6


def test_block_without_asked_tokens():
    asked = pa.table({"qid": [1], "token": ["a"], "qn": [0.5], "aside": [False], "rest": [0.0],
                      "least": [0.1]})
    lists = pa.table({"token": ["a", "c"], "doc_id": [10, 11], "wn": [0.4, 0.6]})
    assert P._score_block(asked, lists).to_pylist() == [{"qid": 1, "doc_id": 10, "score": 0.2}]
    assert P._score_block(asked.slice(0, 0), lists).num_rows == 0
    assert P._score_block(asked, lists.slice(0, 0)).num_rows == 0
