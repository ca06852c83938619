"""Ranked lexical search, term at a time with limited accumulators (operator 11).

The index is a table of segments. A task reads whole texts, counts the terms of
each document and writes a segment whenever about ``segment_bytes`` of text are
gathered: one row per term (ordinals of its documents, its occurrences there) and
one header row (empty term) with the doc_ids and term counts of the segment. No
text and no posting is shuffled to build it, and a lost task is run again alone.

A search reads the query set in blocks of at most ``BLOCK_BYTES`` of terms. The
postings of a block's terms are dealt by segment, and each segment is ranked by
itself: a query's terms are taken rarest first; every document of a term gets an
accumulator until the largest scores that the remaining terms can still give add
up to less than the kth best partial score so far. From then on no accumulator is
created, since a new document could not reach the k best, and the ones that exist
go on to be updated, so that scores are exact. The k best of a segment are merged
by a window per query that keeps k rows per task before it shuffles.

A score is a sum of ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` with the
weights and lengths of ``weights`` and ``scored``; all but the logarithm is 64-bit
integer arithmetic.

Null and empty texts have no term: they count neither for N nor for L and are in
no result, and a query without terms has none. Equal scores rank by ascending
doc_id, a null doc_id last; rows that share a doc_id are ranked one by one, also
when they are equal. Queries that share an id are ranked one by one. A text longer
than ``segment_bytes`` makes a segment of its own. Other columns, whatever their
names, take no part. An empty table of documents or queries gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaywatch.llm import common as C

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # in UTF-8: every character but the other ASCII ones
SEGMENT_BYTES, SEGMENT_DOCS = 8 << 20, 1 << 18
BLOCK_BYTES = 4 << 20  # terms of the queries that are searched together

INDEX = ("segment long, term string, n_docs long, n_terms long, doc_ids array<long>, "
         "at array<int>, counts array<int>")


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all non-ASCII characters; only
    A-Z are lower-cased."""
    return TERM.findall(text.lower())


class Segment:
    """Postings of some documents, gathered in arrays."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list = []
        self.lengths = array("i")
        self.term, self.tf = array("i"), array("i")
        self.sizes = array("i")  # distinct terms of each document
        self.bytes = 0

    def add(self, doc_id, text: bytes) -> None:
        words = terms_of(text)
        counts = Counter(words)
        number = self.vocabulary
        for t in counts:
            self.term.append(number.setdefault(t, len(number)))
        self.tf.extend(counts.values())
        self.sizes.append(len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.bytes += len(text)

    def full(self, most: int) -> bool:
        return self.bytes >= most or len(self.ids) >= SEGMENT_DOCS

    def table(self, number: int) -> pa.RecordBatch:
        """The header row and the term rows, in order of the terms."""
        words = sorted(self.vocabulary)
        rank = np.empty(len(words), np.int32)
        rank[[self.vocabulary[t] for t in words]] = np.arange(len(words), dtype=np.int32)
        term = rank[np.array(self.term, np.int32)] if words else np.zeros(0, np.int32)
        tf = np.array(self.tf, np.int32) if words else np.zeros(0, np.int32)
        at = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.array(self.sizes, np.int32))
        order = np.argsort(term, kind="stable")
        df = np.bincount(term, minlength=len(words))
        total = np.bincount(term, weights=tf, minlength=len(words)).astype(np.int64)
        lengths = np.array(self.lengths, np.int32)
        ends = np.concatenate([[0, 0], np.cumsum(df)]).astype(np.int32)  # no ordinals in the header
        n = len(words) + 1
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, number, np.int64)),
            pa.array([b"", *words], pa.binary()).cast(pa.string()),
            pa.array(np.concatenate([[np.count_nonzero(lengths)], df]).astype(np.int64)),
            pa.array(np.concatenate([[lengths.sum(dtype=np.int64)], total]).astype(np.int64)),
            pa.array([self.ids, *[None] * len(words)], pa.list_(pa.int64())),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(at[order])),
            pa.ListArray.from_arrays(
                pa.array((ends + len(lengths)).astype(np.int32) * (np.arange(n + 1) > 0)).cast(pa.int32()),
                pa.array(np.concatenate([lengths, tf[order]])))],
            names=["segment", "term", "n_docs", "n_terms", "doc_ids", "at", "counts"])


def build_index(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the index of all documents to ``path`` in one pass over the texts
    (``append`` more by building another one and reading both folders)."""
    def index(batches):
        task, n = TaskContext.get().partitionId(), 0
        seg = Segment()
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                seg.add(doc_id, text.as_py())
                if seg.full(segment_bytes):
                    yield seg.table(task << 32 | n)
                    seg, n = Segment(), n + 1
        if seg.ids:
            yield seg.table(task << 32 | n)
        C.tidy()

    spark = docs.sparkSession
    C.pairs_of(docs, id_col, text_col).mapInArrow(index, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def query_terms(queries: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """One row per query (q, query_id, terms): its distinct terms."""
    pairs = queries.select(F.monotonically_increasing_id().alias("q"),
                           F.col(f"`{id_col}`").cast("long").alias("query_id"),
                           F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def split(batches):
        for b in batches:
            found = [sorted(set(terms_of(t.as_py())))
                     for t in b.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [b.column("q"), b.column("query_id"),
                 pa.array([[t.decode() for t in x] for x in found], pa.list_(pa.string()))],
                names=["q", "query_id", "terms"])

    return C.stored(pairs.mapInArrow(split, "q long, query_id long, terms array<string>"),
                    "query-terms")


def weights(index: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(term, df, w) of the wanted terms that the index has:
    w = floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    df = (index.select("term", "n_docs").join(wanted, "term").groupBy("term")
          .agg(F.sum("n_docs").alias("df")))
    return df.withColumn("w", F.floor(F.lit(1000.0) * F.log(
        F.lit(float(2 * n + 2)) / (F.lit(2.0) * F.col("df") + 1.0))).cast("long"))


def limited(terms: list[tuple], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and which documents have an accumulator, of one query in a segment.
    ``terms``: (weight, ordinals, impacts, largest impact), rarest first."""
    acc, made = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    rest = np.cumsum([0, *[w * top for w, _, _, top in reversed(terms)]])[::-1]
    growing = True
    for j, (w, at, impact, _) in enumerate(terms):
        if growing and j:
            live = acc[made]
            # A document without an accumulator can reach rest[j] at most, and an
            # equal score could still win by its doc_id.
            growing = len(live) < k or rest[j] >= np.partition(live, len(live) - k)[len(live) - k]
        if growing:
            made[at] = True
            acc[at] += w * impact
        else:
            old = made[at]
            acc[at[old]] += w * impact[old]
    return acc, made


def best_of(acc: np.ndarray, made: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Ordinals of the k best scores above 0, equal ones by ``order``."""
    found = np.flatnonzero(made & (acc > 0))
    if len(found) > k:
        kth = np.partition(acc[found], len(found) - k)[len(found) - k]
        found = found[acc[found] >= kth]
    return found[np.lexsort((order[found], -acc[found]))][:k]


def search(index: DataFrame, queries: DataFrame, *, k: int = 50, id_col: str = "item_id",
           text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each query: query_id, rank, doc_id, score."""
    asked = query_terms(queries, id_col=id_col, text_col=text_col)
    n, total = index.filter("term = ''").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = int(n or 0), int(total or 0)
    size = asked.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"),
                                       lambda a, t: a + F.octet_length(t) + 32))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    parts = [_block(index, asked.filter(F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == b), n, total, k)
             for b in range(n_blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    place = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k))
    return best.join(asked.select("q", "query_id"), "q").select("query_id", "rank", "doc_id", "score")


def _block(index: DataFrame, asked: DataFrame, n: int, total: int, k: int) -> DataFrame:
    """(q, doc_id, score): the k best of each segment for a bounded block of queries."""
    by_query = asked.select("q", F.explode("terms").alias("term"))
    vocabulary = C.stored(weights(index, by_query.select("term").distinct(), n), "vocabulary")
    # At most a block's terms: they go to every task.
    known = {r.term: (r.df, r.w) for r in vocabulary.collect()}
    plans: dict[int, list[str]] = {}
    for r in by_query.collect():
        if r.term in known:
            plans.setdefault(r.q, []).append(r.term)
    plans = {q: sorted(ts, key=lambda t: (known[t][0], t)) for q, ts in plans.items()}
    weight = {t: w for t, (_, w) in known.items()}

    def rank(key, table):
        names = table.column("term").to_pylist()
        rows = {t: i for i, t in enumerate(names)}
        at, counts = (table.column(c).combine_chunks() for c in ("at", "counts"))
        head = rows.pop("")
        ids = table.column("doc_ids")[head].values
        n_words = counts[head].values.to_numpy()
        m = 50 + (50 * n_words.astype(np.int64) * n) // max(total, 1)
        order = ids.fill_null(C.LAST).to_numpy(zero_copy_only=False)
        postings = {}
        for t, i in rows.items():
            p, tf = at[i].values.to_numpy(), counts[i].values.to_numpy().astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[p])
            postings[t] = (weight[t], p, impact, int(impact.max()))
        out_q, out_at, out_s = [], [], []
        for q, terms in plans.items():
            here = [postings[t] for t in terms if t in postings]
            if here:
                acc, made = limited(here, len(order), k)
                top = best_of(acc, made, order, k)
                out_q.append(np.full(len(top), q, np.int64))
                out_at.append(top)
                out_s.append(acc[top])
        empty = [np.zeros(0, np.int64)]
        return pa.table({"q": np.concatenate(out_q or empty),
                         "doc_id": ids.take(pa.array(np.concatenate(out_at or empty))),
                         "score": np.concatenate(out_s or empty)})

    columns = ["segment", "term", "doc_ids", "at", "counts"]
    held = index.select(*columns).join(
        F.broadcast(vocabulary.select("term").unionByName(
            asked.sparkSession.createDataFrame([("",)], "term string"))), "term", "left_semi")
    return held.groupBy("segment").applyInArrow(rank, "q long, doc_id long, score long")
