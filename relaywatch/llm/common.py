"""Shared helpers: work folders, document frames, range shards, row keys."""

from __future__ import annotations

import ctypes
import math
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.session import ensure_checkpoint_dir

ID, TEXT, SHARD = "doc_id", "text", "shard"
LAST = np.iinfo(np.int64).max  # a null doc_id sorts after every other


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies on their path, whatever
    folder the session was started in (a cluster job gives it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pairs_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text); a null text becomes empty. Other columns, whatever
    their names, do not take part."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(ID),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(TEXT))


def row_key(df: DataFrame, columns: list[str] | None = None) -> Column:
    """64-bit key of a whole row; null and empty values differ."""
    cols = [F.col(f"`{c}`") for c in (columns or sorted(df.columns))]
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cols])
    return F.xxhash64(nulls, *cols)


def carried(docs: DataFrame, id_col: str) -> DataFrame:
    """Whole rows as a struct ``c_row``, with ``c_id`` and ``c_key``: whatever the
    columns of ``docs`` are called, joins find no name twice."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("c_row"),
                       F.col(f"`{id_col}`").cast("long").alias("c_id"), row_key(docs).alias("c_key"))


def semi_rows(docs: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (k_id, k_row, n_same), one row for
    each row of ``kept``; ``n_same`` is how many identical rows ``docs`` has."""
    rows = carried(docs, id_col)
    on = (F.col("c_key") == F.col("k_row")) & F.col("c_id").eqNullSafe(F.col("k_id"))
    once = rows.join(kept.filter("n_same = 1"), on, "left_semi")
    more = rows.join(kept.filter("n_same > 1"), on, "left_semi").dropDuplicates(["c_key", "c_id"])
    return once.unionByName(more).select("c_row.*")


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and text bytes of an (id, text) frame."""
    r = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(TEXT))).first()
    return int(r[0]), int(r[1] or 0)


def range_shards(df: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """Add ``shard``: consecutive ranges of doc_id with about ``shard_bytes`` of
    text each, so a document in a lower shard has a smaller doc_id. Rows of one
    doc_id share a shard; null ids go to the last."""
    n_rows, total = size_of(df)
    n = max(1, math.ceil(total / shard_bytes))
    bounds: list[int] = []
    if n > 1:
        cuts = [i / n for i in range(1, n)]
        got = df.agg(F.percentile_approx(ID, cuts, max(10_000, 20 * n))).first()[0]
        bounds = sorted(set(got or []))
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def shard_of(ids):
        import pandas as pd
        known = ids.fillna(LAST).astype("int64") if ids.isna().any() else ids
        return pd.Series(np.searchsorted(edges, known.to_numpy("int64"), "left").astype("int32"))

    # Nulls would turn the ids into floats: they are dealt with before the UDF.
    return df.withColumn(SHARD, shard_of(F.coalesce(F.col(ID), F.lit(int(LAST))))), len(bounds) + 1


def tidy() -> None:
    """Give freed memory back to the system between groups: a worker lives on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


class Docs:
    """The documents of one shard in ascending doc_id order, as one byte buffer."""

    def __init__(self, table: pa.Table):
        ids = pc.fill_null(table.column(ID), pa.scalar(int(LAST), pa.int64()))
        t = pa.table({"i": ids, "t": table.column(TEXT)})
        order = pc.sort_indices(t, sort_keys=[("i", "ascending"), ("t", "ascending")])
        t = t.take(order).combine_chunks()
        self.raw_ids = table.column(ID).take(order).combine_chunks()
        self.ids = t.column("i").to_numpy()
        text = t.column("t").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks != 1 else text.chunk(0)
        self.text = text
        wide = pa.types.is_large_string(text.type)
        offs = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)
        offs = offs[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = text.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.buf = buf[offs[0]:offs[-1]]
        self.offs = offs - offs[0]

    def __len__(self) -> int:
        return len(self.ids)


def words_of(docs: Docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words ``[^\\x20\\x09-\\x0D]+`` and the first
    word number of each document (with the total at the end)."""
    buf, offs = docs.buf, docs.offs
    word = (buf != 32) & ((buf < 9) | (buf > 13))
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = offs[(offs > 0) & (offs < len(buf))]  # a document's end ends a word
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of SplitMix64 (public constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack_sorted(h: np.ndarray) -> bytes:
    """Ascending uint64 values as byte planes of their differences."""
    d = np.diff(h, prepend=np.uint64(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(d, dtype=np.uint64)


def bucket_edges(h: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal hash ranges starts in the ascending ``h``."""
    step = (1 << 64) // n + 1
    cuts = np.array([min(i * step, (1 << 64) - 1) for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(h, cuts), [len(h)]])
