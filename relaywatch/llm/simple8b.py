"""Token-id files in Simple-8b word-aligned coding (operator 10).

A segment is the file of one shard: consecutive documents in ascending doc_id
order. All integers are little-endian.

    header   8 bytes ``S8B1`` + version 1, 0, 0, 0
             int64 n_docs, n_ids, n_words, n_escapes
    docs     int64[n_docs] ids of each document
    blocks   int64[ceil(n_ids / BLOCK)] first word of each block of BLOCK ids
    escapes  uint64[n_escapes] values too wide for a word
    words    uint64[n_words]

A word holds a selector in its top four bits and that selector's number of
equally wide values below, first value lowest. The table is fixed: selectors 1
to 15 hold 240 zeros, then 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2 and 1
values of 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30 and 60 bits; selector 0 is
an escape, whose low bits number an entry of ``escapes``. A block starts a new
word; its last word may be filled up with zeros. Since every block has its
first word on record, blocks decode on their own, and whole segments decode
selector by selector without a loop over words.

Null texts count as empty; a document always ends with the end id, so none is
without ids. Rows that share a doc_id stay apart, in the order of their texts;
a null doc_id comes last. Texts of any length are encoded whole; other columns,
whatever their names, take no part; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaywatch.llm import common as C

MAGIC = b"S8B1\x01\x00\x00\x00"
BLOCK = 8192
SHARD_BYTES = 6 << 20
CHUNK = 32  # blocks packed or unpacked at a time
# Fixed values of the format, by selector from 1 on.
COUNTS = (240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_COUNT = np.array((1, *COUNTS))
_WIDTH = np.array((60, *WIDTHS))


def _all_of(ok: np.ndarray, n: int) -> np.ndarray:
    """Whether ``ok`` holds for each position and the n - 1 behind it."""
    out, have = ok.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:, :-step] &= out[:, step:]
        have += step
    return out


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escaped values) of unsigned integers."""
    words, blocks, escapes, n_words, n_escapes = [], [], [], 0, 0
    for at in range(0, len(values), CHUNK * BLOCK):
        w, b, e = _pack(values[at:at + CHUNK * BLOCK])
        if n_escapes and len(e):
            w = np.where(w >> np.uint64(60) == 0, w + np.uint64(n_escapes), w)
        words, blocks, escapes = [*words, w], [*blocks, b + n_words], [*escapes, e]
        n_words, n_escapes = n_words + len(w), n_escapes + len(e)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(words, np.uint64), join(blocks, np.int64), join(escapes, np.uint64)


def _pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = np.asarray(values, np.uint64)
    n = len(values)
    rows = -(-n // BLOCK)
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    v = np.zeros((rows, BLOCK + COUNTS[0]), np.uint64)  # zeros behind each block
    body = np.zeros(rows * BLOCK, np.uint64)
    body[:n] = values
    v[:, :BLOCK] = body.reshape(rows, BLOCK)
    sel = np.zeros(v.shape, np.int8)
    most = int(values.max())
    for s in range(15, 0, -1):  # the most values that fit
        ok = v < (np.uint64(1) << np.uint64(WIDTHS[s - 1]))
        if s < 13 and most >> WIDTHS[s - 1] and not ok[:, :BLOCK].any():
            break
        fit = _all_of(ok, COUNTS[s - 1])
        sel[fit] = s
        if not fit.any():
            break
    length = np.minimum(BLOCK, n - np.arange(rows) * BLOCK)
    pos, live, found = np.zeros(rows, np.int64), np.arange(rows), []
    while len(live):  # all blocks in step
        p = pos[live]
        s = sel[live, p]
        found.append((live, p, s))
        pos[live] = p + _COUNT[s]
        live = live[pos[live] < length[live]]
    row = np.concatenate([f[0] for f in found])
    at = np.concatenate([f[1] for f in found])
    s = np.concatenate([f[2] for f in found]).astype(np.int64)
    order = np.argsort(row * (BLOCK + 1) + at)
    row, at, s = row[order], at[order], s[order]
    words = s.astype(np.uint64) << np.uint64(60)
    flat, base = v.ravel(), row * v.shape[1] + at
    for k in range(2, 16):
        here = np.flatnonzero(s == k)
        for j in range(_COUNT[k] if len(here) else 0):
            words[here] |= flat[base[here] + j] << np.uint64(j * _WIDTH[k])
    wide = np.flatnonzero(s == 0)
    words[wide] = np.arange(len(wide), dtype=np.uint64)
    return words, np.searchsorted(row, np.arange(rows)), flat[base[wide]]


def unpack(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values; some blocks at a time, and of these all words of one
    selector at a time."""
    out = np.zeros(n, np.uint64)
    ends = np.append(blocks[1:], len(words))
    for at in range(0, len(blocks), CHUNK):
        some = blocks[at:at + CHUNK]
        lo, hi = at * BLOCK, min(n, (at + CHUNK) * BLOCK)
        part = words[some[0]:ends[min(at + CHUNK, len(blocks)) - 1]]
        out[lo:hi] = _unpack(part, some - some[0], escapes, hi - lo)
    return out


def _unpack(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    rows = len(blocks)
    out = np.zeros((rows, BLOCK + COUNTS[0]), np.uint64)
    s = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[s]
    before = np.cumsum(count) - count
    row = np.searchsorted(blocks, np.arange(len(words)), "right") - 1
    at = row * out.shape[1] + before - before[blocks[row]] if rows else before
    flat = out.ravel()
    for k in range(2, 16):
        here = np.flatnonzero(s == k)
        w, p, mask = words[here], at[here], np.uint64((1 << int(_WIDTH[k])) - 1)
        for j in range(_COUNT[k] if len(here) else 0):
            flat[p + j] = (w >> np.uint64(j * _WIDTH[k])) & mask
    wide = np.flatnonzero(s == 0)
    flat[at[wide]] = escapes[(words[wide] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:, :BLOCK].ravel()[:n]


def segment(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """The file of one shard."""
    words, blocks, escapes = pack(ids)
    head = struct.pack("<4q", len(sizes), len(ids), len(words), len(escapes))
    return b"".join([MAGIC, head, sizes.astype("<i8").tobytes(), blocks.astype("<i8").tobytes(),
                     escapes.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_segment(b: bytes | memoryview) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each document) of a segment."""
    if b[:8] != MAGIC:
        raise ValueError("not a token-id segment")
    n_docs, n_ids, n_words, n_escapes = struct.unpack("<4q", b[8:40])
    parts, at = [], 40
    for kind, n in (("<i8", n_docs), ("<i8", -(-n_ids // BLOCK)), ("<u8", n_escapes),
                    ("<u8", n_words)):
        parts.append(np.frombuffer(b, kind, n, at))
        at += 8 * n
    sizes, blocks, escapes, words = parts
    return unpack(words, blocks, escapes, n_ids), sizes


SHARD_GROUP = 4096
_SEGMENTS = "shard int, doc_ids array<long>, n_ids long, payload binary"
_ROWS = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"
# Parquet looks at the size of its buffers after 100 rows only, which would be 100
# segments: a row group per segment bounds what a writer or reader holds, and lets
# readers share a file. Payloads are coded already: a second codec would shrink
# them by a few per cent and keep its own buffers beside the heap.
_WRITE = {"parquet.block.row.count.limit": 1, "parquet.enable.dictionary": "false",
          "compression": "none"}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, *,
                      id_col: str = "doc_id", text_col: str = "text",
                      shard_bytes: int = SHARD_BYTES) -> None:
    """Encode whole texts, append ``end_id`` to each document and write one
    segment per doc_id range as a row (shard, doc_ids, n_ids, payload) of a
    Parquet folder, whose commit protocol keeps one copy when tasks are retried.

    The only shuffle deals the texts to the ranges; a task holds one range of
    about ``shard_bytes`` of text (more only for one longer document)."""
    parts, _ = C.range_shards(C.pairs_of(docs, id_col, text_col), shard_bytes)

    def encode(key, table):
        from relaywatch.llm.tokens import loaded
        d = C.Docs(table)
        end = np.array([end_id], "<u4")
        ids, sizes = [], []
        for x in loaded(tokenizer).encode(d.text):
            ids += [x, end]
            sizes.append(len(x) + 1)
        raw_ids, got = d.raw_ids, np.concatenate(ids)
        del d, ids, x
        out = pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(raw_ids)], pa.int32()),
                                                            raw_ids),
                        "n_ids": pa.array([len(got)], pa.int64()),
                        "payload": pa.array([segment(got, np.array(sizes))], pa.binary())})
        del got
        C.tidy()
        return out

    parts.groupBy(C.SHARD).applyInArrow(encode, _SEGMENTS).write.options(**_WRITE).parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document read back from its segment: doc_id, start (ids of
    all documents before it), n_tokens and the CRC-32 of its ids as
    little-endian 32-bit integers."""
    files = spark.read.schema(_SEGMENTS).parquet(path)

    def decode(batches):
        for batch in batches:
            for shard, doc_ids, payload in zip(*(batch.column(c) for c in
                                                 ("shard", "doc_ids", "payload"))):
                ids, sizes = read_segment(memoryview(payload.as_buffer()))
                raw = memoryview(ids.astype("<u4")).cast("B")
                del ids
                end = np.cumsum(sizes)
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(end.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard.as_py()] * len(sizes), pa.int32()),
                    "doc_id": doc_ids.values,
                    "start": pa.array(end - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})
                del raw, sizes, end, crc
                C.tidy()

    # The ids before each shard: within its group of shards, and in the groups
    # before (one row per ``SHARD_GROUP`` shards, so that no task sees all shards).
    per = files.select(F.col("shard").alias("s"), F.col("n_ids"),
                       F.floor(F.col("shard") / SHARD_GROUP).alias("g"))
    groups = per.groupBy("g").agg(F.sum("n_ids").alias("in_group"))
    ahead = groups.select("g", (F.sum("in_group").over(Window.orderBy("g")) - F.col("in_group"))
                          .alias("ahead"))
    inside = F.sum("n_ids").over(Window.partitionBy("g").orderBy("s")) - F.col("n_ids")
    base = per.withColumn("inside", inside).join(ahead, "g").select(
        "s", (F.col("inside") + F.col("ahead")).alias("base"))
    rows = files.select("shard", "doc_ids", "payload").mapInArrow(decode, _ROWS)
    return (rows.join(base, rows.shard == base.s)
            .select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens",
                    "ids_crc32"))
