"""Substring deduplication by Rabin-Karp window hashes (operator 1).

Every window of ``width`` consecutive words of a document is hashed. A word
covered by a window whose word sequence also starts in a document with a
smaller doc_id is removed; overlapping windows merge into maximal intervals.
Windows are judged on the input, never on what is left.

How it runs: documents are dealt to consecutive doc_id ranges ("shards"). A
shard sends its distinct window hashes, ascending and packed, to hash-range
buckets, so a passage that half of all documents share is sent once per shard.
A bucket finds the first shard of each hash and answers every later shard with
one bit per hash it sent. The shard then settles its own windows: those an
earlier shard has, and those a smaller doc_id of its own has. Texts are
shuffled once (Spark reuses the exchange), hashes once, answers once.

Hashes have 64 bits: a window meets another sequence's hash by chance with a
probability of (distinct windows) / 2**64, that is 1e-6 at 1.6e13 windows
(100 TB) and 1e-11 at the sizes tested here.

Null texts count as empty, documents shorter than a window keep all words,
rows that share a doc_id never remove each other's words, a null doc_id counts
as larger than all others, and an empty table gives no rows. Texts of any length are
taken whole (a shard may be one long text); equal rows each keep their result row;
other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from relaywatch.llm import common as C

WIDTH = 13
SHARD_BYTES, BUCKET_BYTES = 4 << 20, 12 << 20  # text of a shard, of a bucket's windows
STEP = 1 << 20  # bytes hashed at a time

_BYTE = C.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95   # odd; of the word hashes
_ROLL = np.uint64(0xAF251AF3B0F025B5)  # odd; of the windows


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each word ``buf[start:end]``."""
    out = np.zeros(len(start), np.uint64)
    at, power = 0, np.zeros(0, np.uint64)
    while at < len(start):
        lo = int(start[at])
        upto = max(at + 1, int(np.searchsorted(end, lo + STEP, "right")))
        part = buf[lo:int(end[upto - 1])]
        n = len(part)
        if len(power) <= n:
            power = np.cumprod(np.full(n + 1, _BASE, np.uint64), dtype=np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[:n], out=total[1:])
        s, e = start[at:upto] - lo, end[at:upto] - lo
        unit = np.uint64(pow(_BASE, -n, 1 << 64))  # brings all to one power
        out[at:upto] = (total[e] - total[s]) * power[n - s] * unit
        at = upto
    return C.mix64(out)


def window_hashes(words: np.ndarray, first: np.ndarray, width: int):
    """Hash and first word of each window; ``first`` is where documents begin."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words[:n].copy()
    for k in range(1, width):
        h *= _ROLL
        h += words[k:n + k]
    inside = np.zeros(n, bool)
    for a, b in zip(*(x[np.diff(first) >= width] for x in (first[:-1], first[1:]))):
        inside[a:b - width + 1] = True
    at = np.flatnonzero(inside)
    return C.mix64(h[at]), at


def kept_text(d: C.Docs, start, end, first, keep) -> list[bytes]:
    """The kept words of each document, joined by one space."""
    out = np.full(len(d.buf), 32, np.uint8)
    take = np.zeros(len(d.buf) + 1, np.int8)
    ks, ke = start[keep], end[keep]
    take[ks] += 1
    np.add.at(take, ke, -1)
    word = np.cumsum(take[:-1], dtype=np.int8).astype(bool)
    out[word] = d.buf[word]
    doc = np.searchsorted(first, np.flatnonzero(keep), "right") - 1
    inner = np.ones(len(doc), bool)
    inner[1:] = doc[1:] == doc[:-1]
    if len(inner):
        inner[0] = False
    word[ks[inner] - 1] = True  # the byte before a later word is white space
    size = np.concatenate([[0], np.cumsum(word)])
    raw = out[word].tobytes()
    cut = size[d.offs]
    return [raw[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH, shard_bytes: int = SHARD_BYTES,
                   with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, the removed
    word intervals ``spans`` and, ``with_text``, the text that is left."""
    parts, n_shards = C.range_shards(C.pairs_of(docs, id_col, text_col), shard_bytes)
    parts = parts.repartition(C.SHARD)
    n_buckets = max(1, -(-n_shards * shard_bytes // max(shard_bytes, BUCKET_BYTES)))

    def hashed(table):
        C.tidy()
        d = C.Docs(table)
        start, end, first = C.words_of(d)
        h, at = window_hashes(word_hashes(d.buf, start, end), first, width)
        return d, start, end, first, h, at

    def ask(key, table):
        _, _, _, _, h, _ = hashed(table)
        h = np.unique(h)
        cut = C.bucket_edges(h, n_buckets)
        some = [b for b in range(n_buckets) if cut[b + 1] > cut[b]]
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "shard": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "hashes": pa.array([C.pack_sorted(h[cut[b]:cut[b + 1]]) for b in some], pa.binary())})

    def answer(key, table):
        C.tidy()
        table = table.sort_by("shard")
        shards = table.column("shard").to_pylist()
        lists = [C.unpack_sorted(b) for b in table.column("hashes").to_pylist()]
        h = np.concatenate(lists)
        order = np.argsort(h, kind="stable")  # ties stay in shard order
        late = np.zeros(len(h), bool)
        late[order[1:]] = h[order[1:]] == h[order[:-1]]
        ends = np.cumsum([len(x) for x in lists])
        rows = [(s, np.packbits(late[e - len(x):e]).tobytes())
                for s, x, e in zip(shards, lists, ends) if late[e - len(x):e].any()]
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "shard": pa.array([r[0] for r in rows], pa.int32()),
                         "late": pa.array([r[1] for r in rows], pa.binary())})

    def settle(key, table, answers):
        d, start, end, first, h, at = hashed(table)
        doc = np.searchsorted(first, at, "right") - 1
        uniq, back = np.unique(h, return_inverse=True)
        cut = C.bucket_edges(uniq, n_buckets)
        late = np.zeros(len(uniq), bool)
        for b, bits in zip(answers.column("bucket").to_pylist(),
                           answers.column("late").to_pylist()):
            n = cut[b + 1] - cut[b]
            late[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        least = np.full(len(uniq), C.LAST, np.int64)  # smallest doc_id here
        np.minimum.at(least, back, d.ids[doc])
        hit = late[back] | (d.ids[doc] > least[back])
        cover = np.zeros(len(start) + 1, np.int64)
        cover[at[hit]] += 1
        np.add.at(cover, at[hit] + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
        texts = kept_text(d, start, end, first, ~gone)
        total = np.concatenate([[0], np.cumsum(gone)])
        a, b = C.runs(gone)
        cuts = np.unique(first[1:-1])  # runs end with their document
        inside = cuts[(cuts > 0) & (cuts < len(gone))]
        inside = inside[gone[inside] & gone[inside - 1]]
        a, b = np.sort(np.append(a, inside)), np.sort(np.append(b, inside))
        owner = np.searchsorted(first, a, "right") - 1
        per = np.searchsorted(owner, np.arange(len(d) + 1))
        spans = pa.ListArray.from_arrays(
            pa.array(per, pa.int32()),
            pa.StructArray.from_arrays([pa.array(a - first[owner], pa.int64()),
                                        pa.array(b - first[owner], pa.int64())], ["start", "end"]))
        cols = {"doc_id": d.raw_ids, "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(np.diff(total[first]), pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "spans": spans}
        if with_text:
            cols["kept_text"] = pa.array([t.decode() for t in texts], pa.string())
        return pa.table(cols)

    asked = parts.groupBy(C.SHARD).applyInArrow(ask, "bucket int, shard int, hashes binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "bucket int, shard int, late binary")
    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
              "spans array<struct<start: long, end: long>>" + ", kept_text string" * with_text)
    return parts.groupBy(C.SHARD).cogroup(answers.groupBy("shard")).applyInArrow(settle, schema)
