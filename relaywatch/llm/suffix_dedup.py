"""Suffix-array deduplication of repeated byte strings (operator 4).

Every byte covered by a ``width``-byte string that also starts in a document
with a smaller doc_id is removed; strings overlap, lie within one document and
are judged on the input. Texts are their UTF-8 bytes.

The sort is external induced sorting (``induced``): disk-backed queues carry
(position, common prefix) tuples from the S* suffixes through all L and S
suffixes. Suffixes with a common prefix of ``width`` form a class, whose
smallest doc_id decides. What is sorted together is a bucket that holds every
place where its strings occur, and only text that can repeat is sorted:

1. A string's minimizer is the smallest hash among its ``gram``-byte pieces, the
   leftmost of ties. Neighbouring strings share it, so a document falls into
   segments, the strings of one minimizer each. Equal strings have equal
   minimizers, wherever they stand.
2. Shards (ranges of doc_id) send their distinct minimizers to hash buckets and
   learn which ones another shard has. A string whose minimizer occurs in one
   document only cannot repeat in another: its segment needs no sorting.
3. Shards send the other segments to the buckets of their minimizers, equal
   segments once, with the smallest doc_id of theirs.
4. A bucket sorts the suffixes of its segments and answers, for each segment,
   which of its strings a smaller doc_id has. Where a segment occurs again in a
   later document of its shard, all its strings are repeats.

So a passage that a third of all documents share reaches a bucket once per
shard. Texts are shuffled once (Spark reuses the exchange).

Null texts count as empty; texts shorter than ``width`` keep all bytes; rows that
share a doc_id never remove each other's bytes; a null doc_id counts as larger
than all others; texts of any length are taken whole; equal rows each keep their
result row; other columns, whatever their names, take no part; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from relaywatch.llm import common as C
from relaywatch.llm import induced

WIDTH, GRAM = 50, 20
SHARD_BYTES = 4 << 20
SLICE = 1 << 18  # window starts looked at together
BUCKETS_PER_SHARD = 1

_BYTE = C.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95  # odd
_AGAIN = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at each position, by doubling."""
    out, have, n = None, 0, len(text) - gram + 1
    power, size = _BYTE[text], 1
    while True:
        if gram & size:  # append the next ``size`` bytes
            tail = power[have:have + n]
            out = tail.copy() if out is None else out * np.uint64(pow(_BASE, size, 1 << 64)) + tail
            have += size
        size *= 2
        if size > gram:
            return C.mix64(out)
        half = size // 2
        power = power[:-half] * np.uint64(pow(_BASE, half, 1 << 64)) + power[half:]


def segments(d: C.Docs, width: int = WIDTH, gram: int = GRAM):
    """(first string, number of strings, minimizer hash) of each segment."""
    n = len(d.buf)
    step = np.zeros(n + 1, np.int32)
    long = np.diff(d.offs) >= width
    np.add.at(step, d.offs[:-1][long], 1)
    np.add.at(step, d.offs[1:][long] - width + 1, -1)
    valid = np.cumsum(step[:-1]) > 0
    span = width - gram + 1
    starts, sizes, hashes = [], [], []
    low = np.uint64((1 << 20) - 1)
    for a in range(0, n, SLICE):
        b = min(n, a + SLICE)
        here = valid[a:b]
        p = np.flatnonzero(here)
        if not len(p):
            continue
        text = d.buf[a:min(n, b + width - 1)]
        h = gram_hashes(text, gram)
        # The low bits give the place: ties go to the left.
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        have = 1
        while have < span:
            more = min(have, span - have)
            least = np.minimum(least[:-more], least[more:])
            have += more
        at = (least[p] & low).astype(np.int64)
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1] + 1) | (at[1:] != at[:-1])
        first = np.flatnonzero(new)
        starts.append(p[first] + a)
        sizes.append(np.diff(first, append=len(p)))
        hashes.append(C.mix64(h[at[first]] + _AGAIN))  # the least hashes are not even
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(hashes)


def _shared_here(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each segment's minimizer occurs under two doc_ids; rows ascend by id."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(s)) - 1
    two = ids[order[first]] != ids[order[last]] if len(s) else np.zeros(0, bool)
    out = np.zeros(len(h), bool)
    out[order] = np.repeat(two, last - first + 1)
    return out


class Sent:
    """What a shard sends: its segments that can repeat, equal ones once."""

    def __init__(self, d: C.Docs, answers: pa.Table, n_buckets: int, width: int, gram: int):
        self.start, self.size, h = segments(d, width, gram)
        self.doc = np.searchsorted(d.offs, self.start, "right") - 1
        ids = d.ids[self.doc]
        uniq, back = np.unique(h, return_inverse=True)
        cut = C.bucket_edges(uniq, n_buckets)
        multi = np.zeros(len(uniq), bool)
        for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            n = cut[b + 1] - cut[b]
            multi[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        ok = np.flatnonzero(multi[back] | _shared_here(h, ids))
        ok = ok[np.argsort(h[ok], kind="stable")]  # by bucket, then by document
        raw = d.buf.tobytes()
        seen: dict[bytes, int] = {}
        firsts, number = [], np.zeros(len(ok), np.int64)
        texts = []
        for k, (a, n) in enumerate(zip(self.start[ok].tolist(), self.size[ok].tolist())):
            t = raw[a:a + n + width - 1]
            i = seen.setdefault(t, len(texts))
            if i == len(texts):
                texts.append(t)
                firsts.append(k)
            number[k] = i
        firsts = np.array(firsts, np.int64)
        self.texts, self.ok, self.number, self.ids = texts, ok, number, ids
        self.first_id = ids[ok[firsts]] if len(firsts) else np.zeros(0, np.int64)
        self.sent_size = self.size[ok[firsts]] if len(firsts) else np.zeros(0, np.int64)
        sent_hash = h[ok[firsts]] if len(firsts) else np.zeros(0, np.uint64)
        self.cut = C.bucket_edges(sent_hash, n_buckets)


def repeated_strings(sizes: np.ndarray, ids: np.ndarray, texts: bytes, width: int,
                     memory: int) -> np.ndarray:
    """For each string of the segments (``sizes`` strings each, smallest doc_id
    ``ids``, bytes one after the other) whether a smaller doc_id has it too.
    Equal segments of several shards are sorted once, for the smallest doc_id;
    all strings of the others repeat."""
    length = sizes + width - 1
    ends = np.cumsum(length).tolist()
    seen: dict[bytes, int] = {}
    same = np.array([seen.setdefault(texts[a:b], len(seen)) for a, b in zip([0, *ends], ends)])
    least = np.full(len(seen), C.LAST, np.int64)
    np.minimum.at(least, same, ids)
    first = np.zeros(len(seen), np.int64)
    first[same[::-1]] = np.arange(len(same) - 1, -1, -1)
    one = _sorted_strings(sizes[first], least, b"".join(seen), width, memory)
    per = sizes[first]
    at = np.cumsum(per) - per
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(ids > least[same], sizes) | one[np.repeat(at[same], sizes) + inner]


def _sorted_strings(sizes: np.ndarray, ids: np.ndarray, texts: bytes, width: int,
                    memory: int) -> np.ndarray:
    raw = np.frombuffer(texts, np.uint8)
    length = sizes + width - 1
    start = np.cumsum(length + 1) - length - 1
    text = np.full(len(raw) + len(sizes), induced.END, np.uint8)
    text[np.arange(len(raw)) + np.repeat(np.arange(len(sizes)), length)] = raw
    pos, first = induced.suffix_classes(text, width, memory)
    inner = np.zeros(len(text), bool)  # places where a string starts
    string = np.repeat(start, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inner[string] = True
    found = inner[pos]
    cls = np.zeros(len(pos), np.int32)
    cls[first] = 1
    cls = np.cumsum(cls, dtype=np.int32)[found]
    pos = pos[found]
    own = ids[np.repeat(np.arange(len(sizes), dtype=np.int32), length + 1)[pos]]
    new = np.flatnonzero(np.diff(cls, prepend=0))
    least = np.minimum.reduceat(own, new) if len(new) else own
    least = np.repeat(least, np.diff(new, append=len(pos)))
    late = np.zeros(len(text), bool)
    late[pos[own > least]] = True
    return late[string]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   memory: int = 64 << 20, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the
    removed byte intervals ``spans`` and, ``with_text``, the bytes that are left."""
    parts, n_shards = C.range_shards(C.pairs_of(docs, id_col, text_col), shard_bytes)
    parts = parts.repartition(C.SHARD)
    n_buckets = max(1, n_shards * BUCKETS_PER_SHARD)

    def ask(key, table):
        C.tidy()
        _, _, h = segments(C.Docs(table), width, gram)
        h = np.unique(h)
        cut = C.bucket_edges(h, n_buckets)
        some = [b for b in range(n_buckets) if cut[b + 1] > cut[b]]
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "shard": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "hashes": pa.array([C.pack_sorted(h[cut[b]:cut[b + 1]]) for b in some], pa.binary())})

    def answer(key, table):
        shards = table.column("shard").to_pylist()
        lists = [C.unpack_sorted(b) for b in table.column("hashes").to_pylist()]
        h = np.concatenate(lists)
        order = np.argsort(h)
        same = h[order[1:]] == h[order[:-1]]
        multi = np.zeros(len(h), bool)
        multi[order[1:][same]] = True
        multi[order[:-1][same]] = True
        ends = np.cumsum([len(x) for x in lists])
        rows = [(s, np.packbits(multi[e - len(x):e]).tobytes())
                for s, x, e in zip(shards, lists, ends) if multi[e - len(x):e].any()]
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "shard": pa.array([r[0] for r in rows], pa.int32()),
                         "late": pa.array([False] * len(rows), pa.bool_()),
                         "bits": pa.array([r[1] for r in rows], pa.binary())})

    def send(key, table, answers):
        C.tidy()
        s = Sent(C.Docs(table), answers, n_buckets, width, gram)
        some = [b for b in range(n_buckets) if s.cut[b + 1] > s.cut[b]]
        cuts = [(int(s.cut[b]), int(s.cut[b + 1])) for b in some]
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "shard": pa.array([key[0].as_py()] * len(some), pa.int32()),
            "sizes": pa.array([s.sent_size[a:b].astype("<u2").tobytes() for a, b in cuts], pa.binary()),
            "ids": pa.array([s.first_id[a:b].tobytes() for a, b in cuts], pa.binary()),
            "texts": pa.array([b"".join(s.texts[a:b]) for a, b in cuts], pa.large_binary()
                              ).cast(pa.binary())})

    def sort(key, table):
        C.tidy()
        shards = table.column("shard").to_pylist()
        sizes = [np.frombuffer(b, "<u2").astype(np.int64) for b in table.column("sizes").to_pylist()]
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("ids").to_pylist()])
        texts = b"".join(table.column("texts").to_pylist())
        late = repeated_strings(np.concatenate(sizes), ids, texts, width, memory)
        ends = np.cumsum([s.sum() for s in sizes])
        rows = [(s, np.packbits(late[e - z.sum():e]).tobytes())
                for s, z, e in zip(shards, sizes, ends) if late[e - z.sum():e].any()]
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "shard": pa.array([r[0] for r in rows], pa.int32()),
                         "late": pa.array([True] * len(rows), pa.bool_()),
                         "bits": pa.array([r[1] for r in rows], pa.binary())})

    def settle(key, table, answers):
        C.tidy()
        late = answers.column("late").combine_chunks() if answers.num_rows else pa.array([], pa.bool_())
        if isinstance(late, pa.ChunkedArray):
            late = pa.concat_arrays(late.chunks)
        d = C.Docs(table)
        s = Sent(d, answers.filter(pa.array(~late.to_numpy(zero_copy_only=False))), n_buckets,
                 width, gram)
        first = np.cumsum(s.sent_size) - s.sent_size
        bits = np.zeros(int(s.sent_size.sum()), bool)
        hits = answers.filter(late)
        for b, got in zip(hits.column("bucket").to_pylist(), hits.column("bits").to_pylist()):
            lo, hi = s.cut[b], s.cut[b + 1]
            n = int(s.sent_size[lo:hi].sum())
            bits[first[lo]:first[lo] + n] = np.unpackbits(np.frombuffer(got, np.uint8), count=n)
        # Strings of each sent occurrence: those of a later document all repeat.
        size, start = s.size[s.ok], s.start[s.ok]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        later = s.ids[s.ok] > s.first_id[s.number]
        hit = np.repeat(later, size) | bits[np.repeat(first[s.number], size) + inner]
        at = (np.repeat(start, size) + inner)[hit]
        cover = np.zeros(len(d.buf) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + width, -1)
        gone = np.cumsum(cover[:-1]) > 0
        raw = d.buf[~gone].tobytes()
        total = np.concatenate([[0], np.cumsum(gone)])
        cuts = (d.offs - total[d.offs]).tolist()
        texts = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        a, b = C.runs(gone)
        ends = d.offs[1:-1]  # a span ends with its document
        split = ends[(ends > 0) & (ends < len(gone))]
        split = np.unique(split[gone[split] & gone[split - 1]])
        a, b = np.sort(np.append(a, split)), np.sort(np.append(b, split))
        owner = np.searchsorted(d.offs, a, "right") - 1
        per = np.searchsorted(owner, np.arange(len(d) + 1))
        spans = pa.ListArray.from_arrays(
            pa.array(per, pa.int32()),
            pa.StructArray.from_arrays([pa.array(a - d.offs[owner], pa.int64()),
                                        pa.array(b - d.offs[owner], pa.int64())], ["start", "end"]))
        cols = {"doc_id": d.raw_ids, "n_bytes": pa.array(np.diff(d.offs), pa.int64()),
                "n_removed": pa.array(np.diff(total[d.offs]), pa.int64()),
                "n_spans": pa.array(np.diff(per), pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "spans": spans}
        if with_text:
            cols["kept_bytes"] = pa.array(texts, pa.binary())
        return pa.table(cols)

    bits = "bucket int, shard int, late boolean, bits binary"
    by_shard = parts.groupBy(C.SHARD)
    asked = by_shard.applyInArrow(ask, "bucket int, shard int, hashes binary")
    multi = asked.groupBy("bucket").applyInArrow(answer, bits)
    sent = by_shard.cogroup(multi.groupBy("shard")).applyInArrow(
        send, "bucket int, shard int, sizes binary, ids binary, texts binary")
    late = sent.groupBy("bucket").applyInArrow(sort, bits)
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<start: long, end: long>>" + ", kept_bytes binary" * with_text)
    return by_shard.cogroup(multi.union(late).groupBy("shard")).applyInArrow(settle, schema)
