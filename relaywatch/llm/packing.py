"""Packing documents into fixed-length sequences (operator 3).

First-fit decreasing over a tournament tree of bin capacities, run in
randomised groups of documents. A document's ids (with the end id) are cut into
full sequences and one remainder. The remainders of a group are taken in
descending length; each goes to the first sequence with room, found from the
root of a tree that holds the largest free capacity below each node. What the
emptiest sequences of a group hold is then cut to fill the gaps of the others,
so a group ends with at most one sequence that is not full.

Groups are formed by a hash of doc_id, text and the row's place in the scan, about
``group_docs`` documents each, so no group grows with the input, equal rows are dealt
to all groups, and a task works on one group. Null
texts count as empty (a document then has its end id alone); rows that share a
doc_id are packed as documents of their own; texts of any length are encoded whole
and cut into sequences; other columns, whatever their names, take no part; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaywatch.llm import common as C

GROUP_DOCS = 2000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Tournament:
    """Free capacities of bins; finds the first bin with room in O(log n)."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (max(1, n) - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; its number."""
        best, i = self.best, 1
        while i < self.leaves:
            i *= 2
            if best[i] < size:
                i += 1
        best[i] -= size
        at = i - self.leaves
        while i > 1:
            i //= 2
            left, right = best[2 * i], best[2 * i + 1]
            best[i] = left if left >= right else right
        return at


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the items in each bin; every size is 1 to ``capacity``."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = tree.place(sizes[k])
        if at == len(bins):
            bins.append([])
        bins[at].append(k)
    return bins


def plan(tokens: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length)."""
    full, rest, items = [], [], []
    for k, n in enumerate(tokens):
        whole = n - n % capacity
        full += [[(k, s, capacity)] for s in range(0, whole, capacity)]
        if n > whole:
            rest.append((k, whole, n - whole))
    bins = [[rest[k] for k in b] for b in first_fit_decreasing([r[2] for r in rest], capacity)]
    need = -(-sum(r[2] for r in rest) // capacity)
    bins.sort(key=lambda b: -sum(p[2] for p in b))
    for doc, start, length in (p for b in bins[need:] for p in b):
        items.append((doc, start, length))
    bins = bins[:need]
    at = 0
    for doc, start, length in items:  # cut into the gaps
        while length:
            room = capacity - sum(p[2] for p in bins[at])
            if not room:
                at += 1
                continue
            take = min(room, length)
            bins[at].append((doc, start, take))
            start, length = start + take, length - take
    # One partly filled sequence at most: fill earlier gaps from the last.
    at, last = 0, len(bins) - 1
    while at < last:
        room = capacity - sum(p[2] for p in bins[at])
        if not room:
            at += 1
            continue
        doc, start, length = bins[last].pop()
        take = min(room, length)
        bins[at].append((doc, start, take))
        if length > take:
            bins[last].append((doc, start + take, length - take))
        elif not bins[last]:
            bins.pop()
            last -= 1
    return full + bins


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, *, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text",
                   group_docs: int = GROUP_DOCS, seed: int = 7) -> DataFrame:
    """One row per piece (``PIECES``); ``sequence_id`` names its sequence and
    ``offset`` its place there. Texts are shuffled once, to their groups."""
    pairs = C.pairs_of(docs, id_col, text_col)
    n_groups = max(1, -(-docs.count() // group_docs))
    # The row's place in the scan is part of the hash: equal rows go to all groups.
    group = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(C.ID), F.lit(-1)), F.col(C.TEXT),
                              F.monotonically_increasing_id()), F.lit(n_groups))

    def pack(key, table):
        from relaywatch.llm.tokens import loaded
        d = C.Docs(table)
        end = np.array([end_id], "<u4")
        ids = [memoryview(np.concatenate([x, end])).cast("B")
               for x in loaded(tokenizer).encode(d.text)]
        tokens = [len(x) // 4 for x in ids]
        sequences = plan(tokens, capacity)
        rows = [(k, start, length, number, offset)
                for number, pieces in enumerate(sequences)
                for (k, start, length), offset in zip(pieces, _offsets(pieces))]
        k, start, length, number, offset = map(np.array, zip(*rows))
        crc = [zlib.crc32(ids[i][4 * s:4 * (s + n)])
               for i, s, n in zip(k.tolist(), start.tolist(), length.tolist())]
        return pa.table({
            "doc_id": d.raw_ids.take(pa.array(k)), "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": pa.array(np.array(tokens)[k], pa.int64()),
            "sequence_id": pa.array((key[0].as_py() << 32) + number, pa.int64()),
            "offset": pa.array(offset, pa.int64())})

    return pairs.withColumn("part", group).groupBy("part").applyInArrow(pack, PIECES)


def _offsets(pieces: list[tuple[int, int, int]]) -> list[int]:
    out, at = [], 0
    for _, _, length in pieces:
        out.append(at)
        at += length
    return out
