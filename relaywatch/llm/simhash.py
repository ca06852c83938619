"""SimHash near-duplicates by anchor-point covering (operator 7).

A document's fingerprint has a bit set where more than half of its shingle
hashes (XXH64, seed 42) have it. Fingerprints link at two or fewer differing
bits, and a document's class is the connected component of its fingerprint.

Anchors are the words of a covering code: the perfect Hamming code on bits 1 to
63 with bit 0 free, 2**58 anchors whose covering radius R is 1. The syndrome of
a fingerprint (the exclusive or of the numbers of its set bits) tells every
anchor within a given distance by a fixed list of bit flips. Two fingerprints
at a distance of at most t = 2 have a point between them within t/2 = 1 of both,
and that point has an anchor within R; so it is enough to replicate each
fingerprint to the anchors within R + t/2 = 2, 33 of them at most, instead of
the 683 within R + t = 3. Each anchor then compares what it holds, at most 2,081
distinct fingerprints whatever the input, and every linked pair meets at one.

Copies collapse first: the cover works on distinct fingerprints, and an anchor
returns a spanning forest of its links, not all pairs, so no group of near
copies makes a quadratic number of rows. Components come from rounds of minimum
labels with hooking and shortcuts; each round is a table in the shared folder.

Null and empty texts have fingerprint zero and link like any other. Rows that
share a doc_id are told apart by their whole rows. The class id is the smallest
doc_id of the component (null only if all its rows lack one). Texts of any length
are taken whole; other columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaywatch.llm import common as C

SHINGLE, BITS = 3, 2


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text (ASCII capitals lowered)."""
    import xxhash

    words = text.lower().split()  # bytes: white space is 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = max(0, len(words) - shingle)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42)
                       for a, b in zip(start[:k + 1].tolist(), end[len(words) - k - 1:].tolist())],
                      np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row key and fingerprint (as a signed long) of each row."""
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias(C.ID), C.row_key(docs).alias("k_row"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(C.TEXT))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in b.column(2)],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)],
                                             ["doc_id", "k_row", "fp"])

    return keyed.mapInArrow(run, "doc_id long, k_row long, fp long")


def anchor_flips() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, the flips of at most two bits that lead to an anchor,
    and how many there are."""
    flips: list[list[int]] = [[] for _ in range(64)]
    flips[0].append(0)
    for i in range(64):
        flips[i].append(1 << i)
        for j in range(i):
            flips[i ^ j].append(1 << i | 1 << j)
    most = max(map(len, flips))
    table = np.zeros((64, most), np.uint64)
    for s, f in enumerate(flips):
        table[s, :len(f)] = f
    return table, np.array([len(f) for f in flips])


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _syndrome(fp: np.ndarray) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for k in range(6):
        mask = np.uint64(sum(1 << i for i in range(64) if i >> k & 1))
        out |= (_popcount(fp & mask).astype(np.int64) & 1) << k
    return out


def _forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that connect what is linked within one anchor's fingerprints."""
    rest, out = fp, []
    while len(rest) > 1:
        tree, rest = rest[:1], rest[1:]
        while len(tree) and len(rest):  # breadth first from the smallest
            near = _popcount(tree[:, None] ^ rest[None, :]) <= bits
            got = near.any(axis=0)
            out += list(zip(tree[near[:, got].argmax(axis=0)].tolist(), rest[got].tolist()))
            tree, rest = rest[got], rest[~got]
    return out


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp`` that connect just what
    all pairs at ``bits`` or fewer differing bits connect."""
    if bits != BITS:
        raise ValueError("the cover is built for two differing bits")
    table, count = anchor_flips()

    def replicate(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            s = _syndrome(fp)
            n = count[s]
            row = np.repeat(np.arange(len(fp)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array((fp[row] ^ table[s[row], k]).view(np.int64)),
                 pa.array(fp[row].view(np.int64))], ["anchor", "fp"])

    def compare(batches):
        held = np.zeros((2, 0), np.uint64)  # the last anchor may go on in the next batch

        def edges(anchor, fp):
            cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            cut = np.concatenate([[0], cut, [len(anchor)]])
            size = np.diff(cut)
            two = cut[:-1][size == 2]
            two = two[_popcount(fp[two] ^ fp[two + 1]) <= bits]
            found = list(zip(fp[two].tolist(), fp[two + 1].tolist()))
            for a, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist()):
                found += _forest(fp[a:a + n], bits)
            got = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 0])),
                                               pa.array(np.ascontiguousarray(got[:, 1]))], ["a", "b"])

        for b in batches:
            both = np.stack([b.column(0).to_numpy().view(np.uint64),
                             b.column(1).to_numpy().view(np.uint64)])
            both = np.concatenate([held, both], axis=1)
            if not both.shape[1]:
                continue
            done = int(np.argmax(both[0] == both[0, -1]))  # anchors are in order
            if done:
                yield edges(both[0, :done], both[1, :done])
            held = both[:, done:]
        if held.shape[1]:
            yield edges(held[0], held[1])

    spread = fps.select("fp").mapInArrow(replicate, "anchor long, fp long")
    return (spread.repartition("anchor").sortWithinPartitions("anchor", "fp")
            .mapInArrow(compare, "a long, b long").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each node's component.

    Each round gives every node, and its parent, the smallest label among its
    neighbours (hooking), then follows the labels once more (shortcut). Rounds
    grow with the logarithm of the longest path."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = C.stored(both.distinct(), "edges")
    label = C.stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = (both.join(label, both.b == label.node)
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least")))
        own = label.join(near, "node")
        offers = (own.select("node", F.least("label", "least").alias("label"))
                  .union(own.select(F.col("label").alias("node"),
                                    F.least("label", "least").alias("label"))))
        hooked = offers.groupBy("node").agg(F.min("label").alias("label"))
        hooked = C.stored(hooked, "labels")
        up = hooked.select(F.col("node").alias("p"), F.col("label").alias("up"))
        new = C.stored(hooked.join(up, hooked.label == up.p, "left")
                       .select("node", F.least("label", F.coalesce("up", "label")).alias("label")),
                       "labels")
        old = label.select("node", F.col("label").alias("old"))
        moved = new.join(old, "node").filter("label <> old").limit(1).count()
        label = new
        if not moved:
            return label
    raise RuntimeError(f"no end after {max_rounds} rounds")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, k_row (key of the whole row), fingerprint
    (16 hexadecimal digits), component_id and component (which tells components
    apart even where they share a doc_id)."""
    rows = C.stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "prints")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    label = components(links(per, bits))
    per = per.join(label, per.fp == label.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    per = C.stored(per, "classes")
    least = per.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = per.select("fp", "label").join(least, "label").select(
        "fp", "component_id", F.col("label").alias("component"))
    return rows.join(ids, "fp").select(
        "doc_id", "k_row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", "component")


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` of which one stays for each component: the one with
    the smallest doc_id (of ties, the smallest row key)."""
    found = C.stored(near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle,
                                     bits=bits), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("k_row"))).alias("m")
    best = found.groupBy("component").agg(first)
    best = best.select(F.col("m.doc_id").alias("k_id"), F.col("m.k_row").alias("k_row"))
    same = found.groupBy(F.col("doc_id").alias("s_id"), F.col("k_row").alias("s_row")).agg(
        F.count(F.lit(1)).alias("n_same")).filter("n_same > 1")
    kept = best.join(same, F.col("k_id").eqNullSafe(F.col("s_id"))
                     & (F.col("k_row") == F.col("s_row")), "left")
    kept = kept.select("k_id", "k_row", F.coalesce("n_same", F.lit(1)).alias("n_same"))
    return C.semi_rows(docs, kept, id_col)
