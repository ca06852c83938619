"""Operators 1, 4, 6 and 7 against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from fixture import WORD, byte_dedup, components, frame, key, rows, window_dedup
from relaywatch.llm import common, exact_dedup, induced, simhash, suffix_dedup
from relaywatch.llm import window_dedup as W

PAIRS = [(r[0], r[1]) for r in rows()]


def got(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("width,shard_bytes", [(13, 1 << 20), (13, 2000), (3, 4000)])
def test_window_dedup(spark, width, shard_bytes):
    df = W.remove_repeats(frame(spark), width=width, shard_bytes=shard_bytes)
    assert got(df, "doc_id", "n_words", "n_removed", "kept_sha256") == window_dedup(PAIRS, width)


def test_window_dedup_spans_and_text(spark):
    for r in W.remove_repeats(frame(spark), shard_bytes=3000, with_text=True).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
        assert len(WORD.findall(r.kept_text)) == r.n_words - r.n_removed


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3000])
def test_suffix_dedup(spark, shard_bytes):
    df = suffix_dedup.remove_repeats(frame(spark), shard_bytes=shard_bytes, memory=1000,
                                     with_text=True)
    assert got(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_dedup(PAIRS, 50)
    for r in df.collect():
        assert hashlib.sha256(bytes(r.kept_bytes)).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_induced_classes_small_alphabets():
    rng = np.random.default_rng(5)
    for k in range(150):
        base = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 60)).astype(np.uint8)
        cuts = [base[rng.integers(0, len(base)):] for _ in range(rng.integers(1, 6))]
        text = np.concatenate([np.append(c, np.uint8(induced.END)) for c in cuts])
        for depth in (1, 3, 8, 20, 50):
            pos, first = induced.suffix_classes(text, depth, 10 if k % 3 else 1 << 20)
            assert sorted(pos.tolist()) == list(range(len(text)))
            cls = np.searchsorted(first, np.argsort(pos), "right")
            raw, seen = text.tobytes(), {}
            inside = [i for i in range(len(text) - depth + 1) if induced.END not in text[i:i + depth]]
            for i in inside:
                seen.setdefault(raw[i:i + depth], set()).add(int(cls[i]))
            assert all(len(c) == 1 for c in seen.values())
            assert len(set().union(*seen.values()) if seen else set()) == len(seen)


def test_exact_dedup_batches(spark):
    docs = frame(spark)
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "index"), buckets=4)
    out = exact_dedup.dedup(docs, index).collect()
    assert len(out) == len(PAIRS)
    groups: dict[str, list] = {}
    for i, t in PAIRS:
        groups.setdefault(t or "", []).append(i)
    least_first = lambda i: (0, 0) if i is None else (1, i)
    want = {hashlib.sha256(t.encode()).hexdigest(): (max(ids, key=least_first), len(ids))
            for t, ids in groups.items()}
    for r in out:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    assert Counter(r.text_sha256 for r in out if r.kept) == Counter(list(want))
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    # The same batch again, by an index attached anew: nothing is new.
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert again.read().count() == len(want)
    assert not any(r.kept for r in exact_dedup.dedup(docs, again).collect())
    more = frame(spark, [(99, "quite new", *rows()[0][2:]), (98, PAIRS[0][1], *rows()[0][2:])])
    kept = exact_dedup.distinct_texts(more, again)
    assert [r.doc_id for r in kept.collect()] == [99] and kept.columns == docs.columns
    assert again.read().count() == len(want) + 1


def test_exact_dedup_of_a_batch_that_runs_again(spark):
    """A named batch returns the same rows however often it runs, before or after
    its append, and the index has them once; later batches meet it."""
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "index"), buckets=4)
    first, second = frame(spark, rows()[:12]), frame(spark, rows()[6:])

    def run(docs, batch, at):
        return Counter((r.doc_id, r.text_sha256, r.kept, r.keep_id, r.group_size)
                       for r in exact_dedup.dedup(docs, at, batch=batch).collect())
    a = run(first, "a", index)
    assert run(first, "a", index) == a and index.read().count() == len({t or "" for _, t in PAIRS[:12]})
    b = run(second, "b", index)
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)
    assert run(second, "b", again) == b and run(second, "b", again) == b
    assert again.read().count() == len({t or "" for _, t in PAIRS})
    old = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in PAIRS[:12]}
    assert {sha for _, sha, kept, _, _ in b if kept} == {
        hashlib.sha256((t or "").encode()).hexdigest() for _, t in PAIRS[6:]} - old
    # A plan made before the append was lost (an attempt without its last step).
    third = frame(spark, [(500, "a third batch", *rows()[0][2:])])
    again.append(again.read().limit(3), "c")
    assert [k for _, _, k, _, _ in run(third, "c", again)] == [True]


def test_exact_dedup_keeps_one_of_equal_rows(spark):
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "index"), buckets=4)
    docs = frame(spark, [rows()[0]] * 3 + [rows()[4]])
    kept = exact_dedup.distinct_texts(docs, index).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4]


def plain_print(text, n=3):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if w else 0


def test_near_duplicates(spark):
    out = simhash.near_duplicates(frame(spark)).collect()
    prints = [(i, plain_print(t)) for i, t in PAIRS]
    comp = components(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least: dict[int, int | None] = {}
    for i, p in prints:
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    want = Counter((i, format(p, "016x"), least.get(comp[p])) for i, p in prints)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == want
    kept = simhash.one_per_group(frame(spark))
    assert kept.columns == frame(spark).columns
    assert kept.count() == len(set(comp.values()))


def test_anchor_cover_links_all_pairs(spark):
    """Clusters around centres, chains, and the extreme values."""
    rng = np.random.default_rng(3)
    fps = {0, (1 << 64) - 1, 1, 3}
    for _ in range(30):
        c = int(rng.integers(0, 1 << 63))
        fps.add(c)
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                c2 = c ^ (1 << int(b))
                fps.add(c2)
            if rng.random() < .4:
                c = c2
    nodes = sorted(fps)
    signed = np.array(nodes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    label = {r.node: r.label for r in simhash.components(simhash.links(df)).collect()}
    want = components(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    ours = {x: label.get(x, x) for x in signed}
    assert len(set(zip(ours.values(), want.values()))) == len(set(want.values())) == len(set(ours.values()))


def test_empty_tables(spark):
    none = frame(spark, [])
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "index"), buckets=4)
    for df in (W.remove_repeats(none), suffix_dedup.remove_repeats(none),
               exact_dedup.dedup(none, index), exact_dedup.distinct_texts(none, index),
               simhash.near_duplicates(none), simhash.one_per_group(none)):
        assert df.count() == 0


def test_shards_ascend(spark):
    df, n = common.range_shards(common.pairs_of(frame(spark), "doc_id", "text"), 2000)
    assert n > 3
    per: dict[int, list] = {}
    for r in df.collect():
        per.setdefault(r.shard, []).append(key(r.doc_id))
    order = sorted(per)
    assert all(max(per[a]) < min(per[b]) for a, b in zip(order, order[1:]))
