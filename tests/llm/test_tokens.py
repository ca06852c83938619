"""Operators 2, 3 and 10: exact ids, round trips, brute force."""

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fixture import frame, key, rows
from relaywatch.llm import common, packing, simple8b, token_counts
from relaywatch.llm.tokens import Ids

PAIRS = [(r[0], r[1] or "") for r in rows()]
BYTE, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a  b", "foo \n bar", "foo ", "\n\nx", " foo", "it's we'll I'D 12 3.5ab²Ⅷ z",
       "é é Σας ΣΑΣ", "<|endoftext|>x", "x\n", "\nx", "a\tb", "İstanbul ǅ", "foo\x1cbar \x85z", "ﬁ Å",
       "x' s", "a 's b", "¡ ¢ a¡b £¤ ¥", "á b ́c", "... !!! a!b", "!'s '!s", "a̸ ≮", "A!B?c"]


@pytest.mark.parametrize("path", [BYTE, WORDS])
def test_ids_equal_the_library(path, con):
    texts = [t for _, t in PAIRS] + ODD + [r[0] for r in con.execute(
        "SELECT coalesce(text, '') FROM documents LIMIT 150").fetchall()]
    tok = Tokenizer.from_file(path)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    enc = Ids(path)
    for _ in range(2):  # from an empty cache and a full one
        assert [x.tolist() for x in enc.encode(pa.array(texts))] == want


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for k in range(40):
        n = int(rng.integers(0, 30_000))
        v = rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
        if k % 3 == 0:
            v = v % np.uint64(50_257)
        if k % 7 == 0:
            v = np.repeat(v, 200)[:n]
        assert (simple8b.unpack(*simple8b.pack(v), len(v)) == v).all()
    sizes = np.array([3, 0, 4])
    ids, back = simple8b.read_segment(simple8b.segment(np.arange(7), sizes))
    assert ids.tolist() == list(range(7)) and back.tolist() == sizes.tolist()
    small, _, _ = simple8b.pack(np.full(simple8b.BLOCK, 7))
    assert len(small) == -(-simple8b.BLOCK // 20)  # twenty values of three bits a word


@pytest.mark.parametrize("shard_bytes", [1 << 20, 5000])
def test_token_files(spark, shard_bytes):
    path = common.scratch(spark, "files")
    simple8b.write_token_files(frame(spark), path, BYTE, 2, shard_bytes=shard_bytes)
    out = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32)
                  for r in simple8b.read_token_files(spark, path).collect()), key=lambda r: r[0])
    tok = Tokenizer.from_file(BYTE)
    want, at = [], 0
    for i, t in sorted(PAIRS, key=lambda p: (key(p[0]), p[1])):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4")
        want.append((at, i, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert out == want


def check_pieces(pieces, docs, capacity):
    """docs: {key: ids}; pieces: (key, start, length, crc, sequence, offset)."""
    per, sequences = defaultdict(list), defaultdict(list)
    for k, start, length, crc, seq, offset in pieces:
        assert zlib.crc32(docs[k][start:start + length].tobytes()) == crc and length > 0
        per[k].append((start, length))
        sequences[seq].append((offset, length))
    assert set(per) == set(docs)
    for k, spans in per.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == len(docs[k])
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(sum(n for _, n in s) < capacity for s in sequences.values())


def test_packing(spark):
    tok = Tokenizer.from_file(WORDS)
    some = [(k, r[1], *r[2:]) for k, r in enumerate(rows())]
    docs = {r[0]: np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
            for r in some}
    for group_docs in (1000, 5):
        out = packing.pack_documents(frame(spark, some), WORDS, 1, capacity=64,
                                     group_docs=group_docs).collect()
        partial = check_pieces([(r.doc_id, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset)
                                for r in out], docs, 64)
        assert partial <= -(-len(some) // group_docs) + 2
        assert all(r.doc_tokens == len(docs[r.doc_id]) for r in out)


def test_packing_edges(spark):
    out = packing.pack_documents(frame(spark), WORDS, 1).collect()
    assert sum(r.length for r in out if r.doc_id is None) > 0
    assert Counter(r.doc_id for r in out if r.start == 0) == Counter(i for i, _ in PAIRS)
    assert packing.pack_documents(frame(spark, []), WORDS, 1).count() == 0


def test_first_fit_decreasing_equals_a_scan():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = rng.integers(1, 101, rng.integers(1, 80)).tolist()
        bins, free = [], []
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            at = next((b for b, f in enumerate(free) if f >= sizes[k]), len(free))
            if at == len(free):
                bins.append([])
                free.append(100)
            bins[at].append(k)
            free[at] -= sizes[k]
        assert packing.first_fit_decreasing(sizes, 100) == bins


def test_token_counts_by_start(spark):
    tok = Tokenizer.from_file(BYTE)
    out = defaultdict(list)
    for r in token_counts.token_counts(frame(spark), BYTE).collect():
        out[r.doc_id].append((r.section, r.n_tokens, r.doc_tokens, r.start_byte, r.end_byte))
    for i, t in PAIRS:
        if sum(j == i for j, _ in PAIRS) > 1:
            continue
        e = tok.encode(t, add_special_tokens=False)
        ends, at = [], 0
        for line in t.splitlines(keepends=True) if "\x1c" not in t else [t]:
            at += len(line)
            if line.endswith("\n"):
                ends.append(at)
        if not ends or ends[-1] < len(t):
            ends.append(len(t))
        want = [0] * len(ends)
        for a, _ in e.offsets:
            want[min(bisect_right(ends, a), len(ends) - 1)] += 1
        mine = sorted(out[i])
        assert [r[1] for r in mine] == want and {r[2] for r in mine} == {len(e.ids)}
        assert mine[-1][4] == len(t.encode())
    assert token_counts.token_counts(frame(spark, []), BYTE).count() == 0


def test_boundary_rules():
    tokens, sections = np.array([2, 5, 9]), np.array([3, 8, 9])  # spans 0-2, 2-5, 5-9
    assert token_counts.attribute(tokens, sections, "start")[0].tolist() == [2, 1, 0]
    assert token_counts.attribute(tokens, sections, "majority")[0].tolist() == [1, 2, 0]
    share, crossing = token_counts.attribute(tokens, sections, "share")
    assert np.allclose(share, [1 + 1 / 3, 2 / 3 + 3 / 4, 1 / 4]) and crossing.tolist() == [1, 1, 0]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_of_fields(spark, rule):
    out = token_counts.token_counts(frame(spark), BYTE, rule=rule, fields=["lang", "text", "source"])
    per = defaultdict(float)
    total = {}
    for k, r in enumerate(out.filter("doc_id IS NOT NULL AND doc_id NOT IN (2, 18)").collect()):
        per[r.doc_id] += r.n_tokens
        total[r.doc_id] = r.doc_tokens
        assert r.field == ["lang", "text", "source"][r.section]
    assert all(abs(per[i] - total[i]) < 1e-6 for i in total) and len(total) > 20


@pytest.mark.parametrize("path", [BYTE, WORDS])
def test_token_counts_equal_library_offsets_for_any_vocabulary(spark, path):
    """Lines of every text, the ``start`` rule, against the library's offsets."""
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in PAIRS:
        ends, at = [], 0
        for line in t.split("\n"):
            at += len(line) + 1
            ends.append(min(at, len(t)))
        if len(ends) > 1 and ends[-1] == ends[-2]:
            ends.pop()
        enc = tok.encode(t, add_special_tokens=False)
        # Bytes, as a byte-level token may begin inside a character.
        per = [0] * len(ends)
        for a, _ in enc.offsets:
            per[min(bisect_right(ends, a), len(ends) - 1)] += 1
        want.update((i, k, n, len(enc.ids)) for k, n in enumerate(per))
    got = Counter((r.doc_id, r.section, r.n_tokens, r.doc_tokens)
                  for r in token_counts.token_counts(frame(spark), path).collect())
    assert got == want
    for rule in ("majority", "share"):
        total = defaultdict(float)
        rows_ = token_counts.token_counts(frame(spark).filter("doc_id > 18"), path, rule=rule).collect()
        for r in rows_:
            total[r.doc_id, r.doc_tokens] += r.n_tokens
        assert all(abs(n - d) < 1e-6 for (_, d), n in total.items())


def test_packing_deals_equal_rows_to_all_groups(spark):
    docs = spark.createDataFrame([(1, "the same text again")] * 400 + [
        (i, f"some text {i}") for i in range(2, 802)], "doc_id long, text string")
    out = packing.pack_documents(docs, WORDS, 1, group_docs=100).collect()
    sizes = Counter(r.sequence_id >> 32 for r in out)
    assert sum(r.doc_id == 1 for r in out) == 400
    assert max(sizes.values()) < 2 * np.median(list(sizes.values()))


def test_token_files_add_up_over_groups_of_shards(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7)) for i in range(60)],
                                 "doc_id long, text string")
    path = common.scratch(spark, "files")
    simple8b.write_token_files(docs, path, BYTE, 2, shard_bytes=150)
    want = sorted((r.doc_id, r.start) for r in simple8b.read_token_files(spark, path).collect())
    monkeypatch.setattr(simple8b, "SHARD_GROUP", 3)
    assert sorted((r.doc_id, r.start) for r in simple8b.read_token_files(spark, path).collect()) == want
    assert want[0] == (0, 0) and [s for _, s in want] == sorted(s for _, s in want)


def test_token_files_hold_one_segment_at_a_time(spark):
    import pyarrow.dataset as ds
    rng = np.random.default_rng(0)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 999, 40)))
                                  for i in range(400)], "doc_id long, text string")
    path = common.scratch(spark, "files")
    simple8b.write_token_files(docs.coalesce(1), path, BYTE, 2, shard_bytes=2000)
    files = [f.metadata for f in ds.dataset(path.removeprefix("file:"), format="parquet").get_fragments()]
    groups = [m.row_group(k) for m in files for k in range(m.num_row_groups)]
    n_rows = sum(g.num_rows for g in groups)
    assert n_rows > 2 * len(files)  # some writers had several segments
    assert {g.num_rows for g in groups} == {1}  # and held one of them at a time
    columns = [g.column(c) for g in groups for c in range(g.num_columns)]
    assert {c.compression for c in columns} == {"UNCOMPRESSED"}  # no codec buffers beside the heap
    assert sum(r.n_tokens > 0 for r in simple8b.read_token_files(spark, path).collect()) == 400
