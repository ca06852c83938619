"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fixture import LINE, frame, key, rows
from relaywatch.llm import common as C
from relaywatch.llm import lexical, line_dedup, vector_codes

PAIRS = [(r[0], r[1] or "") for r in rows()]
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- lines (13)

def plain_lines(docs, min_chars, min_docs):
    def key_of(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    df = Counter(k for _, t in docs for k in {key_of(x) for x in t.split("\n")})
    out = Counter()
    for i, t in docs:
        lines = t.split("\n")
        kept = [x for x in lines if len(key_of(x)) < min_chars or df[key_of(x)] < min_docs]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def dropped(df, **options):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text)
                   for r in line_dedup.drop_common_lines(df, **options).collect())


@pytest.mark.parametrize("min_chars,min_docs", [(1, 2), (0, 2), (6, 3), (1, 1)])
def test_lines_equal_plain_version(spark, min_chars, min_docs):
    assert dropped(frame(spark), min_chars=min_chars, min_docs=min_docs) == plain_lines(
        PAIRS, min_chars, min_docs)


def test_lines_hot_rows_and_long_texts(spark):
    """A third of the rows equal and without id, a long text of many lines."""
    docs = [(None, "Common\nhot line\nrest")] * 40 + [(i, f" COMMON \nown {i}\n") for i in range(60)]
    docs += [(99, "\n".join(f"row {k % 7000}" for k in range(20000)) + "\ncommon\t"), (99, "ÄÖ\näö")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert dropped(df, min_docs=10) == plain_lines(docs, 1, 10)


def test_lines_of_nothing(spark):
    assert not dropped(frame(spark, []))
    assert dropped(frame(spark, [(1, None, *[None] * 10)]), min_chars=0, min_docs=1) == {(1, 1, 1, ""): 1}


def test_runs_level_and_survive_replays(spark):
    """Counts over seven batches equal one count; a batch added again, an attempt
    without marker and a merge that stopped half-way change nothing."""
    docs = spark.createDataFrame([(i, f"a\nb{i % 3}\nonly {i}") for i in range(70)],
                                 "doc_id long, text string")
    path = C.scratch(spark, "runs")
    runs = line_dedup.LineRuns(spark, path, buckets=2, settled=10 ** 9, fanout=2)
    for b in range(7):
        counts = line_dedup.line_counts(docs.filter(f"doc_id % 7 = {b}")).drop("batch")
        runs.add(counts, b)
        runs.add(counts, b)
        if b == 3:
            runs._write(runs.totals([(0, 3)]), (90, 90))  # files of an attempt ...
            runs._fs.delete(runs._path("done/90-90"), True)  # ... whose marker is missing
    assert runs.covered() == [(0, 3), (4, 5), (6, 6)]
    # The wider run counts, the narrow ones under it do not.
    again = line_dedup.LineRuns(spark, path, buckets=2, settled=10 ** 9, fanout=2)
    got = {(r.h1, r.h2): r.n for r in again.totals().collect()}
    want = {(r.h1, r.h2): r.n for r in line_dedup.line_counts(docs).collect()}
    assert got == want and max(want.values()) == 70
    runs.detach()
    again.detach()


def test_settled_lines_are_not_added_again(spark):
    runs = line_dedup.LineRuns(spark, C.scratch(spark, "runs"), buckets=2, settled=5)
    docs = spark.createDataFrame([(i, f"hot\nonly {i}") for i in range(20)], "doc_id long, text string")
    for b in range(2):
        runs.add(line_dedup.line_counts(docs.filter(f"doc_id % 2 = {b}")).drop("batch"), b)
    assert runs.read([(0, 0)]).count() == 11 and runs.read([(1, 1)]).count() == 10
    runs.detach()


# ---------------------------------------------------------------- search (11)

def plain_search(docs, queries, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = [term.findall(t.translate(FOLD)) for _, t in docs]
    n, total = sum(map(bool, split)), sum(map(len, split))
    counts = [Counter(w) for w in split]
    df = Counter(t for c in counts for t in c)
    out = Counter()
    for q, text in queries:
        asked = set(term.findall(text.translate(FOLD)))
        scores = []
        for (i, _), words, c in zip(docs, split, counts):
            m = 50 + (50 * len(words) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                scores.append((-s, key(i), i))
        for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1):
            out[q, r, i, -s] += 1
    return out


QUERIES = [(1, LINE), (2, "s1 s2 S3 tail head"), (3, "äöü 日本語 İ"), (4, None), (5, "nothinghere"),
           (6, "one one two line W5x5"), (6, "a b the it"), (None, "emoji \U0001F600 line kappa")]


@pytest.mark.parametrize("k,segment", [(50, 1 << 20), (3, 400), (1, 1)])
def test_search_equals_plain_version(spark, k, segment):
    index = lexical.build_index(frame(spark), C.scratch(spark, "index"), segment_bytes=segment)
    queries = spark.createDataFrame([(*q, "x", 1) for q in QUERIES],
                                    "item_id long, text string, term string, q int")
    got = Counter((r.query_id, r["rank"], r.doc_id, r.score)
                  for r in lexical.search(index, queries, k=k, block_bytes=200).collect())
    assert got == plain_search(PAIRS, [(q, t or "") for q, t in QUERIES], k)


def test_search_of_nothing(spark):
    queries = spark.createDataFrame(QUERIES, "item_id long, text string")
    empty = lexical.build_index(frame(spark, []), C.scratch(spark, "index"))
    assert lexical.search(empty, queries).count() == 0
    blank = lexical.build_index(frame(spark, [(1, None, *[None] * 10), (2, " -", *[None] * 10)]),
                                C.scratch(spark, "index"))
    assert lexical.search(blank, queries).count() == 0
    index = lexical.build_index(frame(spark), C.scratch(spark, "index"))
    assert lexical.search(index, queries.limit(0)).count() == 0


def test_accumulators_stop_and_scores_stay_exact():
    """With a rare strong term and frequent weak ones, few documents get an
    accumulator, and the best documents equal those of full scores."""
    rng = np.random.default_rng(4)
    n = 5000
    for trial in range(20):
        full, terms = np.zeros(n, np.int64), []
        for df, w in ((30, 9000), (60, 7000), (300, 900), (2500, 40), (4000, 9)):
            at = np.sort(rng.choice(n, df, replace=False)).astype(np.int32)
            impact = rng.integers(300_000, 900_000, df)
            full[at] += w * impact
            terms.append((w, at, impact, int(impact.max())))
        acc, made = lexical.limited(terms, n, 20)
        assert (acc[made] == full[made]).all() and made.sum() < 1000
        order = rng.permutation(n)
        best = lexical.best_of(acc, made, order, 20)
        assert best.tolist() == np.lexsort((order, -full))[:20].tolist()


def test_equal_scores_keep_accumulators_open():
    """A later term can still tie with the kth score and win by doc_id."""
    terms = [(1, np.array([5]), np.array([7]), 7), (1, np.array([2]), np.array([7]), 7)]
    acc, made = lexical.limited(terms, 6, 1)
    assert lexical.best_of(acc, made, np.arange(6), 1).tolist() == [2]


# ---------------------------------------------------------------- codes (12)

def plain_codes(vectors, parts, entries, rounds, scale=4096):
    """(vec_id, code, error, label_error, sha) in plain integers."""
    rows = [(i, v, lab) for i, v, lab in vectors
            if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows]
    ints.sort(key=lambda r: (key(r[0]), r[1]))
    fit = [r for r in ints if len(r[1]) % parts == 0]
    ints = [r for r in ints if fit and len(r[1]) == len(fit[0][1])]
    if not ints:
        return Counter()
    w = len(ints[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in ints]
    books = [[list(cut[e][p]) for e in range(min(entries, len(ints)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))
                 for p, x in enumerate(c)] for c in cut]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, got) if g[p][1] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    got = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in g) for g in got]
    label = defaultdict(int)
    for (_, _, lab), e in zip(ints, errors):
        label[lab] += e
    return Counter((i, "".join(f"{e:02x}" for _, e in g), err, label[lab], sha)
                   for (i, _, lab), g, err in zip(ints, got, errors))


def coded(df, **options):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)
                   for r in vector_codes.vector_codes(df, **options).collect())


VEC = "vec_id long, embedding array<float>, label int, v string, code string"


def vectors(n, dim, spread=0.3, seed=0):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) * spread).astype(np.float32)
    return [(k, [float(c) for c in v], k % 3) for k, v in enumerate(x)]


@pytest.mark.parametrize("cell", [16, 512, 1 << 20])
def test_codes_equal_plain_version(spark, cell):
    some = vectors(150, 16)
    some += [(None, some[3][1], None), (7, some[8][1], None), (7, some[8][1], 1), (200, None, 1),
             (201, [], 1), (202, [None] * 16, 1), (203, [float("nan")] * 16, 1),
             (204, [float("inf")] + [0.0] * 15, 1), (-3, [0.25] * 16, 2), (205, [0.5] * 8, 0)]
    df = spark.createDataFrame([(*v, "x", "y") for v in some], VEC)
    assert coded(df, parts=4, entries=5, rounds=3, cell=cell) == plain_codes(some, 4, 5, 3)


def test_codes_hot_few_and_none(spark):
    same = [(i, [0.1, -0.2, 0.3, 0.4], i % 2) for i in range(60)] + vectors(5, 4)
    df = spark.createDataFrame([(*v, "x", "y") for v in same], VEC).repartition(7)
    assert coded(df, parts=2) == plain_codes(same, 2, 16, 6)
    few = vectors(3, 4)
    assert coded(spark.createDataFrame([(*v, "x", "y") for v in few], VEC), parts=2) == plain_codes(
        few, 2, 16, 6)
    assert not coded(spark.createDataFrame([], VEC))
    assert not coded(spark.createDataFrame([(1, None, 1, "", "")], VEC))


def test_codes_of_large_components(spark):
    """Beyond 2**28 the distances are taken in Python integers."""
    some = [(k, [c * 3e5 for c in v], lab) for k, v, lab in vectors(40, 4)]
    df = spark.createDataFrame([(*v, "x", "y") for v in some],
                               VEC.replace("array<float>", "array<double>"))
    assert coded(df, parts=2, entries=4, rounds=2) == plain_codes(some, 2, 4, 2)


def test_cells_keep_every_nearest_entry():
    """Pruned search equals the search over all entries, and does prune."""
    rng = np.random.default_rng(1)
    book = rng.integers(-1500, 1500, (16, 8))
    x = rng.integers(-1500, 1500, (4000, 8))
    cells = vector_codes.Cells(book, 128)
    code, dist = vector_codes.nearest(x, cells)
    d = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()
    assert cells.masks.mean() < 0.6
    before = len(cells.masks)
    vector_codes.nearest(x[:100], cells)
    assert len(cells.masks) == before  # all cells were known
