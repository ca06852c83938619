"""Small documents with the awkward cases, and plain versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, shard int, bucket string, "
          "words string, k_row long, kept boolean, fp string, label int, t_row string")
LINE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def rows() -> list[tuple]:
    """(doc_id, text, lang, source, ...clashing columns)."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(6000))
    shared = " ".join(f"s{i}" for i in range(60))
    texts = [
        (1, LINE), (2, LINE), (2, LINE), (3, LINE + " tail"), (4, "head " + LINE + "\n" + LINE),
        (5, None), (6, ""), (7, " \t\n\x0b\f\r "), (8, "one"), (9, "one two"), (10, long_text),
        (11, "x " + long_text + " y"), (12, shared + " end"), (13, "begin\n" + shared),
        (14, "a" * 300), (15, "b" + "a" * 200), (16, "äöü " * 40), (17, "日本語 テキスト " * 30),
        (18, "tab\tseparated  double  spaces \n\n lines "), (18, "other text of eighteen"),
        (19, "Released under the MIT License.\nSome prose follows here\nLicensed under the Apache "
             "License, Version 2.0."),
        (20, "<|endoftext|> it's we'll 12 345 !!! a!b 'x' ... don't"),
        (21, "no-break space and　wide spaces"), (None, LINE), (None, "null id text"),
        (None, None), (22, shared), (-5, "begin\n" + shared + " minus"),
        (23, LINE.replace("kappa", "KAPPA")), (24, "line\nline\nline\n\nline\n"),
        (25, "# $ % & | < > *** " * 20), (26, "\U0001F600 emoji \U0001F600 " * 15),
    ]
    lang, source = ["en", "de", None, "en"], ["src0", "src0", "src1", None]
    return [(i, t, lang[k % 4], source[k % 4], k, "b", "w", k, True, "f", 1, None)
            for k, (i, t) in enumerate(texts)]


def frame(spark, some: list[tuple] | None = None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def key(i):
    """Order of ids: a null comes last."""
    return (1, 0) if i is None else (0, i)


def window_dedup(docs, width):
    """{(id, text): (n_words, n_removed, sha)} as a counter."""
    least: dict[tuple, tuple] = {}
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in split:
        for k in range(len(w) - width + 1):
            s = tuple(w[k:k + width])
            least[s] = min(least.get(s, (2, 0)), key(i))
    out = Counter()
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if least[tuple(w[k:k + width])] < key(i):
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def byte_dedup(docs, width):
    least: dict[bytes, tuple] = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for k in range(len(b) - width + 1):
            s = b[k:k + width]
            least[s] = min(least.get(s, (2, 0)), key(i))
    out = Counter()
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if least[b[k:k + width]] < key(i):
                gone[k:k + width] = b"\1" * width
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def components(nodes: list, linked) -> dict:
    """Smallest-index representative of each node's component."""
    up = list(range(len(nodes)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(nodes)):
        for b in range(a):
            if linked(nodes[a], nodes[b]):
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(k) for k, n in enumerate(nodes)}
