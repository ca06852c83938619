"""Token counts per section by offset-mapped attribution (operator 2).

A document is encoded once as a whole, as a trainer would see it. Each token has
a span of bytes of the text, and each section a span too. The spans of a byte-level
vocabulary follow from the lengths of its tokens, which add up to the text; those of
any other from the offsets of the library. An interval join of the two gives a token to

    start      the section its first byte lies in (the rule of the query)
    majority   the section that holds most of its bytes, the earlier of ties
    share      every section it touches, in proportion to the bytes there

Sections tile the text, so the counts of all sections add up to the document's
tokens under every rule. By default sections are lines with the line feed that
ends them; ``fields`` joins several columns into one text, a line feed after
each, and counts tokens per field.

A task works on one batch of documents; nothing is shuffled. Null texts and
empty texts have one empty section without tokens; a null field counts as empty;
rows that share a doc_id keep their own rows of counts; other columns may have any
name; very long texts are encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("start", "majority", "share")
ROWS = ("doc_id long, section int, field string, start_byte long, end_byte long, "
        "n_tokens {n}, n_crossing long, doc_tokens long")


def attribute(token_end: np.ndarray, section_end: np.ndarray, rule: str = "start",
              token_start: np.ndarray | None = None):
    """(tokens of each section, tokens that cross its end). Sections tile the text,
    given by their ascending ends; so do tokens, unless their starts are given, too."""
    n = len(section_end)
    if token_start is None:
        token_start = np.concatenate([[0], token_end])[:-1].astype(np.int64)
    size = token_end - token_start
    real = size > 0
    first = np.searchsorted(section_end, token_start, "right")
    last = np.searchsorted(section_end, np.maximum(token_end - 1, token_start), "right")
    crossing = np.bincount(first[real & (last > first)], minlength=n)
    if rule == "start":
        return np.bincount(np.minimum(first, n - 1), minlength=n), crossing
    out = np.zeros(n)
    whole = real & (first == last)
    np.add.at(out, first[whole], 1)
    for k in np.flatnonzero(real & (first != last)):
        edges = np.clip(section_end[first[k]:last[k] + 1], token_start[k], token_end[k])
        inside = np.diff(edges, prepend=token_start[k])
        if rule == "majority":
            out[first[k] + int(inside.argmax())] += 1
        else:
            out[first[k]:last[k] + 1] += inside / size[k]
    return (out.astype(np.int64) if rule == "majority" else out), crossing


def token_sizes(path: str) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary file."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    out = np.zeros(tok.get_vocab_size(), np.int64)
    for token, i in tok.get_vocab().items():
        out[i] = len(token)  # one character stands for one byte
    for i, added in tok.get_added_tokens_decoder().items():
        out[i] = len(added.content.encode())
    return out


def byte_level(path: str) -> bool:
    """Whether the tokens of a vocabulary file are byte strings that add up to the
    text: its decoder, or one of its decoders, is the byte-level one."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = [spec.get("decoder") or {}]
    kinds = {d.get("type") for p in parts for d in [p, *p.get("decoders", [])]}
    return "ByteLevel" in kinds and not spec.get("normalizer")


def library_spans(tokenizer, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the tokens of a text, from the library's offsets
    (characters of the text); white space may lie in none."""
    at = np.array(tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
    width = np.array([len(c.encode()) for c in text], np.int64)
    byte = np.concatenate([[0], np.cumsum(width)])
    return byte[at[:, 0]], byte[at[:, 1]]


def token_counts(docs: DataFrame, tokenizer: str, *, rule: str = "start",
                 fields: list[str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per section (``ROWS``) with its tokens, and how many of them go on
    into the next section."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    names = fields or [text_col]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"f{i}")
                         for i, c in enumerate(names)])

    def count(batches):
        from relaywatch.llm.tokens import loaded
        exact = byte_level(tokenizer)  # else the library's offsets, text by text
        if exact:
            enc, size = loaded(tokenizer), token_sizes(tokenizer)
        else:
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(tokenizer)
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i + 1) for i in range(len(names))]
            if fields:
                texts = pa.array(["".join(f"{v}\n" for v in row)
                                  for row in zip(*(c.to_pylist() for c in columns))], pa.string())
            else:
                texts = columns[0]
            out = []
            spans = ((None, np.cumsum(size[ids])) for ids in enc.encode(texts)) if exact else (
                library_spans(library, t.as_py()) for t in texts)
            for k, (start, end) in enumerate(spans):
                if fields:
                    ends = np.cumsum([len(c[k].as_py().encode()) + 1 for c in columns])
                else:
                    raw = np.frombuffer(texts[k].as_buffer(), np.uint8)
                    ends = np.flatnonzero(raw == 10) + 1
                    if not len(ends) or ends[-1] < len(raw):
                        ends = np.append(ends, len(raw))
                got, crossing = attribute(end, ends, rule, start)
                out.append((np.full(len(ends), k), np.arange(len(ends)),
                            np.concatenate([[0], ends[:-1]]), ends, got, crossing,
                            np.full(len(ends), len(end))))
            doc, section, start, end, got, crossing, total = map(np.concatenate, zip(*out))
            field = pa.array(names).take(pa.array(section if fields else section * 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(section, pa.int32()), field,
                 pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                 pa.array(got, pa.float64() if rule == "share" else pa.int64()),
                 pa.array(crossing, pa.int64()), pa.array(total, pa.int64())],
                ["doc_id", "section", "field", "start_byte", "end_byte", "n_tokens", "n_crossing",
                 "doc_tokens"])

    return rows.mapInArrow(count, ROWS.format(n="double" if rule == "share" else "long"))
