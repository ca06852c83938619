"""Token ids of whole texts by the public tokenizers, with a cache of pieces.

The ids equal those of ``Tokenizer.encode`` on the whole text. Both
vocabularies split a text before merging. A single blank or line feed between
two other characters, and the meeting of an ASCII letter or digit with an ASCII
sign other than the apostrophe, is always such a split. So a text is cut there
(with numpy, by byte classes), each distinct piece is encoded once by the
library and remembered under a 64-bit hash, and the ids are gathered. A text in
which white space stands together, other white space or the marker of an added
token occurs is encoded whole by the library.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from relaywatch.llm.common import mix64

# White space apart from single blanks and line feeds, or an added token.
_WHOLE = (r"[\t\r\f\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|<\|")
CACHE = 1_000_000  # remembered pieces per worker; the cache starts anew beyond
GROUP = 50         # new pieces encoded in one text
STEP = 2 << 20     # bytes worked on at a time

_CLASS = np.full(256, 4, np.int8)  # 0 blank, 1 line feed, 2 sign, 3 letter or digit, 4 other
_CLASS[33:127] = 2
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _CLASS[_a:_b] = 3
_CLASS[[32, 10, 39]] = 0, 1, 4
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)  # odd


class Ids:
    """Encoder of a vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.drops_space = self.tok.normalizer is not None  # and case
        # What stands between new pieces in one call: a line feed, or (where white
        # space leaves no id) a sign with an id of its own.
        self.sep = self._sign() if self.drops_space else "\n"
        self.mark = self.sep.strip(" ")
        self.sep_id = int(self.whole(self.mark)[0])
        self.power = np.ones(1, np.uint64)
        self.forget()

    def _sign(self) -> str:
        signs = (c for c in map(chr, range(0xA1, 0x3000)) if not c.isalnum() and not c.isspace())
        return next(f" {c} " for c in signs if len(self.whole(c)) == 1)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)   # hashes, ascending
        self.number = np.zeros(0, np.int32)   # their piece numbers
        self.flat = np.zeros(1 << 20, "<u4")  # ids of all pieces
        self.end = np.zeros(1 << 16, np.int64)
        self.n = 0

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        last = self.end[self.n]
        while last + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) + 1 > len(self.end):
            self.end = np.concatenate([self.end, np.zeros_like(self.end)])
        self.flat[last:last + len(ids)] = ids
        self.end[self.n + 1:self.n + 1 + len(sizes)] = last + np.cumsum(sizes)
        self.n += len(sizes)

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Encode new pieces; their numbers."""
        out = np.zeros(len(pieces), np.int32)
        alone = [i for i, s in enumerate(pieces) if self.mark in s or not s.strip(" ")]
        for i in alone:
            ids = self.whole(pieces[i])
            out[i] = self.n
            self._add(ids, np.array([len(ids)]))
        skip = set(alone)
        rest = [i for i in range(len(pieces)) if i not in skip] if skip else range(len(pieces))
        groups = [rest[i:i + GROUP] for i in range(0, len(rest), GROUP)]
        texts = [self.sep.join([pieces[i] for i in g]) for g in groups]
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([x for e in got for x in (*e.ids, self.sep_id)], "<u4")
        cut = np.flatnonzero(ids == self.sep_id)
        assert len(cut) == len(rest)
        out[list(rest)] = np.arange(self.n, self.n + len(rest))
        self._add(ids[ids != self.sep_id], np.diff(cut, prepend=-1) - 1)
        return out

    def _numbers(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The cache number of each piece of ``buf``."""
        if len(self.known) > CACHE:
            self.forget()
        size = len(buf) + 1
        if len(self.power) < size:
            self.power = np.cumprod(np.full(size, _BASE), dtype=np.uint64)
        total = np.zeros(size, np.uint64)
        np.cumsum(_BYTE[buf] * self.power[:len(buf)], out=total[1:])
        # Bring all to the power 0: base ** (len - start) * base ** -len.
        lift = self.power[len(buf) - start] * np.uint64(pow(int(_BASE), -len(buf) - 1, 1 << 64))
        h = mix64((total[end] - total[start]) * lift)
        codes, uniq = pd.factorize(h)
        first = np.zeros(len(uniq), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        at = np.searchsorted(self.known, uniq)
        hit = np.zeros(len(uniq), bool)
        inside = at < len(self.known)
        hit[inside] = self.known[at[inside]] == uniq[inside]
        number = np.zeros(len(uniq), np.int32)
        number[hit] = self.number[at[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            raw = buf.tobytes()
            s, e = start[first[new]].tolist(), end[first[new]].tolist()
            number[new] = self._learn([raw[a:b].decode("utf-8", "replace") for a, b in zip(s, e)])
            order = new[np.argsort(uniq[new])]
            self.known = np.insert(self.known, at[order], uniq[order])
            self.number = np.insert(self.number, at[order], number[order])
        return number[codes]

    def encode(self, texts: pa.Array):
        """Yield the ids of each text in order."""
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < len(texts):
            upto = int(np.searchsorted(total, (total[at - 1] if at else 0) + STEP, "right"))
            upto = max(upto, at + 1)
            yield from self._some(texts.slice(at, upto - at))
            at = upto

    def _some(self, texts: pa.Array):
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~whole)) if whole.any() else texts
        ids, ends = self._plain(plain)
        k = 0
        for i, w in enumerate(whole):
            if w:
                yield self.whole(texts[i].as_py())
            else:
                yield ids[ends[k]:ends[k + 1]]
                k += 1

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together and where each text's begin."""
        wide = pa.types.is_large_string(texts.type)
        offs = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
        offs = offs[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if not len(texts) or offs[0] == offs[-1]:
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        buf = np.frombuffer(texts.buffers()[2], np.uint8)[offs[0]:offs[-1]]
        offs = offs - offs[0]
        if self.drops_space:
            upper = (buf >= 65) & (buf <= 90)
            buf = buf + (upper.view(np.uint8) << np.uint8(5))
        kind = _CLASS[buf]
        begins = np.ones(len(buf), bool)
        a, b = kind[:-1], kind[1:]
        begins[1:] = (b <= 1) | (a == 1) | ((a == 2) & (b == 3)) | ((a == 3) & (b == 2))
        if self.drops_space:
            begins[1:] |= a == 0
        begins[offs[:-1][offs[:-1] < len(buf)]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(buf))
        if self.drops_space:
            real = kind[start] > 1
            start, end = start[real], end[real]
        number = self._numbers(buf, start, end)
        at = self.end[number]
        n = self.end[number + 1] - at
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(at - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(start, offs)]


_LOADED: dict[str, Ids] = {}


def loaded(path: str) -> Ids:
    """One encoder per worker and file."""
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]
