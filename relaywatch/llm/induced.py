"""External induced sorting of suffixes with common-prefix values.

``suffix_classes`` groups the suffixes of a byte text by their first ``depth``
bytes. It follows the induced-sorting scheme for external memory:

1. Suffixes are of type S (smaller than the next suffix) or L. The S suffixes
   behind an L suffix (S*) cut the text into substrings, which get names by
   sorting their bytes.
2. The names form a shorter text whose suffixes are sorted by naming pairs of
   names again and again, each level covering twice the substrings, until a
   name covers ``depth`` bytes (a comparison never needs more).
3. From the sorted S* suffixes all L suffixes are induced in ascending order and
   from these all S suffixes in descending order. A priority queue keyed by
   first byte and order of arrival carries tuples (position, common prefix with
   the tuple before it); a popped run of tuples is worked on as one array, and
   what it induces is pushed with a common prefix of one byte more than the
   least value passed since the last push under the same byte.

The queue keeps its runs on disk beyond ``memory`` bytes, in a folder of its own
that goes when the sort ends; popped runs come back one at a time, so memory is
bounded by the text, its types and the longest run.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

END = 0xFE  # ends each segment of a text; never a byte of UTF-8
PAD = 0xFF  # above all bytes
# By the bytes left of a substring: PAD over the rest of its eight.
_FILL = np.array([(1 << 64) - 1 >> 8 * k for k in range(8)] + [0], np.uint64)


class RunQueue:
    """Runs of (position, common prefix) tuples, first in first out per byte."""

    def __init__(self, folder: str, name: str, memory: int):
        self.folder, self.name, self.memory = folder, name, memory
        self.runs: list[list] = [[] for _ in range(256)]
        self.held = self.files = 0

    def push(self, byte: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        if self.held + pos.nbytes + lcp.nbytes > self.memory:
            name = os.path.join(self.folder, f"{self.name}{self.files}.npz")
            self.files += 1
            np.savez(name, pos=pos, lcp=lcp)
            self.runs[byte].append(name)
        else:
            self.held += pos.nbytes + lcp.nbytes
            self.runs[byte].append((pos, lcp))

    def pop(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples that wait under ``byte``, in order of arrival."""
        runs, self.runs[byte] = self.runs[byte], []
        if not runs:
            return None
        got = []
        for r in runs:
            if isinstance(r, str):
                with np.load(r) as f:
                    got.append((f["pos"], f["lcp"]))
                os.unlink(r)
            else:
                self.held -= r[0].nbytes + r[1].nbytes
                got.append(r)
        return (got[0] if len(got) == 1 else
                (np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])))


def _eight(text: np.ndarray) -> np.ndarray:
    """A view of the eight bytes from each position, the first one highest; PAD
    behind the end."""
    padded = np.concatenate([text, np.full(72, PAD, np.uint8)])
    return np.ndarray((len(text) + 64,), ">u8", padded, strides=(1,))


def _refine(rank: np.ndarray, key: np.ndarray, which: np.ndarray) -> None:
    """Order ties of ``rank`` among ``which`` by their ``key``. A rank is the number
    of smaller elements, so ranks of other elements stay as they are."""
    if len(which) == len(rank) and not rank.any():
        order = np.argsort(key)
    elif key.dtype == np.uint64:
        order = np.lexsort((key, rank[which]))
    else:  # a rank too: both fit into one number
        order = np.argsort(rank[which].astype(np.int64) * (len(rank) + 1) + key)
    key = key[order]
    order = which[order]
    r = rank[order]
    new = np.ones(len(order), bool)
    new[1:] = r[1:] != r[:-1]
    at = np.arange(len(order), dtype=rank.dtype)
    first_rank = np.maximum.accumulate(np.where(new, at, 0))
    new[1:] |= key[1:] != key[:-1]
    first_key = np.maximum.accumulate(np.where(new, at, 0))
    rank[order] = r + (first_key - first_rank)


def _ties(rank: np.ndarray) -> np.ndarray:
    n = np.bincount(rank, minlength=len(rank)) > 1
    return np.flatnonzero(n[rank])


def _common(eight: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of suffixes a and b, at most ``depth`` (64 or less)."""
    out = np.full(len(a), depth, np.uint8)
    live = np.arange(len(a))
    for c in range(0, depth, 8):
        x = eight[np.minimum(a[live] + c, len(eight) - 1)] ^ eight[np.minimum(b[live] + c, len(eight) - 1)]
        x = x.astype(np.uint64)
        off = x != 0
        y = x[off]
        same = np.zeros(len(y), np.uint8)
        for j in range(1, 8):
            same += (y >> np.uint64(64 - 8 * j)) == 0
        out[live[off]] = np.minimum(depth, c + same)
        live = live[~off]
    return out


def sorted_stars(text: np.ndarray, stars: np.ndarray, depth: int) -> np.ndarray:
    """The S* suffixes in order of their first ``depth`` bytes or more."""
    m, eight = len(stars), _eight(text)
    kind = np.int32 if m < 2**31 else np.int64
    after = np.append(stars[1:], len(text) - 1)
    size = np.minimum(after - stars + 1, depth + 8)  # a substring ends on the next S*
    rank = np.zeros(m, kind)
    which, c = np.arange(m, dtype=kind), 0
    while len(which):
        key = eight[np.minimum(stars[which] + c, len(eight) - 1)].astype(np.uint64)
        left = np.clip(size[which] - c, 0, 8)
        # A substring that ends sorts behind one that goes on (S behind L).
        key |= _FILL[left]
        _refine(rank, key, which)
        c += 8
        ties = _ties(rank)
        longer = np.zeros(m, bool)  # ranks under which a substring goes on
        longer[rank[ties[size[ties] > c]]] = True
        which = ties[longer[rank[ties]]]
    del size, after
    h, ends = 1, np.append(stars, len(text) + depth)
    while True:
        ties = _ties(rank)
        far = np.minimum(ties + h, m)
        if not len(ties) or (ends[far] - stars[ties]).min() >= depth:
            return stars[np.argsort(rank, kind="stable")]
        _refine(rank, np.append(rank + 1, 0)[far].astype(np.int64), ties)
        h *= 2


def suffix_classes(text: np.ndarray, depth: int, memory: int = 64 << 20):
    """(positions, starts): all suffixes of ``text`` in descending order of their
    first ``depth`` bytes, and where in it each new class of equal ones starts.
    ``text`` ends with ``END`` and has no ``PAD``."""
    n = len(text)
    kind = np.int32 if n < 2**31 else np.int64
    cut = np.flatnonzero(text[1:] != text[:-1])
    run_end = np.append(cut, n - 1)
    run_size = np.diff(run_end, prepend=-1)
    rising = np.append(text[cut] < text[cut + 1], False)
    is_s = np.repeat(rising, run_size)
    run = np.minimum(np.repeat(run_end, run_size) - np.arange(n) + 1, depth).astype(np.uint8)
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    order = sorted_stars(text, stars, depth) if len(stars) else stars
    star_lcp = np.zeros(len(order), np.uint8)
    if len(order) > 1:
        star_lcp[1:] = _common(_eight(text), order[:-1], order[1:], depth)
    star_at = np.searchsorted(text[order], np.arange(257))
    order = order.astype(kind)

    with tempfile.TemporaryDirectory(prefix="induced-") as folder:
        falling = RunQueue(folder, "l", memory // 2)
        kept = RunQueue(folder, "k", memory // 2)  # the L suffixes, for the second scan
        carry = np.full(256, depth, np.uint8)

        def induce(queue, pos, lcp, allowed):
            """Push the suffixes before ``pos`` whose first byte is allowed."""
            ok = pos > 0
            before = text[pos - 1]
            ok &= allowed(before)
            at = np.flatnonzero(ok)
            by = before[at]
            turn = np.argsort(by, kind="stable")
            at, by = at[turn], by[turn]
            edge = np.flatnonzero(np.diff(by, prepend=-1) if len(by) else by)
            least = lcp.min()
            old = carry.copy()
            np.minimum(carry, least, out=carry)
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(by)]):
                p, idx = int(by[a]), at[a:b]
                bounds = np.concatenate([[0], idx + 1])
                last = bounds[-1] == len(lcp)
                low = np.minimum.reduceat(lcp, bounds[:-1] if last else bounds)
                carry[p] = depth if last else low[-1]
                low = low[:len(idx)]
                low[0] = min(low[0], old[p])
                queue.push(p, pos[idx] - 1, np.minimum(low + 1, depth).astype(np.uint8))

        # Ascending: L suffixes from L and S* suffixes. The first is the last byte.
        falling.push(int(text[-1]), np.array([n - 1], kind), np.zeros(1, np.uint8))
        for c in range(256):
            last = None
            while (got := falling.pop(c)) is not None:
                pos, lcp = got
                if last is None:
                    lcp[0] = 0
                kept.push(c, pos, lcp)
                induce(falling, pos, lcp, lambda b: b >= c)
                last = pos[-1]
            a, b = star_at[c], star_at[c + 1]
            if a < b:
                lcp = star_lcp[a:b].copy()
                lcp[0] = 0 if last is None else min(run[last], run[order[a]])
                induce(falling, order[a:b], lcp, lambda b: b > c)
        # Descending: S suffixes from S and L suffixes.
        rising_queue = RunQueue(folder, "s", memory // 2)
        carry[:] = depth
        out_pos, out_lcp = [], []
        for c in range(255, -1, -1):
            last = None
            while (got := rising_queue.pop(c)) is not None:
                pos, lcp = got
                if last is None:
                    lcp[0] = 0
                out_pos.append(pos)
                out_lcp.append(lcp)
                induce(rising_queue, pos, lcp, lambda b: b <= c)
                last = pos[-1]
            got = kept.pop(c)
            if got is not None:
                pos = got[0][::-1]
                lcp = np.empty_like(got[1])
                lcp[1:] = got[1][1:][::-1]
                lcp[0] = 0 if last is None else min(run[last], run[pos[0]])
                out_pos.append(pos)
                out_lcp.append(lcp)
                induce(rising_queue, pos, lcp, lambda b: b < c)
    pos, lcp = np.concatenate(out_pos), np.concatenate(out_lcp)
    start = lcp < depth
    start[0] = True
    return pos, np.flatnonzero(start)
