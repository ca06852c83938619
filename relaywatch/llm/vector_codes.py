"""Product codes of vectors by memoised grid cells (operator 12).

A vector's components become integers ``floor(scale * x)`` and are cut into equal
consecutive parts; each part position has a codebook, refined by rounds of nearest
assignment and componentwise means, all in exact integer arithmetic.

The nearest entry of a part is found through the grid cell it lies in. For a cell,
an entry whose least squared distance to the cell's box is above the largest
distance that some other entry has there is nearest to no point of the box. The
entries that remain are cached by cell and part position, and only these are
evaluated exactly. The cache of a task is bounded and emptied when full; a cell is
found by its hash and compared with the cell on record, so that it never meets
another one's entries.

A round is one pass over the stored integer vectors. A task adds up counts and
component sums per part position and entry, Spark adds up the tasks, and the driver
sees ``parts * entries`` rows of a codebook's size, whatever the input.

Rows whose vector is null, or holds null or non-finite components, are dropped, and
so are vectors without components or of another length than the first kept one (by
vec_id): no codebook fits them. The codebook starts from the smallest vec_ids, a
null vec_id after all others, equal ones by their vectors; with fewer kept rows
than entries it has that many entries. Repeated rows count each. The errors of
equal labels are added up, null labels together. Components beyond 2**28 after
scaling are handled by Python integers, beyond 64 bits they stay at its limits, as
do errors. Other columns, whatever their names, take no part; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaywatch.llm import common as C

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CELL = 768            # side of a grid cell in scaled units
CACHE_CELLS = 1 << 16  # cells kept per part position and task
SAFE = 1 << 28        # components below it have exact 64-bit distances
MOST = int(np.iinfo(np.int64).max)


def integer_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the vectors without null or non-finite components, as
    integers."""
    v = F.col(f"`{vector_col}`")
    whole = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                           F.col(f"`{label_col}`").cast("long").alias("label"),
                           F.when(whole, v).alias("x")).filter(F.size("x") > 0)
            .select("vec_id", "label",
                    F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
                    .alias("v")))


class Cells:
    """Entries that can be nearest in a cell, for one part position: a table of cell
    hashes in order, the cells themselves and their flags."""

    def __init__(self, book: np.ndarray, side: int):
        self.book, self.side = book, side
        self.turn = C.mix64(np.arange(1, book.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, self.book.shape[1]), np.int64)
        self.masks = np.zeros((0, len(self.book)), bool)

    def possible(self, cells: np.ndarray) -> np.ndarray:
        """One row of flags per cell: entries not dominated across its box. Squared
        distances to a box are sums over the dimensions, each of which has few cells."""
        near = np.zeros((len(cells), len(self.book)), np.int64)
        far = near.copy()
        for i, e in enumerate(self.book.T):
            values, at = np.unique(cells[:, i], return_inverse=True)
            low = values[:, None] * self.side
            high = low + (self.side - 1)
            least = np.maximum(np.maximum(low - e, e - high), 0)
            most = np.maximum(abs(e - low), abs(e - high))
            near += (least * least)[at]
            far += (most * most)[at]
        return near <= far.min(1)[:, None]

    def of(self, cells: np.ndarray) -> np.ndarray:
        """Flags for each row of ``cells``, by the cache where it knows the cell."""
        h = C.mix64((cells.astype(np.uint64) * self.turn).sum(1, dtype=np.uint64))
        key, first, back = np.unique(h, return_index=True, return_inverse=True)
        own = cells[first]
        if (own[back] != cells).any():  # two cells share a hash
            return self.possible(cells)
        at = np.searchsorted(self.keys, key)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == key[there]
        known = there.copy()
        known[there] = (self.cells[at[there]] == own[there]).all(1)
        flags = np.empty((len(key), len(self.book)), bool)
        flags[known] = self.masks[at[known]]
        if not known.all():
            flags[~known] = self.possible(own[~known])
            new = ~there
            if len(self.keys) + np.count_nonzero(new) > CACHE_CELLS:
                self._forget()
                new[:] = True
            order = np.argsort(np.concatenate([self.keys, key[new]]))
            for name, more in (("keys", key), ("cells", own), ("masks", flags)):
                setattr(self, name, np.concatenate([getattr(self, name), more[new]])[order])
        return flags[back]


def nearest(x: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each row, equal
    distances by the lower index."""
    if x.dtype == object:  # beyond 64-bit distances
        d = ((x[:, None, :] - cells.book.astype(object)[None]) ** 2).sum(2)
        code = np.array([min(range(len(r)), key=r.__getitem__) for r in d], np.int64)
        return code, d[np.arange(len(x)), code]
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Row by row, the entries that can be nearest, in ascending order.
    row, entry = np.nonzero(cells.of(np.floor_divide(x, cells.side)))
    diff = x[row] - cells.book[entry]
    d = np.einsum("ij,ij->i", diff, diff)
    best = np.minimum.reduceat(d, np.flatnonzero(np.diff(row, prepend=-1)))
    hit = np.flatnonzero(d == best[row])[::-1]
    code = np.empty(len(x), np.int64)
    code[row[hit]] = entry[hit]  # the lowest entry is written last
    return code, best


def _matrix(column, dim: int, books: list[list[list[int]]]) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    big = len(x) and (int(x.max()) >= SAFE or int(x.min()) < -SAFE)
    big = big or any(abs(c) >= SAFE for b in books for e in b for c in e)
    return x.astype(object) if big else x


def _assigned(batches, books, cell):
    """(batch, its integer matrix, codes and distances of each part)."""
    width = len(books[0][0])
    cells = None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("v"), width * len(books), books)
        if cells is None or cells[0].book.dtype != x.dtype:
            cells = [Cells(np.array(b, x.dtype), cell) for b in books]
        got = [nearest(x[:, p * width:(p + 1) * width], c) for p, c in enumerate(cells)]
        yield batch, x, [g[0] for g in got], [g[1] for g in got]


def next_books(ints: DataFrame, books: list, *, cell: int = CELL) -> list:
    """One round: every part to its nearest entry, every entry to the
    componentwise floor of its parts' mean; unused entries stay."""
    parts, entries, width = len(books), len(books[0]), len(books[0][0])

    def add_up(batches):
        count = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), object)
        for _, x, codes, _ in _assigned(batches, books, cell):
            for p, code in enumerate(codes):
                count[p] += np.bincount(code, minlength=entries)
                own = x[:, p * width:(p + 1) * width]
                for e in np.unique(code).tolist():
                    sums[p, e] += own[code == e].sum(0).astype(object)
        used = np.argwhere(count > 0)
        if len(used):
            p, e, i = (np.repeat(used[:, 0], width), np.repeat(used[:, 1], width),
                       np.tile(np.arange(width), len(used)))
            yield pa.RecordBatch.from_arrays([
                pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(i.astype(np.int32)),
                pa.array(count[p, e]),
                pa.array([Decimal(int(v)) for v in sums[p, e, i]], pa.decimal128(38, 0))],
                names=["part", "entry", "i", "n", "total"])

    rows = (ints.select("v").mapInArrow(add_up, "part int, entry int, i int, n long, total decimal(38,0)")
            .groupBy("part", "entry", "i").agg(F.sum("n").alias("n"),
                                               F.sum("total").cast("decimal(38,0)").alias("total")))
    new = [[list(e) for e in b] for b in books]
    for r in rows.collect():  # a codebook's size
        new[r.part][r.entry][r.i] = int(r.total) // r.n
    return new


def coded(ints: DataFrame, books: list, *, cell: int = CELL) -> DataFrame:
    """(vec_id, label, code, error) of each vector against the final codebooks."""
    def code(batches):
        for batch, _, codes, errors in _assigned(batches, books, cell):
            hexes = np.char.mod("%02x", np.stack(codes, 1))
            total = sum(errors)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array(["".join(h) for h in hexes.tolist()], pa.string()),
                pa.array([min(int(t), MOST) for t in total], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return ints.select("vec_id", "label", "v").mapInArrow(
        code, "vec_id long, label long, code string, error long")


def train(ints: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          cell: int = CELL) -> tuple[DataFrame, list]:
    """The vectors that fit the codebooks, and the codebooks after all rounds
    (none for no vector)."""
    first = ints.filter(F.size("v") % parts == 0).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    head = first.select(F.size("v").alias("n")).first()
    if head is None:
        return ints.limit(0), []
    ints = ints.filter(F.size("v") == head.n)
    seeds = [r.v for r in ints.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    width = head.n // parts
    books = [[list(s[p * width:(p + 1) * width]) for s in seeds] for p in range(parts)]
    for _ in range(rounds):
        books = next_books(ints, books, cell=cell)
    return ints, books


def digest(books: list) -> str:
    """SHA-256 of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def vector_codes(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS, scale: int = SCALE, cell: int = CELL) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of each kept row.
    ``train``, ``digest`` and ``coded`` give codebooks and codes on their own."""
    ints = C.stored(integer_vectors(vectors, id_col=id_col, vector_col=vector_col,
                                    label_col=label_col, scale=scale), "vectors")
    ints, books = train(ints, parts=parts, entries=entries, rounds=rounds, cell=cell)
    if not books:
        none = F.lit(None)
        return ints.select("vec_id", "label", none.cast("string").alias("code"),
                           *[none.cast("long").alias(c) for c in ("error", "label_error")],
                           none.cast("string").alias("codebooks_sha256"))
    rows = C.stored(coded(ints, books, cell=cell), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy(F.col("label").alias("l")).agg(
        F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"))
