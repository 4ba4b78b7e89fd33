"""Vector code compression: a product quantiser whose k-means keeps Drake-Hamerly bounds.

Vectors become integers, are cut into equal parts, and each part position has a codebook. A round assigns every part to
the nearest entry and then moves each entry to the floored mean of its parts, all in integers, so that any order of rows
gives the same codebooks.

Most assignments do not change from round to round, and bounds prove it without looking at all entries. With each part are
kept, from round to round in a written table, its entry, the ``b`` next closest entries with a lower bound of the distance
to each, and one outer bound for all the rest. When entries move, the bounds shrink by how far: an entry's own bound by its
own move, the outer one by the largest. The distance to the part's own entry is taken anew, in integers. If it is below all
bounds nothing is to do; if it is below the outer bound only the kept entries are measured, in integers, and put in order
again; otherwise all are. Bounds are rounded downward and compared strictly, so that ties are always settled by integers.
``b`` adapts to each part position by what the last round had to look at.

Each round is one pass over the rows without a shuffle: the sums of a task are rows of the table that it writes, a few
for a task, and codebooks of ``parts * entries`` integers vectors are what reaches the driver. A lost executor repeats its
task on the written table of the round before; the table before that is deleted.

Defined cases: vectors that are null, empty, hold null or non-finite components, or components beyond ``LIMIT`` after
scaling (their errors would not fit a long) take no part; nor do those whose length is not a multiple of the parts, or
not that of the vector with the smallest id (the shortest, then the smallest vector, where ids repeat). Fewer rows than
entries give so many entries; entries that no part chooses stay. Rows that repeat an id are rows each; null ids come last;
null labels are one label; a label_error that does not fit a long is null; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written

#: Largest integer component.
LIMIT = 1 << 24
#: One part in so many may need a look beyond the kept entries before more are kept.
SLACK = 16
_NONE = 255
_STATE = "vec_id long, label string, v array<int>, near binary, bounds binary, part int, entry int, pos int, total long"


def quantised(vectors: DataFrame, scale: int, parts: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of the vectors that take part, of any length."""
    v = F.col("v")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    # before the floor, which may not fit
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= LIMIT))
    own = own.filter(v.isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & fine)
    return own.select("vec_id", "label", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"))


def _down(x: np.ndarray) -> np.ndarray:
    """Nonnegative numbers in 16 bits each, rounded downward."""
    return (np.maximum(x, 0).astype(np.float32).view(np.uint32) >> np.uint32(16)).astype(np.uint16)


def _up(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows (n, d) to entries (k, d) or to the rows' own entries (n, k, d)."""
    diff = x[:, None, :] - (entries if entries.ndim == 3 else entries[None])
    return np.einsum("nkd,nkd->nk", diff, diff)


def _ranked(squares: np.ndarray, names: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest name of each row (ties: the lower), the ``b`` next, and bounds of these and of the rest."""
    order = np.lexsort((names, squares), axis=-1)
    names, far = np.take_along_axis(names, order, 1), np.sqrt(np.take_along_axis(squares, order, 1).astype(np.float64))
    far[names == _NONE] = np.inf
    rest = far[:, b + 1] if far.shape[1] > b + 1 else np.full(len(far), np.inf)
    near, low = np.full((len(names), b + 1), _NONE, np.uint8), np.full((len(names), b + 1), np.inf)
    have = min(b + 1, names.shape[1])
    near[:, :have] = names[:, :have]
    low[:, : have - 1] = far[:, 1:have]
    low[:, b] = rest
    return near[:, 0], near[:, 1:], low


class Bounds:
    """What is kept of one part position for many rows: entry, next entries, their bounds and the outer bound."""

    def __init__(self, x: np.ndarray, entries: np.ndarray, b: int):
        every = np.broadcast_to(np.arange(len(entries), dtype=np.uint8), (len(x), len(entries)))
        self.own, self.near, self.low = _ranked(_squares(x, entries), every, b)

    @classmethod
    def kept(cls, own: np.ndarray, near: np.ndarray, low: np.ndarray, b: int) -> Bounds:
        """As they were written, with room for ``b`` entries now."""
        self = cls.__new__(cls)
        n, was = near.shape
        self.own = own.copy()
        self.near, self.low = np.full((n, b), _NONE, np.uint8), np.full((n, b + 1), np.inf)
        have = min(b, was)
        self.near[:, :have], self.low[:, :have] = near[:, :have], low[:, :have]
        self.low[:, b] = low[:, have:].min(1)
        return self

    def follow(self, x: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Assign anew after the entries moved; the number of kept places each row had to look at (one more: all entries)."""
        b = self.near.shape[1]
        by = np.concatenate((moved, np.zeros(_NONE + 1 - len(moved))))[self.near] if b else np.zeros((len(x), 0))
        # shortened by more than all rounding errors
        self.low = np.maximum(self.low * (1 - 1e-6) - np.concatenate((by, np.full((len(x), 1), moved.max())), 1), 0)
        here = np.sqrt(_squares(x, entries[self.own][:, None]).astype(np.float64))[:, 0] * (1 + 1e-9)
        open_ = self.low <= here[:, None]
        looked = np.where(open_.any(1), b + 1 - open_[:, ::-1].argmax(1), 0)
        some = np.flatnonzero((looked > 0) & (looked <= b))
        if len(some):
            names = np.concatenate((self.own[some, None], self.near[some]), 1)
            squares = _squares(x[some], entries[np.minimum(names, len(entries) - 1)])
            squares[names == _NONE] = np.iinfo(np.int64).max
            rest = self.low[some, b]
            self.own[some], self.near[some], self.low[some] = _ranked(squares, names, b)
            self.low[some, b] = rest
        every = np.flatnonzero(looked > b)
        if len(every):
            fresh = Bounds(x[every], entries, b)
            self.own[every], self.near[every], self.low[every] = fresh.own, fresh.near, fresh.low
        return looked


def _sums(x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each entry, and behind them their number."""
    out = np.zeros((k, x.shape[1] + 1), np.int64)
    np.add.at(out, own, np.concatenate((x, np.ones((len(x), 1), np.int64)), 1))
    return out


class Round:
    """One pass: assign the parts to the codebooks, then either write what the next round needs or the final codes."""

    def __init__(self, codebooks: np.ndarray, moved: np.ndarray | None, width: list[int], was: list[int], final: bool):
        self.codebooks, self.moved, self.width, self.was, self.final = codebooks, moved, width, was, final

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, d = self.codebooks.shape
        totals, seen = np.zeros((parts, k, d + 1), np.int64), np.zeros((parts, _NONE + 1), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q = batch.column(2).flatten().to_numpy().reshape(n, parts, d)
            if self.moved is not None:
                near = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, -1)
                low = _up(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16)).reshape(n, -1)
            held, error, at = [], np.zeros(n, np.int64), 0
            for p in range(parts):
                x, b = q[:, p].astype(np.int64), self.width[p]
                if self.moved is None:
                    now = Bounds(x, self.codebooks[p], b)
                else:
                    end = at + self.was[p] + 1
                    now = Bounds.kept(near[:, at], near[:, at + 1 : end], low[:, at:end], b)
                    seen[p] += np.bincount(now.follow(x, self.codebooks[p], self.moved[p]), minlength=_NONE + 1)
                    at = end
                held.append(now)
                if self.final:
                    error += _squares(x, self.codebooks[p][now.own][:, None])[:, 0]
                else:
                    totals[p] += _sums(x, now.own, k)
            if self.final:
                own = np.ascontiguousarray(np.stack([h.own for h in held], 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes().hex() for r in own]), pa.array(error)], names=["vec_id", "label", "code", "error"])
                continue
            near = np.ascontiguousarray(np.concatenate([np.concatenate((h.own[:, None], h.near), 1) for h in held], 1))
            low = np.ascontiguousarray(_down(np.concatenate([h.low for h in held], 1)))
            yield self._rows(n, batch.columns[:3], [r.tobytes() for r in near], [r.tobytes() for r in low])
        if not self.final:
            yield self._totals(totals, seen)

    def _rows(self, n, columns, near, low):
        empty = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
        return self._batch([*columns, pa.array(near, pa.binary()), pa.array(low, pa.binary()), *empty])

    def _totals(self, totals, seen):
        parts, k, d = totals.shape
        p, e, i = (x.ravel() for x in np.indices((parts, k, d)))
        where = [np.concatenate(x) for x in ((p, np.repeat(np.arange(parts), _NONE + 1)), (e, np.full(seen.size, -1)), (i, np.tile(np.arange(_NONE + 1), parts)))]
        total = np.concatenate((totals.ravel(), seen.ravel()))
        used = total != 0
        n = int(used.sum())
        empty = [pa.nulls(n, t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary(), pa.binary())]
        return self._batch([*empty, *(pa.array(x[used], pa.int32()) for x in where), pa.array(total[used], pa.int64())])

    @staticmethod
    def _batch(columns):
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _STATE.split(", ")])


def _next_width(seen: np.ndarray, b: int, k: int) -> int:
    """How many next entries to keep of a part position, from how many places its rows had to look at."""
    if seen[b + 1 :].sum() * SLACK > seen.sum():
        return min(k - 1, 2 * b)
    beyond = seen[::-1].cumsum()[::-1]  # rows that looked at so many places or more
    return min(b, max(1, int(np.flatnonzero(beyond * SLACK <= seen.sum())[0]) if seen.any() else b))


def vector_codes(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """The codes (vec_id, label, code, error) of all vectors that take part, and the codebooks (part, entry, position).

    The entries start as the parts of the smallest ids; at most 255 entries. ``code`` is the 0-based entry of each part,
    two hexadecimal digits each; ``error`` is the sum of squared distances to them.
    """
    spark = vectors.sparkSession
    own = quantised(vectors, scale, parts, id_col, vector_col, label_col)
    by_id = [F.col("vec_id").asc_nulls_last(), F.size("v"), F.col("v")]
    first = own.select("vec_id", "v").orderBy(*by_id).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), np.empty((parts, 0, 0), np.int64)
    state = Written(own.filter(F.size("v") == len(first[0]["v"])), "vectors")
    start = state.df.select("vec_id", "v").orderBy(*by_id).limit(entries).collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    k, d = books.shape[1:]
    width = was = [min(k - 1, max(1, k // 4))] * parts
    moved = None
    for _ in range(rounds):
        columns = ["vec_id", "label", "v"] + ([] if moved is None else ["near", "bounds"])
        after = Written(state.df.filter("part is null" if moved is not None else "true").select(columns).mapInArrow(Round(books, moved, width, was, False), _STATE), "round")
        state.drop()
        state, was = after, width
        totals, seen = np.zeros((parts, k, d + 1), np.int64), np.zeros((parts, _NONE + 1), np.int64)
        for p, e, i, total in state.df.filter("part is not null").groupBy("part", "entry", "pos").agg(F.sum("total")).collect():
            (totals[p, e] if e >= 0 else seen[p])[i] = total
        count = totals[:, :, d:]
        after = np.where(count > 0, totals[:, :, :d] // np.maximum(count, 1), books)
        moved = np.sqrt(np.square((after - books).astype(np.float64)).sum(2)) * (1 + 1e-9)
        width = [_next_width(seen[p], was[p], k) for p in range(parts)]
        books = after
    columns = ["vec_id", "label", "v"] + ([] if moved is None else ["near", "bounds"])
    codes = Written(state.df.filter("part is null" if moved is not None else "true").select(columns).mapInArrow(Round(books, moved, width, was, True), "vec_id long, label string, code string, error long"), "codes")
    state.drop()
    return codes.df, books


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the errors summed over rows of equal labels, nulls together."""
    total = F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error")
    sums = codes.groupBy(F.col("label").alias("_label")).agg(total)
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """sha256 of all components in the order of part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def decode(codes: DataFrame, codebooks: np.ndarray, scale: int = 4096) -> DataFrame:
    """(vec_id, vector): the entries of each code one after the other, divided by ``scale``."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(-1, parts)
            flat = codebooks[np.arange(parts), code].reshape(len(code), -1) / scale
            ends = pa.array(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))], names=["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, vector array<double>")
