"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers. A block of rows is indexed by slices: bitmap b of attribute d holds bit b of every
row's value. A query weighs the slices: each nonzero digit of its component adds the attribute's slices, shifted, into
the columns of one sum, and a tree of carry-save adders brings every column to one bitmap, 64 rows a machine word.
Negative digits add the complemented slices, which shifts all scores of the query alike. The result is the sliced score
of all rows; the top k are read from its most significant slice downward, and rows that tie at the boundary are resolved
exactly, by id. Scores of the few rows found are then added up directly.

Every row goes to one block, whose index is built once; the queries are sent to every block and stream by behind it. A
block keeps k rows a query, and a last window over k rows a block and query ranks them. Work is queries times rows, as
the exact answer asks; what is shuffled is each row once and each query once a block.

Defined cases: null ids, null vectors and those holding null or non-finite components, or components beyond ``LIMIT`` after
scaling (whose scores might not fit a long), take no part; vectors of another
length than the query's are not compared with it; a zero vector scores 0; equal scores rank by id; rows that repeat an
id are queries and candidates each, the query's own row alone being left out; fewer than k candidates give all of them;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows of a block; far fewer would cost more calls than work.
BLOCK = 16_384
#: Largest integer component: products of 2,048 components still fit a long.
LIMIT = 1 << 26


def digits(value: int) -> list[tuple[int, int]]:
    """Signed digits (place, 1 or -1) of an integer, no two neighbours nonzero."""
    out, place = [], 0
    while value:
        if value & 1:
            d = 2 - (value & 3)
            out.append((place, d))
            value -= d
        value >>= 1
        place += 1
    return out


class Slices:
    """The bit-sliced index of one block of integer vectors (rows, attributes)."""

    def __init__(self, values: np.ndarray):
        self.values, self.rows = values, len(values)
        low = values.min(0)
        width = [max(1, int(x).bit_length()) for x in values.max(0) - low]
        words = -(-self.rows // 64)
        self.slices = []
        for d, bits in enumerate(width):
            shifted = (values[:, d] - low[d]).astype(np.uint64)
            planes = ((shifted[None, :] >> np.arange(bits, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(planes, axis=1, bitorder="little")
            own = np.zeros((bits, words * 8), np.uint8)
            own[:, : packed.shape[1]] = packed
            self.slices.append(own.view(np.uint64))
        full = np.zeros(words * 8, np.uint8)
        full[: -(-self.rows // 8)] = np.packbits(np.ones(self.rows, np.uint8), bitorder="little")
        self.all = full.view(np.uint64)

    def score(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of a number that grows with the score, the lowest first."""
        columns: dict[int, list[np.ndarray]] = {}
        for d, value in enumerate(query.tolist()):
            own = self.slices[d]
            for place, sign in digits(value):
                planes = own if sign > 0 else ~own
                for b in range(len(planes)):
                    columns.setdefault(b + place, []).append(planes[b : b + 1])
        out, place, last = [], min(columns, default=0), max(columns, default=-1)
        carried: list[np.ndarray] = []
        while place <= last or carried:
            stack = np.concatenate([*columns.get(place, []), *carried]) if columns.get(place) or carried else np.zeros((1, len(self.all)), np.uint64)
            carried = []
            while len(stack) > 1:
                third = len(stack) // 3
                if not third:  # two are left: a half adder
                    carried.append(stack[:1] & stack[1:])
                    stack = stack[:1] ^ stack[1:]
                    break
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                stack = np.concatenate((half ^ c, stack[3 * third :]))
            out.append(stack[0])
            place += 1
        return out

    def top(self, query: np.ndarray, k: int, without: np.ndarray) -> np.ndarray:
        """Places of the top k rows, rows of equal score by place; ``without`` are places that do not count."""
        left = self.all.copy()
        for p in without:
            left[p >> 6] &= ~(np.uint64(1) << np.uint64(p & 63))
        chosen = np.zeros_like(left)
        have, room = 0, int(np.bitwise_count(left).sum())
        if room > k:
            for plane in reversed(self.score(query)):
                ones = left & plane
                n = int(np.bitwise_count(ones).sum())
                if have + n > k:
                    left = ones
                else:
                    chosen |= ones
                    left &= ~plane
                    have += n
                    if have == k:
                        break
        places = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
        return np.concatenate((places(chosen), places(left)[: k - have]))


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors that take part."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= LIMIT))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(fine & F.col("vec_id").isNotNull()).select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and sizes of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(), offsets[:-1], np.diff(offsets)


class Block:
    """The rows of one block: an index for each length of vectors, rows in the order of ids."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.own: dict[int, tuple] = {}
        ids, rows = (np.concatenate([b.column(k).to_numpy() for b in batches]) for k in (2, 3))
        flat, starts, sizes = _flat(pa.concat_arrays([b.column(4) for b in batches]))
        for size in np.unique(sizes[sizes > 0]).tolist():
            r = np.flatnonzero(sizes == size)
            r = r[np.lexsort((rows[r], ids[r]))]
            by_row = np.argsort(rows[r])
            self.own[size] = (Slices(flat[starts[r][:, None] + np.arange(size)]), ids[r], rows[r], by_row, rows[r][by_row])

    def top(self, query: np.ndarray, row: int, k: int) -> Iterator[tuple[int, int, int]]:
        """(vec_id, row, score) of the k best rows other than ``row``."""
        if len(query) not in self.own:
            return
        index, ids, rows, by_row, sorted_rows = self.own[len(query)]
        a, b = np.searchsorted(sorted_rows, [row, row + 1])
        best = index.top(query, k, by_row[a:b])
        yield from zip(ids[best].tolist(), rows[best].tolist(), (index.values[best] @ query).tolist(), strict=True)


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products with rows other than its own.

    ``is_query`` is a condition on ``vec_id``.
    """
    # a row's own number is written with it, so that it stays
    rows = cut(quantised(vectors, scale, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "quantised")
    blocks = max(1, -(-rows.count() // BLOCK))
    cols = ["block", "query", "vec_id", "row", "v"]
    left = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn("query", F.lit(False)).select(cols)
    right = rows.filter(is_query).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).withColumn("query", F.lit(True)).select(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in batches:
            key, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (query[1:] != query[:-1]))))[: batch.num_rows]
            for a, b in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if key[a] != at:
                    at, held, block = key[a], [], None
                if not query[a]:
                    held.append(part)
                    continue
                if block is None:
                    block, held = Block(held) if held else None, []
                if block is None:
                    continue
                ids, own = part.column(2).to_pylist(), part.column(3).to_pylist()
                flat, starts, sizes = _flat(part.column(4))
                found = [(own[i], ids[i], *x) for i in range(len(ids)) for x in block.top(flat[starts[i] : starts[i] + sizes[i]], own[i], k)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["query_row", "query_id", "vec_id", "row", "score"])

    both = left.unionByName(right).repartitionByRange(blocks, "block").sortWithinPartitions("block", "query")
    best = both.mapInArrow(run, "query_row long, query_id long, vec_id long, row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
