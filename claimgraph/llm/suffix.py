"""Repeated passages by suffix order and longest-previous-factor arrays, in bytes.

A passage repeats if ``LENGTH`` bytes of it start at two places. Suffixes that share so much must meet in one suffix order,
and no one order of all suffixes is needed for that: each window of ``LENGTH`` bytes belongs to the group of its anchor,
the gram of least hash in it, and equal windows have equal anchors. Consecutive windows of one group are a piece of text,
less than twice as long as a window at the first anchor length. Groups that only one piece has are left out, equal pieces
meet in an aggregation and are kept once, and the different pieces of a group are sorted in one task: prefix doubling
orders all their suffixes, the ranks of each doubling give the common prefixes of neighbours, and previous and next smaller
positions in suffix order give the longest previous factor of each. The mirrored array (previous and next larger ones)
tells which have a later match. Bytes of windows with a match go: all of them, or with ``keep="first"`` those that have an
earlier match, so that the first place stays.

Skew: whole copies enter once. A passage in very many documents is one piece but for its ends, where its surroundings
differ; a group of more than ``GROUP`` different pieces is cut again by longer anchors (``GRAMS``), which fewer of them
share, the last being the window itself, of which there is one piece. So no task sorts more than ``GROUP`` pieces, and
nothing is capped. What is counted of a key is written before it meets the key's rows: Spark splits a join of two shuffled
tables where one key has very many rows, but not one whose side is an aggregation by that key. Texts are written once,
bucketed by row, so that each later pass joins them in place.

Defined cases: null texts are empty; texts under ``LENGTH`` bytes lose nothing; matches never cross rows, and rows that
repeat a doc_id, or have none, are documents each; "first" is by doc_id, null last, then the row in the table; bytes go
where windows say so, also within a character; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as w
from .common import cut, fresh_path, map_groups, partitions

LENGTH = 400
#: Lengths of anchors, the last of which is replaced by the window.
GRAMS = (100, 250, 350)
#: Different pieces of a group that one task sorts.
GROUP = 2048
#: Most windows of a piece, and of a slice of a text that is hashed at once.
LONGEST, SLICE = 512, 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_END = (1 << 31) - 1


def _sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` consecutive values, from running minima of blocks to both sides."""
    n = len(x) - span + 1
    if n <= 0 or span == 1:
        return x[: max(n, 0)]
    blocks = -(-len(x) // span)
    grid = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(x)] = x
    grid = grid.reshape(blocks, span)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[span - 1 : span - 1 + n])


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    n = len(data)
    if n < gram:
        return np.empty(0, np.uint64)
    up, down = w.powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return w.mix((sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1])


def _slice_pieces(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, ...]:
    """(row, first byte in the data, windows, group, inner) of the pieces of the windows at ``at``, in order.

    ``inner`` tells whether a piece has its anchor at more than one place, without which no window repeats inside it.
    """
    hashes = _gram_hashes(data, gram)
    low = _sliding_min((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)[at] & _PLACE
    group = hashes[low.astype(np.int64)]
    row = np.searchsorted(offsets, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    if len(count) and count.max() > LONGEST:
        new |= (np.arange(len(at)) - np.repeat(first, count)) % LONGEST == 0
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
    moves = np.zeros(len(at), np.int64)
    moves[1:] = (low[1:] != low[:-1]) & ~new[1:]
    return row[first], at[first], count, group[first], np.add.reduceat(moves, first) > 0 if len(first) else np.empty(0, bool)


def _pieces(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, ...]:
    """As above, over slices of long texts."""
    found = []
    for begin in range(0, len(data), SLICE):
        own = at[np.searchsorted(at, begin) : np.searchsorted(at, begin + SLICE)]
        if len(own):
            row, start, *rest = _slice_pieces(data[begin : begin + SLICE + length - 1], np.clip(offsets - begin, 0, None), own - begin, gram, length)
            found.append((row, start + begin, *rest))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, bool))


def _windows_of(batch: pa.RecordBatch, length: int, wanted: int | None):
    """(first row, bytes, offsets, places of windows) of runs of texts; column ``wanted`` restricts the windows."""
    for first, end, data, offsets in w.text_chunks(batch.column(1)):
        if wanted is None:
            yield first, data, offsets, w.within(offsets, length)
            continue
        places = []
        for i in range(first, end):
            asked = batch.column(wanted)[i].values
            begin, count = asked.field("start").to_numpy().astype(np.int64), asked.field("count").to_numpy().astype(np.int64)
            places.append(np.unique(np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)) + offsets[i - first])
        yield first, data, offsets, np.concatenate(places)


def _anchors(gram: int, length: int, wanted: bool):
    """(g, row, twice): the groups of each text, and whether more than one place of it is in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, data, offsets, at in _windows_of(batch, length, 2 if wanted else None):
                row, _, _, group, inner = _pieces(data, offsets, at, gram, length)
                order = np.lexsort((group, row))
                row, group, inner = row[order], group[order], inner[order]
                start = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (group[1:] != group[:-1])))[: len(row)])
                if len(start):
                    twice = (np.diff(np.append(start, len(row))) > 1) | np.maximum.reduceat(inner, start)
                    yield pa.RecordBatch.from_arrays([pa.array(group[start].view(np.int64)), pa.array(ids[first + row[start]]), pa.array(twice)], names=["g", "row", "twice"])

    return run


def _cut_pieces(gram: int, length: int, wanted: bool):
    """(g, h, l, o, row, start, count, inner): the pieces of shared groups, h and l being a 128-bit hash of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.uint64(0x9E6C63D0876A9A47)
        for batch in batches:
            ids, order, shared = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3)
            for first, data, offsets, at in _windows_of(batch, length, 4 if wanted else None):
                row, start, count, group, inner = _pieces(data, offsets, at, gram, length)
                lists = shared.slice(first, len(offsets) - 1)
                own = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                pair = lambda r, g: w.mix(g ^ (r.astype(np.uint64) * salt))
                good = np.flatnonzero(np.isin(pair(row, group), pair(own, lists.flatten().to_numpy().view(np.uint64))))
                if not len(good):
                    continue
                row, start, count, group, inner = row[good], start[good], count[good], group[good], inner[good]
                raw = data.tobytes()
                hashes = np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), (start + count + length - 1).tolist(), strict=True)), np.int64).reshape(-1, 2)
                columns = [group.view(np.int64), hashes[:, 0], hashes[:, 1], order[first + row], ids[first + row], (start - offsets[row]).astype(np.int32), count.astype(np.int32), inner]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["g", "h", "l", "o", "row", "start", "count", "inner"])

    return run


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` (ascending) in order of their first ``length`` bytes, ties by place, and the common prefix of
    each with the one before it, at most ``length``; each start has ``length`` bytes from it on.
    """
    n = len(data)
    wide = np.zeros(n + 8, np.uint8)
    wide[:n] = data
    first = np.zeros(n, np.uint64)
    for i in range(8):
        first = (first << np.uint64(8)) | wide[i : i + n]
    names, sizes = [_named(first)], [8]
    while sizes[-1] < length:
        step = min(sizes[-1], length - sizes[-1])
        rank = names[-1]
        after = np.zeros(n, np.uint64)
        after[: max(n - step, 0)] = rank[step:]
        names.append(_named((rank.astype(np.uint64) << np.uint64(32)) | after))
        sizes.append(sizes[-1] + step)
    final = names[-1][starts]
    order = np.argsort(final, kind="stable")
    sa = starts[order]
    a, b = sa[1:], sa[:-1]
    shared = np.zeros(len(a), np.int64)
    same = final[order][1:] == final[order][:-1]
    for rank, size in zip(names[-2::-1], sizes[-2::-1], strict=True):  # descending sizes, as far as both have equal ranks
        p, q = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        shared += np.where((rank[p] == rank[q]) & (shared + size <= length), size, 0)
    rest = shared < length
    for _ in range(8):  # single bytes below the first size
        p, q = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        rest &= (wide[p] == wide[q]) & (shared < length)
        shared += rest
    lcp = np.zeros(len(sa), np.int64)
    lcp[1:] = np.where(same, length, np.minimum(shared, length))
    return sa, lcp


def _named(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the different ones."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.zeros(len(keys), np.uint32)
    np.cumsum(ranked[1:] != ranked[:-1], out=new[1:])
    out = np.empty(len(keys), np.uint32)
    out[order] = new
    return out


def longest_previous(sa: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factor of each suffix, in suffix order: its longest common prefix with one at a smaller position.

    It is the longer of those with the previous and the next smaller position in suffix order, which pointers find that
    skip what is already known to be larger. Factors under ``least`` count as none.
    """
    n = len(sa)
    best = np.zeros(n, np.int64)
    for side in (1, -1):
        place, near = (sa, lcp) if side == 1 else (sa[::-1], np.concatenate(([0], lcp[:0:-1])))
        to, common = np.arange(n) - 1, near.copy()
        to[common < least] = -1
        open_ = np.flatnonzero(to >= 0)
        open_ = open_[place[to[open_]] > place[open_]]
        while len(open_):
            over = to[open_]
            common[open_] = np.minimum(common[open_], common[over])
            to[open_] = np.where(common[open_] >= least, to[over], -1)
            open_ = open_[to[open_] >= 0]
            open_ = open_[place[to[open_]] > place[open_]]
        found = np.where(to >= 0, common, 0)
        best = np.maximum(best, found if side == 1 else found[::-1])
    return best


def _matched(texts: list[bytes], length: int, first: bool) -> list[np.ndarray]:
    """Which windows of each piece have an earlier match or, unless ``first``, a later one; pieces stand in order of place."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    counts = np.array([len(t) - length + 1 for t in texts])
    begin = np.cumsum(counts) - counts
    starts = np.arange(counts.sum()) + np.repeat(ends - [len(t) for t in texts] - begin, counts)
    sa, lcp = suffix_order(data, starts, length)
    hit = longest_previous(sa, lcp, length) >= length
    if not first:
        hit |= longest_previous(-sa, lcp, length) >= length
    flags = np.zeros(len(data), bool)
    flags[sa[hit]] = True
    return np.split(flags[starts], begin[1:])


def _sort_groups(length: int, first: bool, size: int = 1 << 20):
    """Spans (row, lo, hi) of repeated bytes in the pieces of whole groups."""

    def spans(rows, texts):
        for (row, start), hit in zip(rows, _matched(texts, length, first), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
            yield from ((row, start + a, start + b + length - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))

    def run(table: pa.Table) -> pa.Table:
        group, found = table["g"].to_numpy(), []
        rows = list(zip(table["row"].to_pylist(), table["start"].to_pylist(), strict=True))
        texts = table["piece"].to_pylist()
        border = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))).tolist() + [len(group)]
        begin = held = 0
        for a, b in zip(border, border[1:], strict=False):
            held += sum(map(len, texts[a:b]))
            if held > size or b == len(group):
                found.extend(spans(rows[begin:b], texts[begin:b]))
                begin, held = b, 0
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["row", "lo", "hi"]) if found else None

    return run


def _read_pieces(length: int):
    """(g, o, row, start, piece) of the asked places of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row, text, order, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for x in asked:
                    out.append((x["g"], order, row, x["start"], raw[x["start"] : x["start"] + x["count"] + length - 1]))
                    held += len(out[-1][-1])
                if held > 1 << 22:
                    yield _piece_batch(out)
                    out, held = [], 0
            if out:
                yield _piece_batch(out)

    return run


def _piece_batch(out: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["g", "o", "row", "start", "piece"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without the bytes of their spans."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts, spans = batch.column(1), batch.column(2)
        for first in range(0, batch.num_rows, 256):
            size, gone, runs, kept = [], [], [], []
            for i in range(first, min(first + 256, batch.num_rows)):
                raw, own = texts[i].as_py().encode(), []
                for x in sorted((s["lo"], s["hi"]) for s in spans[i].as_py() or []):
                    if own and x[0] <= own[-1][1]:
                        own[-1] = (own[-1][0], max(own[-1][1], min(x[1], len(raw))))
                    else:
                        own.append((x[0], min(x[1], len(raw))))
                ends = [0, *(y for x in own for y in x), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                size.append(len(raw))
                gone.append(sum(b - a for a, b in own))
                runs.append([{"start": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(size)), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()), pa.array(runs, span)], names=["doc_id", "n_bytes", "n_removed", "kept", "repeats"]
            )


_OUT = "doc_id long, n_bytes long, n_removed long, kept binary, repeats array<struct<start:long,end:long>>"


def _by_row(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` as a table of the shared folder bucketed by row, which later joins on row read in place."""
    n, name = partitions(spark), f"claimgraph_{uuid.uuid4().hex}"
    df.repartition(n, "row").write.bucketBy(n, "row").option("path", fresh_path(spark, "texts")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def remove_long_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, kept (the remaining bytes), repeats (maximal removed byte spans).

    ``keep="none"`` removes a passage of ``length`` bytes that starts at two places from both, ``keep="first"`` from the later.
    """
    if keep not in ("none", "first") or length < 8:
        raise ValueError("keep is 'none' or 'first', and length 8 or more")
    spark, first = docs.sparkSession, keep == "first"
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    long = docs.filter(F.octet_length("text") >= length).withColumn("row", F.monotonically_increasing_id()).withColumn("o", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    texts = _by_row(long.withColumn("key", F.unhex(F.substring(F.sha2(F.encode("text", "UTF-8"), 256), 1, 32))), spark)

    place = F.struct("o", "row")
    copied = cut(texts.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo < hi").drop("hi"), "copied")
    copies = cut(texts.select("key", "o", "row").join(copied, "key").select("row", (place > F.col("lo")).alias("later")), "copies")
    later = copies.filter("later").select("row")
    spans = [(later if first else copies).select("row", F.lit(0).alias("lo"), F.lit(_END).alias("hi"))]

    own = texts.select("row", "text", "o").join(later, "row", "left_anti")
    wanted = None
    for gram in (*(g for g in GRAMS if g < length), length):
        asked = own if wanted is None else texts.select("row", "text", "o").join(wanted, "row")
        also = [] if wanted is None else ["wanted"]
        anchors = cut(asked.select("row", "text", *also).mapInArrow(_anchors(gram, length, wanted is not None), "g long, row long, twice boolean"), "anchors")
        shared = anchors.groupBy("g").agg(F.min("row").alias("a"), F.max("row").alias("b"), F.max("twice").alias("twice")).filter("a < b or twice").select("g")
        shared = cut(shared, "shared")
        lists = cut(anchors.select("g", "row").join(shared, "g").groupBy("row").agg(F.collect_list("g").alias("groups")), "groups")
        met = texts.select("row", "text", "o").join(lists, "row")
        met = met if wanted is None else met.join(wanted, "row")
        pieces = met.select("row", "text", "o", "groups", *also).mapInArrow(_cut_pieces(gram, length, wanted is not None), "g long, h long, l long, o long, row long, start int, count int, inner boolean")
        pieces = cut(pieces, "pieces")
        place = F.struct("o", "row", "start")
        once = pieces.groupBy("g", "h", "l").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("inner").alias("inner"), F.max("count").alias("count"))
        once = cut(once, "once")
        whole = once.filter("lo < hi").select("g", "h", "l", "lo")
        whole = pieces.join(whole, ["g", "h", "l"]).filter(F.lit(not first) | (place > F.col("lo")))
        spans.append(whole.select("row", F.col("start").alias("lo"), (F.col("start") + F.col("count") + length - 1).alias("hi")))

        groups = once.groupBy("g").agg(F.count("*").alias("n"), F.max("inner").alias("any")).filter("n > 1 or any").select("g", (F.lit(gram < length) & (F.col("n") > GROUP)).alias("hot"))
        groups = cut(groups, "flags")
        mixed = cut(once.join(groups, "g").select("g", "lo.o", "lo.row", "lo.start", "count", "hot"), "mixed")
        asks = mixed.filter("not hot").groupBy("row").agg(F.collect_list(F.struct("g", "start", "count")).alias("asked"))
        read = texts.select("row", "text", "o").join(asks, "row").mapInArrow(_read_pieces(length), "g long, o long, row long, start int, piece binary")
        spans.append(cut(map_groups(read, ["g"], _sort_groups(length, first), "row long, lo int, hi int", 2000, ["o", "row", "start"]), "spans"))
        wanted = mixed.filter("hot").groupBy("row").agg(F.collect_list(F.struct("start", "count")).alias("wanted"))
        if mixed.filter("hot").isEmpty():
            break
        wanted = cut(wanted, "wanted")

    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    every = cut(every.groupBy("row").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "all")
    changed = texts.select("row", "doc_id", "text").join(every, "row", "left").select("doc_id", "text", "spans").mapInArrow(_remove, _OUT)
    short = docs.filter(F.octet_length("text") < length)
    same = short.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.encode("text", "UTF-8").alias("kept"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("repeats"))
    return changed.unionByName(same)
