"""Near-duplicate documents by MinHash bands, odd sketches and an exact check on whole shingle sets.

Every document's set of word 5-grams is MinHashed with 128 functions. Bands of four values give the candidate buckets;
all 128 values are folded into a 512-bit parity bitmap (an odd sketch), and the population count of the XOR of two
bitmaps estimates the similarity of a candidate pair, so that only likely pairs are confirmed on the full sets.

Skew: equal sets are one class and enter once. A bucket larger than ``CHUNK`` is dealt into chunks, differently in each
band; likely pairs within a chunk unite documents to clusters, and a bucket whose chunks left several clusters has the
rows outside its largest one compared with all of its rows, by sketch, chunk against chunk. Round one confirms each
document's best partner. Round two takes the clusters that still hold several components: the rows outside a cluster's
largest component meet all of its rows, first by sketch, then, of those with a likely partner of another component, by
full sets. Pairs are never listed: a pair of chunks gives a spanning forest of its links. What grows with the square of
a group is the number of 64-byte sketches compared, for documents that share a band with very many others and are unlike
them; copies cost a row each.

Defined cases: null and empty texts have no shingles and stay alone; texts of fewer than five words have one shingle,
their whole sequence; rows that repeat a doc_id are one document, linked by any of their texts, and have a row each; a
null doc_id has a row, links with nothing and is kept, its component null; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as w
from .common import components, cut, map_groups

SHINGLE, HASHES, ROWS, BITS = 5, 128, 4, 512
BANDS = HASHES // ROWS
#: Estimates this far below the threshold are dropped: five standard deviations of 128 samples at 0.75 are 0.19.
SLACK = 0.19
#: Most rows of a bucket that are compared in one piece.
CHUNK = 512
#: Rows of a chunk on either side where sketches are compared, and words (with 1,000 a row) where texts are.
SKETCHES, TEXTS = (2048, 8192), (1 << 20, 1 << 20)
_rng = np.random.default_rng(20240607)
_MULTIPLY = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_SALT = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingle hashes of all rows, offsets) of runs of whole texts."""
    for first, end, data, offsets in w.text_chunks(column):
        h, _, _, at = w.hash_words(data, offsets, lower=True)
        counts = np.diff(at)
        grams = w.windows(h, size)
        place = w.within(at, size)
        values = [grams[place]] if len(place) else []
        rows = [np.repeat(np.arange(end - first), np.maximum(counts - size + 1, 0))]
        for n in range(1, size):  # the whole sequence of a short text
            short = np.flatnonzero(counts == n)
            if len(short):
                values.append(w.windows(h, n)[at[short]])
                rows.append(short)
        values = np.concatenate(values) if values else np.empty(0, np.uint64)
        rows = np.concatenate(rows)
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
        ends = np.searchsorted(rows, np.arange(end - first + 1))
        for i in np.flatnonzero(np.diff(ends) > 1):
            values[ends[i] : ends[i + 1]].sort()
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        yield first, end, values[new], np.concatenate(([0], np.cumsum(new)))[ends]


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, bands, sketch) of every document; no bands for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, values, at in shingle_sets(batch.column(1)):
                counts = np.diff(at)
                full = np.flatnonzero(counts)
                low = values.astype(np.uint32)
                starts = at[:-1][full]
                mins = np.empty((len(full), HASHES), np.uint32)
                if len(full):
                    for k in range(HASHES):
                        mins[:, k] = np.minimum.reduceat(low * _MULTIPLY[k] + _ADD[k], starts)
                    fp1, fp2 = np.add.reduceat(values, starts), np.add.reduceat(w.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                else:
                    fp1 = fp2 = np.empty(0, np.uint64)
                bands = np.zeros((len(full), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = w.mix(bands + mins[:, k::ROWS].astype(np.uint64) + _SALT[:BANDS])
                odd = (w.mix(mins.astype(np.uint64) + _SALT) % np.uint64(BITS)).astype(np.int64)
                flips = np.bincount((odd + np.arange(len(full))[:, None] * BITS).ravel(), minlength=len(full) * BITS) & 1
                sketch = np.packbits(flips.astype(np.uint8).reshape(-1, BITS), axis=1) if len(full) else np.empty((0, BITS // 8), np.uint8)
                n, lengths = end - first, np.zeros(end - first + 1, np.int32)
                lengths[1:][full] = 1
                place = np.cumsum(lengths, dtype=np.int32)
                none = counts == 0
                whole = lambda x: pa.array(np.where(none, 0, x[np.minimum(place[:-1], max(len(full) - 1, 0))] if len(full) else 0).astype(np.uint64).view(np.int64), mask=none)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(counts.astype(np.int64)),
                        whole(fp1),
                        whole(fp2),
                        pa.ListArray.from_arrays(pa.array(place * np.int32(BANDS)), pa.array(bands.view(np.int64).ravel())),
                        pa.array([None if none[i] else sketch[place[i]].tobytes() for i in range(n)], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "fp1", "fp2", "bands", "sketch"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>, sketch binary")


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    return [values[at[k] : at[k + 1]] for _, _, values, at in shingle_sets(column) for k in range(len(at) - 1)]


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from the XOR of two odd sketches of ``HASHES`` samples each."""
    odd = np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)
    return 1 + BITS / (4 * HASHES) * np.log(np.maximum(1 - 2 * odd / BITS, 1e-9))


def _most_odd(least: float) -> int:
    """The population count up to which the estimate is ``least`` or more."""
    return int(BITS / 2 * (1 - np.exp((least - 1) * 4 * HASHES / BITS)))


def _united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that each place reaches by the links (a, b) and what ``root`` has united before."""
    while True:
        low = root.copy()
        np.minimum.at(low, root[a], root[b])
        np.minimum.at(low, root[b], root[a])
        low = low[low[root]]
        if (low == root).all():
            return root
        root = low


def _runs(t: pa.Table, *keys: str) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of each group of ``keys``; the rows are sorted by them."""
    key = np.zeros(t.num_rows, np.uint64)
    for k in keys:
        key = w.mix(key + t[k].to_numpy().astype(np.int64).view(np.uint64))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return first, np.diff(np.append(first, t.num_rows))


def _best(most: int, block: int = 1 << 18):
    """Each row's most similar partner in its bucket chunk, and (with odd -1) a spanning forest of the likely pairs there.

    Groups of one size are compared together, at most ``block`` pairs at once.
    """

    def run(t: pa.Table) -> pa.Table:
        ids, s = t["doc_id"].to_numpy(), _sketches(t["sketch"])
        root, best, least = np.arange(len(ids)), np.zeros(len(ids), np.int64), np.full(len(ids), BITS)
        starts, sizes = _runs(t, "bucket", "chunk")
        for n in np.unique(sizes[sizes > 1]).tolist():
            first, step = starts[sizes == n], max(1, block // (n * n))
            for k in range(0, len(first), step):
                place = first[k : k + step, None] + np.arange(n)
                odd = np.bitwise_count(s[place][:, :, None] ^ s[place][:, None]).sum(-1, dtype=np.int16)
                odd[ids[place][:, :, None] == ids[place][:, None]] = BITS
                least[place] = odd.min(2)
                best[place] = np.take_along_axis(place, odd.argmin(2), 1)
                g, a, b = np.nonzero(odd <= most)
                root = _united(root, place[g, a], place[g, b])
        good, far = np.flatnonzero(least <= most), np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"x": np.concatenate((ids[good], ids[far])), "y": np.concatenate((ids[best[good]], ids[root[far]])), "odd": np.concatenate((least[good], np.full(len(far), -1)))})

    return run


def _sides(rows: DataFrame, left: int, right: int) -> DataFrame:
    """Rows of the groups with several tags, dealt so that the rows outside a group's commonest tag meet all its rows.

    ``rows`` (part, doc_id, tag, weight, ...); each comes back once for every pair (i, j) of chunks that it is in, as a
    small row of chunk i or as one of all rows of chunk j, chunks holding a weight of about ``left`` and ``right``.
    """
    shares = rows.groupBy("part", "tag").agg(F.sum("weight").alias("c"))
    parts = shares.groupBy("part").agg(F.count("*").alias("tags"), F.sum("c").alias("n"), F.max_by(F.struct("tag", "c"), F.struct("c", -F.col("tag"))).alias("m")).filter("tags > 1")
    pieces = lambda c, most: F.greatest(F.ceil(c / most), F.lit(1)).cast("long")
    parts = cut(parts.select("part", F.col("m.tag").alias("main"), pieces(F.col("n") - F.col("m.c"), left).alias("ni"), pieces(F.col("n"), right).alias("nj")), "parts")
    own = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(n)), F.col(n))
    steps = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    whole = F.transform(steps("ni"), lambda i: F.struct(i.alias("i"), own("nj").alias("j"), F.lit(False).alias("small")))
    small = F.transform(steps("nj"), lambda j: F.struct(own("ni").alias("i"), j.alias("j"), F.lit(True).alias("small")))
    dealt = F.explode(F.when(F.col("tag") != F.col("main"), F.concat(whole, small)).otherwise(whole))
    return rows.join(parts, "part").withColumn("at", dealt).select(*rows.columns, "at.*")


def _likely_pairs(t: pa.Table, most: int, percent: int, block: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Likely pairs (small row, row) of different tags in each pair of chunks, block by block."""
    tag, small, s, size = t["tag"].to_numpy(), t["small"].to_numpy(zero_copy_only=False), _sketches(t["sketch"]), t["n_shingles"].to_numpy()
    for first, n in zip(*(x.tolist() for x in _runs(t, "part", "i", "j")), strict=True):
        one, two = first + np.flatnonzero(small[first : first + n]), first + np.flatnonzero(~small[first : first + n])
        step = max(1, block // max(len(two), 1))
        for k in range(0, len(one) if len(two) else 0, step):
            a = one[k : k + step]
            good = np.bitwise_count(s[a][:, None] ^ s[two][None]).sum(-1, dtype=np.int16) <= most
            good &= tag[a][:, None] != tag[two][None]
            good &= 100 * np.minimum(size[a][:, None], size[two][None]) >= percent * np.maximum(size[a][:, None], size[two][None])
            p, q = np.nonzero(good)
            yield a[p], two[q]


def _bridges(most: int, percent: int):
    """A spanning forest of the likely pairs of each pair of chunks."""

    def run(t: pa.Table) -> pa.Table:
        ids, root = t["doc_id"].to_numpy(), np.arange(t.num_rows)
        for p, q in _likely_pairs(t, most, percent):
            root = _united(root, p, q) if len(p) else root
        far = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"x": ids[far], "y": ids[root[far]]})

    return run


def _likely(most: int, percent: int):
    """The rows that have a likely partner of another tag."""

    def run(t: pa.Table) -> pa.Table:
        good = np.zeros(t.num_rows, bool)
        for p, q in _likely_pairs(t, most, percent):
            good[p] = good[q] = True
        return t.filter(pa.array(good)).select(["part", "doc_id", "tag", "n_shingles", "sketch"])

    return run


def _across(most: int, percent: int):
    """A spanning forest of the confirmed links between rows of different tags in each pair of chunks."""

    def run(t: pa.Table) -> pa.Table:
        sets = _sets(t["text"])
        ids, root, size = t["doc_id"].to_numpy(), np.arange(t.num_rows), np.array([len(x) for x in sets])
        for p, q in _likely_pairs(t, most, percent):
            if len(p):
                one, two = np.unique(p), np.unique(q)
                common = _common([sets[k] for k in one], [sets[k] for k in two])[np.searchsorted(one, p), np.searchsorted(two, q)]
                good = 100 * common >= percent * (size[p] + size[q] - common)
                root = _united(root, p[good], q[good])
        far = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"x": ids[far], "y": ids[root[far]]})

    return run


def _common(one: list[np.ndarray], two: list[np.ndarray], tile: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets: a product of 0/1 matrices over the values that both sides have."""
    out = np.zeros((len(one), len(two)), np.float32)
    x, y = np.concatenate(one), np.concatenate(two)
    names = np.intersect1d(x, y)
    rows = [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (one, two)]
    place = []
    for v in (x, y):
        at = np.minimum(np.searchsorted(names, v), max(len(names) - 1, 0))
        place.append(np.where(names[at] == v, at, -1) if len(names) else np.full(len(v), -1))
    for lo in range(0, len(names), tile):
        both = []
        for row, at, n in ((rows[0], place[0], len(one)), (rows[1], place[1], len(two))):
            own = (at >= lo) & (at < lo + tile)
            m = np.zeros((n, min(tile, len(names) - lo)), np.float32)
            m[row[own], at[own] - lo] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out.astype(np.int64)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets meet 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i in range(0, batch.num_rows, 256):
                one, two = (_sets(batch.column(k).slice(i, 256)) for k in (2, 3))
                for k, (a, b) in enumerate(zip(one, two, strict=True)):
                    met = np.concatenate((a, b))
                    met.sort()
                    common = int((met[1:] == met[:-1]).sum())
                    good[i + k] = 100 * common >= percent * (len(a) + len(b) - common)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["x", "y"])

    one, two = texts.select(F.col("doc_id").alias("x"), F.col("text").alias("tx")), texts.select(F.col("doc_id").alias("y"), F.col("text").alias("ty"))
    return pairs.select("x", "y").join(one, "x").join(two, "y").select("x", "y", "tx", "ty").mapInArrow(run, "x long, y long")


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked id), kept, class_id (smallest id with an equal set)."""
    most = _most_odd(percent / 100 - SLACK)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = cut(signatures(docs), "sig")
    able = sig.filter("n_shingles > 0 and doc_id is not null")
    classes = cut(able.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("class_id")), "classes")
    member = cut(able.select("doc_id", "fp1", "fp2", "n_shingles").join(classes, ["fp1", "fp2", "n_shingles"]).select("doc_id", "class_id"), "member")
    one = cut(able.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n_shingles", "bands", "sketch"), "one")

    # each bucket: best partners, and what is likely alike there
    rows = one.select(F.explode("bands").alias("bucket"), "doc_id")
    sizes = cut(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    found = cut(rows.join(sizes, "bucket").join(one.select("doc_id", "n_shingles", "sketch"), "doc_id"), "found")
    chunk = F.when(F.col("n") <= CHUNK, F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", "bucket"), F.ceil(F.col("n") / CHUNK))).cast("long")
    dealt = found.select("bucket", chunk.alias("chunk"), "doc_id", "sketch")
    met = cut(map_groups(dealt, ["bucket", "chunk"], _best(most), "x long, y long, odd long", size=4096, order=["doc_id"]), "met")
    likely = met.filter("odd < 0").select(F.col("x").alias("a"), F.col("y").alias("b"))
    cluster = cut(components(likely), "cluster")
    hot = found.filter(F.col("n") > CHUNK)
    if not hot.isEmpty():  # rows of a hot bucket that their chunks left in different clusters
        hot = hot.select(F.col("bucket").alias("part"), "doc_id", "n_shingles", "sketch", F.lit(1).alias("weight"))
        hot = hot.join(cluster.select(F.col("id").alias("doc_id"), F.col("component_id").alias("tag")), "doc_id", "left").withColumn("tag", F.coalesce("tag", "doc_id"))
        more = cut(map_groups(_sides(hot, *SKETCHES), ["part", "i", "j"], _bridges(most, percent), "a long, b long", size=4096), "bridges")
        if not more.isEmpty():
            cluster = cut(components(cluster.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(more)), "cluster")

    # round one: the best partner of each document
    first = met.filter("odd >= 0").groupBy("x").agg(F.min_by("y", F.struct("odd", "y")).alias("y"))
    first = cut(first.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "first")
    texts = cut(docs.join(cluster.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"), "texts")
    linked = cut(confirm(first, texts, percent), "linked")
    final = cut(components(linked.select(F.col("x").alias("a"), F.col("y").alias("b"))), "linked")

    # round two: clusters of likely pairs that still hold several components
    rows = cluster.select(F.col("id").alias("doc_id"), F.col("component_id").alias("part")).join(final.select(F.col("id").alias("doc_id"), F.col("component_id").alias("tag")), "doc_id", "left")
    rows = cut(rows.withColumn("tag", F.coalesce("tag", "doc_id")), "tagged")
    open_ = rows.groupBy("part").agg(F.count_distinct("tag").alias("tags")).filter("tags > 1").select("part")
    rows = cut(rows.join(open_, "part", "left_semi").join(one.select("doc_id", "n_shingles", "sketch"), "doc_id"), "open")
    pairs = _sides(rows.withColumn("weight", F.lit(1)), *SKETCHES)
    schema = "part long, doc_id long, tag long, n_shingles long, sketch binary"
    rows = cut(map_groups(pairs, ["part", "i", "j"], _likely(most, percent), schema, size=4096).distinct(), "likely")
    pairs = _sides(rows.withColumn("weight", F.col("n_shingles") + 1000), *TEXTS).join(texts, "doc_id")
    links = map_groups(pairs, ["part", "i", "j"], _across(most, percent), "a long, b long", size=1024)

    # several texts of one doc_id are one document
    several = member.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).filter("a < b").select("doc_id", "a")
    more = cut(links.unionByName(member.join(several, "doc_id").select("a", F.col("class_id").alias("b"))).filter("a <> b").distinct(), "more")
    if not more.isEmpty():
        final = cut(components(final.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(more)), "final")
    own = member.join(final.withColumnRenamed("id", "class_id"), "class_id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component_id", "class_id")).alias("component_id"), F.min("class_id").alias("class_id"))
    out = sig.select("doc_id", "n_shingles").join(own, "doc_id", "left").withColumns({c: F.coalesce(c, "doc_id") for c in ("component_id", "class_id")})
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
