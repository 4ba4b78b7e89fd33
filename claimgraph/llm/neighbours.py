"""Near-duplicate vectors by a forest of random-projection trees with spill.

Trees are fitted on a bounded sample: a node projects on a random direction and splits at the sample's median; vectors
within a margin of the split go both ways, the margin being set by how far apart two linked vectors project. All vectors
are routed, each to one leaf or more of every tree. Within a leaf and label, cosines are taken in double precision. A
pair that meets in several leaves counts in the first they share, so links are counted without listing pairs: a leaf
gives one row a vector, its links and the smallest id it reaches there, and these are united.

The bounded sample gives a bounded number of leaves; leaves that hold over ``CAP`` rows are split further by Spark, at
medians of all their rows, with the same spill.

Skew: equal vectors of a label enter once, with their count. A leaf of vectors so alike that the sides of a split would
cost nearly as much as the leaf is dealt into chunks, and each pair of chunks is compared by itself; if it holds its whole
label, the label is compared in it alone.

Defined cases: null labels, null or zero vectors, and vectors with null or non-finite components link with nothing but
have a row; vectors of different length never link; repeated ids are rows each, and a
component is named by the smallest id in it; very small and very large components count like others; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut

#: Most vectors the trees are fitted on.
SAMPLE = 16_384
TREES, LEAF, SPILL = 4, 256, 0.64
CAP = 2048


def grow(sample: np.ndarray, depth: int, margin: float, seed: int) -> list[tuple]:
    """Nodes (direction, split, left, right) of one tree, the root first; a leaf is None."""
    rng = np.random.default_rng(seed)
    nodes: list = []

    def split(own: np.ndarray, level: int) -> int:
        place = len(nodes)
        nodes.append(None)
        if level >= depth or len(own) < 32:
            return place
        direction = rng.standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        p = sample[own] @ direction
        middle = float(np.median(p))
        left, right = own[p <= middle + margin], own[p > middle - margin]
        if vain(len(left), len(right), len(own)):
            return place
        nodes[place] = (direction, middle, split(left, level + 1), split(right, level + 1))
        return place

    split(np.arange(len(sample)), 0)
    return nodes


def route(nodes: list, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves that the rows of ``x`` reach."""
    rows, leaves = [], []
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, own = todo.pop()
        if not len(own):
            continue
        if nodes[at] is None:
            rows.append(own)
            leaves.append(np.full(len(own), at))
            continue
        direction, middle, left, right = nodes[at]
        p = x[own] @ direction
        todo += [(left, own[p <= middle + margin]), (right, own[p > middle - margin])]
    return (np.concatenate(rows), np.concatenate(leaves)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def _matrix(column, size: int, pick: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The rows in double precision, each scaled by a power of two so that no square is lost or overflows."""
    x = column[starts[pick][:, None] + np.arange(size)].astype(float)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if x.size else x


def vain(left, right, rows):
    """Whether comparing both sides of a split would cost nearly as much as comparing all its rows with each other."""
    return left * left + right * right > 0.9 * rows * rows


def _lists(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values, starts and sizes of an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets[:-1], np.diff(offsets)


def _compare(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        ids, count, chunk = t["vec_id"].to_numpy(), t["copies"].to_numpy(), t["chunk"].to_numpy()
        key = t["key"][0].as_py()
        flat, starts, sizes = _lists(t["v"])
        x = _matrix(flat, int(sizes[0]), np.arange(len(ids)), starts)
        norm = np.sqrt((x * x).sum(1))
        cos = (x @ x.T) / (norm[:, None] * norm[None, :])
        link = np.triu(cos >= threshold, 1)
        if chunk.min() != chunk.max():  # a pair of chunks: what lies within one is compared elsewhere
            link &= chunk[:, None] != chunk[None, :]
        a, b = np.nonzero(link)
        if len(a):
            keys, where, many = _lists(t["keys"])
            row = np.repeat(np.arange(len(ids)), many)
            names, col = np.unique(keys, return_inverse=True)
            earlier = names[col] < key
            if earlier.any():
                has = np.zeros((len(ids), len(names)), np.float32)
                has[row[earlier], col[earlier]] = 1
                fresh = (has @ has.T)[a, b] == 0
                a, b = a[fresh], b[fresh]
        links = np.bincount(a, count[b], len(ids)) + np.bincount(b, count[a], len(ids))
        root = ids.copy()
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            if (low == root).all():
                break
            root = low
        own = np.flatnonzero(links)
        return pa.table({"vec_id": ids[own], "links": links[own].astype(np.int64), "root": root[own]})

    return run


def _leaf_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label", "key").agg(F.count("*").alias("n"))


def _split_large(routed: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``routed`` with its leaves of over ``CAP`` rows split further, and the leaves (label, key, n) that stay larger.

    All rows of such a leaf are projected on a direction that its key gives, and Spark finds their median, so leaves stay
    bounded however many vectors there are; a leaf of which a split keeps too many rows on both sides stays whole.
    """
    places = cut(routed.select("label", "rep", F.explode("keys").alias("key")), "places")
    big = cut(_leaf_sizes(places).filter(F.col("n") > CAP), "big")
    if big.isEmpty():
        return routed, big
    done, stuck = places.join(big, ["label", "key"], "left_anti"), None
    places = places.join(big.select("label", "key"), ["label", "key"], "left_semi")
    vectors = routed.select("label", "rep", "v")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(2).to_numpy()
            flat, starts, sizes = _lists(batch.column(3))
            p = np.empty(len(key))
            for k, size in set(zip(key.tolist(), sizes.tolist(), strict=True)):
                own = np.flatnonzero((key == k) & (sizes == size))
                x = _matrix(flat, size, own, starts)
                direction = np.random.default_rng([k & 0x7FFFFFFFFFFFFFFF, size]).standard_normal(size)
                p[own] = x @ direction / np.linalg.norm(direction) / np.linalg.norm(x, axis=1)
            margin = SPILL * np.sqrt((2 - 2 * threshold) / np.maximum(sizes, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p), pa.array(margin)], names=["label", "rep", "key", "p", "margin"])

    while True:
        at = places.join(vectors, ["label", "rep"]).select("label", "rep", "key", "v").mapInArrow(project, "label string, rep long, key long, p double, margin double")
        at = cut(at, "projected")
        middle = cut(at.groupBy("label", "key").agg(F.percentile_approx("p", 0.5, 1000).alias("m"), F.count("*").alias("n")), "middle")
        sides = F.filter(F.array(F.when(F.col("p") <= F.col("m") + F.col("margin"), 0), F.when(F.col("p") > F.col("m") - F.col("margin"), 1)), lambda x: x.isNotNull())
        split = cut(at.join(middle, ["label", "key"]).select("label", "rep", F.col("key").alias("parent"), "n", F.explode(sides).alias("side")).withColumn("key", F.xxhash64("parent", "side")), "split")
        parts = split.groupBy("label", "parent", "n").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
        alike = cut(parts.filter(vain(F.col("a").cast("double"), F.col("b"), F.col("n"))).select("label", F.col("parent").alias("key"), "n"), "alike")
        stuck = alike if stuck is None else stuck.unionByName(alike)
        kept = at.join(alike, ["label", "key"], "left_semi").select("label", "rep", "key")
        split = split.join(alike.select("label", F.col("key").alias("parent")), ["label", "parent"], "left_anti").select("label", "rep", "key")
        big = cut(_leaf_sizes(split).filter(F.col("n") > CAP), "big")
        done = done.unionByName(kept).unionByName(split.join(big, ["label", "key"], "left_anti"))
        if big.isEmpty():
            break
        places = split.join(big.select("label", "key"), ["label", "key"], "left_semi")
    # a leaf that holds all of a label and stays whole compares all its pairs: the label needs no other leaf
    stuck = cut(stuck, "stuck")
    total = routed.groupBy("label").agg(F.count("*").alias("n"))
    only = cut(stuck.join(total, ["label", "n"]).groupBy("label").agg(F.min("key").alias("only")), "only")
    if not only.isEmpty():
        done, stuck = (df.join(only, "label", "left").filter("only is null or key = only").drop("only") for df in (done, stuck))
        stuck = cut(stuck, "stuck")
    keys = done.groupBy("label", "rep").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    return cut(routed.drop("keys").join(keys, ["label", "rep"]).select("label", "rep", "v", "copies", "keys"), "routed"), stuck


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", trees: int = TREES) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.col(label_col).cast("string").alias("label"))
    fine = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.filter(fine)
    # a set's number is written with it, so that it stays; ids may name several vectors
    sets = good.groupBy("label", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    sets = cut(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")
    n, largest, twice = sets.groupBy("label").agg(F.count("*").alias("n"), F.max("copies").alias("c")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n"), F.max("c")).first()
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    alone = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not n:
        return alone.select("*", kept)
    sample = sets.select("v", "low").orderBy(F.xxhash64("low"), "low", "v").limit(SAMPLE).select("v").toArrow()
    flat, starts, sizes = _lists(sample["v"])
    depth = max(0, int(np.ceil(np.log2(max(largest / LEAF, 1)))))
    forest: dict[int, list] = {}
    for size in np.unique(sizes).tolist():
        own = _matrix(flat, size, np.flatnonzero(sizes == size), starts)
        own /= np.linalg.norm(own, axis=1, keepdims=True)
        margin = SPILL * float(np.sqrt((2 - 2 * threshold) / size))
        forest[size] = [margin, *(grow(own, depth, margin, 1000 * size + t) for t in range(trees))]
    sent = sets.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample: a node a few sampled vectors

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, sizes = _lists(batch.column(2))
            who, what = [], []
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                plan = sent.value.get(size)
                if plan is None:
                    who.append(own)
                    what.append(np.full(len(own), size << 40))
                    continue
                x = _matrix(flat, size, own, starts)
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                for t, nodes in enumerate(plan[1:]):
                    r, leaf = route(nodes, x, plan[0])
                    who.append(own[r])
                    what.append((size << 40) + (t << 32) + leaf)
            row, key = np.concatenate(who), np.concatenate(what)
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(key))], names=["label", "rep", "v", "copies", "keys"])

    kind = dict(sets.dtypes)["v"]
    routed = cut(sets.select("label", "rep", "v", "copies").mapInArrow(leaves, f"label string, rep long, v {kind}, copies long, keys array<long>"), "routed")
    routed, big = _split_large(routed, threshold)
    rows8 = routed.select("label", F.col("rep").alias("vec_id"), "v", "copies", "keys", F.explode("keys").alias("key"))
    whole = rows8.withColumn("chunk", F.lit(0).cast("long")).withColumn("other", F.lit(0).cast("long"))
    if not big.isEmpty():
        rows8 = rows8.join(big, ["label", "key"], "left")
        whole = rows8.filter("n is null").drop("n").withColumn("chunk", F.lit(0).cast("long")).withColumn("other", F.lit(0).cast("long")).withColumn("pair", F.lit(0).cast("long"))
        parts = F.ceil(F.col("n") / (CAP // 2))
        dealt = rows8.filter("n is not null").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "key"), parts)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        dealt = dealt.withColumn("pair", F.least("chunk", "with")).withColumn("other", F.greatest("chunk", "with")).drop("n", "with")
        whole = whole.unionByName(dealt)
    else:
        whole = whole.withColumn("pair", F.lit(0).cast("long"))
    met = cut(whole.groupBy("label", "key", "pair", "other").applyInArrow(_compare(threshold), "vec_id long, links long, root long"), "met")
    comp = components(met.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("vec_id").agg(F.sum("links").alias("links"))
    # the number of a component's smallest set, and the smallest id of all its sets
    comp = sets.select("rep", "low").join(comp.withColumnRenamed("id", "rep"), "rep").select("rep", "component_id", "low")
    lows = comp.groupBy("component_id").agg(F.min("low").alias("least"))
    per = comp.join(lows, "component_id").select("rep", "least").join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
    linked = cut(sets.join(per, "rep", "left").select("label", "v", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "low").alias("component_id")), "linked")
    if twice == 1:
        out = linked.select(F.col("low").alias("vec_id"), "n_links", "component_id")
    else:
        out = good.join(linked, ["label", "v"]).select("vec_id", "n_links", "component_id")
    return out.unionByName(alone).select("*", kept)
