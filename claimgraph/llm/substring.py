"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of every ``WINDOW`` words the least hash of ``GRAM`` consecutive words is picked, so that two
documents with the same ``WINDOW`` words pick the same anchor in them. Documents are joined on anchors, and a seed is one
that another document has too. Each document extends its seeds both ways, over all windows of ``WINDOW`` words that have
the seed as their anchor; their 128-bit hashes meet in one aggregation, which gives the smallest
document of each. Runs of windows that a smaller document has are united to maximal repeats, and their words removed.

Skew: whole copies are found first and enter once. Seeds and windows meet in aggregations that combine before the
shuffle and keep two ids a key, never in lists or pairs, so a passage in a third of all documents costs what it weighs.

Defined cases: null and empty texts have no words; texts under ``WINDOW`` words lose nothing; a window that repeats only
inside its own document stays; rows that repeat a doc_id are one document to each other; a null doc_id takes no part and
keeps its words; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as w
from .common import cut

WINDOW, GRAM = 50, 25
_SALT = np.uint64(0xD1B54A32D192ED03)


def _anchors(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of each window of one text: the least hash of its grams."""
    grams = w.windows(h, gram)
    span = window - gram + 1
    return sliding_window_view(grams, span).min(1) if len(grams) >= span else grams[:0]


def _hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text."""
    for first, end, data, offsets in w.text_chunks(column):
        h, _, _, at = w.hash_words(data, offsets, lower=False)
        for i in range(end - first):
            yield first + i, h[at[i] : at[i + 1]]


def seed_table(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, n_words, whole, anchors): ``whole`` is a 128-bit hash of all words, for texts of ``window`` words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, whole, anchors, ends = [], [], [], [0]
            for _, h in _hashed(batch.column(1)):
                count.append(len(h))
                if len(h) >= window:
                    anchors.append(np.unique(_anchors(h, window, gram)))
                    whole.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    ends.append(ends[-1] + len(anchors[-1]))
                else:
                    whole.append(None)
                    ends.append(ends[-1])
            flat = np.concatenate(anchors) if anchors else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(count, np.int64)), pa.array(whole, pa.binary()), pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(flat.view(np.int64)))], names=["doc_id", "n_words", "whole", "anchors"]
            )

    return docs.mapInArrow(run, "doc_id long, n_words long, whole binary, anchors array<long>")


def _extend(window: int, gram: int):
    """128-bit hashes of the windows whose anchor is a seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, rows, held = batch.column(0).to_numpy(), [], [], 0
            seeds = batch.column(2)
            for i, h in _hashed(batch.column(1)):
                good = np.isin(_anchors(h, window, gram), seeds[i].values.to_numpy().view(np.uint64))
                if not good.any():
                    continue
                hashes, at = np.unique(w.windows(h, window)[good], return_index=True)
                out.append(np.stack((hashes, w.windows(w.mix(h + _SALT), window)[good][at])))
                rows.append(np.full(len(hashes), ids[i]))
                held += len(hashes)
                if held > 200_000:
                    yield from _pairs(out, rows)
                    out, rows, held = [], [], 0
            yield from _pairs(out, rows)

    return run


def _pairs(out: list, rows: list) -> Iterator[pa.RecordBatch]:
    if out:
        h, g = np.concatenate(out, 1).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(np.concatenate(rows))], names=["h", "g", "doc_id"])


def _remove(window: int):
    """Kept words and maximal repeats of each text; column 2 has the hashes of whole texts that go, column 3 the repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans, kept, total, gone = [], [], [], []
            for i, h in _hashed(batch.column(1)):
                parts = (texts[i] or "").encode().split()
                n, runs = len(parts), []
                copies = batch.column(2)[i].as_py()
                if copies and n >= window and hashlib.blake2b(h.tobytes(), digest_size=16).digest() in copies:
                    runs = [(0, n)]
                elif batch.column(3)[i].is_valid:
                    hit = np.isin(w.windows(h, window), batch.column(3)[i].values.to_numpy().view(np.uint64))
                    depth = np.zeros(n + 1, np.int64)
                    at = np.flatnonzero(hit)
                    depth[at] += 1
                    np.subtract.at(depth, at + window, 1)
                    cover = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], cover, [False])).astype(np.int8)))
                    runs = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                lost = sum(b - a for a, b in runs)
                if runs:
                    mask = np.ones(n, bool)
                    for a, b in runs:
                        mask[a:b] = False
                    parts = compress(parts, mask.tolist())
                kept.append(b" ".join(parts).decode())
                total.append(n)
                gone.append(lost)
                spans.append([{"start": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)], names=["doc_id", "n_words", "n_removed", "kept_text", "repeats"])

    return run


_OUT = "doc_id long, n_words long, n_removed long, kept_text string, repeats array<struct<start:long,end:long>>"


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words, one space between), repeats (maximal word spans)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = cut(seed_table(docs, window, gram), "seeds")
    long = table.filter("whole is not null and doc_id is not null")
    whole = long.groupBy("whole").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    whole = cut(whole.select("whole", "first"), "whole")
    # by text, not by id: an id may have other rows that are no copies
    copy = cut(long.select("doc_id", "whole").join(whole, "whole").filter("first < doc_id").select("doc_id", "whole").distinct(), "copies")
    once = long.select("doc_id", "whole", "anchors").join(copy, ["doc_id", "whole"], "left_anti")
    anchors = cut(once.select(F.explode("anchors").alias("a"), "doc_id"), "anchors")
    shared = cut(anchors.groupBy("a").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("a"), "shared")
    seeds = cut(anchors.join(shared, "a").groupBy("doc_id").agg(F.collect_list("a").alias("seeds")), "own")

    met = docs.join(seeds, "doc_id").select("doc_id", "text", "seeds").mapInArrow(_extend(window, gram), "h long, g long, doc_id long")
    met = cut(met, "windows")
    first = cut(met.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("h", "g", "first"), "first")
    hits = met.join(first, ["h", "g"]).filter("first < doc_id").select("doc_id", F.col("h").alias("window"), F.lit(None).cast("binary").alias("whole"))
    hits = hits.unionByName(copy.select("doc_id", F.lit(None).cast("long").alias("window"), "whole"))
    hits = cut(hits.groupBy("doc_id").agg(F.collect_set("whole").alias("copies"), F.collect_set("window").alias("windows")), "hits")
    changed = docs.join(hits, "doc_id", "left").select("doc_id", "text", "copies", "windows")
    return changed.mapInArrow(_remove(window), _OUT)
