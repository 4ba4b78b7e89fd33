"""Fill-in-the-middle transformation by displacement scatter.

A document is cut at two unit boundaries into prefix, middle and suffix, and written in the order a model is to learn it:
``<P>``prefix``<S>``suffix``<M>``middle (psm) or ``<S>``suffix``<P>``prefix``<M>``middle (spm). The bytes of many documents
are moved at once: a scan finds the cuts, a difference array holds by how far the displacement changes at each document
and cut, its running sum is the displacement of every byte, and one scatter writes all outputs. The way back finds the
marks in the outputs alone, builds the same running sum over the restored bytes, and gathers them.

One pass over the texts each way, no shuffle; arrays are bounded by runs of ``RUN`` bytes or one longer text.

Units are ``[A-Za-z]+|[^A-Za-z]`` over code points. The draws are the first four 8-digit groups of the hexadecimal sha256
of ``seed:doc_id``, so that reruns agree and no order matters.

Defined cases: a null text is empty; empty texts and texts that hold a mark stay plain; a null doc_id draws as the
empty string; rows that repeat a doc_id draw alike; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import text_chunks

#: Prefix, suffix and middle mark: three bytes each, ``<`` and ``>`` around one letter.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes that are moved at once.
RUN = 1 << 18
_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123]] = True


def _draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[4 * i : 4 * i + 4], "big") for i in range(4))


def _found(data: np.ndarray, mark: str) -> np.ndarray:
    """Places of ``mark`` in the bytes, possibly across the ends of texts."""
    m = mark.encode()
    return np.flatnonzero((data[:-2] == m[0]) & (data[1:-1] == m[1]) & (data[2:] == m[2])) if len(data) > 2 else np.empty(0, np.int64)


def _inside(places: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those places at which a mark lies whole in one text, and the text of each."""
    row = np.searchsorted(offsets, places, "right") - 1
    good = places + 3 <= offsets[row + 1]
    return places[good], row[good]


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each unit, and the place of each text's first unit (one entry more than texts)."""
    letter = _LETTER[data]
    first = (data & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts] = True
    at = np.flatnonzero(first)
    return at, np.searchsorted(at, offsets)


def _displaced(total: int, places: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Displacement of each of ``total`` bytes: the running sum of what changes at ``places``."""
    diff = np.zeros(total + 1, np.int64)
    np.add.at(diff, places, change)
    return np.cumsum(diff[:-1])


def _scatter(data, offsets, a, b, form):
    """Outputs of texts cut at bytes ``a`` and ``b``; ``form`` is 0 plain, 1 psm, 2 spm. Returns bytes and offsets."""
    moved = form > 0
    to = offsets + np.concatenate(([0], np.cumsum(9 * moved)))
    start, end = offsets[:-1], offsets[1:]
    p, m, s = a - start, b - a, end - b
    base = to[:-1] - start
    spm = form == 2
    # displacement of each part; a plain text is all prefix
    prefix = base + np.where(moved, 3, 0) + np.where(spm, s + 3, 0)
    middle = base + np.where(moved, 9 + s, 0)
    suffix = base + np.where(spm, 3 - p - m, np.where(moved, 6 - m, 0))
    change = np.concatenate((prefix - np.concatenate(([0], suffix[:-1])), middle - prefix, suffix - middle))
    out = np.empty(int(to[-1]), np.uint8)
    out[np.arange(len(data)) + _displaced(len(data), np.concatenate((start, a, b)), change)] = data
    for mark, where in zip(MARKS, (np.where(spm, to[:-1] + 3 + s, to[:-1]), np.where(spm, to[:-1], to[:-1] + 3 + p), to[1:] - m - 3), strict=True):
        for i, byte in enumerate(mark.encode()):
            out[where[moved] + i] = byte
    return out, to


def _gather(data, offsets, form):
    """Texts of outputs, from the marks found in them."""
    start, end = offsets[:-1], offsets[1:]
    spm = form == 2
    at = np.full((3, len(form)), -1, np.int64)
    for k, mark in enumerate(MARKS):
        places, row = _inside(_found(data, mark), offsets)
        at[k, row[::-1]] = places[::-1]  # the first of a text; those of plain texts are not used
    p_at, s_at, m_at = at
    moved = (form > 0) & (at >= 0).all(0)
    to = offsets - np.concatenate(([0], np.cumsum(9 * moved)))
    p = np.where(spm, m_at, s_at) - p_at - 3
    s = np.where(spm, p_at, m_at) - s_at - 3
    p, s = np.where(moved, p, end - start), np.where(moved, s, 0)
    m = np.diff(to) - p - s
    own = to[:-1]
    # where each restored byte comes from, less its place
    prefix = np.where(moved, p_at + 3, start) - own
    middle = np.where(moved, m_at + 3, start) - own - p
    suffix = np.where(moved, s_at + 3, start) - own - p - m
    places = np.concatenate((own, own + p, own + p + m))
    change = np.concatenate((prefix - np.concatenate(([0], suffix[:-1])), middle - prefix, suffix - middle))
    return data[np.arange(int(to[-1])) + _displaced(int(to[-1]), places, change)], to


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def _transform(seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, last, data, offsets in text_chunks(batch.column(1), RUN):
                at, unit = _units(data, offsets)
                n = np.diff(unit)
                h = np.array([_draws(seed, i) for i in ids[first:last]], np.int64)
                x, y = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
                ends = np.concatenate((at, [len(data)]))  # a cut behind the last unit is the next text's first byte
                a, b = (np.where(k == n, offsets[1:], ends[np.minimum(unit[:-1] + k, len(at))]) for k in (np.minimum(x, y), np.maximum(x, y)))
                plain = (n == 0) | (h[:, 2] % 100 >= rate)
                for mark in MARKS:
                    plain[_inside(_found(data, mark), offsets)[1]] = True
                form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm, 2, 1))
                a, b = np.where(plain, offsets[1:], a), np.where(plain, offsets[1:], b)
                out, to = _scatter(data, offsets, a, b, form)
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(["plain", "psm", "spm"], object)[form], pa.string()),
                        pa.array(chars[a] - chars[offsets[:-1]], pa.int64(), mask=plain),
                        pa.array(chars[b] - chars[a], pa.int64(), mask=plain),
                        _strings(out, to),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document.

    ``rate`` of a hundred documents are rearranged, ``spm`` of a hundred of those suffix first. The lengths are code points,
    null for plain documents, whose output is their text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_transform(seed, rate, spm), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_text(outputs: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """``outputs`` with the text of each, rebuilt from output and form alone.

    A null output restores to the empty text, an output without the marks of its form to itself.
    """
    names = [c for c in outputs.columns if c != restored_col]
    kinds = dict(outputs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {"psm": 1, "spm": 2}
        for batch in batches:
            forms = np.array([codes.get(x, 0) for x in batch.column(names.index(form_col)).to_pylist()], np.int64)
            for first, last, data, offsets in text_chunks(batch.column(names.index(output_col)), RUN):
                text = _strings(*_gather(data, offsets, forms[first:last]))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns, text], names=[*names, restored_col])

    return outputs.select(names).mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), f"`{restored_col}` string"]))
