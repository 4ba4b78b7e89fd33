"""The vector quantiser against all distances in plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from claimgraph.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label string, code int, v string"


def by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) and abs(x * scale) <= codes.LIMIT for x in r[1]) and len(r[1]) % parts == 0]
    kept = sorted(((r[0], [math.floor(x * scale) for x in r[1]], r[2]) for r in fine), key=lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    d = len(kept[0][1]) // parts
    cut = lambda q, p: q[p * d : (p + 1) * d]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, q, _ in kept:
                groups.setdefault(nearest(cut(q, p), books[p])[1], []).append(cut(q, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, q, label in kept:
        found = [nearest(cut(q, p), books[p]) for p in range(parts)]
        error = sum(x for x, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append([i, "".join(f"{k:02x}" for _, k in found), error, label])
    return sorted(str((i, c, e, sums[label])) for i, c, e, label in out), books


def vectors(n, size, seed, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.choice(["a", "b", None]), 1, "x") for i in range(n)]


@pytest.mark.parametrize(("n", "size", "seed", "spread"), [(400, 16, 1, 0.3), (300, 8, 2, 2.0), (700, 24, 3, 0.05), (5, 8, 4, 1.0), (1, 8, 5, 1.0), (60, 8, 6, 0.0)])
def test_against_all_distances(frame, n, size, seed, spread):
    rows = vectors(n, size, seed, spread)
    found, books = codes.vector_codes(frame(rows, SCHEMA))
    want, by_hand_books = by_hand(rows)
    got = codes.label_errors(found).select("vec_id", "code", "error", "label_error").collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert books.tolist() == by_hand_books
    assert codes.codebooks_digest(books) == hashlib.sha256(",".join(str(x) for b in by_hand_books for e in b for x in e).encode()).hexdigest()


def test_whole_numbers_tie(frame):
    """Distances are often equal here: the lower entry counts."""
    rng = random.Random(8)
    rows = [(i, [rng.randint(0, 2) / 4096 for _ in range(16)], "a", 1, "x") for i in range(500)]
    assert sorted(str(tuple(r)) for r in codes.label_errors(codes.vector_codes(frame(rows, SCHEMA))[0]).select("vec_id", "code", "error", "label_error").collect()) == by_hand(rows)[0]


def test_odd_rows(frame):
    """Nulls, empties, broken and huge components, other lengths, repeated and null ids."""
    rows = vectors(40, 8, 9)
    rows += [(41, None, "a", 1, "x"), (42, [], "a", 1, "x"), (43, [None] * 8, "a", 1, "x"), (44, [float("nan")] * 8, "a", 1, "x"), (45, [float("inf")] * 8, "a", 1, "x")]
    rows += [(46, [1e300] * 8, "a", 1, "x"), (47, [1e-300] * 8, "a", 1, "x"), (48, [0.5] * 7, "a", 1, "x"), (0, [0.5] * 16, "a", 1, "x"), (3, [0.25] * 8, "b", 1, "x"), (None, [0.1] * 8, None, 1, "x")]
    found, _ = codes.vector_codes(frame(rows, SCHEMA))
    assert sorted(str(tuple(r)) for r in codes.label_errors(found).select("vec_id", "code", "error", "label_error").collect()) == by_hand(rows)[0]
    none, books = codes.vector_codes(frame([], SCHEMA))
    assert codes.label_errors(none).count() == 0 and codes.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()


def test_decoded_vectors_are_near(frame):
    rows = vectors(300, 16, 11, 0.02)
    found, books = codes.vector_codes(frame(rows, SCHEMA))
    own = {r[0]: np.array(r[1]) for r in rows}
    errors = {r["vec_id"]: r["error"] for r in found.collect()}
    for r in codes.decode(found, books).collect():
        off = np.square(np.floor(own[r["vec_id"]] * 4096) - np.array(r["vector"]) * 4096).sum()
        assert round(off) == errors[r["vec_id"]]


def test_bounds_spare_work():
    """Once entries hardly move, most rows look at no other entry, and the width follows."""
    rng = np.random.default_rng(1)
    x = np.floor(4096 * (rng.normal(size=(9, 4))[rng.integers(0, 9, 4000)] + rng.normal(scale=0.05, size=(4000, 4)))).astype(np.int64)
    books = x[:16].copy()
    now, looked = codes.Bounds(x, books, 4), []
    for _ in range(8):
        sums = codes._sums(x, now.own, 16)
        after = np.where(sums[:, 4:] > 0, sums[:, :4] // np.maximum(sums[:, 4:], 1), books)
        looked.append(now.follow(x, after, np.sqrt(np.square(after - books).sum(1))))
        books = after
        assert (now.own == codes._squares(x, books).argmin(1)).all()
    assert (looked[-1] == 0).mean() > 0.9
    assert codes._next_width(np.bincount(looked[-1], minlength=256), 4, 16) < 4
