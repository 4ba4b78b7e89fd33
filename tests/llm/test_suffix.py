"""Suffix orders, longest previous factors and the removal of long repeats against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimgraph.llm import suffix

SCHEMA = "doc_id long, text string, row int, key string, g string"


def common(a, b, most):
    n = 0
    while n < most and n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize(("letters", "n", "length"), [("ab", 300, 8), ("ab", 300, 20), ("a", 120, 33), ("abcdefgh", 400, 9), ("ab", 500, 64)])
def test_suffix_order_and_previous_factors(letters, n, length):
    rng = random.Random(n + length)
    block = "".join(rng.choice(letters) for _ in range(n // 3))
    raw = (block + "".join(rng.choice(letters) for _ in range(n // 3)) + block).encode()
    data, starts = np.frombuffer(raw, np.uint8), np.arange(len(raw) - length + 1)
    sa, lcp = suffix.suffix_order(data, starts, length)
    want = sorted(starts.tolist(), key=lambda p: (raw[p : p + length], p))
    assert sa.tolist() == want
    assert lcp.tolist() == [0] + [common(raw[a:], raw[b:], length) for a, b in zip(want[1:], want, strict=False)]
    lpf = suffix.longest_previous(sa, lcp)
    for p, found in zip(sa.tolist(), lpf.tolist(), strict=True):
        assert found == max((common(raw[p:], raw[q:], length) for q in range(p)), default=0)
    assert (np.where(lpf >= 6, lpf, 0) == suffix.longest_previous(sa, lcp, 6)).all()


def by_hand(rows, length, first=False):
    """(doc_id, n_bytes, n_removed, spans, kept hash); with ``first`` the ids have to differ."""
    raws = [(r[1] or "").encode() for r in rows]
    seen = Counter(raw[p : p + length] for raw in raws for p in range(len(raw) - length + 1))
    met, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        raw, gone = raws[k], np.zeros(len(raws[k]), bool)
        for p in range(len(raw) - length + 1):
            own = raw[p : p + length]
            if own in met if first else seen[own] > 1:
                gone[p : p + length] = True
            met.add(own)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist()
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append(str((rows[k][0], len(raw), int(gone.sum()), list(zip(edge[::2], edge[1::2], strict=True)), hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def found(df, length, keep="none"):
    rows = suffix.remove_long_repeats(df, length, keep).collect()
    return sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], [(s["start"], s["end"]) for s in r["repeats"]], hashlib.sha256(r["kept"]).hexdigest())) for r in rows)


def corpus(seed, n=60):
    """Copies, near copies, shared passages with other surroundings, inner repeats, runs of one letter, other scripts, nulls."""
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice("abcdefghij é€") for _ in range(k))
    base, passage = make(700), make(90)
    texts = [None, "", "a" * 39, "a" * 40, "a" * 41, "b" * 900, make(50) * 3, "xy" * 60, make(3000), "日本" * 100]
    for i in range(n):
        kind = i % 6
        if kind == 0:
            own = list(base)
            for _ in range(rng.randint(0, 8)):
                own[rng.randrange(len(own))] = rng.choice("XYZ")
            texts.append("".join(own))
        elif kind == 1:
            texts.append(make(rng.randint(0, 80)) + passage + make(rng.randint(0, 80)))
        elif kind == 2:
            texts.append(make(rng.randint(0, 200)))
        elif kind == 3:
            texts.append(base[rng.randint(0, 300) : rng.randint(300, 700)])
        elif kind == 4:
            texts.append(rng.choice(texts[10:]))
        else:
            texts.append(passage[rng.randint(0, 30) :] + passage[: rng.randint(30, 90)])
    return [(i * 3 % 1000, t, 1, "x", "y") for i, t in enumerate(texts)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [2048, 4])
def test_against_all_windows(frame, monkeypatch, keep, group):
    """With small groups nearly everything is cut again by longer anchors, down to single windows."""
    monkeypatch.setattr(suffix, "GRAMS", (10, 25, 35))
    monkeypatch.setattr(suffix, "GROUP", group)
    rows = corpus(group)
    assert found(frame(rows, SCHEMA), 40, keep) == by_hand(rows, 40, keep == "first")


def test_repeated_ids_and_nothing(frame):
    one, two = "passage " * 2 + "x" * 50, "".join(chr(97 + i * 7 % 26) for i in range(200)) + "q"
    rows = [(1, one, 1, "x", "y"), (2, one, 1, "x", "y"), (2, two, 1, "x", "y"), (2, two, 1, "x", "y"), (4, "ab" + two, 1, "x", "y"), (None, two, 1, "x", "y"), (None, None, 1, "x", "y"), (None, "another", 1, "x", "y")]
    assert found(frame(rows, SCHEMA), 40) == by_hand(rows, 40)
    assert found(frame([], SCHEMA), 40) == []


def test_hot_passage_spreads(frame, monkeypatch):
    """A passage in all documents, each with its own surroundings: no task sorts more than a group's limit."""
    monkeypatch.setattr(suffix, "GRAMS", (10, 25, 35))
    monkeypatch.setattr(suffix, "GROUP", 16)
    sizes = []
    in_groups = suffix.map_groups

    def watched(df, keys, *rest):
        sizes.append(df.groupBy(*keys).count().selectExpr("coalesce(max(count), 0)").first()[0])
        return in_groups(df, keys, *rest)

    monkeypatch.setattr(suffix, "map_groups", watched)
    rng = random.Random(3)
    make = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage = make(120)
    rows = [(i, make(60) + passage + make(60), 1, "x", "y") for i in range(300)]
    got = suffix.remove_long_repeats(frame(rows, SCHEMA), 40).collect()
    assert all(r["n_removed"] >= 120 for r in got) and sorted(r["doc_id"] for r in got) == list(range(300))
    assert len(sizes) == 4 and max(sizes) <= 16
    assert found(frame(rows, SCHEMA), 40) == by_hand(rows, 40)


def test_large_keys_are_split_where_they_meet_their_counts(spark, frame, monkeypatch):
    """Neither the copies of one text nor the different pieces of one group are all read by one task of their joins."""
    monkeypatch.setattr(suffix, "GRAMS", (10,))
    monkeypatch.setattr(suffix, "GROUP", 16)
    low = {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "4k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "adaptive.skewJoin.skewedPartitionFactor": "1.01", "adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in low}
    written, shares = suffix.cut, {"copies": [], "mixed": []}

    def watched(df, name):
        if name in shares:
            seen = [(r["g"] if name == "mixed" else 0, r["task"]) for r in df.withColumn("task", F.spark_partition_id()).collect()]
            for g, n in Counter(g for g, _ in seen).most_common(1):
                shares[name].append((n, max(Counter(task for k, task in seen if k == g).values())))
        return written(df, name)

    monkeypatch.setattr(suffix, "cut", watched)
    rng = random.Random(8)
    make = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage, copy = make(120), make(200)
    rows = [(i, make(60) + passage + make(60) if i % 2 else copy, 1, "x", "y") for i in range(4000)]
    try:
        for k, v in low.items():
            spark.conf.set(f"spark.sql.{k}", v)
        assert found(frame(rows, SCHEMA), 40) == by_hand(rows, 40)
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)
    (copies, most), (pieces, largest) = shares["copies"][0], shares["mixed"][0]
    assert copies == 2000 and most < copies
    assert pieces > 1000 and largest < pieces


def test_slices_and_long_runs_keep_groups(monkeypatch):
    """However texts are sliced and runs are cut, each window has the group of its anchor and is in one piece."""
    data = np.frombuffer(b"".join((r[1] or "").encode() for r in corpus(5)) + b"a" * 3000, np.uint8)
    offsets, at = np.array([0, len(data)]), np.arange(len(data) - 39)
    groups = []
    for part, longest in ((1 << 20, 512), (64, 512), (1000, 7)):
        monkeypatch.setattr(suffix, "SLICE", part)
        monkeypatch.setattr(suffix, "LONGEST", longest)
        _, start, count, group, _ = suffix._pieces(data, offsets, at, 10, 40)
        assert count.max() <= longest and (np.concatenate([np.arange(a, a + n) for a, n in zip(start, count, strict=True)]) == at).all()
        groups.append(np.repeat(group, count))
    assert (groups[0] == groups[1]).all() and (groups[0] == groups[2]).all()
