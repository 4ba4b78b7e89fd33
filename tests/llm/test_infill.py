"""Fill-in-the-middle against a text at a time."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from claimgraph.llm import infill

TEXTS = [None, "", "a", "?", "ab cd", "é", "ab<P>cd", "x<S>", "<M>", "<", "<P", "P>", "日本 語ab\x00\n\tc", "<<PP>> <S <M", "Zürich ist schön, 10 €", "x" * 70_000, "é?" * 90_000, "<P"] + [f"doc {i} says <{'ab' * (i % 7)}> und {i * 37}!" for i in range(300)]


def by_hand(doc_id, text, seed=1, rate=90, spm=20):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "rate", "spm", "run"), [(1, 90, 20, 1 << 18), (7, 100, 50, 64), (3, 0, 0, 1)])
def test_against_single_texts(frame, monkeypatch, seed, rate, spm, run):
    monkeypatch.setattr(infill, "RUN", run)
    rows = [(i, t, 3, "plain") for i, t in enumerate(TEXTS)] + [(4, "ab cd", 3, "x"), (4, "another text of four", 3, "x"), (None, "no id at all", 3, "x")]
    got = infill.restore_text(infill.fill_in_middle(frame(rows, "doc_id long, text string, n int, form string"), seed, rate, spm)).collect()
    want = sorted((str((r[0], *by_hand(r[0], r[1], seed, rate, spm), r[1] or "")) for r in rows))
    assert sorted(str(tuple(r)) for r in got) == want


def test_empty_table_and_foreign_columns(frame):
    assert infill.fill_in_middle(frame([], "doc_id long, text string")).count() == 0
    df = frame([(1, None, "x", 2)], "doc_id long, output string, restored string, form int")
    assert [tuple(r) for r in infill.restore_text(df.withColumn("form", F.lit("psm"))).collect()] == [(1, None, "psm", "")]
