"""Rows that repeat an id with different texts or vectors, extreme components, and adversarial texts."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimgraph.llm import bitslice, neighbours, queries, secrets, substring, toxicity, warc
from claimgraph.llm.common import cut

DOCS = "doc_id long, text string, whole string, copies int"


def test_remove_repeats_of_repeated_ids(frame):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (4, "two words " + b), (5, b), (5, b), (5, a + " " + b), (None, a), (6, None)]
    got = substring.remove_repeats(frame([(*r, "w", 1) for r in rows], DOCS)).collect()
    by = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_text"]) for r in got)
    assert by == sorted([(-1, 60, 0, a), (1, 60, 0, a), (2, 60, 60, ""), (2, 60, 0, b), (4, 62, 60, "two words"), (5, 60, 60, ""), (5, 60, 60, ""), (5, 120, 120, ""), (6, 0, 0, "")])


VECTORS = "vec_id long, embedding array<double>, label string, low int"


def near(frame, rows):
    got = neighbours.near_vectors(frame([(*r, 1) for r in rows], VECTORS)).collect()
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"], r["kept"]) for r in got)


def test_near_vectors_of_repeated_ids(frame):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (2, [1.0, 0.0], "a"), (2, None, "a"), (None, [1.0, 0.0], "a"), (3, [0.0, 1.0], "b")]
    assert near(frame, rows) == [(-1, 0, None, True), (1, 0, 1, True), (1, 1, 1, True), (2, 0, 2, True), (2, 1, 1, False), (3, 0, 3, True)]
    rows = [(5, [1.0, 0.0], "a"), (5, [1.0, 0.0], "a"), (4, [1.0, 0.01], "a"), (9, [-1.0, 0.0], "a")]
    assert near(frame, rows) == [(4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (9, 0, 9, True)]


@pytest.mark.parametrize("size", [1e-200, 1e-310, 1.0, 1e200, 1e308])
def test_near_vectors_of_any_size(frame, size):
    rows = [(1, [size, size], "a"), (2, [1.0, 0.3], "a"), (3, [size * 0.5, size * 0.49], "a")]
    assert near(frame, rows) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)]


@pytest.mark.parametrize("n", [3000, 9000])
def test_dense_labels_are_compared_once(spark, monkeypatch, n):
    """Vectors so alike that no split helps meet in one leaf, in chunks, and not in a leaf of every tree."""
    import pyarrow as pa

    rng = np.random.default_rng(n)
    x = (rng.standard_normal(64) + rng.standard_normal((n, 64)) / 3).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    degree = (unit @ unit.T >= 0.93).sum(1) - 1
    places = []
    split = neighbours._split_large

    def watched(routed, threshold):
        out = split(routed, threshold)
        places.append(out[0].agg(F.sum(F.size("keys"))).first()[0])
        return out

    monkeypatch.setattr(neighbours, "_split_large", watched)
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float32())), "label": np.zeros(n, int)}))
    got = neighbours.near_vectors(rows).select("vec_id", "n_links").toPandas().set_index("vec_id")["n_links"].sort_index().to_numpy()
    assert places[0] <= 4 * n and (got <= degree).all() and got.sum() >= 0.95 * degree.sum()


def test_fit_is_bounded_by_labels(frame, monkeypatch):
    """One labelled id with very many rows brings one of them to the driver."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(6))
    rows = [(i, " ".join(word() for _ in range(20)) + (" vermin filth" if i % 4 == 0 else ""), "w", 1) for i in range(300)]
    rows += [(7, f"row {k} of seven " + word(), "w", 1) for k in range(3000)]
    kept = []
    monkeypatch.setattr(toxicity, "cut", lambda df, name="cut": (kept.append((name, out := cut(df, name))), out)[1])
    docs, labels = frame(rows, DOCS), frame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(7, 1, 0)] * 5, "doc_id long, quality int, toxic int")
    scored = toxicity.toxicity_scores(docs, labels).collect()
    sample = next(df for name, df in kept if name == "sample")
    assert sample.count() <= 300 and len(scored) == len(rows)
    null = toxicity.toxicity_scores(frame([(None, "x", "w", 1)], DOCS), labels).collect()[0]
    assert (null["held_out"], null["doc_id"]) == (False, None)


@pytest.mark.parametrize("word", [*secrets._WORDS, "eyJ.", "eyJaaaaaaaaaa.eyJ", "-----BEGIN PRIVATE KEY-----", "token ", "token=", "password\"", "ghp_a", "AKIA"])
def test_repeated_keywords_scan_in_linear_time(word):
    scan = secrets.scanner()
    began = time.process_time()
    scan(word * (1_000_000 // len(word)))
    scan((word.upper() + "a") * (1_000_000 // len(word)))
    assert time.process_time() - began < 8


def test_signed_tokens_behind_broken_ones():
    import base64

    part = base64.urlsafe_b64encode(b'{"alg":"none"}').decode().rstrip("=")
    good = f"{part}.{part}.{'s' * 20}"
    scan = secrets.scanner()
    for before in ("eyJ", "eyJ" * 50 + " ", "eyJaaaaaaaaaaaa.eyJ ", "eyJaaaaaaaaaaaa. "):
        found = [(a, b) for kind, a, b in scan(before + good) if kind == "signed_token"]
        assert found == [(0 if before == "eyJ" else len(before), len(before + good))]


def test_top_k_leaves_out_what_would_not_fit(frame):
    rows = [(0, [1e300, 1.0], "a", 1), (50, [1.0, 0.5], "a", 1), (1, [2.0**18, 0.0], "a", 1), (2, [2.0**18 + 1, 0.0], "a", 1), (3, [1e-300, -1e-300], "a", 1)]
    got = bitslice.top_k(frame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got) == [(50, 1, 256 * 2**26), (50, 3, -128)]


def test_archives_of_one_common_payload(frame):
    html = "<p>" + "the same page " * 20
    rows = [(i, f"http://h/{i}", html) for i in (5, 9, 3, 3, 12)] + [(None, "u", html), (1, "u", "short"), (2, "u", "short"), (3, "other", "x" * 200)]
    pages = frame(rows, "page_id long, url string, html string")
    got = warc.read_archives(cut(warc.normalise_archives(cut(warc.write_archives(pages)))))
    found = sorted((r["page_id"] or -1, r["url"], r["record_type"], r["refers_to"]) for r in got.collect())
    assert found == sorted([(5, "http://h/5", "revisit", 3), (9, "http://h/9", "revisit", 3), (3, "http://h/3", "response", None), (3, "http://h/3", "response", None), (12, "http://h/12", "revisit", 3), (-1, "u", "response", None), (1, "u", "response", None), (2, "u", "response", None), (3, "other", "response", None)])


SF = "/root/testdata/sf0.001"
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def test_sizes_and_counts_in_sql(spark):
    """What SQL can say of op5 and op7: the base counts, and sizes, source sizes and water-filled targets."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(
        f"""WITH RECURSIVE s AS (SELECT source, CAST(sum({_WORDS}) AS DOUBLE) AS n FROM documents GROUP BY 1), w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, sum(n) OVER () AS total FROM s),
        f AS (SELECT source, n, w, total, 0 AS k, FALSE AS stopped FROM w UNION ALL SELECT source, n, w, total, k + 1, stopped OR w * (total - coalesce(sum(CASE WHEN stopped THEN 3 * n END) OVER (), 0)) / nullif(sum(CASE WHEN stopped THEN 0 ELSE w END) OVER (), 0) > 3 * n FROM f WHERE k < 20),
        t AS (SELECT source, n, CASE WHEN stopped THEN 3 * n ELSE w * (total - coalesce(sum(CASE WHEN stopped THEN 3 * n END) OVER (), 0)) / sum(CASE WHEN stopped THEN 0 ELSE w END) OVER () END AS target FROM f WHERE k = 20)
        SELECT doc_id, {_WORDS} AS size, CAST(n AS BIGINT), round(target, 4) FROM documents d JOIN t ON d.source IS NOT DISTINCT FROM t.source ORDER BY 1"""
    ).fetchall()
    got = sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 4)) for r in queries.op7_mixing(spark, SF).collect())
    assert got == want
    want = con.execute(
        r"""SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 12)),
        len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)), len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) FROM documents ORDER BY 1"""
    ).fetchall()
    assert sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"]) for r in queries.op5_secrets(spark, SF).collect()) == want
