"""Operators against brute force, and their defined edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimgraph.llm import bitslice, html_text, minhash, mixing, neighbours, packing, secrets, substring, toxicity, warc
from claimgraph.llm.common import components, cut
from claimgraph.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, source string, bands int, component_id string"


def words(text):
    return (text or "").encode().split()


def corpus(seed=5, n=120):
    """Texts with copies, near copies, shared passages, nulls, empties and a very long one; extra columns clash with internal names."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    make = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = make(70), make(160)
    texts = [None, "", "  \n\t ", "one", "one two three four", "One two THREE four", " ".join(make(20_000))]
    for i in range(n):
        kind = i % 6
        if kind == 0:
            w = make(rng.randint(1, 90))
        elif kind == 1:
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        elif kind == 2:
            w = make(rng.randint(0, 40)) + passage + make(rng.randint(0, 40))
        elif kind == 3:
            w = base[: rng.randint(40, 160)]
        elif kind == 4:
            w = list(passage) * 2
        else:
            w = make(55) if i % 12 == 5 else words(texts[-6] or "")
            w = [x.decode() if isinstance(x, bytes) else x for x in w]
        texts.append("  ".join(w) if i % 2 else " ".join(w))
    return [(i, t, ["a", "b", None, "c"][i % 4] if i % 3 else "a", 1, "x") for i, t in enumerate(texts)]


def groups(pairs, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates(frame):
    rows = corpus()

    def shingles(text):
        w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}

    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = groups(links, ids)
    got = minhash.near_duplicates(frame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_near_duplicates_over_chunks(frame, monkeypatch):
    """Buckets over several chunks give the same components."""
    monkeypatch.setattr(minhash, "CHUNK", 8)
    rows = [r for r in corpus(9, 90) if r[0] != 6]
    df = frame(rows, DOCS)
    small = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    monkeypatch.setattr(minhash, "CHUNK", 512)
    assert small == {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}


def test_near_duplicates_apart_in_hot_buckets(frame, monkeypatch):
    """A pair that shares hot buckets only, in different chunks of each, among documents that are unlike it."""
    rng = random.Random(43)
    make = lambda k: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(k)]
    base = make(60)
    texts = [" ".join(base + make(70)) for _ in range(1000)]
    texts = [" ".join(base + make(9)) for _ in range(2)] + texts
    df = frame([(i, t, "a", 1, "x") for i, t in enumerate(texts)], DOCS)
    monkeypatch.setattr(minhash, "CHUNK", 4)
    assert [(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df).orderBy("doc_id").collect()] == [(i, i if i != 1 else 0) for i in range(1002)]


def test_near_duplicates_of_repeated_and_null_ids(frame):
    """Several texts of one id link as one document; a null id links with nothing and is kept."""
    make = lambda k, n=30: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(1, make(1)), (5, make(1)), (5, make(2)), (7, make(2) + " more"), (8, make(3)), (8, make(3)), (9, make(4)), (9, ""), (3, make(4)), (None, make(1)), (None, None)]
    df = frame([(i, t, "a", 1, "x") for i, t in rows], DOCS)
    got = sorted(((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()), key=lambda r: r[0])
    assert got == [(-1, None, True), (-1, None, True), (1, 1, True), (3, 3, True), (5, 1, False), (5, 1, False), (7, 1, False), (8, 8, True), (8, 8, True), (9, 3, False), (9, 3, False)]


@pytest.mark.parametrize("chunks", [(2, 3), (2048, 8192)])
def test_hot_buckets_of_near_copies(frame, monkeypatch, chunks):
    """A group of near copies over many chunks, and unlike documents with the same opening, cost rows in proportion."""
    rng = random.Random(12)
    make = lambda k: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(k)]
    base, opening = make(120), make(60)
    texts = [" ".join(base[:i] + ["changed", str(i)] + base[i:]) for i in range(60)] + [" ".join(opening + make(60)) for _ in range(60)]
    monkeypatch.setattr(minhash, "CHUNK", 8)
    monkeypatch.setattr(minhash, "SKETCHES", chunks)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame([(i, t, "a", 1, "x") for i, t in enumerate(texts)], DOCS)).collect()}
    assert got == {i: 0 if i < 60 else i for i in range(120)}


def test_odd_sketches_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2, (1, minhash.BITS)).astype(np.uint8)
    pack = lambda x: np.packbits(x, axis=1).view(np.uint64)
    assert minhash._estimate(pack(a), pack(a))[0] == 1.0
    assert minhash._estimate(pack(a), pack(1 - a))[0] < 0


def test_components(frame):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000, i) for i in range(1001, 1060)] + [(i, i + 1) for i in range(2000, 2040)] + [(7, 7)]
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    got = {r["id"]: r["component_id"] for r in components(frame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in groups(pairs, ids | {7}).items() if k in ids}


def test_remove_repeats(frame):
    rows = corpus(7)
    seen, want = {}, {}
    for i, text, *_ in rows:
        w = words(text)
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if seen.setdefault(tuple(w[k : k + 50]), i) < i:
                keep[k : k + 50] = [False] * 50
        want[i] = (len(w), keep.count(False), b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.remove_repeats(frame(rows, DOCS)).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 1000


def test_packing_is_exact(frame):
    from tokenizers import Tokenizer

    rows = corpus(2, 60) + [(9000, "<|endoftext|> a b\n\n c  d ſK", "a", 1, "x")]
    path = tokenizer_path()
    slow = Tokenizer.from_file(path)
    ids = {r[0]: slow.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    got = packing.pack(frame(rows, DOCS), path).collect()
    found, seqs = {}, {}
    for r in got:
        tokens = np.frombuffer(r["token_ids"], "<u4").tolist()
        assert len(tokens) == r["length"] and tokens == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, pieces in found.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[i])
    assert found.keys() == ids.keys()
    padding = 0
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 1024 * 3


@pytest.mark.parametrize("seed", range(6))
def test_pack_plan(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(1, 3000 if seed % 2 else 200, 300)
    pieces, kinds = packing.pack_plan(n)
    used = np.bincount(pieces[:, 3], pieces[:, 2], len(kinds)).astype(int)
    assert (np.bincount(pieces[:, 0], pieces[:, 2], len(n)).astype(int) == n).all()
    assert (used <= kinds).all() and (used < kinds).sum() <= 1


def test_mixing(frame):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["x", "y", "Z", None, "tiny"]) if i > 5 else "tiny2", 0, "") for i in range(400)] + [(400, None, "void", 0, ""), (401, "a " * 5000, "x", 0, "")]
    got = mixing.mix(frame(rows, DOCS)).collect()
    again = mixing.mix(frame(rows, DOCS, 7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == len(rows)
    size = {i: len(words(t)) for i, t, *_ in rows}
    total = {}
    for i, _, s, *_ in rows:
        total[s] = total.get(s, 0) + size[i]
    names = sorted((s for s in total if s is not None)) + [None]
    weight = {s: [1, 2, 3][k % 3] for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        if not over:
            target = share | {s: 3 * total[s] for s in capped}
            break
        capped |= over
    taken = {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] and abs(r["target"] - target[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(25, 0.02 * target[s])


def test_mixing_keeps_expected_copies():
    """Over many seeds each document's mean copies come to its fraction."""
    import pandas as pd

    pdf = pd.DataFrame({"source": "s", "row_id": range(12), "size": [5, 9, 30, 7, 1, 2, 8, 8, 3, 40, 6, 4], "base": 0, "fraction": 0.3, "shard": 0, "copies": 0, "done": False})
    mean = np.mean([mixing._round(k, True)(pdf.copy()).sort_values("row_id")["copies"].to_numpy() for k in range(1500)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.06


def test_taking_the_mix(frame):
    """Repeated and null ids, and columns named like internal ones."""
    rows = [(i % 5 if i % 7 else None, f"w{i} " * (i % 4), ["a", "b"][i % 2], 70 + i, 7, 9, i) for i in range(40)] + [(1, "same words", "a", 1, 2, 3, 99)] * 2
    df = frame(rows, "doc_id long, text string, source string, copies int, nth int, row int, mark int")
    taken, want = {}, {}
    for r in mixing.take(df).collect():
        assert tuple(r) in rows
        taken[r["source"]] = taken.get(r["source"], 0) + len(words(r["text"]))
    for r in mixing.mix(df).collect():
        want[r["source"]] = r["target"]
    assert all(abs(taken[s] - want[s]) <= 4 for s in want)
    assert sorted(map(str, mixing.take(df).collect())) == sorted(map(str, mixing.take(df.repartition(2)).collect()))
    plain = frame([(i, "w " * (i % 5), "ab"[i % 2], 0, 0, 0, i) for i in range(60)], df.schema)
    counts = {r["doc_id"]: r["copies"] for r in mixing.mix(plain).collect()}
    got = [r["doc_id"] for r in mixing.take(plain).collect()]
    assert all(got.count(i) == n for i, n in counts.items())


def test_secrets(frame):
    token = "ghp_" + "a" * 30
    good = token + secrets.checksum_base62("a" * 30)
    rows = [
        (1, f"{good} {token}000000 AKIA{'A' * 14} AKIAB deadbeefdeadbeef 0123"),
        (2, "Password = 'hunter2hunter2' passwd:short token=secret=abcdefghijkl API-KEY apiKey\"  :  \"x1234567890ab"),
        (3, "paſsword=abcdefghijklmnop toKen=abcdefghijklmnop İ secret: abcdefabcdefabcdef"),
        (4, None),
        (5, ""),
        (6, "é" * 50_000 + " secret=aaaaaaaaaaaa"),
        (None, "token=bbbbbbbbbbbb"),
    ]
    got = {r["doc_id"]: r for r in secrets.span_digests(secrets.find_secrets(frame(rows, "doc_id long, text string"))).collect()}
    for i, text in rows:
        spans, text = [], text or ""
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
            spans += [(m.start(), 0, "assign", m.end())] if len(m[2]) >= 12 else []
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), i
    assert "checked_token:0:40" in got[1]["spans"] and got[1]["spans"].count("checked_token") == 1
    red = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(frame(rows, "doc_id long, text string")).collect()}
    assert red[4] is None and red[5] == "" and red[6].endswith(" [REDACTED]") and good not in red[1]


def test_html(frame):
    nav = '<nav><a href="/">Home</a></nav>'
    shell = "<div id=x>Subscribe to Example now</div>"
    rows = [(i, f"https://Site.com/{i}", f"<html><head><title>t</title></head><body>{nav}{shell}<h1>Title {i}</h1><p>Body &amp; {i} <b>bold<p>Second&nbsp; \n line {i}<br>x</body></html>") for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "just text"), (103, "u", "<article><h1>A</h1><p>one<section class='comments'><p>no</section></article><footer>f</footer>"), (104, "u", "<p>" + "long " * 50_000)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Title 3\n\nBody & 3 bold\n\nSecond line 3 x"
    assert (got[100], got[101], got[102], got[103]) == ("", "", "just text", "A\n\none") and len(got[104]) == 249_999


def test_html_keeps_copied_articles(frame):
    page = "<body><div>Menu of site</div><article><h1>Same</h1><p>copied paragraph</p></article></body>"
    rows = [(i, "http://h/", page) for i in range(30)] + [(100 + i, "http://h/", f"<body><div>Menu of site</div><article><p>other {i}</p></article></body>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(frame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Same\n\ncopied paragraph" and got[105] == "other 5"


def test_html_keeps_marked_wrappers_of_articles(frame):
    story = "<article><p>story</p></article>"
    pages = [
        f'<div class="layout has-sidebar">{story}</div>',
        '<div id="no-sidebar"><p>story</p></div>',
        f'<body><div class="with-banner">{story}</div></body>',
        '<article class="post category-social tag-ads"><p>story</p></article>',
        f'<div class="sidebar"><div class="ad-free">{story}</div></div>',
        '<main><article class="promo"><p>story</p></article></main>',
        '<p>story</p><div class="ad-slot">buy</div><div class="left ad">buy</div>',
    ]
    got = html_text.extract_text(frame([(i, f"http://h{i}/", page) for i, page in enumerate(pages)], "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict.fromkeys(range(len(pages)), "story")


def test_html_falls_back_to_the_body(frame):
    pages = [
        "<div><p>story</p></div><aside><article>teaser</article></aside>",
        '<div><p>story</p></div><div id="comments"><article class="comment">first!</article><article class="comment-body">second</article></div>',
        '<article><p>story</p></article><p>around</p><article class="comment">first!</article>',
    ]
    got = html_text.extract_text(frame([(i, f"http://h{i}/", page) for i, page in enumerate(pages)], "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict.fromkeys(range(len(pages)), "story")


def test_html_templates_decide(frame):
    """Blocks that recur on a host go, in and outside articles, with no rule on their names; counts tell by whom."""
    share = "<div class=x><p>Read it in the app</p></div>"
    rows = [(i, "http://a/", f"<body><div><p>Welcome to site A</p></div><div><p>text {i}</p></div></body>") for i in range(12)]
    rows += [(100 + i, "http://b/", f"<article><h1>t {i}</h1>{share}<p>story {i}</p></article><footer>legal</footer><p>beside {i}</p>") for i in range(12)]
    rows += [(200, "http://c/", f"<article><h1>t</h1>{share}<p>story</p></article>")]
    got = {r["page_id"]: r for r in html_text.extract_text(frame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, keys int")).collect()}
    assert (got[3]["text"], got[3]["template_chars"], got[3]["rule_chars"]) == ("text 3", len("Welcome to site A"), 0)
    assert got[103]["text"] == "t 3\n\nstory 3" and got[103]["template_chars"] == len("Read it in the app") + len("legal") and got[103]["outside_chars"] == len("beside 3")
    assert got[200]["text"] == "t\n\nRead it in the app\n\nstory"


@pytest.mark.parametrize("piece", ['<a href="', "<a href='\"", "<div ", "<div>", "<p><b", "<!-- ", "<a", "</", "<td><p>", '"<a', "<textarea>", "<li>"])
def test_html_parses_broken_pages_in_linear_time(piece):
    import time

    began = time.process_time()
    html_text.main_text(piece * 100_000 + " end", set())
    html_text.main_text(piece * 100_000 + '">end', set())
    assert time.process_time() - began < 8


def test_html_broken_tags():
    text = lambda x: html_text.main_text(x, set())[0]
    assert text('<p title="a > b">one</p><p class=">two</p>three') == "one\n\ntwo\n\nthree"
    assert text("a < b <3 <p>c<") == "a < b <3\n\nc<" and text("<div>" * 2000 + "deep" + "</div>" * 2000 + "after") == "deep\n\nafter"


VECTORS = "vec_id long, embedding array<float>, label int, keys string"


def vectors(seed=1, n=300, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[50:120] = x[:70] + 0.08 * rng.standard_normal((70, dim))
    x[120:140] = x[5]
    x[140:200] = x[7] + 0.05 * rng.standard_normal((60, dim))
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3 == 0), "k") for i, v in enumerate(x)]
    bad = [(1000, None, 1, "k"), (1001, [0.0] * dim, 1, "k"), (1002, [float("nan")] + [1.0] * (dim - 1), 1, "k"), (1003, [None] + [1.0] * (dim - 1), 1, "k"), (1004, rows[3][1], None, "k"), (1005, [float("inf")] * dim, 0, "k")]
    return rows, bad


def test_near_vectors(frame):
    rows, bad = vectors()
    ok = {i: np.array(v, np.float32).astype(float) for i, v, _, _ in rows}
    label = {i: c for i, _, c, _ in rows}
    ids = sorted(ok)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if label[a] == label[b] and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= 0.93]
    want = groups(links, ids + [r[0] for r in bad])
    degree = {i: 0 for i in want}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = {r["vec_id"]: r for r in neighbours.near_vectors(frame(rows + bad, VECTORS)).collect()}
    assert len(links) > 500 and {i: r["n_links"] for i, r in got.items()} == degree and {i: r["component_id"] for i, r in got.items()} == want


def clustered(n=20_000, dim=32, seed=11):
    """Vectors of three labels: a half of them around 2,000 centres, about as far apart as linked vectors are."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x[: n // 2] = x[n // 2 + np.arange(n // 2) % 2000] + (0.3 * rng.standard_normal((n // 2, dim))).astype(np.float32)
    return x, np.arange(n) % 3


@pytest.mark.parametrize("cap", [2048, 300])
def test_near_vectors_recall(spark, monkeypatch, cap):
    """Links of 20,000 vectors against brute force; a small cap has leaves split further."""
    monkeypatch.setattr(neighbours, "CAP", cap)
    x, label = clustered()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    degree = np.zeros(len(x), int)
    for c in range(3):
        own = np.flatnonzero(label == c)
        degree[own] = (unit[own] @ unit[own].T >= 0.93).sum(1) - 1
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32())), "label": label}))
    got = neighbours.near_vectors(rows).select("vec_id", "n_links").toPandas().set_index("vec_id")["n_links"].sort_index().to_numpy()
    assert degree.sum() > 4000 and (got <= degree).all() and got.sum() >= 0.97 * degree.sum()


def test_near_vectors_in_chunks(frame, monkeypatch):
    rows, _ = vectors(2)
    df = frame(rows, VECTORS)
    one = sorted(map(tuple, neighbours.near_vectors(df).collect()))
    monkeypatch.setattr(neighbours, "CAP", 40)
    assert one == sorted(map(tuple, neighbours.near_vectors(df).collect()))


def test_top_k(frame, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK", 100)
    rows, bad = vectors(3)
    got = bitslice.top_k(frame(rows + bad, VECTORS), F.col("vec_id") % 50 == 0).collect()
    x = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _, _ in rows + [bad[1], bad[4]]}
    want = set()
    for q in (i for i in x if i % 50 == 0):
        best = sorted(((-int(x[q] @ x[i]), i) for i in x if i != q))[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want


def test_top_k_with_few_candidates(frame):
    rows = [(0, [1.0, -2.5], 0, ""), (7, [0.5, 0.5], 0, ""), (9, [0.5, 0.5], 0, ""), (50, [3.0, 4.0, 5.0], 0, "")]
    got = sorted(map(tuple, bitslice.top_k(frame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()))
    assert got == [(0, 1, 7, 256 * 128 - 640 * 128), (0, 2, 9, 256 * 128 - 640 * 128)]


def test_top_k_of_repeated_ids(frame):
    """Rows of one id are queries each, and candidates of each other."""
    rows = [(0, [2.0, 0.0], 0, ""), (0, [1.0, 1.0], 0, ""), (3, [1.0, 0.0], 0, ""), (3, [1.0, 0.0], 0, ""), (4, [0.0, 1.0], 0, ""), (None, [9.0, 9.0], 0, "")]
    got = bitslice.top_k(frame([(*r, 7, 7) for r in rows], VECTORS + ", row int, block int"), F.col("vec_id") % 50 == 0).collect()
    s = 256 * 256
    want = [(0, 1, 0, 2 * s), (0, 2, 3, 2 * s), (0, 3, 3, 2 * s), (0, 4, 4, 0)] + [(0, 1, 0, 2 * s), (0, 2, 3, s), (0, 3, 3, s), (0, 4, 4, s)]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("sliced", [np.array([[0, 5], [-7, 300], [2, -1]]), np.array([[1], [1], [1]])])
def test_slices_score_in_order(sliced):
    index = bitslice.Slices(sliced)
    for query in ([3] * sliced.shape[1], [-2] * sliced.shape[1], [0] * sliced.shape[1]):
        want = np.lexsort((np.arange(len(sliced)), -(sliced @ np.array(query))))[:2]
        assert set(index.top(np.array(query), 2, np.array([], int)).tolist()) == set(want.tolist())


def test_warc_round_trip(frame):
    same = "<html>" + "same" * 60
    rows = [(1, "http://a", same), (2, "http://b", "short"), (3, "http://c", same), (4, None, None), (5, "http://d\r\nx", "é" * 100_000), (6, "http://e", "short"), (7, "f", same)]
    careless = cut(warc.write_archives(frame(rows, "page_id long, url string, html string")), "a")
    got = {r["page_id"]: r for r in warc.read_archives(cut(warc.normalise_archives(careless), "n")).collect()}
    assert len(got) == 7
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = html == same and i > 1
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None)
        assert r["payload"] == (None if revisit else raw)


def test_warc_repeated_and_null_ids(frame):
    a, b = "a" * 200, "b" * 200
    rows = [(1, "u", a, "d", 1), (2, "u", a, "d", 1), (2, "u", a, "d", 1), (2, "u", b, "d", 1), (None, "u", a, "d", 1), (None, None, None, "d", 1)]
    pages = frame(rows, "page_id long, url string, html string, digest string, first int")
    got = warc.read_archives(cut(warc.normalise_archives(cut(warc.write_archives(pages))))).collect()
    want = [(-1, 0, "response", None), (-1, 200, "response", None), (1, 200, "response", None), (2, 200, "response", None), (2, 200, "revisit", 1), (2, 200, "revisit", 1)]
    assert sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == want


def test_normaliser_reads_any_members():
    import gzip

    one = b"".join(warc.record(i, "u", b"x" * 1000 * i, "d", None) for i in range(4))
    for content in (gzip.compress(one), b"".join(gzip.compress(one[i : i + 700]) for i in range(0, len(one), 700))):
        fresh, index = warc.normalise(content)
        assert [warc.fields(zlib.decompress(fresh[o : o + n], 31).split(b"\r\n\r\n")[0])["warc-record-id"] for o, n, _ in index] == [f"<urn:page:{i}>" for i in range(4)]
    with pytest.raises(ValueError):
        warc.normalise(gzip.compress(one)[:-9])


def test_toxicity_generalises(frame):
    rng = random.Random(8)
    plain = ["".join(rng.choice("bcdfgaeiou") for _ in range(6)) for _ in range(400)]
    bad = ["zorkish", "grumple", "blastard"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            w += [rng.choice(bad)] * rng.randint(1, 3)
        rng.shuffle(w)
        docs.append((i, " ".join(w), "s", 0, ""))
        labels.append((i, 1, int(toxic)))
    docs += [(5000, None, "s", 0, ""), (5001, "", "s", 0, ""), (5002, "you idiot moron", "s", 0, "")]
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(frame(docs, DOCS), frame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in range(900) if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert got[5001]["predicted"] == 0 and got[5002]["predicted"] == 1


def test_label_model_discounts_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    label = np.where(rng.random(4000) < 0.1, ~y, y)
    good = y & (rng.random(4000) < 0.6)
    noise = rng.random(4000) < 0.2
    post, rates, weight = toxicity.label_model(np.stack((label, good, noise, noise), 1).astype(float))
    assert weight[2] < 0.6 and weight[1] > 0.8 and rates[1][1] > 5 * rates[0][1] and ((post > 0.5) == y).mean() > 0.88


@pytest.mark.parametrize("name", ["near", "remove", "pack", "mix", "secrets", "tox"])
def test_empty_documents(spark, name):
    docs = spark.createDataFrame([], DOCS)
    run = {
        "near": lambda: minhash.near_duplicates(docs),
        "remove": lambda: substring.remove_repeats(docs),
        "pack": lambda: packing.pack(docs, tokenizer_path()),
        "mix": lambda: mixing.mix(docs),
        "secrets": lambda: secrets.span_digests(secrets.find_secrets(docs)),
        "tox": lambda: toxicity.toxicity_scores(docs, spark.createDataFrame([], "doc_id long, toxic int")),
    }[name]
    assert run().count() == 0


def test_empty_pages_and_vectors(spark):
    pages, rows = spark.createDataFrame([], "page_id long, url string, html string"), spark.createDataFrame([], VECTORS)
    assert html_text.extract_text(pages).count() == 0
    assert warc.read_archives(cut(warc.normalise_archives(cut(warc.write_archives(pages))))).count() == 0
    assert neighbours.near_vectors(rows).count() == 0 and bitslice.top_k(rows, F.col("vec_id") % 50 == 0).count() == 0
