"""Links told apart by siblings, pointers in order, data URIs, and name matches against brute force."""

import base64
import json
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from claimgraph.functions import jsonwalk
from claimgraph.operators import resolve


def leaves(spark, *docs):
    rows = [(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)]
    return jsonwalk.json_leaves(spark.createDataFrame(rows, "k int, j string"), "k", "j", 6)


def links(spark, doc):
    return sorted((r["url"], r["kind"], r["form"], r["reason"], r["via"]) for r in jsonwalk.model_links(leaves(spark, doc), "k").collect())


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        ({"x": "see https://a/m.VRM?v=1, and ipfs://b/c.glb."}, [("https://a/m.VRM?v=1", "asset", "vrm", "vrm_address", "record"), ("ipfs://b/c.glb", "asset", "glb", "glb_address", "record")]),
        ({"vrm_urls": ["https://a/1", "https://a/2"]}, [("https://a/1", "asset", "vrm", "vrm_path", "record"), ("https://a/2", "asset", "vrm", "vrm_path", "record")]),
        ({"idle": "https://a/w.glb", "body": "https://a/b-animations-1.gltf"}, [("https://a/b-animations-1.gltf", "animation", "glb", "animation_file", "record"), ("https://a/w.glb", "animation", "glb", "animation_path", "record")]),
        ({"files": [{"uri": "https://a/f", "type": "model/gltf-binary"}, {"uri": "https://a/g", "mimeType": "video/mp4; x=1"}]}, [("https://a/f", "asset", "glb", "sibling_type", "record"), ("https://a/g", "media", "file", "sibling_type", "record")]),
        ({"animation_url": "https://a/clip.mp4", "image": "https://a/i.jpeg"}, [("https://a/clip.mp4", "media", "file", "media_address", "record"), ("https://a/i.jpeg", "media", "file", "media_address", "record")]),
        ({"a": "https://m/x.glb", "s": "<m-character id=1\n src=\"https://m/x.glb\"><m-model src=https://m/y.vrm>"}, [("https://m/x.glb", "asset", "glb", "glb_address", "mml_inline"), ("https://m/y.vrm", "asset", "vrm", "vrm_address", "mml_inline")]),
        ({"token_uri": "https://a/9", "link": "https://a/9.json", "home": "https://a/", "mml": "https://a/s"}, [("https://a/9", "metadata", "json", "metadata_field", "record"), ("https://a/9.json", "metadata", "json", "json_address", "record"), ("https://a/s", "document", "mml", "mml", "record")]),
        ({"n": None, "t": "no links"}, []),
    ],
)
def test_model_links(spark, doc, want):
    assert links(spark, doc) == want


def test_pointers_in_the_order_of_a_walk(spark):
    docs = [
        {"vrm_url": "anything", "animation_url": "a.vrm"},
        {"animation_url": "a.mp4", "z": {"vrm_url": "deep"}, "a": ["x.vrm"]},
        {"properties": {"files": [{"uri": "i.png", "type": "image/png"}, {"uri": "m", "type": "model/VRM"}]}, "a": "x.vrm"},
        {"deep": {"properties": {"files": [{"uri": "m", "type": "vrm"}]}}, "list": ["n"] * 2 + [f"{i}.vrm" for i in range(12)]},
        {"vrm_url": "", "b": 1},
        None,
        "not json",
        "plain.vrm",
    ]
    got = {r["k"]: (r["has_vrm"], r["vrm_url"], r["vrm_field"]) for r in jsonwalk.model_pointer(leaves(spark, *docs), "k").collect()}
    assert got == {0: (True, "anything", "vrm_url"), 1: (True, "x.vrm", "a[0]"), 2: (True, "m", "properties.files[].uri"), 3: (True, "0.vrm", "list[2]"), 4: (False, None, None)}


def test_documents_in_data_uris(spark):
    inner = json.dumps({"deep": "1+1 = 100%", "é": ["ü"]})
    coded = base64.b64encode(inner.encode()).decode()
    rows = [
        (0, "data:application/json;base64," + coded),
        (1, "data:text/json;charset=utf-8," + urllib.parse.quote(inner)),
        (2, "data:application/ld+json," + inner.replace("%", "%25")),
        (3, json.dumps({"token": "data:application/json;base64," + coded, "image": "data:image/png;base64,AAAA"})),
        (4, "data:application/json;base64,%%%"),
        (5, "data:application/json;base64,###"),
        (6, "data:application/json,%zz"),
        (7, inner),
    ]
    got = {}
    for r in jsonwalk.json_leaves(spark.createDataFrame(rows, "k int, j string"), "k", "j", 6).collect():
        got.setdefault(r["k"], {})[r["path"]] = r["value"]
    plain = {"$.deep": "1+1 = 100%", "$.é[0]": "ü"}
    assert got == {0: plain, 1: plain, 2: plain, 7: plain, 3: {"$.token.deep": "1+1 = 100%", "$.token.é[0]": "ü", "$.image": "data:image/png;base64,AAAA"}}


def name(rng):
    return "".join(rng.choice("aAb c-é") for _ in range(rng.randint(0, 7)))


@pytest.mark.parametrize("seed", range(3))
def test_contained_names(spark, seed):
    rng = random.Random(seed)
    a, b = ([(i, name(rng) if rng.random() < 0.95 else None) for i in range(n)] for n in (150, 120))
    got = {r["left_id"]: r["right_id"] for r in resolve.contains_match(spark.createDataFrame(a, "i long, n string"), "i", F.col("n"), spark.createDataFrame(b, "j long, n string"), "j", F.col("n")).collect()}
    want = {i: min(j for j, y in b if y and (y in x or x in y)) for i, x in a if x and any(y and (y in x or x in y) for _, y in b)}
    assert got == want


@pytest.mark.parametrize("seed", range(2))
def test_shared_words(spark, seed):
    import re

    rng = random.Random(seed)
    words = ["sun", "moon", "avatars", "punks", "cool", "the", "a", "of", "dragons", "x1"]
    rows = [(i, rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))).title() + rng.choice(["!", " #7", ""])])) for i in range(60)]
    got = {r["id"]: r["first"] for r in resolve.token_duplicates(spark.createDataFrame(rows, "i long, n string"), "i", "n").collect()}
    split = lambda n: set(re.sub("[^a-z0-9]+", " ", n.lower()).split())
    same = lambda x, y: x == y or len(split(x) & split(y)) > 1 or any(len(w) > 4 for w in split(x) & split(y))
    want = {i: min(j for j, y in rows if y is not None and same(x, y)) for i, x in rows if x is not None}
    assert got == {i: j for i, j in want.items() if j < i}
