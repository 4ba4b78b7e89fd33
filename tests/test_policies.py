"""Policy rules on tiny frames, negative cases first."""

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from claimgraph.functions import jsonwalk, shared, text, uri
from claimgraph.operators import assets, consensus, license, merge, quality, ranking, resolve
from claimgraph.sources import readers, writers
from claimgraph.streaming import twins


def one(df):
    return df.first()[0]


def test_unknown_license_is_never_green(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "use_scope string, redistribute_original string, modify string, commercial_scope string, corporate_use string")
    assert one(df.select(license.color())) == "gray"
    assert one(df.select(license.license_category(F.col("use_scope")))) == "unknown"


def test_restrictive_license_does_not_gate_the_file(spark):
    df = spark.createDataFrame([("All rights reserved", None)], "license string, access string")
    row = df.select(license.license_gated(license.license_category(F.col("license"))), license.file_gated(F.col("access"))).first()
    assert row[0] is True and row[1] is None


def test_shared_key_alone_is_refused(spark):
    records = spark.createDataFrame([("k", 1, 10)], "key string, sub int, e int")
    df = spark.createDataFrame([("k", None), ("k", 1), ("k", 2)], "key string, sub int")
    got = {r["sub"]: (r["resolved"], r["error"]) for r in resolve.guarded_resolve(df, "key", "sub", records.select("key"), records, "e").collect()}
    assert got == {None: (None, "shared_key_without_sub_key"), 1: (10, None), 2: (None, "shared_key_unresolved")}


def test_ambiguous_keys_stay_unbound(spark):
    records = spark.createDataFrame([(1, None, ["a", "b"]), (2, None, ["a"]), (3, 9, []), (4, 99, [])], "id long, sup long, keys array<string>")
    owners = spark.createDataFrame([("a", 5), ("b", 6)], "key string, e long")
    known = spark.createDataFrame([(9,)], "e long")
    curated = spark.createDataFrame([], "id long, e long")
    got = {r["id"]: (r["bound_to"], r["diagnostic"]) for r in resolve.bind(records, "id", "sup", "keys", known, "e", owners, "key", curated).collect()}
    assert got == {1: (None, "ambiguous_contract_binding:5,6"), 2: (5, None), 3: (9, None), 4: (None, "no_explicit_binding")}


def test_conflicting_curated_map_is_an_error(spark):
    records = spark.createDataFrame([(1, None, ["a"])], "id long, sup long, keys array<string>")
    none = spark.createDataFrame([], "key string, e long")
    curated = spark.createDataFrame([(1, 2), (1, 3)], "id long, e long")
    with pytest.raises(Exception, match="curated map"):
        resolve.bind(records, "id", "sup", "keys", none.select("e"), "e", none, "key", curated).collect()


def test_url_on_another_key_is_flagged(spark):
    registry = spark.createDataFrame([("http://a", "k1"), ("http://b", "k2")], "url string, key string")
    catalog = spark.createDataFrame([("http://a", ["k9"]), ("http://b", ["k2"])], "url string, ks array<string>")
    got = resolve.url_identity_conflicts(registry, F.col("url"), "key", catalog, F.col("url"), "ks").collect()
    assert [r["key"] for r in got] == ["k1"]


def test_rate_limited_evidence_keeps_the_last_good(spark):
    fresh = spark.createDataFrame([(1, "rate_limited", False, "new"), (2, None, False, "new"), (3, "rate_limited", True, "new")], "k int, error string, ok boolean, v string")
    prior = spark.createDataFrame([(1, True, "old"), (2, True, "old"), (3, True, "old")], "k int, ok boolean, v string")
    got = {r["k"]: (r["v"], r["preserved"]) for r in consensus.preserve_last_good(fresh, prior, ["k"], "ok", "error", ["v"]).collect()}
    assert got == {1: ("old", True), 2: ("new", False), 3: ("new", False)}
    assert consensus.all_failed(spark.createDataFrame([("x",), ("y",)], "error string"), "error").first()["fail_closed"]


def test_conflict_prefers_nothing(spark):
    df = spark.createDataFrame([("f", "1", "2", False), ("f", "1", None, None), ("f", None, None, None)], "field string, a string, b string, agrees boolean")
    got = [(r["state"], r["preferred"]) for r in consensus.consensus(df).collect()]
    assert got == [("conflict", None), ("single_source_a", "1"), ("unobserved", None)]


def test_access_is_never_inferred(spark):
    df = spark.createDataFrame([("public", False, 0, 0, True, None, None)], "o string, e boolean, n int, p int, c boolean, x int, u string")
    assert one(df.select(quality.access_mode(*(F.col(c) for c in df.columns)))) == "unknown"


def test_snapshot_ignores_order_and_transient_tables(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    a = one(writers.snapshot_id({"a": df, "cache": df}, ["cache"]))
    b = one(writers.snapshot_id({"a": df.orderBy(F.desc("id")).repartition(5)}))
    assert a == b != one(writers.snapshot_id({"a": df.unionByName(df.limit(1))}))


def test_gateway_keeps_path_case(spark):
    df = spark.createDataFrame([("https://IPFS.io:443/ipfs/QmAbC/X.json#f",), ("https://arweave.net/AbC",), ("HTTP://H.com:80",), ("a b",), (None,)], "u string")
    got = [tuple(r[0]) for r in df.select(uri.canonical_uri(F.col("u"))).collect()]
    assert got == [("ipfs://QmAbC/X.json", None), ("ar://AbC", None), ("http://h.com/", None), (None, "no_scheme"), (None, "empty")]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("https://studio.mypinata.cloud/ipfs/QmZ/low.vrm", "ipfs://QmZ/low.vrm"),
        ("https://shop.example/ipfs/QmZ/low.vrm", "https://shop.example/ipfs/QmZ/low.vrm"),
        ("https://shop.example/a?next=/ipfs/QmZ", "https://shop.example/a?next=/ipfs/QmZ"),
        ("https://dweb.link/about", "https://dweb.link/about"),
        ("https://nftstorage.link/x/ipfs//QmZ/1?d=2#f", "ipfs://QmZ/1?d=2"),
        ("https://bafyone.ipfs.dweb.link/7.vrm", "ipfs://bafyone/7.vrm"),
        ("https://bafyone.ipfs.w3s.link/ipfs/bafyone/7.vrm", "ipfs://bafyone/7.vrm"),
        ("https://bafyone.ipfs.w3s.link/ipfs/bafyone", "ipfs://bafyone"),
        ("https://bafyone.ipfs.w3s.link/ipfs/other/7", "ipfs://bafyone/ipfs/other/7"),
        ("https://bafyone.ipfs.example/7", "https://bafyone.ipfs.example/7"),
        ("ipfs://ipfs/QmZ/p.json", "ipfs://QmZ/p.json"),
        ("ipfs:QmZ/p.json#x", "ipfs://QmZ/p.json"),
        ("IPNS://k51Ab/p", "ipns://k51Ab/p"),
        ("arweave://TxA/m.json", "ar://TxA/m.json"),
        ("https://arweave.net/TxA?x=1", "ar://TxA?x=1"),
        ("https://arweave.net/", "https://arweave.net/"),
        ("https://[2001:DB8::1]:443/A?b#c", "https://[2001:db8::1]/A?b"),
        ("http://[::1]:8080", "http://[::1]:8080/"),
        ("data:application/json,{\"a\":1}", "data:application/json,{\"a\":1}"),
        ("data:image/png;base64,AA", "scheme"),
        ("ftp://a/b", "scheme"),
        ("C:\\models\\a.vrm", "scheme"),
        ("https://me:pw@host/a", "credentials"),
        ("ipfs://", "no_cid"),
        ("https:///a", "no_host"),
    ],
)
def test_canonical_uris(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "u string").select(uri.canonical_uri(F.col("u")).alias("r")).select("r.*").first()
    assert (got["uri"] or got["error"]) == want


def test_json_leaves_mark_what_they_do_not_walk(spark):
    deep = '{"a":{"b":{"c":1}},"l":[1,{"x":"[2,3]"}],"e":{},"s":"{broken"}'
    long = '{"s":"[' + "1," * 600_000 + '1]"}'
    df = spark.createDataFrame([(1, deep), (2, long), (3, None), (4, "no json")], "k int, j string")
    got = sorted((r["k"], r["path"], (r["value"] or "~")[:9], r["truncated"]) for r in jsonwalk.json_leaves(df, "k", "j", 3).collect())
    assert got == [(1, "$.a.b.c", "1", False), (1, "$.l[0]", "1", False), (1, "$.l[1].x", "~", True), (1, "$.s", "{broken", False), (2, "$.s", "[1,1,1,1,", True)]


def test_links_beyond_the_limit_are_marked(spark):
    doc = '{"files":[' + ",".join(f'{{"vrm":"https://h/{i:04d}.vrm"}}' for i in range(510)) + "]}"
    links = jsonwalk.classify_links(jsonwalk.json_leaves(spark.createDataFrame([(1, doc)], "k int, j string"), "k", "j"), "k")
    assert links.count() == 510 and links.filter("beyond_limit").count() == 10


def test_numbered_rows_over_many_partitions(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000)
    assert [r["place"] for r in ranking.numbered(df, ["v"]).orderBy("v").collect()] == list(range(1, 1001))


def test_token_duplicates(spark):
    names = [(1, "red gear"), (2, "Red Gear"), (3, "red lamp"), (4, "crimson lamp"), (5, "crimson hat"), (6, ""), (7, None), (8, "")]
    assert sorted(map(tuple, resolve.token_duplicates(spark.createDataFrame(names, "id int, n string"), "id", "n").collect())) == [(2, 1), (5, 4), (8, 6)]
    a = spark.createDataFrame([(1, "Pixel Beasts (new)"), (2, "the cat"), (3, "a b c"), (4, "zz")], "id int, n string")
    b = spark.createDataFrame([(9, "pixel"), (7, "Beasts"), (5, "the dog"), (6, "c x b"), (8, "z z")], "id int, n string")
    assert sorted(map(tuple, resolve.token_match(a, "id", b, "id", "n").collect())) == [(1, 7), (3, 6)]


def test_files_over_the_limit_have_a_status(spark, tmp_path):
    (tmp_path / "small.vrm").write_bytes(b"no model")
    (tmp_path / "large.vrm").write_bytes(b"x" * 100)
    files = readers.read_assets(spark, f"{tmp_path}/*.vrm", 50)
    got = assets.validate_assets(files, "path", "content", 50, F.col("length")).collect()
    assert sorted((r["path"][-9:], r["status"]) for r in got) == [("large.vrm", "too_large"), ("small.vrm", "not_glb")]


def _model(document: bytes, rest: bytes = b"", more: int = 0) -> bytes:
    """A binary model file; its header claims ``more`` bytes than it has."""
    document += b" " * (-len(document) % 4)
    return struct.pack("<4sIIII", b"glTF", 2, 20 + len(document) + len(rest) + more, len(document), 0x4E4F534A) + document + rest


def test_binary_model_files(spark, tmp_path):
    """Files with every byte value, which text readers would break."""
    new, old = b'{"extensions":{"VRMC_vrm":{"meta":{"name":"a"}}}}', b'{"extensions":{"VRM":{}}}'
    files = {
        "new": _model(new, bytes(range(256)) * 4),
        "old": _model(old),
        "plain": _model(b'{"asset":{"version":"2.0"}}'),
        "cut": _model(old, more=8),
        "json": _model(b'{"extensions":{"VRM":'),
        "text": b"glb\r\n\x00\xff",
        "empty": b"",
    }
    for name, content in files.items():
        (tmp_path / f"{name}.vrm").write_bytes(content)
    found = readers.read_assets(spark, f"{tmp_path}/*.vrm")
    got = {r["path"].rsplit("/", 1)[1][:-4]: (r["status"], r["spec"], r["content_sha256"]) for r in assets.validate_assets(found, "path", "content", observed=F.col("length")).collect()}
    want = {"new": ("valid", "1.0"), "old": ("valid", "0.x"), "plain": ("valid_glb_not_vrm", None), "cut": ("length_mismatch", "0.x"), "json": ("bad_json", None), "text": ("not_glb", None)}
    assert {k: v[:2] for k, v in got.items()} == want
    assert all(got[k][2] == hashlib.sha256(files[k]).hexdigest() for k in got)


def test_rule_tables_have_any_size(spark):
    rules = spark.range(10_001).selectExpr("'terms' as layer", "concat('rule ', lpad(id, 5, '0')) as pattern", "'d' as dimension", "cast(id as string) as value")
    found = license.statements(spark.createDataFrame([(1, "x"), (2, "by RULE 10000.")], "e int, t string"), "e", "terms", "t", rules)
    assert [tuple(r) for r in found.collect()] == [(2, "terms", "d", "10000")]


def test_latest_of_a_stream_appends_changes_only(spark, tmp_path):
    schema = "k string, ts timestamp, tie long, v int"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for rows in ([("a", 1, 1, 10), ("b", 5, 1, 20)], [("a", 3, 1, 11), ("b", 4, 1, 21)]):
        spark.createDataFrame(rows, "k string, s long, tie long, v int").selectExpr("k", "timestamp_seconds(s) as ts", "tie", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        twins.latest_stream(stream, "k", "ts", "tie", str(tmp_path / "out")).awaitTermination()
    assert sorted((r["k"], r["v"]) for r in twins.read_latest(spark, str(tmp_path / "out"), "k", "ts", "tie").collect()) == [("a", 11), ("b", 20)]


def test_sweep_deletes_old_tables_only(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    kept = shared.cut(spark.range(3), "kept")
    assert shared.sweep(spark, 1.0) == 0 and kept.count() == 3 and folder


def test_strict_merge_and_missing_values(spark):
    shards = spark.createDataFrame([(1, "f", "x"), (1, "f", "x"), (2, "f", "x"), (2, "f", "y")], "e int, f string, v string")
    ok, bad = merge.merge_strict(shards, ["e", "f"], "v")
    assert [r["e"] for r in ok.collect()] == [1] and [r["e"] for r in bad.collect()] == [2]


def test_short_text_keeps_sentences(spark):
    long = "A first sentence that is short. " + "word " * 60
    df = spark.createDataFrame([("# tiny",), (long,), (None,)], "t string")
    got = [r[0] for r in df.select(text.short_text(F.col("t"), 180, False)).collect()]
    assert got == ["tiny", "A first sentence that is short.", None]


def test_broken_models_are_not_valid(spark):
    df = spark.createDataFrame([(1, b""), (2, b"glTF"), (3, b"glTF\x02\x00\x00\x00\xff\x00\x00\x00")], "id int, content binary")
    assert [r["status"] for r in assets.validate_assets(df, "id", "content").orderBy("id").collect()] == ["not_glb", "not_glb", "bad_header"]


def test_never_expiring_rows_stay_fresh(spark):
    df = spark.sql("select * from values ('a', timestamp '2020-01-01'), ('b', timestamp '2020-01-01') t(kind, ts)")
    got = {r["kind"]: (r["expires_at"] is None, r["fresh"]) for r in twins.freshness(df, "kind", "ts", {"a": -1}, 60, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert got == {"a": (True, True), "b": (False, False)}


def test_stream_expiry_sets_no_timer_for_never(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.sql("select * from values ('a', timestamp '2024-01-01', 60L), ('b', timestamp '2024-01-01', -1L), ('z', timestamp '2024-01-02', 60L) t(k, ts, ttl)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = twins.run_once(twins.expiry_stream(stream, "k", "ts", F.col("ttl"), "0 seconds"), "expiry", spark)
    assert [r["key"] for r in got.collect()] == ["a"]


def test_contains_match(spark):
    """Names of one and two letters included."""
    a = spark.createDataFrame(list(enumerate(["AI dragons", "x", "go", "dragon", "", None, "zebra", "éa"])), "id long, name string")
    b = spark.createDataFrame([(9, "AI"), (3, "AI"), (4, "dragons"), (5, "box"), (6, "g"), (7, "a"), (8, ""), (10, None), (11, "zebra")], "id long, name string")
    assert sorted(map(tuple, resolve.contains_match(a, "id", F.col("name"), b, "id", F.col("name")).collect())) == [(0, 3), (1, 5), (2, 4), (3, 4), (6, 7), (7, 7)]
