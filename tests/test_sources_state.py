"""Page leads, binary proofs and compacted state on literal cases."""

import pytest
from pyspark.sql import functions as F

from claimgraph.operators import assets
from claimgraph.sources import readers
from claimgraph.streaming import twins


def leads(spark, html, base="https://site.org/a/b?x=1"):
    rows = readers.page_leads(spark.createDataFrame([(1, base, html)], "id long, u string, h string"), "id", "u", "h", "partner").collect()
    return sorted((r["label"], r["url"], r["image_url"], r["role"]) for r in rows)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, []),
        ("", []),
        ("<a href='https://x.org/p'>  Some\n name </a>", [("Some name", "https://x.org/p", "", "relationship")]),
        ('<A class="k" HREF = "/p"><b>Learn more</b><img alt="logo" title="The One" src="i.png"></A>', [("The One", "https://site.org/p", "https://site.org/a/i.png", "relationship")]),
        ("<a href=https://www.host.net/x>visit</a>", [("host.net", "https://www.host.net/x", "", "relationship")]),
        ("<a href='mailto:a@b.c'>Mail</a><a href='#top'></a><a href='javascript:x()'><img src='/j.png'></a>", [("", "", "https://site.org/j.png", "relationship"), ("Mail", "", "", "relationship")]),
        ("<img src='/l.png' alt='L &amp; M'><a href='/q'><img src='/l.png'></a><img src='/m.png' title=' M '><img alt='none'>", [("M", "", "https://site.org/m.png", "image"), ("site.org", "https://site.org/q", "https://site.org/l.png", "relationship")]),
        ("<!-- <a href='/c'>c</a> --><script>'<a href=\"/s\">s</a>'</script><a href='/d'>d</a><a href='/d'>d</a><a href='/open'>never closed", [("d", "https://site.org/d", "", "relationship")]),
        ("<a href='//other.org/x'>y</a><a href='../up'>up</a>", [("up", "https://site.org/up", "", "relationship"), ("y", "https://other.org/x", "", "relationship")]),
    ],
)
def test_page_leads(spark, html, want):
    assert leads(spark, html) == want


def fbx(version, end, rest=b"x" * 100):
    return bytes.fromhex(assets.FBX_BINARY) + version.to_bytes(4, "little") + end.to_bytes(8 if version >= 7500 else 4, "little") + rest


@pytest.mark.parametrize(
    ("content", "rigged", "evidence", "want"),
    [
        (None, True, ["e"], (None, None, False, "no_content")),
        (b"", True, ["e"], (None, None, False, "not_fbx")),
        (b"glTF....", True, ["e"], (None, None, False, "not_fbx")),
        (fbx(7400, 60), True, ["e"], ("binary", 7400, False, "valid_rigged_fbx")),
        (fbx(7400, 60), True, [], ("binary", 7400, False, "valid_fbx_rigging_unproven")),
        (fbx(7700, 60, b"Model\x00\x01LimbNode .. Deformer \xff\xfe" + b"y" * 60), None, ["e"], ("binary", 7700, True, "valid_fbx_rigging_unproven")),
        (fbx(7700, 1 << 33), True, ["e"], ("binary", 7700, False, "truncated")),
        (fbx(7400, 60)[:29], True, ["e"], ("binary", 7400, False, "truncated")),
        (bytes.fromhex(assets.FBX_BINARY), True, ["e"], ("binary", None, False, "truncated")),
        (b"\n  ; FBX 6.1 file", True, ["e"], ("text", None, False, "valid_rigged_fbx")),
        (b"\x00" * 3000 + b"FBXHeaderExtension", False, ["e"], ("text", None, False, "valid_fbx_rigging_unproven")),
        (b"\x00" * 5000 + b"FBXHeaderExtension", False, ["e"], (None, None, False, "not_fbx")),
    ],
)
def test_fbx_proof(spark, content, rigged, evidence, want):
    df = spark.createDataFrame([(1, bytearray(content) if content is not None else None, rigged, evidence)], "id long, c binary, r boolean, e array<string>")
    row = assets.fbx_proof(df, "id", "c", F.col("r"), F.col("e")).first()
    assert (row["form"], row["version"], row["skeleton"], row["status"]) == want and row["valid_avatar"] == (want[3] == "valid_rigged_fbx")


SCHEMA = "k long, v string, ts timestamp, n long"


def written(spark, folder, batches):
    for number, rows in batches.items():
        spark.createDataFrame(rows, "k long, v string, s long, n long").selectExpr("k", "v", "timestamp_seconds(s) AS ts", "n").write.mode("overwrite").parquet(f"{folder}/batch={number}")


def latest(spark, folder):
    return sorted((r["k"], r["v"]) for r in twins.read_compacted(spark, folder, "k", "ts", "n").collect())


def test_compaction(spark, tmp_path):
    folder = str(tmp_path / "state")
    with pytest.raises(FileNotFoundError):
        twins.read_compacted(spark, folder, "k", "ts", "n")
    assert twins.compact(spark, folder, "k", "ts", "n") is None
    written(spark, folder, {0: [(1, "a", 1, 1), (2, "b", 1, 2)], 1: [(1, "c", 2, 3)]})
    assert latest(spark, folder) == [(1, "c"), (2, "b")]
    assert twins.compact(spark, folder, "k", "ts", "n") == 1 and twins.compact(spark, folder, "k", "ts", "n") is None
    written(spark, folder, {2: [(3, "d", 3, 4), (2, "old", 0, 1)]})
    assert latest(spark, folder) == [(1, "c"), (2, "b"), (3, "d")]
    # a base that was not written to its end does not count, nor does such a delta
    spark.createDataFrame([(9, "broken")], "k long, v string").write.parquet(f"{folder}/base=2")
    (tmp_path / "state/base=2/_SUCCESS").unlink()
    spark.createDataFrame([(8, "broken")], "k long, v string").write.parquet(f"{folder}/batch=3")
    (tmp_path / "state/batch=3/_SUCCESS").unlink()
    assert latest(spark, folder) == [(1, "c"), (2, "b"), (3, "d")]
    written(spark, folder, {3: [(3, "e", 4, 5)]})
    assert twins.compact(spark, folder, "k", "ts", "n") == 3 and latest(spark, folder) == [(1, "c"), (2, "b"), (3, "e")]
    # what no reader needs any more is gone; the base before the newest stays, with the deltas behind it
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if (p / "_SUCCESS").exists()) == ["base=1", "base=3", "batch=2", "batch=3"]


def test_compacted_stream_goes_on(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    want = {}
    for turn in range(3):
        for part in range(3):
            i = turn * 3 + part
            rows = [(k, f"v{i}", i, i) for k in range(i % 4, 12, 3)]
            want |= {k: v for k, v, _, _ in rows}
            spark.createDataFrame(rows, "k long, v string, s long, n long").selectExpr("k", "v", "timestamp_seconds(s) AS ts", "n").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        twins.compacted_stream(stream, "k", "ts", "n", folder, 4).awaitTermination()
        assert latest(spark, folder) == sorted(want.items())
    assert len(twins._finished(spark, folder, "base")) <= 2 and len([n for n in twins._finished(spark, folder, "batch")]) <= 8


def test_shared_folder(spark):
    from claimgraph.functions import shared

    class Conf:
        def __init__(self, own):
            self.own = own

        def get(self, key, default=None):
            return self.own.get(key, default)

    class Session:
        def __init__(self, master, **own):
            self.conf, self._jvm, self._jsc = Conf({k.replace("_", "."): v for k, v in own.items()}), spark._jvm, spark._jsc
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-of-the-test"})

    assert shared.shared_dir(Session("yarn", spark_checkpoint_dir="hdfs://c")) == "hdfs://c"
    assert shared.shared_dir(Session("local[2]")) == shared.shared_dir(Session("local[*]")) != ""
    with pytest.raises(ValueError):
        shared.shared_dir(Session("spark://h:7077", spark_sql_warehouse_dir="file:/tmp/warehouse"))
    with pytest.raises(ValueError):
        shared.shared_dir(Session("local-cluster[2,1,1024]", spark_sql_warehouse_dir="/tmp/warehouse"))


def test_page_meta(spark):
    html = """<title> The
    page </title><meta name="Description" content="one &amp; two"><meta name=description content=later><meta content='a>b "c"' property="og:title"><meta property=og:image content=i.png><meta name="x"><meta content="y"><script>'<meta name=no content=no>'</script>"""
    rows = spark.createDataFrame([(1, html), (2, "<title>T</title>"), (3, None)], "k int, h string")
    got = {r["k"]: (r["meta"], r["title"], r["description"], r["image"]) for r in readers.page_meta(rows, "k", "h").collect()}
    assert got == {1: ({"description": "one & two", "og:title": 'a>b "c"', "og:image": "i.png"}, 'a>b "c"', "one & two", "i.png"), 2: ({}, "T", None, None), 3: ({}, None, None, None)}
