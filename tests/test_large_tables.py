"""Steps that once held too much in one place: what is broadcast, and files that grow with the tables."""

import functools

import duckdb
from pyspark.sql import functions as F

from claimgraph.functions import jsonwalk
from claimgraph.functions.shared import cut
from claimgraph.operators import graph, resolve
from claimgraph.plans import links_streams
from claimgraph.plans.catalog import ORACLES, QUERIES
from claimgraph.sources import readers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_token_duplicates_broadcast_nothing(spark):
    names = [(1, "red bolt"), (2, "Red, bolt!"), (3, None), (4, "bolt"), (5, "a b"), (6, "b c a"), (7, "bolt"), (7, "x"), (8, "large x"), (9, "large"), (10, "")]
    df = resolve.token_duplicates(cut(spark.createDataFrame(names, "id int, n string")), "id", "n")
    assert "BroadcastExchange" not in _plan(df)
    assert sorted(map(tuple, df.collect())) == [(2, 1), (6, 5), (7, 4), (9, 8)]


def test_assets_of_a_table_larger_than_the_limit_of_a_file(spark, tmp_path, monkeypatch):
    part = spark.range(60_000, numPartitions=1).select(F.col("id").alias("p_partkey"), F.repeat(F.lit("n"), 30).alias("p_name"))
    part.write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(readers, "read_assets", functools.partial(readers.read_assets, most=6 << 20))
    assert dict(map(tuple, QUERIES["a7_read_assets"](spark, str(tmp_path)).collect())) == {"not_glb": 12_000, "valid_glb_not_vrm": 24_000, "valid": 24_000}


def test_renames_broadcast_nothing(spark):
    pairs = cut(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 8), (8, 7), (9, 10), (9, 11)], "loser long, survivor long"))
    children = cut(spark.createDataFrame([(1, "a"), (4, "a"), (7, "b"), (9, "c")], "k long, p string"))
    df = resolve.merge_entities(children, "k", pairs, ["k", "p"])
    assert "BroadcastExchange" not in _plan(df) and all("BroadcastExchange" not in _plan(x) for x in resolve.follow_renames(pairs))
    assert sorted(map(tuple, df.collect())) == [(4, "a"), (7, "b"), (9, "c")]


def test_page_meta_query_leaves_references_of_a_title(spark, tmp_path):
    html = ["<title> a &quot;b&quot; &amp; &lt;c &amp;lt; &x </title><p>&quot;</p>", "<title></title>", None]
    spark.createDataFrame(list(enumerate(html, 1)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["title"] for r in QUERIES["a6_page_meta"](spark, str(tmp_path)).collect()}
    assert got == {1: "a &quot;b&quot; & &lt;c &lt; &x", 2: 'Page "2"', 3: None}


def test_pointer_documents_are_parsed_behind_the_exchange(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    df = QUERIES["h5_model_pointer"](spark, str(tmp_path))
    before = _plan(df).split("REPARTITION_BY_NUM")
    assert len(before) == 2 and "parseJson" not in before[1]
    assert df.filter("has_vrm").count() == 8
    rows = spark.createDataFrame([(1, "{"), (2, None), (3, "[1, {}]"), (4, "null")], "k long, j string")
    assert sorted((r["k"], r["path"], r["value"]) for r in jsonwalk.json_leaves(rows, "k", "j", 2).collect()) == [(3, "$[0]", "1"), (4, "$", None)]


def test_shards_hold_many_entities(spark, tmp_path, monkeypatch):
    """No file an entity, and rows that repeat a key, have none or have odd names are rows as in the SQL."""
    names = [(7, "a"), (8, "b"), (8, "c"), (9, None), (10, 'd"\\e\n'), (11, ""), (None, "f"), (-3, "g")]
    rows = names + [(k, f"n{k}") for k in range(100, 300)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string").withColumn("s_nationkey", F.lit(1)).coalesce(2).write.parquet(f"{tmp_path}/supplier.parquet")
    seen, read = [], readers.read_shards
    monkeypatch.setattr(readers, "read_shards", lambda *a, **b: seen.append(read(*a, **b)) or seen[-1])
    got = QUERIES["a4_read_shards"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(ORACLES["a4_read_shards"]).fetchall()))
    assert seen[0].select("shard").distinct().count() <= 4


def test_shards_of_one_document(spark, tmp_path):
    for name, document in {"a.json": '{\n"x": 1\n}', "b.json": '{"x": 1'}.items():
        (tmp_path / name).write_text(document)
    assert sorted((r["entity"], r["valid"]) for r in readers.read_shards(spark, f"{tmp_path}/*.json").collect()) == [("a", True), ("b", False)]
    (tmp_path / "packed").mkdir()
    (tmp_path / "packed/p.json").write_text('{"entity": "a", "document": "{\\"x\\": 1}"}\n{"entity": "b", "document": "{"}\n{"entity": \n')
    assert sorted((r["entity"] or "", r["valid"]) for r in readers.read_shards(spark, f"{tmp_path}/packed", packed=True).collect()) == [("", False), ("a", True), ("b", False)]


def test_frontier_carries_segments_and_writes_no_edges(spark, monkeypatch):
    """What a level writes grows with its nodes, an edge is joined once a segment, and nothing is broadcast by a file's size."""
    written, plans = {}, []

    def counted(df, name="cut"):
        plans.append((name, _plan(df)))
        out = cut(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(graph, "cut", counted)
    monkeypatch.setattr(links_streams, "cut", counted)
    rows = QUERIES["i1_expand_frontier"](spark, "/root/testdata/sf0.001").count()
    assert set(written) == {"ids", "found"} and max(written["found"]) <= rows
    levels = [p for name, p in plans if name == "found"][1:]
    assert len(levels) == 3 and all("SortMergeJoin [xxhash64(parent" in p for p in levels)


def test_frontier_query_on_unknown_keys(spark, tmp_path):
    """Unknown accounts and parts are reached and lead nowhere, repeated rows count once, accounts may have no nation."""
    tables = {
        "customer": ("c_custkey long, c_nationkey int", [(1, 3), (1, 11), (2, None), (None, 4), (5, 7), (6, 3)]),
        "supplier": ("s_suppkey long", [(1,), (1,), (9,), (None,)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (2, 2), (3, None), (4, 5), (None, 6)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long", [(1, 10, 1), (1, 10, 1), (2, 11, 1), (2, None, 2), (3, 12, 9), (4, 10, None), (None, 13, 9), (4, 14, 9)]),
    }
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = QUERIES["i1_expand_frontier"](spark, str(tmp_path)).select("kind", "key", "depth", "priority", "bindings").collect()
    want = con.execute(ORACLES["i1_expand_frontier"]).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) > 9
