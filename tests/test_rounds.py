"""Operators that work in rounds, segments and levels, against sequential brute force and literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from claimgraph.operators import graph, license, postings, quality, resolve, trees


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# ordered matching


def in_order(leads, catalog, rules=3):
    """(lead, entity, same_as_lead, matched_by) one lead after the other."""
    index = {}
    for entity, *keys in sorted(catalog):
        for r, k in enumerate(keys):
            if k is not None:
                index.setdefault((r, k), (entity, None))
    out = []
    for lead, *keys in sorted(leads):
        hit = next(((r, index[r, k]) for r, k in enumerate(keys) if k is not None and (r, k) in index), None)
        if hit:
            r, (entity, other) = hit
            out.append((lead, entity, other, ("lead:" if other is not None else "") + "abc"[r]))
            continue
        out.append((lead, None, None, "new"))
        for r, k in enumerate(keys):
            if k is not None:
                index[r, k] = (None, lead)
    return out


def matched(spark, leads, catalog):
    left, right = frame(spark, leads, "lead_id long, a string, b string, c string"), frame(spark, catalog, "e long, x string, y string, z string")
    got = resolve.cascade_match(left, "lead_id", right, "e", [(n, F.col(n), F.col(k)) for n, k in zip("abc", "xyz", strict=True)])
    return sorted(tuple(r) for r in got.select("lead_id", "entity", "same_as_lead", "matched_by").collect())


def test_a_duplicate_lead_is_no_entity(spark):
    leads = [(1, "k1", None, None), (2, "k1", None, "n"), (3, None, None, "n"), (4, None, None, None), (5, None, "n", None)]
    assert matched(spark, leads, []) == [(1, None, None, "new"), (2, None, 1, "lead:a"), (3, None, None, "new"), (4, None, None, "new"), (5, None, None, "new")]
    # a later rule of the catalog does not outrank an earlier rule of a new lead
    assert matched(spark, [(1, "k", None, None), (2, "k", None, "n")], [(9, None, None, "n")]) == [(1, None, None, "new"), (2, None, 1, "lead:a")]


@pytest.mark.parametrize("seed", range(4))
def test_ordered_matching(spark, seed):
    rng = random.Random(seed)
    key = lambda n: None if rng.random() < 0.3 else str(rng.randrange(n))
    leads = [(i, key(60), key(80), key(100)) for i in rng.sample(range(1000), 150)]
    catalog = [(i, key(200), key(300), key(300)) for i in range(15)]
    assert matched(spark, leads, catalog) == in_order(leads, catalog)
    chain = [(i, str(i // 2), str((i + 1) // 2), None) for i in range(20)]
    assert matched(spark, chain, []) == in_order(chain, [])


# renames


def test_chains_cycles_and_ambiguous_renames(spark):
    pairs = [(3, 2), (2, 1), (10, 11), (11, 12), (12, 10), (13, 10), (20, 21), (20, 22), (23, 20), (30, 30), (None, 1), (1, None), (2, 1)] + [(i, i - 1) for i in range(101, 200)]
    final, refused = resolve.follow_renames(frame(spark, pairs, "loser long, survivor long"))
    got = {r["loser"]: r["survivor"] for r in final.collect()}
    assert got == {3: 1, 2: 1, 23: 20} | {i: 100 for i in range(101, 200)}
    assert {(r["loser"], r["reason"]) for r in refused.collect()} == {(i, "cycle") for i in (10, 11, 12, 13, 30)} | {(20, "several_survivors")}
    children = frame(spark, [(3, "z", 1), (2, "z", 2), (1, "y", 3), (150, "q", 4), (10, "c", 5)], "e long, k string, v int")
    moved = resolve.merge_entities(children, "e", frame(spark, pairs, "loser long, survivor long"), ["e", "k"])
    assert sorted(tuple(r) for r in moved.collect()) == [(1, "y", 3), (1, "z", 1), (10, "c", 5), (100, "q", 4)]


def test_no_renames(spark):
    final, refused = resolve.follow_renames(frame(spark, [], "loser long, survivor long"))
    assert final.count() == refused.count() == 0


# postings


@pytest.mark.parametrize("size", [7, 1000])
def test_a_hub_is_cut_into_segments(spark, size):
    rows = [("hub", i * 7 % 5000) for i in range(5000)] * 2 + [("a", 1), ("a", 2), (None, 5), ("z", None)]
    got = postings.postings(frame(spark, rows, "h string, m long", 5), ["h"], ["m"], size).collect()
    assert max(r["n_members"] for r in got) <= size and all(r["n_members"] == len(r["members"]) for r in got)
    for hub in ("hub", "a", None, "z"):
        own = sorted((r for r in got if r["h"] == hub), key=lambda r: r["segment"])
        want = sorted({m for h, m in rows if h == hub}, key=lambda m: m or 0)
        assert [m["m"] for r in own for m in r["members"]] == want
        assert [r["segment"] for r in own] == list(range(len(own))) and all((r["total"], r["segments"]) == (len(want), len(own)) for r in own)
        at = 1
        for r in own:
            assert r["first_place"] == at
            at += r["n_members"]


def test_reverse_postings_and_details(spark):
    refs = frame(spark, [("u", "e1", 1), ("u", "e1", 2), ("u", "e2", None), (None, "e3", 4)], "u string, entity string, child long")
    index, invalid = postings.reverse_postings(refs, F.col("u"), {"entities": "entity", "children": "child"})
    assert sorted((r["url_key"], r["field"], [m["value"] for m in r["members"]], r["total"]) for r in index.collect()) == [("u", "children", ["1", "2"], 2), ("u", "entities", ["e1", "e2"], 2)]
    assert [tuple(r) for r in invalid.collect()] == [(None, "e3", 4)]
    out = postings.detail_segments(frame(spark, [("u",), ("v",)], "u string"), refs, "u", ["entity", "child"], 2).collect()
    assert sum(r["total"] for r in out if r["u"] == "u" and r["segment"] == 0) == 3 and [(r["segment"], r["total"], r["children"]) for r in out if r["u"] == "v"] == [(0, 0, None)]


def test_hits_and_evidence_in_segments(spark):
    hits = frame(spark, [("k", f"q{i:03d}") for i in range(250)] * 2 + [("k", None), ("alone", None), (None, "q1")], "k string, q string", 5)
    leads, found, rest = postings.hit_postings(hits, ["k"], "q", 100)
    assert sorted(tuple(r) for r in leads.collect()) == [("alone", 1), ("k", 501)] and rest.count() == 1
    got = sorted(found.collect(), key=lambda r: r["segment"])
    assert {r["k"] for r in got} == {"k"} and max(r["n_members"] for r in got) <= 100
    assert [m["q"] for r in got for m in r["members"]] == [f"q{i:03d}" for i in range(250)] and {r["total"] for r in got} == {250}
    assets = frame(spark, [("u", "unknown", False, "e2"), ("u", "vrm", None, "e1"), ("u", "glb", True, "e1"), ("v", None, None, None)], "u string, fmt string, rigged boolean, e string")
    merged, evidence = postings.asset_postings(assets, ["u"], "fmt", "rigged", "e", size=1)
    assert sorted((r["u"], r["fmt"], r["rigged"]) for r in merged.collect()) == [("u", "glb", True), ("v", "unknown", None)]
    assert sorted((r["u"], r["segment"], r["members"][0]["e"], r["total"]) for r in evidence.collect()) == [("u", 0, "e1", 2), ("u", 1, "e2", 2)]


def test_hits_of_an_empty_table(spark):
    leads, found, rest = postings.hit_postings(frame(spark, [], "k string, q string"), ["k"], "q")
    assert leads.isEmpty() and found.isEmpty() and rest.isEmpty()


# the frontier


def crawl(seeds, edges, max_depth, max_nodes):
    """Nodes by a queue: levels, parents by priority and node, edges by seq and child."""
    nodes, level = {}, []
    for node, priority in sorted({n: min(p for m, p, _ in seeds if m == n) for n, _, _ in seeds}.items(), key=lambda x: (x[1], x[0])):
        if len(nodes) < max_nodes:
            nodes[node] = [0, priority]
            level.append(node)
    refused = []
    for depth in range(max_depth + 1):
        after = []
        for parent in sorted(level, key=lambda n: (nodes[n][1], n)):
            for seq, child, priority in sorted((s, c, p) for a, c, p, s in edges if a == parent):
                if depth == max_depth:
                    refused.append((parent, child, "max_depth"))
                elif len(nodes) >= max_nodes:
                    refused.append((parent, child, "max_nodes"))
                elif child in nodes:
                    after.append((child, priority))
                else:
                    nodes[child] = [depth + 1, priority]
                    after.append((child, priority))
        if depth == max_depth:
            break
        for child, priority in after:  # priorities fall when the level is done
            nodes[child][1] = min(nodes[child][1], priority)
        level = [n for n, _ in {c: p for c, p in after if nodes[c][0] == depth + 1}.items()]
        if not level:
            break
    return {n: tuple(v) for n, v in nodes.items()}, sorted(refused)


@pytest.mark.parametrize(("seed", "max_nodes"), [(1, 10), (1, 25), (2, 40), (3, 3), (4, 70), (5, 1000)])
def test_admission_is_that_of_a_queue(spark, seed, max_nodes):
    rng = random.Random(seed)
    kinds = ["meta", "asset"]
    node = lambda: (rng.choice(kinds), rng.randrange(60))
    edges = list({(*e[:2],): e for e in ((node(), node(), rng.choice([20, 30, 50]), rng.randrange(5)) for _ in range(220))}.values())
    seeds = [(node(), rng.choice([10, 15]), f"s{i}") for i in range(5)]
    n = "struct<kind:string,key:long>"
    got, _, met = graph.expand_frontier(frame(spark, seeds, f"node {n}, priority int, entity string"), frame(spark, edges, f"parent {n}, child {n}, priority int, seq long"), 3, max_nodes)
    want, refused = crawl(seeds, edges, 3, max_nodes)
    assert {tuple(r["node"]): (r["depth"], r["priority"]) for r in got.collect()} == want
    assert sorted((tuple(r["parent"]), tuple(r["child"]), r["refused"]) for r in met.filter("refused is not null").collect()) == refused


def walked(seeds, edges, max_depth):
    """Depth, priority and entities of what is reached, by walking from each seed."""
    depths, priorities, entities = {}, {}, {}
    for node, priority, entity in seeds:
        priorities[node] = min(priority, priorities.get(node, priority))
        level = {node}
        for depth in range(max_depth + 1):
            for n in level:
                depths[n] = min(depth, depths.get(n, depth))
                entities.setdefault(n, set()).update([] if entity is None else [entity])
            level = {c for p, c, _ in edges if p in level}
    for p, c, priority in edges:
        if depths.get(p, max_depth) < max_depth:
            priorities[c] = min(priority, priorities.get(c, priority))
    return depths, priorities, entities


@pytest.mark.parametrize(("seed", "kind", "max_nodes"), [(1, None, None), (2, "kind", None), (3, "kind", 10_000), (4, None, 10_000)])
def test_entities_of_many_segments(spark, seed, kind, max_nodes):
    """200 entities are several segments; edges repeat and lead back, nodes may have no entity, keys of two types meet."""
    rng = random.Random(seed)
    node = lambda: (rng.choice(["meta", "asset", None]), rng.choice([*range(60), None]))
    edges = [(node(), node(), rng.choice([20, 30, 50])) for _ in range(200)]
    edges += edges[:9]
    hub = ("meta", 99)
    seeds = [(hub, 60, f"s{i}") for i in range(150)] + [(node(), rng.choice([10, 60]), rng.choice([None, f"s{i}"])) for i in range(40)]
    edges += [(hub, node(), 20) for _ in range(5)]
    n = "struct<kind:string,key:{}>"
    got, bound, met = graph.expand_frontier(
        frame(spark, seeds, f"node {n.format('int')}, priority int, entity string"), frame(spark, edges, f"parent {n.format('long')}, child {n.format('int')}, priority int"), 3, max_nodes, kind=kind
    )
    depths, priorities, entities = walked(seeds, edges, 3)
    assert {tuple(r["node"]): (r["depth"], r["priority"]) for r in got.collect()} == {x: (d, priorities[x]) for x, d in depths.items()}
    found = {}
    for r in bound.collect():
        held = found.setdefault(tuple(r["node"]), set())
        assert 0 < len(r["entities"]) <= 64 and held.isdisjoint(r["entities"])
        held.update(r["entities"])
    assert found == {x: e for x, e in entities.items() if e}
    want = [(p, c, w, depths[p], "max_depth" if depths[p] == 3 else None) for p, c, w in edges if p in depths]
    assert sorted(map(str, want)) == sorted(str((tuple(r["parent"]), tuple(r["child"]), r["priority"], r["depth"], r["refused"])) for r in met.collect())


def test_bindings_of_no_entity(spark):
    seeds, edges = frame(spark, [(1, 10, None)], "node long, priority int, entity string"), frame(spark, [(1, 2, 20), (2, 1, 5)], "parent long, child long, priority int")
    nodes, bound, _ = graph.expand_frontier(seeds, edges, 3)
    assert sorted(map(tuple, nodes.collect())) == [(1, 0, 5), (2, 1, 20)] and bound.isEmpty()
    assert all(df.isEmpty() for df in graph.expand_frontier(seeds.limit(0), edges, 3))


# trees and coverage


def test_folders(spark):
    tree = [("r", "root/a/b/one.fbx", "blob", "x"), ("r", "root/a/b/one.fbx.meta", "blob", "m1"), ("r", "root/a/two.FBX", "blob", "x"), ("r", "root/a/two.FBX.meta", "blob", "m2"), ("r", "root/c/three.fbx", "blob", "x"), ("r", "root/c/four.fbx", "blob", "x"), ("r", "root/c/four.fbx.meta", "blob", "m3")]
    tree += [("r", "other/five.fbx", "blob", "x"), ("r", "root/d.fbx", "tree", "x"), ("r", "root/e/six.fbx", "blob", "x"), ("r", "root/e/six.fbx.meta", "blob", None), ("q", "root/x.fbx", "blob", "x"), ("q", "root/x.fbx.meta", "blob", "m1"), ("r", None, "blob", "x")]
    blobs = [("m1", "x:\n  humanName: Hips", None), ("m2", "animationType: 3\navatarSetup: 2\n  - name: Root", None), ("m3", None, "timeout")]
    lane = trees.lane_files(frame(spark, tree, "repo string, p string, t string, sha string"), "repo", "p", "t", "sha", frame(spark, blobs, "blob string, text string, error string"), F.lit("root"))
    assert sorted((r["path"], r["reason"]) for r in lane.filter("repo = 'r'").collect()) == [("root/a/b/one.fbx", None), ("root/a/two.FBX", None), ("root/c/four.fbx", "meta_fetch_error"), ("root/c/three.fbx", "missing_fbx_meta"), ("root/e/six.fbx", "missing_fbx_meta")]
    got = {(r["repo"], r["folder"]): r for r in trees.folder_rollup(lane, frame(spark, [("r", False), ("q", True), ("none", None)], "repo string, truncated boolean")).collect()}
    assert {k: (r["files"], r["proven"], r["state"], r["depth"]) for k, r in got.items()} == {
        ("r", ""): (5, 2, "partial", 0),
        ("r", "root"): (5, 2, "partial", 1),
        ("r", "root/a"): (2, 2, "complete", 2),
        ("r", "root/a/b"): (1, 1, "complete", 3),
        ("r", "root/c"): (2, 0, "unknown", 2),
        ("r", "root/e"): (1, 0, "unknown", 2),
        ("q", ""): (1, 1, "partial", 0),
        ("q", "root"): (1, 1, "partial", 1),
        ("none", ""): (0, 0, "unknown", 0),
    }
    assert [got["r", "root/c"][x] for x in trees.FAILURES] == [1, 1, 0]


def test_parent_coverage_needs_all_and_sums(spark):
    rows = [("p", "k1", "1", "u", 2, None, True, False), ("p", "k1", "2", "v", 2, None, True, False), ("p", "k2", "1", "u", None, 3, True, False), ("p", "k2", "2", None, None, 3, True, True), ("q", "k3", None, None, 0, 0, True, False), (None, "k4", "1", "w", None, None, True, False)]
    df = frame(spark, rows, "p string, k string, i string, u string, d long, api long, x boolean, t boolean")
    out = trees.parent_coverage(df, "p", "k", "i", F.col("u").isNotNull(), F.col("u"), F.col("d"), F.col("api"), F.col("x"), F.col("t"), F.lit(None).cast("string"))
    got = {(r["parent"], r["key"], r["scope"]): (r["keys"], r["items"], r["with_links"], r["expected"], r["exhausted"], r["truncated"], r["covered"], r["complete"], r["unique_urls"]) for r in out.collect()}
    assert got == {
        ("p", "k1", "key"): (1, 2, 2, 2, True, False, True, True, 2),
        ("p", "k2", "key"): (1, 2, 1, 3, True, True, False, False, 1),
        ("p", None, "parent"): (2, 4, 3, 5, True, True, False, False, 2),
        ("q", "k3", "key"): (1, 0, 0, None, True, False, True, False, 0),
        ("q", None, "parent"): (1, 0, 0, None, True, False, True, False, 0),
        (None, "k4", "key"): (1, 1, 1, None, True, False, True, True, 1),
        (None, None, "parent"): (1, 1, 1, None, True, False, True, True, 1),
    }


# links, colours and licenses


@pytest.mark.parametrize(
    ("case", "want"),
    [
        ((True, "valid", 0, 2, False, []), ("healthy", "info")),
        ((True, "valid", 1, 1, False, ["timeout"]), ("healthy_with_transport_degradation", "warning")),
        ((True, "valid", 0, 1, True, []), ("healthy_with_transport_degradation", "warning")),
        ((False, "valid_glb_not_vrm", 0, 1, False, []), ("non_vrm_glb", "error")),
        ((False, "not_glb", 0, 1, False, ["http_404"]), ("not_glb", "error")),
        ((False, "invalid_glb", 0, 1, False, []), ("invalid_glb", "error")),
        ((False, None, 0, 1, False, []), ("validation_rejected", "error")),
        ((None, None, 1, 0, False, ["http_404", "http_410", None, ""]), ("missing", "error")),
        ((None, None, 1, 0, False, ["http_401"]), ("access_blocked", "error")),
        ((None, None, 1, 1, False, ["http_404", "invalid_uri"]), ("blocked_or_invalid_uri", "error")),
        ((None, None, 1, 1, False, ["http_404", "timeout"]), ("unstable_transport", "warning")),
        ((None, None, 1, 0, False, ["http_404", "timeout"]), ("transient_transport_failure", "warning")),
        ((None, None, 1, 0, False, ["http_404", "http_401"]), ("unclassified_error", "error")),
        ((None, None, 0, 1, False, []), ("unclassified_error", "error")),
        ((None, None, None, None, None, None), ("unclassified_error", "error")),
    ],
)
def test_link_classes(spark, case, want):
    df = spark.createDataFrame([case], "valid boolean, status string, f int, s int, fb boolean, e array<string>")
    health, severity = quality.classify_link(*(F.col(c) for c in df.columns))
    assert tuple(df.select(health, severity).first()) == want


@pytest.mark.parametrize(
    ("dims", "want"),
    [
        (("everyone", "corporation", "1", "1", None), "green"),
        (("everyone", "personal_profit", "1", "1", "1"), "green"),
        (("everyone", "corporation", "1", None, None), "gray"),
        (("everyone", "corporation", None, "1", "1"), "yellow"),
        ((None, None, None, None, "1"), "yellow"),
        ((None, None, None, None, "0"), "gray"),
        ((None, "none", None, None, "1"), "yellow"),
        ((None, "none", "1", "1", None), "red"),
        ((None, None, None, None, None), "gray"),
    ],
)
def test_colours(spark, dims, want):
    df = spark.createDataFrame([dims], "use_scope string, commercial_scope string, redistribute_original string, modify string, corporate_use string")
    assert df.select(license.color()).first()[0] == want


def test_license_layers_in_order(spark):
    schema = "e string, layer string, part int, seq long, dimension string, value string, reasons array<string>"
    rows = [
        ("a", "embedded", 1, 1, "use_scope", "holder", ["HOLDER"]),
        ("a", "embedded", 0, 1, "use_scope", "everyone", ["EVERYONE", "CREDIT"]),
        ("a", "terms", None, 1, "commercial_scope", "none", ["NO_COMMERCIAL"]),
        ("a", "terms", None, 2, "commercial_scope", "personal_profit", ["CREDIT"]),
        ("a", "manual", None, 1, "commercial_scope", "none", []),
        ("a", "url", None, 1, "modify", None, None),
        ("b", "embedded", 0, 1, "modify", "1", ["X"]),
        ("c", "manual", None, 1, "modify", "0", None),
        ("d", "terms", None, 1, "modify", None, ["ONLY_CODE"]),
    ]
    out, conflicts = license.layered_license(frame(spark, rows, schema), "e")
    got = {r["e"]: r for r in out.collect()}
    assert (got["a"]["use_scope"], got["a"]["commercial_scope"], got["a"]["modify"], got["a"]["confidence"]) == ("everyone", "personal_profit", None, "collection")
    assert got["a"]["reason_codes"] == ["NO_COMMERCIAL", "CREDIT", "EVERYONE", "HOLDER", "LICENSE_CONFLICT"] and got["a"]["n_conflicts"] == 2
    assert [r["detail"] for r in conflicts.orderBy("e", "place").collect()] == ["LICENSE_CONFLICT:use_scope=everyone(embedded[0])_vs_holder(embedded[1])", "LICENSE_CONFLICT:commercial_scope=personal_profit(terms)_vs_none(manual)"]
    assert (got["b"]["confidence"], got["c"]["confidence"], got["d"]["confidence"]) == ("embedded", "manual", "unknown")
    assert got["d"]["reason_codes"] == ["ONLY_CODE"] and got["c"]["reason_codes"] == []


def test_longest_code_at_a_boundary(spark):
    codes = frame(spark, [(c, "grade", c, ["R"]) for c in ("CC0", "CC-BY", "CC_BY_NC", "CC-BY-NC-ND")], "code string, dimension string, value string, reasons array<string>")
    texts = [(1, "CC0 (CBE-Public)"), (2, "cc_by_nc(4.0)"), (3, "CC-BY-NC-ND"), (4, "CC-BYX"), (5, " cc-by "), (6, None), (7, ""), (8, "see CC0")]
    got = license.code_statements(frame(spark, texts, "e long, t string"), "e", "t", codes)
    assert sorted((r["e"], r["code"]) for r in got.collect()) == [(1, "CC0"), (2, "CC-BY-NC"), (3, "CC-BY-NC-ND"), (5, "CC-BY")]


def test_patterns_meet_texts_by_their_beginning(spark):
    rules = [("url", f"site{i}.org/free", "use_scope", f"v{i}") for i in range(12_000)] + [("url", "site7.org/free/by", "use_scope", "longer"), ("url", "", "use_scope", "never"), ("terms", "x", "use_scope", "x")]
    mapping = frame(spark, rules, "layer string, pattern string, dimension string, value string")
    texts = [(1, "https://SITE7.org/free/by/4"), (2, "http://site11999.org/free"), (3, "nothing"), (4, None), (5, "")]
    got = license.statements(frame(spark, texts, "e long, t string"), "e", "url", "t", mapping)
    assert sorted((r["e"], r["value"]) for r in got.collect()) == [(1, "longer"), (2, "v11999")]
