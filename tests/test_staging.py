"""Staging, proofs, identifiers and queues on literal cases."""

import pytest
from pyspark.sql import functions as F

from claimgraph.operators import staging

D = "a" * 64
OWN, LISTED = "0x" + "1" * 40, "0x" + "2" * 40


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_primary_keys(spark):
    entities = frame(spark, [("a", "own"), ("b", "own"), ("c", " "), ("d", "own")], "e string, k string")
    listed = frame(spark, [("a", "k1", None, 1), ("a", "k2", True, 9), ("a", "k0", True, 10), ("b", " ", True, 1), ("d", "kd", True, 1)], "e string, a string, p boolean, s int")
    proven = frame(spark, [("d", "kp"), ("d", None)], "e string, contract string")
    got = {r["e"]: (r["contract"], r["chosen_by"]) for r in staging.primary_keys(entities, "e", F.col("k"), listed, "a", "p", "s", proven).collect()}
    assert got == {"a": ("k2", "listed"), "b": ("own", "entity"), "c": (None, None), "d": ("kp", "evidence")}


def staged(spark, children, evidence, valid=(), **more):
    kids = frame(spark, children, "e string, id int, url string, ok boolean")
    counts = staging.stage_candidates(kids, "e", "id", "url", F.col("ok"), frame(spark, [(v,) for v in valid], "id int"))
    own = {"contract": "0x1", "chain": "ethereum", "excluded": False, "nsfw": None, "gated": False, "banner": "b", "picture": "p", "supply": None} | more
    entity = frame(spark, [("x", evidence, *own.values())], "e string, ev boolean, contract string, chain string, excluded boolean, nsfw boolean, gated boolean, banner string, picture string, supply long")
    row = staging.stage_records(entity, "e", counts, F.col("ev"), F.col("contract"), F.col("chain"), ("ethereum",), ("ipfs",), F.col("excluded"), F.col("nsfw"), F.col("gated"), F.col("banner"), F.col("picture"), [F.col("supply")]).first()
    return row["stage"], row["blockers"], row["warnings"], row["staged"], row["coverage"]


KIDS = [("x", 1, "u1", True), ("x", 2, "u2", False), ("x", 3, "u1", True), ("x", 4, None, True)]


@pytest.mark.parametrize(
    ("children", "evidence", "valid", "more", "want"),
    [
        (KIDS, True, [], {}, ("partial_ready", [], ["partial_avatar_inventory"], 1, 0.25)),
        (KIDS, True, [2], {"supply": 3}, ("partial_ready", [], ["partial_avatar_inventory"], 2, 0.666667)),
        # without proof of the whole only validated children count, and a shared URL is its first child's
        (KIDS, False, [2, 3], {}, ("partial_ready", [], ["partial_avatar_inventory"], 1, 0.25)),
        (KIDS, None, [], {}, ("deferred", ["no_binary_validated_vrm"], [], None, None)),
        (KIDS[:1], True, [], {"gated": None, "banner": None}, ("bulk_ready", [], ["license_requires_review", "banner_uses_pfp_fallback"], 1, 1.0)),
        ([], True, [], {"banner": "", "picture": None, "chain": "IPFS", "contract": None}, ("preview_ready", [], ["sample_only", "missing_banner", "missing_pfp"], 1, 1.0)),
        ([], True, [], {"contract": "", "excluded": True, "nsfw": True}, ("deferred", ["owner_excluded", "nsfw_requires_review", "missing_contract"], ["sample_only"], None, None)),
        ([], False, [], {"chain": "Tron"}, ("deferred", ["unsupported_chain:tron", "no_binary_validated_vrm"], [], None, None)),
    ],
)
def test_stages(spark, children, evidence, valid, more, want):
    assert staged(spark, children, evidence, valid, **more) == want


HIT = {"entity": "a", "chain": "Ethereum", "contract": OWN, "canonical_url": "ipfs://1", "transport_url": "https://g/1", "status": "valid_vrm", "spec": "1.0", "digest": D, "length": 9, "observed_at": "now"}


def reconcile(spark, *hits, catalog=(("a", "ethereum", OWN, None, None),), promotions=()):
    rows = [tuple((HIT | h).values()) for h in hits]
    return staging.reconcile_proofs(
        frame(spark, rows, "entity string, chain string, contract string, canonical_url string, transport_url string, status string, spec string, digest string, length long, observed_at string"),
        frame(spark, list(catalog), "entity string, chain string, contract string, check_status string, url string"),
        frame(spark, [("a", "ETHEREUM", LISTED.upper().replace("0X", "0x")), ("a", "base", "0x" + "3" * 40)], "entity string, chain string, contract string"),
        frame(spark, [("a", 5, "https://g/1"), ("a", 3, "ipfs://1"), ("b", 1, "ipfs://1"), ("a", 2, "ipfs://11")], "entity string, child int, url string"),
        frame(spark, list(promotions), "entity string, canonical_url string, digest string, state string"),
    )


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, "collection_primary_contract"),
        ({"contract": LISTED}, "collection_contract_table"),
        ({"contract": "0x" + "3" * 40}, "contract_mismatch"),
        ({"chain": "base"}, "chain_mismatch"),
        ({"entity": "z"}, "collection_not_found"),
        ({"entity": None}, "incomplete_hit_identity"),
        ({"contract": "0x12"}, "incomplete_hit_identity"),
        ({"digest": "A" * 64}, "incomplete_proof"),
        ({"length": 0}, "incomplete_proof"),
        ({"spec": None}, "incomplete_proof"),
        ({"status": "rejected", "entity": "z"}, "incomplete_proof"),
    ],
)
def test_identities_of_hits(spark, change, want):
    judged = reconcile(spark, change)[0].first()
    assert (judged["identity"], judged["accepted"]) == (want, want.startswith("collection_") and want != "collection_not_found")


def test_proofs_change_what_they_prove(spark):
    promotions = [("a", "ipfs://1", D, staging.READY), ("a", "ipfs://1", "b" * 64, staging.READY), ("a", "ipfs://1", D, "lead_only"), ("b", "ipfs://1", D, staging.READY)]
    catalog = [("a", "ethereum", OWN, None, None), ("b", "ethereum", OWN, "ok_vrm", "https://old"), ("c", "ethereum", OWN, "ok_vrm", " ")]
    _, entities, links, moved = reconcile(spark, {}, {"canonical_url": "ipfs://2", "transport_url": None}, {"entity": "b"}, {"entity": "c", "transport_url": None}, catalog=catalog, promotions=promotions)
    assert {r["entity"]: (r["outcome"], r["check_status"], r["url"]) for r in entities.collect()} == {"a": ("updated", "ok_vrm", "https://g/1"), "b": ("kept_confirmed", "ok_vrm", "https://old"), "c": ("updated", "ok_vrm", "ipfs://1")}
    assert sorted((r["entity"], r["canonical_url"], r["child"]) for r in links.collect()) == [("a", "ipfs://1", 3), ("b", "ipfs://1", 1)]
    assert sorted(r["state"] for r in moved.collect()) == ["lead_only", staging.READY, staging.DONE, staging.DONE]


def test_queue_puts_evidence_first(spark):
    failures = frame(spark, [("a", "B", ["inv", "x", "inv"]), ("b", "a", ["rights"]), ("c", "c", [])], "e string, n string, f array<string>")
    research = frame(spark, [("a", "shipped", None), ("a", None, True), ("z", "shipped", True)], "e string, state string, gated boolean")
    actions = {"inv": [(F.col("state") == "shipped", "recover"), (F.col("gated"), F.concat(F.lit("gate of "), "e")), (F.col("state") == "none", "no")]}
    got = staging.evidence_queue(failures, "e", "n", "f", {"inv": 100, "rights": 85}, 50, {"inv": ["general", "recover"], "rights": ["terms"]}, research, actions).collect()
    assert [(r["e"], r["priority"], r["n_fields"]) for r in got] == [("a", 100, 2), ("b", 85, 1)]
    assert got[0]["plans"] == {"inv": ["recover", "gate of a", "general"], "x": ["authoritative project source", "archived source"]}


def test_ages_and_archives(spark):
    rows = frame(spark, [(1, "2024-01-01T00:00:00Z"), (2, "2024-01-01T12:00:00+02:00"), (3, "soon"), (4, None)], "k int, s string")
    got = {r["k"]: (r["age_hours"], r["violation"]) for r in staging.artifact_age(rows, "k", "s", F.lit("2024-01-02 00:00:00").cast("timestamp")).collect()}
    assert got == {1: (24.0, None), 2: (14.0, None), 3: (None, "invalid_market_data_as_of:soon"), 4: (None, None)}
    status = frame(spark, [("dead", "w"), ("dead", ""), ("alive", "w"), ("http_410", "w"), ("timeout", None)], "s string, w string")
    assert sorted(r[0] for r in status.select(staging.archived_status(F.col("s"), F.col("w"))).collect()) == ["alive", "archived", "archived", "dead", "timeout"]
