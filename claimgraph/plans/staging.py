"""Queries of staging, proofs and identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, staging
from .registry import Tables, query

_KIDS = """WITH k AS (SELECT o_custkey AS e, o_orderkey AS id, CASE WHEN o_orderkey % 13 > 0 THEN 'u' || o_orderkey // 2 END AS url, o_orderstatus <> 'P' AS ok, o_orderkey % 3 = 0 AS v FROM orders),
    u AS (SELECT e, url, arg_min(v, id) AS v FROM k WHERE url IS NOT NULL AND (ok OR v) GROUP BY 1, 2), n AS (SELECT e, count(*) AS known FROM k GROUP BY 1), c AS (SELECT e, count(*) AS cand, count(*) FILTER (v) AS val FROM u GROUP BY 1),
    b AS (SELECT c_custkey AS id, c_custkey % 4 < 2 AS ev, coalesce(known, 0) AS known, CASE WHEN c_custkey % 4 < 2 THEN coalesce(cand, 0) ELSE coalesce(val, 0) END AS cand, coalesce(val, 0) AS val, CASE c_mktsegment WHEN 'BUILDING' THEN 'ethereum' WHEN 'FURNITURE' THEN 'tron' WHEN 'MACHINERY' THEN 'arweave' ELSE 'polygon' END AS chain, c_nationkey, c_acctbal FROM customer LEFT JOIN n ON c_custkey = n.e LEFT JOIN c ON c_custkey = c.e)"""


@query(
    "g27_stage_records",
    _KIDS
    + """, x AS (SELECT *, concat_ws(',', CASE WHEN id % 17 = 0 THEN 'owner_excluded' END, CASE WHEN id % 19 = 0 THEN 'nsfw_requires_review' END, CASE WHEN chain = 'tron' THEN 'unsupported_chain:tron' END, CASE WHEN chain IN ('ethereum', 'polygon') AND id % 11 = 0 THEN 'missing_contract' END, CASE WHEN NOT ev AND val = 0 THEN 'no_binary_validated_vrm' END) AS blockers,
        concat_ws(',', CASE WHEN cand = 0 AND ev THEN 'sample_only' END, CASE WHEN cand > 0 AND cand < known THEN 'partial_avatar_inventory' END, CASE WHEN c_acctbal < 0 THEN 'license_requires_review' END, CASE WHEN c_nationkey % 2 = 0 AND c_nationkey % 3 > 0 THEN 'banner_uses_pfp_fallback' END, CASE WHEN c_nationkey % 6 = 0 THEN 'missing_banner' END, CASE WHEN c_nationkey % 3 = 0 THEN 'missing_pfp' END) AS warnings FROM b),
    s AS (SELECT *, CASE WHEN blockers <> '' THEN 'deferred' WHEN cand > 0 AND cand = known THEN 'bulk_ready' WHEN cand > 0 THEN 'partial_ready' ELSE 'preview_ready' END AS stage, greatest(cand, 1) AS staged FROM x)
    SELECT id AS c_custkey, blockers, warnings, stage, CASE WHEN stage <> 'deferred' THEN staged END AS staged, known, val AS validated, CASE WHEN stage <> 'deferred' THEN round(staged / CASE WHEN id % 5 > 0 THEN id % 5 * 10 WHEN known > 0 THEN known ELSE staged END, 6) END AS coverage FROM s""",
)
def g27b(t: Tables):
    key = F.col("c_custkey")
    children = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderkey") % 13 > 0, F.concat(F.lit("u"), F.floor(F.col("o_orderkey") / 2).cast("string"))).alias("url"), (F.col("o_orderstatus") != "P").alias("ok"))
    counts = staging.stage_candidates(children, "c_custkey", "o_orderkey", "url", F.col("ok"), t.orders.filter("o_orderkey % 3 = 0").select("o_orderkey"))
    seg, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    chain = F.when(seg == "BUILDING", "Ethereum").when(seg == "FURNITURE", "Tron").when(seg == "MACHINERY", "arweave").otherwise("polygon")
    out = staging.stage_records(
        t.customer, "c_custkey", counts, key % 4 < 2, F.when(key % 11 > 0, F.lit("0xabc")), chain, ("ethereum", "polygon"), ("arweave", "ipfs"), key % 17 == 0, key % 19 == 0,
        F.when(F.col("c_acctbal") >= 0, True), F.when(nation % 2 > 0, F.lit("b")), F.when(nation % 3 > 0, F.lit("p")), [key % 5 * 10, F.lit(0)],
    )
    return out.select("c_custkey", F.array_join("blockers", ",").alias("blockers"), F.array_join("warnings", ",").alias("warnings"), "stage", "staged", "known", "validated", "coverage")


@query(
    "c13_primary_keys",
    """WITH l AS (SELECT o_custkey AS k, arg_min('k' || o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS a FROM orders WHERE o_orderkey % 7 > 0 GROUP BY 1), e AS (SELECT user_id AS k, min(event_type) AS a FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1)
    SELECT c_custkey, coalesce(e.a, l.a, CASE WHEN c_custkey % 2 = 0 THEN c_name END) AS contract, CASE WHEN e.a IS NOT NULL THEN 'evidence' WHEN l.a IS NOT NULL THEN 'listed' WHEN c_custkey % 2 = 0 THEN 'entity' END AS chosen_by FROM customer LEFT JOIN l ON c_custkey = l.k LEFT JOIN e ON c_custkey = e.k""",
)
def c13b(t: Tables):
    listed = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))).otherwise(" ").alias("a"), F.when(F.col("o_orderstatus") == "F", True).alias("p"))
    seen = t.events.select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_type").isin("purchase", "signup"), F.col("event_type")).alias("contract"))
    return staging.primary_keys(t.customer, "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")), listed, "a", "p", "o_orderkey", seen)


def _proofs(t: Tables):
    """Orders as hits on customers, suppliers' numbers as further keys, line items as children, orders as promotions."""
    k = F.col("o_orderkey")
    hexed = lambda c, n: F.lpad(F.lower(F.hex(c)), n, "0")
    address = lambda c: F.concat(F.lit("0x"), hexed(c, 40))
    hits = t.orders.select(
        F.when(k % 23 > 0, (F.col("o_custkey") + F.when(k % 29 == 0, 10_000_000).otherwise(0)).cast("string")).alias("entity"), F.when(k % 7 == 0, "Base").otherwise("Ethereum").alias("chain"), address(F.col("o_custkey") % 1000 + F.when(k % 5 == 0, 1).when(k % 5 == 1, 5).otherwise(0)).alias("contract"),
        F.concat(F.lit("ipfs://"), k.cast("string")).alias("canonical_url"), F.when(k % 2 == 0, F.concat(F.lit("https://gw/"), k.cast("string"))).alias("transport_url"), F.when(F.col("o_orderstatus") == "F", "valid_vrm").otherwise("rejected").alias("status"),
        F.when(k % 3 == 0, "1.0").otherwise("0.x").alias("spec"), F.sha2(k.cast("string"), 256).alias("digest"), F.when(k % 31 > 0, k).otherwise(0).alias("length"), F.col("o_orderdate").cast("string").alias("observed_at"),
    )
    c = F.col("c_custkey")
    catalog = t.customer.select(c.cast("string").alias("entity"), F.lit("ethereum").alias("chain"), F.upper(address(c % 1000)).alias("contract"), F.when(c % 4 == 0, "ok_vrm").alias("check_status"), F.when(c % 8 > 0, F.lit("https://old")).alias("url"))
    catalog = catalog.withColumn("contract", F.replace("contract", F.lit("0X"), F.lit("0x")))
    keys = t.customer.select(c.cast("string").alias("entity"), F.lit("Ethereum").alias("chain"), address(c % 1000 + 1).alias("contract"))
    li = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    children = li.select(F.col("o_custkey").cast("string").alias("entity"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("child"), F.concat(F.when(F.col("l_linenumber") % 2 == 0, "https://gw/").otherwise("ipfs://"), F.col("l_orderkey").cast("string")).alias("url"))
    promotions = hits.filter("entity is not null").select("entity", "canonical_url", "digest", F.when(F.length("canonical_url") % 2 == 0, staging.READY).otherwise("lead_only").alias("state"))
    return hits, catalog, keys, children, promotions


_PROOFS = """WITH h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 23 > 0 THEN o_custkey + CASE WHEN o_orderkey % 29 = 0 THEN 10000000 ELSE 0 END END AS e, o_orderkey % 7 = 0 AS base, CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 0 END AS off, o_orderstatus = 'F' AND o_orderkey % 31 > 0 AS proof FROM orders),
    j AS (SELECT h.*, CASE WHEN NOT proof THEN 'incomplete_proof' WHEN e IS NULL THEN 'incomplete_hit_identity' WHEN c_custkey IS NULL THEN 'collection_not_found' WHEN base THEN 'chain_mismatch' WHEN off = 0 THEN 'collection_primary_contract' WHEN off = 1 THEN 'collection_contract_table' ELSE 'contract_mismatch' END AS identity FROM h LEFT JOIN customer ON e = c_custkey),
    g AS (SELECT * FROM j WHERE identity IN ('collection_primary_contract', 'collection_contract_table'))"""


@query(
    "g20_reconcile_proofs",
    _PROOFS
    + """, b AS (SELECT e, min('ipfs://' || k) AS u FROM g GROUP BY 1), w AS (SELECT e, u, CAST(u[8:] AS BIGINT) AS k FROM b),
    o AS (SELECT c_custkey, w.k, c_custkey % 8 = 4 AS confirmed FROM customer LEFT JOIN w ON c_custkey = w.e)
    SELECT CAST(c_custkey AS VARCHAR) AS entity, CASE WHEN k IS NULL THEN 'unchanged' WHEN confirmed THEN 'kept_confirmed' ELSE 'updated' END AS outcome, CASE WHEN k IS NOT NULL AND NOT confirmed THEN CASE WHEN k % 2 = 0 THEN 'https://gw/' ELSE 'ipfs://' END || k WHEN c_custkey % 8 > 0 THEN 'https://old' END AS url,
    CASE WHEN k IS NOT NULL AND NOT confirmed THEN k END AS check_bytes FROM o""",
)
def g20b(t: Tables):
    return staging.reconcile_proofs(*_proofs(t))[1].select("entity", "outcome", "url", "check_bytes")


@query(
    "g20_judged",
    _PROOFS
    + """, l AS (SELECT g.k, min(l_orderkey * 10 + l_linenumber) AS child FROM g JOIN lineitem ON l_orderkey = g.k AND (l_linenumber % 2 = 1 OR g.k % 2 = 0) GROUP BY 1), p AS (SELECT k, length('ipfs://' || k) % 2 = 0 AS ready FROM h WHERE e IS NOT NULL)
    SELECT 'judged' AS step, identity AS state, count(*) AS n FROM j GROUP BY 2 UNION ALL SELECT 'link', 'linked', count(*) FROM l UNION ALL SELECT 'promotion', CASE WHEN NOT ready THEN 'lead_only' WHEN k IN (SELECT k FROM g) THEN 'reconciled' ELSE 'ready_for_reconciliation' END, count(*) FROM p GROUP BY 2""",
)
def g20c(t: Tables):
    judged, _, links, moved = staging.reconcile_proofs(*_proofs(t))
    count = lambda df, step, state: df.groupBy(state.alias("state")).agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), "state", "n")
    return count(judged, "judged", F.col("identity")).unionByName(count(links, "link", F.lit("linked"))).unionByName(count(moved, "promotion", F.col("state")))


@query(
    "g35_identifier_rows",
    "SELECT 'osa-' || o_orderkey AS entity, 'contract' AS namespace, o_orderpriority AS value, o_orderstatus AS source FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 > 0 UNION ALL SELECT 'osa-' || o_orderkey, 'slug', CAST(o_custkey AS VARCHAR), o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 > 0 AND o_orderkey % 2 = 0",
)
def g35b(t: Tables):
    name = F.concat(F.lit("osa-"), F.col("o_orderkey").cast("string"))
    fresh, _ = quality.promote_validated(t.orders, "o_orderkey", F.col("o_orderstatus") == "F", name, t.orders.filter("o_orderkey % 3 = 0").select(name.alias("id")), "id")
    rows = fresh.join(t.orders, "o_orderkey")
    return staging.identifier_rows(rows, "entity_id", {"contract": F.col("o_orderpriority"), "slug": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(" ")}, {"source": F.col("o_orderstatus")})


@query(
    "g25_artifact_age",
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN round((epoch_us(TIMESTAMP '2024-06-01') - epoch_us(date_trunc('second', ts))) / 3600000000, 1) END AS age_hours, CASE WHEN event_id % 3 = 1 THEN 'invalid_market_data_as_of:yesterday' END AS violation FROM events",
)
def g25c(t: Tables):
    stamp = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, "yesterday")
    return staging.artifact_age(t.events.select("event_id", stamp.alias("s")), "event_id", "s", F.lit("2024-06-01").cast("timestamp"))


@query(
    "g32_archived",
    "SELECT event_id, CASE WHEN event_type IN ('view', 'error') AND event_id % 2 = 0 THEN 'archived' WHEN event_type = 'view' THEN 'dead' WHEN event_type = 'error' THEN 'http_404' WHEN event_type = 'click' THEN 'alive' ELSE 'timeout' END AS status FROM events",
)
def g32b(t: Tables):
    kind = F.col("event_type")
    status = F.when(kind == "view", "dead").when(kind == "error", "http_404").when(kind == "click", "alive").otherwise("timeout")
    return t.events.select("event_id", staging.archived_status(status, F.when(F.col("event_id") % 2 == 0, "https://web/x").otherwise(" ")).alias("status"))


@query(
    "e3_evidence_queue",
    """WITH r AS (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus = 'F' THEN 'shipped_unenumerated' ELSE 'complete' END) AS inv, bool_or(o_totalprice > 300000) AS gated FROM orders GROUP BY 1),
    f AS (SELECT c_custkey, c_name, 'avatar_inventory' AS field FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, c_name, 'rights' FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name, 'banner' FROM customer WHERE c_custkey % 5 = 0),
    p AS (SELECT f.*, CASE field WHEN 'avatar_inventory' THEN concat_ws('|', CASE WHEN inv = 'shipped_unenumerated' THEN 'recover surface' END, CASE WHEN gated THEN 'inspect gate' END, 'search lanes', 'repositories') WHEN 'rights' THEN 'terms' ELSE 'authoritative project source|archived source' END AS plan, CASE field WHEN 'avatar_inventory' THEN 100 WHEN 'rights' THEN 85 ELSE 50 END AS pr FROM f LEFT JOIN r ON c_custkey = k)
    SELECT c_custkey, max(pr) AS priority, count(*) AS n_fields, string_agg(field || '=' || plan, ';' ORDER BY field) AS plan FROM p GROUP BY 1""",
)
def e3b(t: Tables):
    key = F.col("c_custkey")
    fields = F.array_compact(F.array(F.when(key % 3 > 0, "avatar_inventory"), F.when(key % 2 == 0, "rights"), F.when(key % 5 == 0, "banner")))
    research = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "shipped_unenumerated").otherwise("complete").alias("inv"), (F.col("o_totalprice") > 300000).alias("gated"))
    actions = {"avatar_inventory": [(F.col("inv") == "shipped_unenumerated", "recover surface"), (F.col("gated"), "inspect gate")]}
    out = staging.evidence_queue(t.customer.withColumn("f", fields), "c_custkey", "c_name", "f", {"avatar_inventory": 100, "rights": 85}, 50, {"avatar_inventory": ["search lanes", "repositories"], "rights": ["terms"]}, research, actions)
    return out.select("c_custkey", "priority", "n_fields", F.array_join(F.transform(F.map_entries("plans"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|"))), ";").alias("plan"))
