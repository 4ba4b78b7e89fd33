"""Queries of the search, rollup and ranking operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cols import joined, missing
from ..operators import ranking, rollup, search
from .registry import Tables, query


@query(
    "b1_faceted_search",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE (o_orderpriority ILIKE '%urg%' OR o_orderstatus ILIKE '%urg%')
    AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'""",
)
def b1(t: Tables):
    found = search.faceted_search(t.orders, "urg", ["o_orderpriority", "o_orderstatus"], {"o_orderstatus": "F"}, "o_orderdate", "1996-01-01", "1998-12-31", (), ["o_orderkey"])
    return found.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("b2_candidate_search", "SELECT p_partkey, p_name FROM part WHERE (p_name ILIKE '%red%' OR p_type ILIKE '%red%') AND p_size = 10")
def b2(t: Tables):
    return search.faceted_search(t.part, "red", ["p_name", "p_type"], {"p_size": 10}, order=["p_name", "p_partkey"]).select("p_partkey", "p_name")


@query(
    "b3_search_children",
    """SELECT o_orderkey, o_orderpriority, c_name AS parent_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority ILIKE '%high%' ORDER BY o_orderdate, o_orderkey LIMIT 50""",
)
def b3(t: Tables):
    parent = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return search.search_children(t.orders, parent, "o_custkey", "o_custkey", "c_name", "high", ["o_orderpriority"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderpriority", "parent_name")


@query(
    "b4_lookup",
    """SELECT c_custkey, c_name, CASE WHEN lower(c_name) = '77' OR CAST(c_custkey AS VARCHAR) = '77' THEN 0 WHEN c_name ILIKE '%77%' THEN 1 ELSE 2 END AS match_rank
    FROM customer WHERE lower(c_name) = '77' OR CAST(c_custkey AS VARCHAR) ILIKE '%77%' OR c_name ILIKE '%77%' ORDER BY match_rank, c_name, c_custkey LIMIT 1""",
)
def b4(t: Tables):
    return search.lookup(t.customer, "77", ["c_custkey"], "c_name").select("c_custkey", "c_name", "match_rank")


@query(
    "b5_haystack_search",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 3 ELSE 2 END AS status_rank FROM part
    WHERE contains(lower(concat_ws(' ', p_name, p_brand)), 'widget brand#1') AND coalesce(CAST(p_size AS VARCHAR), 'unknown') = '7'""",
)
def b5(t: Tables):
    return search.haystack_search(t.part, "widget brand#1", ["p_name", "p_brand"], {"p_size": 7}, "p_type", {"PROMO": 0, "SMALL": 1, "LARGE": 3}, "p_name").select("p_partkey", "status_rank")


@query("b6_sql", "SELECT n_name, count(*) AS n, CAST(round(sum(c_acctbal), 2) AS DOUBLE) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def b6(t: Tables):
    text = "SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"
    return search.sql(t.spark, {"customer": t.customer, "nation": t.nation}, text)


@query(
    "b7_select_targets",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END AS tier_rank FROM customer
    WHERE c_acctbal > 5000 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY tier_rank, c_name LIMIT 200""",
)
def b7(t: Tables):
    done = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return search.select_targets(t.customer, done, "c_custkey", F.col("c_acctbal") > 5000, "c_mktsegment", ["BUILDING", "MACHINERY"], ["c_name"], 200).select("c_custkey", "tier_rank")


@query(
    "b8_pending",
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'N')",
)
def b8(t: Tables):
    link = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return search.pending(t.orders, link, "o_orderkey", F.col("o_totalprice") > 100000, F.col("l_returnflag") == "N").select("o_orderkey")


@query("b9_has_child", "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING' AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def b9(t: Tables):
    child = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return search.has_child(t.customer, child, "c_custkey", F.col("o_totalprice") > 450000, F.col("c_mktsegment") != "BUILDING").select("c_custkey")


@query(
    "b10_detail",
    """SELECT c_custkey, count(o_orderkey) AS n_children, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) FILTER (WHERE rn <= 3) AS first_children
    FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) o ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def b10(t: Tables):
    child = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    out = search.detail(t.customer, child, "c_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey"], 3)
    return out.select("c_custkey", "n_children", F.array_join(F.transform("first_children", lambda x: x["o_orderkey"].cast("string")), ",").alias("first_children"))


@query(
    "b11_registry",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' THEN 'mapped' ELSE 'unmapped' END AS side,
    CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' THEN lower(c_mktsegment) WHEN c_mktsegment = 'FURNITURE' THEN 'unsupported_tier' ELSE 'negative' END AS value FROM customer""",
)
def b11(t: Tables):
    reason = F.when(F.col("c_mktsegment") == "FURNITURE", "unsupported_tier").otherwise("negative")
    ok, rest = search.project_registry(t.customer, (F.col("c_acctbal") >= 0) & (F.col("c_mktsegment") != "FURNITURE"), {"c_custkey": F.col("c_custkey"), "value": F.lower("c_mktsegment")}, reason)
    return ok.select("c_custkey", F.lit("mapped").alias("side"), "value").unionByName(rest.select("c_custkey", F.lit("unmapped").alias("side"), F.col("reason").alias("value")))


@query(
    "b12_manifest",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'template' WHEN p_size > 20 THEN 'metadata' WHEN p_size > 5 THEN 'param' ELSE 'unavailable' END AS strategy,
    'brand:' || lower(p_brand) AS caip_id, coalesce(CASE WHEN p_size > 30 THEN 'x' || CAST(p_partkey AS VARCHAR) END, p_name) AS identifier FROM part""",
)
def b12(t: Tables):
    when = lambda n, v: F.when(F.col("p_size") > n, F.lit(v))
    ids = [F.when(F.col("p_size") > 30, F.concat(F.lit("x"), F.col("p_partkey").cast("string"))), F.col("p_name")]
    return search.project_manifest(t.part, F.lit("brand"), F.lower("p_brand"), when(40, "t"), when(20, "m"), when(5, "p"), ids).select("p_partkey", "strategy", "caip_id", "identifier")


@query(
    "b13_chain_neutral",
    """SELECT n_nationkey, CASE r_name WHEN 'AFRICA' THEN 'eip155' WHEN 'AMERICA' THEN 'eip155' WHEN 'ASIA' THEN 'solana' END AS namespace,
    CASE r_name WHEN 'AFRICA' THEN '1' WHEN 'AMERICA' THEN '137' WHEN 'ASIA' THEN 'mainnet' END AS reference FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def b13(t: Tables):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return search.chain_neutral(rows, "r_name", {"africa": ("eip155", "1"), "america": ("eip155", "137"), "asia": ("solana", "mainnet")}).select("n_nationkey", "namespace", "reference")


@query(
    "d1_facet_counts",
    """SELECT 'c_mktsegment' AS dimension, coalesce(c_mktsegment, '?') AS value, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'c_nationkey', coalesce(CAST(c_nationkey AS VARCHAR), '?'), count(*) FROM customer GROUP BY 2""",
)
def d1(t: Tables):
    return rollup.facet_counts(t.customer, ["c_mktsegment", "c_nationkey"])


_BLANKED = """WITH b AS (SELECT c_custkey, c_name, CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS nation,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'unknown' WHEN 'FURNITURE' THEN '' ELSE c_mktsegment END AS tier, CASE WHEN c_acctbal < -980 THEN NULL ELSE c_acctbal END AS balance FROM customer) """


def blanked(t: Tables):
    c = t.customer
    tier = F.when(F.col("c_mktsegment") == "BUILDING", "unknown").when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", "c_name", F.when(F.col("c_nationkey") >= 5, F.col("c_nationkey")).alias("nation"), tier.alias("tier"), F.when(F.col("c_acctbal") >= -980, F.col("c_acctbal")).alias("balance"))


def _miss(c: str) -> str:
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'unknown'))"


@query(
    "d2_completeness",
    _BLANKED + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (NOT {_miss(c)}) AS have, count(*) FILTER ({_miss(c)}) AS missing, CAST(floor(count(*) FILTER (NOT {_miss(c)}) * 100 / count(*)) AS BIGINT) AS pct FROM b" for c in ("nation", "tier", "balance")),
)
def d2(t: Tables):
    return rollup.completeness(blanked(t), ["nation", "tier", "balance"])


@query(
    "d3_gaps",
    _BLANKED
    + ", m AS (" + " UNION ALL ".join(f"SELECT '{c}' AS field, c_custkey, c_name FROM b WHERE {_miss(c)}" for c in ("nation", "tier", "balance"))
    + """), r AS (SELECT *, count(*) OVER (PARTITION BY field) AS missing, CAST(row_number() OVER (PARTITION BY field ORDER BY c_name, c_custkey) AS INTEGER) AS place FROM m)
    SELECT field, missing, place, c_custkey, c_name FROM r WHERE (missing <= 15 OR place <= 8)""",
)
def d3(t: Tables):
    return rollup.gaps(blanked(t), "c_custkey", "c_name", ["nation", "tier", "balance"])


@query(
    "d4_child_rollup",
    """SELECT o_custkey, count(*) AS n_rows, count(CASE WHEN o_totalprice > 50000 THEN o_orderpriority END) AS with_url, count(*) FILTER (o_orderstatus = 'F') AS public_rows,
    count(*) FILTER (o_orderstatus <> 'F') AS nonpublic_rows, count(*) FILTER (o_totalprice > 200000) AS ok_rows, count(*) FILTER (NOT o_totalprice > 200000) AS bad_rows,
    count(DISTINCT CASE WHEN o_totalprice > 50000 THEN o_orderpriority END) AS n_urls FROM orders GROUP BY o_custkey""",
)
def d4(t: Tables):
    return rollup.child_rollup(t.orders, "o_custkey", F.when(F.col("o_totalprice") > 50000, F.col("o_orderpriority")), F.col("o_orderstatus") == "F", F.col("o_totalprice") > 200000)


@query(
    "d5_reason_counts",
    _BLANKED + "SELECT reason, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT 'missing_{c}' AS reason FROM b WHERE {_miss(c)}" for c in ("nation", "tier", "balance")) + ") GROUP BY reason",
)
def d5(t: Tables):
    rows = blanked(t).withColumn("r", F.array_compact(F.array(*(F.when(missing(c), F.lit(f"missing_{c}")) for c in ("nation", "tier", "balance")))))
    return rollup.reason_counts(rows, "r")


@query(
    "d6_link_summary",
    """SELECT 'scheme' AS dimension, regexp_extract(url, '^([a-z]+):', 1) AS value, count(*) AS n FROM pages GROUP BY 2
    UNION ALL SELECT 'fragment', CASE WHEN contains(url, '#') THEN 'yes' ELSE 'no' END, count(*) FROM pages GROUP BY 2""",
)
def d6(t: Tables):
    rows = t.pages.select(F.regexp_extract("url", "^([a-z]+):", 1).alias("scheme"), F.when(F.contains("url", F.lit("#")), "yes").otherwise("no").alias("fragment"))
    return rollup.link_summary(rows, ["scheme", "fragment"])


@query(
    "d6_links_by_entity",
    """WITH l AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS e, o_totalprice > 100000 AS h FROM orders)
    SELECT coalesce(e, '<unbound>') AS entity, count(*) AS links, count(*) FILTER (h) AS healthy, count(*) FILTER (NOT h) AS problem FROM l GROUP BY 1""",
)
def d6b(t: Tables):
    rows = t.orders.withColumn("ids", F.when(F.col("o_orderstatus") != "P", F.array("o_orderpriority")))
    return rollup.link_summary_by_entity(rows, "ids", F.col("o_totalprice") > 100000)


@query(
    "d8_counters",
    """SELECT 'orders' AS counter, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS before, count(*) AS after, count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderdate IS NULL) AS change FROM orders
    UNION ALL SELECT 'large', count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01' AND o_totalprice > 300000), count(*) FILTER (o_totalprice > 300000), count(*) FILTER (o_totalprice > 300000 AND (o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderdate IS NULL)) FROM orders""",
)
def d8(t: Tables):
    tables = lambda df: {"orders": (df, None), "large": (df, F.col("o_totalprice") > 300000)}
    return rollup.delta(rollup.counters(tables(t.orders.filter("o_orderdate < timestamp '1998-01-01'"))), rollup.counters(tables(t.orders)))


@query(
    "d9_coverage",
    """WITH i AS (SELECT l_suppkey, l_partkey, bool_or(l_returnflag = 'R') AS linked, max(greatest(CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT))) AS e FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, count(*) AS items, count(*) FILTER (linked) AS with_links, count(*) FILTER (NOT linked) AS without_links, max(e) AS expected,
    count(*) = count(*) FILTER (linked) AND count(*) >= max(e) AS complete FROM i GROUP BY l_suppkey""",
)
def d9(t: Tables):
    return rollup.coverage(t.lineitem, "l_suppkey", "l_partkey", F.col("l_returnflag") == "R", [F.col("l_linenumber").cast("long"), F.floor("l_quantity").cast("long")], F.lit(True), F.lit(False))


@query(
    "d10_page_coverage",
    """SELECT user_id, count(DISTINCT props) AS rows, count(DISTINCT event_type) AS pages, max(CAST(floor(value) AS BIGINT)) AS reported, bool_or(event_type = 'error' AND value > 50) AS truncated,
    NOT bool_or(event_type = 'error' AND value > 50) AND count(DISTINCT props) >= max(CAST(floor(value) AS BIGINT)) AS complete FROM events GROUP BY user_id""",
)
def d10(t: Tables):
    rows = t.events.withColumn("total", F.floor("value").cast("long")).withColumn("cut", (F.col("event_type") == "error") & (F.col("value") > 50))
    return rollup.page_coverage(rows, "user_id", "props", "event_type", "total", "cut")


@query(
    "d11_attribute_profile",
    """WITH a AS (SELECT p_brand, p_partkey, p_name, unnest(['type', 'size']) AS k, unnest([p_type, CAST(p_size AS VARCHAR)]) AS v FROM part),
    i AS (SELECT p_brand, p_partkey, count(k) AS n, min(p_name) AS name, string_agg(k || '=' || v, '|' ORDER BY k || '=' || v) AS combo FROM a GROUP BY 1, 2),
    g AS (SELECT p_brand, count(*) AS items, avg(n) AS av, count(DISTINCT n) AS counts, count(DISTINCT name) AS names, count(*) FILTER (regexp_matches(name, '#?[0-9]+\\s*$')) AS numbered, count(DISTINCT combo) AS combos FROM i GROUP BY 1),
    y AS (SELECT p_brand, count(*) AS types, count(*) FILTER (v > 1) AS varied FROM (SELECT p_brand, k, count(DISTINCT v) AS v FROM a GROUP BY 1, 2) GROUP BY 1)
    SELECT g.p_brand, items, round(av, 4) AS avg_attributes, types, round(varied / greatest(types, 1), 4) AS variation, names, combos,
    CASE WHEN av = 0 THEN 'no_traits' WHEN av >= 5 AND varied / types > 0.5 THEN 'generative' WHEN av >= 3 AND varied / types > 0.3 THEN 'generative' WHEN av >= 2 AND counts = 1 AND varied / types > 0.3 THEN '1of1_series'
    WHEN av <= 2 AND names = items AND numbered = 0 THEN '1of1_art' WHEN numbered / items > 0.5 THEN 'numbered' ELSE 'mixed' END AS classified FROM g JOIN y ON g.p_brand = y.p_brand""",
)
def d11(t: Tables):
    rows = t.part.select("p_brand", "p_partkey", "p_name", F.explode(F.array(F.struct(F.lit("type").alias("k"), F.col("p_type").alias("v")), F.struct(F.lit("size").alias("k"), F.col("p_size").cast("string").alias("v")))).alias("a"))
    return rollup.attribute_profile(rows.select("p_brand", "p_partkey", "p_name", "a.k", "a.v"), "p_brand", "p_partkey", "p_name", "k", "v")


_URL_KEY = r"regexp_replace(regexp_replace(lower(url), '^https?://(m\.|blog\.|www\.)?', ''), '[?#].*$|/$', '', 'g')"


@query("d12_reverse_index", f"SELECT {_URL_KEY} AS url_key, count(*) AS refs, string_agg(DISTINCT regexp_extract(url, '^([a-z]+):', 1), ',' ORDER BY regexp_extract(url, '^([a-z]+):', 1)) AS schemes FROM pages GROUP BY 1")
def d12(t: Tables):
    key = F.regexp_replace(F.regexp_replace(F.lower("url"), r"^https?://(m\.|blog\.|www\.)?", ""), r"[?#].*$|/$", "")
    index, _ = rollup.reverse_index(t.pages.withColumn("scheme", F.regexp_extract("url", "^([a-z]+):", 1)), key, {"schemes": "scheme"})
    return index.select("url_key", "refs", joined("schemes").alias("schemes"))


@query(
    "d13_expand_results",
    "SELECT status, count(*) AS n FROM (SELECT CASE WHEN s_suppkey IS NULL THEN 'none' WHEN s_acctbal < 0 THEN 'invalid' ELSE 'valid' END AS status FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey) GROUP BY status",
)
def d13(t: Tables):
    results = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_acctbal") < 0, "invalid").otherwise("valid").alias("status"))
    return rollup.expand_results(results, t.lineitem, "l_suppkey").groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count("*").alias("n"))


@query(
    "d14_feed_health",
    """WITH b AS (SELECT DISTINCT c_custkey AS k FROM customer), p AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS v FROM orders GROUP BY 1)
    SELECT count(*) AS bound, count(p.k) AS probed, count(*) FILTER (v) AS valid, count(*) = count(p.k) AS complete FROM b LEFT JOIN p ON b.k = p.k""",
)
def d14(t: Tables):
    return rollup.feed_health(t.customer, t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "F")


@query(
    "d15_probe_rollup",
    """SELECT o_custkey, bool_and(o_totalprice > 1000) AS complete, count(DISTINCT o_orderkey) AS urls, count(*) FILTER (l_returnflag <> 'R') AS valid, count(DISTINCT l_linestatus) AS formats,
    count(*) FILTER (NOT coalesce(l_returnflag <> 'R', false)) AS invalid, bool_and(o_totalprice > 1000) AND count(DISTINCT o_orderkey) > 0 AND count(*) FILTER (NOT coalesce(l_returnflag <> 'R', false)) = 0 AS ready
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""",
)
def d15(t: Tables):
    inventory = t.orders.withColumn("done", F.col("o_totalprice") > 1000)
    probes = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") != "R").alias("ok"), "l_linestatus")
    return rollup.probe_rollup(inventory, probes, "o_custkey", "o_orderkey", "done", "ok", "l_linestatus")


@query(
    "d16_evidence_counters",
    """WITH e AS (SELECT user_id, count(DISTINCT event_type) AS sources, max(ts) AS last_seen, count(*) FILTER (event_type = 'purchase') AS corroborated, count(*) FILTER (event_type = 'error') AS conflicts FROM events GROUP BY 1),
    o AS (SELECT o_custkey, count(*) AS candidates FROM orders GROUP BY 1)
    SELECT c_custkey, coalesce(sources, 0) AS sources, last_seen, coalesce(corroborated, 0) AS corroborated, coalesce(conflicts, 0) AS conflicts, coalesce(candidates, 0) AS candidates
    FROM customer LEFT JOIN e ON c_custkey = user_id LEFT JOIN o ON c_custkey = o_custkey""",
)
def d16(t: Tables):
    evidence, candidates = t.events.withColumnRenamed("user_id", "c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey")
    flags = {"corroborated": F.col("event_type") == "purchase", "conflicts": F.col("event_type") == "error"}
    return rollup.evidence_counters(t.customer.select("c_custkey"), "c_custkey", evidence, candidates, "event_type", "ts", flags)


@query(
    "e1_top_leads",
    """WITH s AS (SELECT p_brand, p_type, 1 + 8 * contains(lower(p_name), 'red')::INT + 5 * contains(lower(p_name), 'widget')::INT + 3 * contains(lower(p_name), 'bolt')::INT + 2 * contains(lower(p_name), lower(p_type))::INT AS score, p_partkey FROM part)
    SELECT CAST(p_partkey AS VARCHAR) AS slug, max(score) AS score, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS queries FROM s GROUP BY 1 ORDER BY score DESC, slug LIMIT 25""",
)
def e1(t: Tables):
    leads = ranking.top_leads(t.part.withColumn("slug", F.col("p_partkey").cast("string")), "slug", F.col("p_name"), "p_type", {"red": 8, "widget": 5, "bolt": 3}, 25)
    return leads.select("slug", "score", joined("queries").alias("queries"))


@query("e2_sample_per_group", "SELECT o_custkey, o_orderkey, place FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place FROM orders) WHERE place <= 3")
def e2(t: Tables):
    return ranking.sample_per_group(t.orders, "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "place")


@query(
    "e3_priority_queue",
    _BLANKED
    + ", f AS (" + " UNION ALL ".join(f"SELECT c_custkey, c_name, '{f}' AS field, {p} AS p, '{a}' AS a FROM b WHERE {_miss(c)}" for c, f, p, a in (("nation", "access", 95, "probe"), ("tier", "rights", 85, "read_terms"), ("balance", "other", 50, "review")))
    + ") SELECT c_custkey, c_name, max(p) AS priority, count(*) AS n_fields, string_agg(field || ':' || a, ',' ORDER BY field || ':' || a) AS plan FROM f GROUP BY 1, 2",
)
def e3(t: Tables):
    fields = F.array_compact(F.array(*(F.when(missing(c), F.lit(f)) for c, f in (("nation", "access"), ("tier", "rights"), ("balance", "other")))))
    rows = blanked(t).withColumn("fields", fields)
    out = ranking.priority_queue(rows, "c_custkey", "c_name", "fields", ranking.FIELD_PRIORITIES, {"access": "probe", "rights": "read_terms"})
    return out.select("c_custkey", "c_name", "priority", "n_fields", F.array_join("plan", ",").alias("plan"))


@query(
    "e4_natural_order",
    """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS id FROM part)
    SELECT id, p_partkey, row_number() OVER (ORDER BY CASE WHEN regexp_full_match(id, '[0-9]+') THEN 0 ELSE 1 END, TRY_CAST(id AS BIGINT), id, p_partkey) AS place FROM x""",
)
def e4(t: Tables):
    rows = t.part.withColumn("id", F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_partkey").cast("string")))
    return ranking.numbered(rows, [*ranking.natural_order(F.col("id")), "p_partkey"]).select("id", "p_partkey", "place")


@query(
    "e5_strongest",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE 1 END DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def e5(t: Tables):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 3).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(1)
    return ranking.strongest(t.orders, "o_custkey", rank, "o_orderkey").select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "e6_candidate_order",
    """WITH h AS (SELECT regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS host, url, CASE WHEN lower(url) LIKE '%.html' THEN 0 WHEN lower(url) LIKE '%/' THEN 1 ELSE 2 END AS r FROM pages)
    SELECT host, CAST(min(r) AS INTEGER) AS rank, arg_min(url, (r, url)) AS url FROM h GROUP BY host""",
)
def e6(t: Tables):
    return ranking.candidate_order(t.pages.withColumn("host", F.regexp_extract(F.lower("url"), "^[a-z]+://([^/?#:]*)", 1)), "host", "url", [".html", "/"])


@query(
    "e7_merge_hits",
    """SELECT CAST(c_nationkey AS VARCHAR) AS k, count(*) AS hits, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS queries FROM customer WHERE c_acctbal > 0 GROUP BY 1
    UNION ALL SELECT '<unresolved>', count(*), NULL FROM customer WHERE NOT c_acctbal > 0""",
)
def e7(t: Tables):
    rows = t.customer.withColumn("k", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")))
    leads, rest = ranking.merge_hits(rows, ["k"], "c_mktsegment")
    return leads.select("k", "hits", joined("queries").alias("queries")).unionByName(rest.agg(F.count("*").alias("hits")).select(F.lit("<unresolved>").alias("k"), "hits", F.lit(None).cast("string").alias("queries")))


@query("f1_distinct_keys", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def f1(t: Tables):
    return ranking.distinct_keys(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k")), "k")


@query(
    "f2_scope_omissions",
    """SELECT item_id FROM benchmark WHERE item_id NOT IN (SELECT 3 * doc_id FROM documents)
    AND lower(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) NOT IN (SELECT lower(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) FROM documents WHERE text IS NOT NULL)""",
)
def f2(t: Tables):
    actual = t.documents.select((3 * F.col("doc_id")).alias("item_id"), "text")
    return ranking.scope_omissions(t.benchmark, actual, "item_id", F.sha2(F.lower(F.regexp_replace("text", "[^A-Za-z0-9]", "")), 256)).select("item_id")


@query(
    "f3_union_candidates",
    """WITH u AS (SELECT c_nationkey AS k, 'customer' AS tag, 0 AS r, c_mktsegment AS status FROM customer UNION ALL SELECT s_nationkey, 'supplier', 1, CASE WHEN s_acctbal > 0 THEN 'paid' ELSE 'due' END FROM supplier)
    SELECT k, arg_max(status, (r, status)) AS status, CASE WHEN max(r) = 0 THEN 'customer' WHEN min(r) = 1 THEN 'supplier' ELSE 'customer,supplier' END AS tags FROM u GROUP BY k""",
)
def f3(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("status"), F.lit("customer").alias("tag"))
    b = t.supplier.select(F.col("s_nationkey").alias("k"), F.when(F.col("s_acctbal") > 0, "paid").otherwise("due").alias("status"), F.lit("supplier").alias("tag"))
    return ranking.union_candidates([a, b], "k", "status", "tag")


@query(
    "f4_merge_assets",
    """SELECT l_partkey, l_suppkey, coalesce(min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END), 'unknown') AS fmt, bool_or(l_discount > 0.05) AS rigged, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS evidence FROM lineitem GROUP BY 1, 2""",
)
def f4(t: Tables):
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("unknown").alias("fmt"), (F.col("l_discount") > 0.05).alias("rigged"), "l_linestatus")
    return ranking.merge_assets(rows, ["l_partkey", "l_suppkey"], "fmt", "rigged", "l_linestatus").withColumn("evidence", joined("evidence"))
