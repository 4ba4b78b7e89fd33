"""Queries of the resolution, quality, consensus, merge and license operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cols import joined
from ..operators import consensus, license, merge, quality, resolve
from .registry import Tables, query


def digits(c: str):
    return F.regexp_extract(c, r"(\d+)$", 1)


_C1_RULES = """WITH RECURSIVE l AS (SELECT s_suppkey AS id, list_filter([
        CASE WHEN s_suppkey % 4 = 0 THEN '0:' || s_suppkey * 30 END, CASE WHEN s_suppkey % 3 = 0 THEN '1:' || s_nationkey * 2 END,
        CASE WHEN s_suppkey % 5 < 3 THEN '2:' || (s_suppkey // 3) * 7 END, CASE WHEN s_suppkey % 2 = 1 THEN '3:' || s_suppkey // 5 END], lambda x: x IS NOT NULL) AS ks FROM supplier),
    c AS (SELECT '0:' || c_custkey AS k, min(c_custkey) AS e FROM customer GROUP BY 1 UNION ALL SELECT '1:' || c_nationkey, min(c_custkey) FROM customer GROUP BY 1
        UNION ALL SELECT '2:' || c_custkey * 13, min(c_custkey) FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1),
    x AS (SELECT id, unnest(ks) AS k FROM l), m AS (SELECT id, k, e FROM x JOIN c USING (k))"""


@query(
    "c1_cascade_match",
    _C1_RULES
    + """, o AS (SELECT *, row_number() OVER (ORDER BY id) AS i FROM l WHERE id NOT IN (SELECT id FROM m)),
    g(i, have, new) AS (SELECT 0::BIGINT, []::VARCHAR[], []::BIGINT[] UNION ALL
        SELECT o.i, CASE WHEN list_has_any(have, ks) THEN have ELSE list_concat(have, ks) END, CASE WHEN list_has_any(have, ks) THEN new ELSE list_append(new, id) END FROM g JOIN o ON o.i = g.i + 1),
    n AS (SELECT unnest(new) AS id FROM (SELECT new FROM g ORDER BY i DESC LIMIT 1)),
    f AS (SELECT id, k, e, NULL::BIGINT AS other FROM m UNION ALL SELECT x.id, x.k, NULL, y.id FROM x JOIN x y ON x.k = y.k AND y.id < x.id WHERE y.id IN (SELECT id FROM n)),
    b AS (SELECT id, min(CAST(k[1] AS INTEGER)) AS r, arg_min(e, k[1]) AS e0, arg_min((e, other), CAST(k[1] AS INTEGER)) AS w FROM f GROUP BY 1)
    SELECT l.id AS s_suppkey, w[1] AS entity, w[2] AS same_as_lead, CASE WHEN r IS NULL THEN 'new' ELSE CASE WHEN w[2] IS NOT NULL THEN 'lead:' ELSE '' END || CASE r WHEN 0 THEN 'id' WHEN 1 THEN 'key' WHEN 2 THEN 'name' ELSE 'slug' END END AS matched_by
    FROM l LEFT JOIN b ON l.id = b.id""",
)
def c1(t: Tables):
    key = F.col("s_suppkey")
    rules = [
        ("id", F.when(key % 4 == 0, key * 30), F.col("c_custkey")),
        ("key", F.when(key % 3 == 0, F.col("s_nationkey") * 2), F.col("c_nationkey")),
        ("name", F.when(key % 5 < 3, F.floor(key / 3) * 7), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") * 13)),
        ("slug", F.when(key % 2 == 1, F.floor(key / 5)), F.lit(None).cast("bigint")),
    ]
    return resolve.cascade_match(t.supplier, "s_suppkey", t.customer, "c_custkey", rules).select("s_suppkey", "entity", "same_as_lead", "matched_by")


@query(
    "c2_page_cascade",
    """WITH p AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS host, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS id FROM pages),
    h AS (SELECT replace(host, '.com', '.net') AS host, min(page_id) AS e FROM p GROUP BY 1), c AS (SELECT c_custkey * 2 AS c_custkey FROM customer)
    SELECT p.page_id, coalesce(c_custkey, h.e) AS entity, CASE WHEN c_custkey IS NOT NULL THEN 'key' WHEN h.e IS NOT NULL THEN 'host' ELSE 'new' END AS matched_by
    FROM p LEFT JOIN c ON p.id = c_custkey LEFT JOIN h ON p.host = h.host""",
)
def c2(t: Tables):
    rows = t.pages.select("page_id", F.regexp_extract(F.lower("url"), "^[a-z]+://([^/?#:]*)", 1).alias("host"), F.regexp_extract("url", "/([0-9]+)", 1).try_cast("bigint").alias("id"))
    catalog = t.customer.select((F.col("c_custkey") * 2).alias("entity_id"), (F.col("c_custkey") * 2).alias("key"), F.lit(None).cast("string").alias("h"))
    catalog = catalog.unionByName(rows.select(F.col("page_id").alias("entity_id"), F.lit(None).cast("bigint").alias("key"), F.replace("host", F.lit(".com"), F.lit(".net")).alias("h")))
    out = resolve.cascade_match(rows, "page_id", catalog, "entity_id", [("key", F.col("id"), F.col("key")), ("host", F.col("host"), F.col("h"))], among_leads=False)
    return out.select("page_id", "entity", "matched_by")


@query(
    "c3_presence",
    """WITH o AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS o FROM orders GROUP BY 1)
    SELECT c_custkey, CASE WHEN n IS NULL THEN 'absent' WHEN n > 1 AND o >= n THEN 'onboarded' ELSE 'partial' END AS presence, coalesce(n, 0) AS n_rows FROM customer LEFT JOIN o ON k = CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 100000 * (c_custkey % 3) END""",
)
def c3(t: Tables):
    other = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") != "P").alias("o"))
    own = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(F.col("c_custkey") + 100000 * (F.col("c_custkey") % 3))
    return resolve.presence(t.customer, "c_custkey", other, [(own, F.col("o_custkey"))], "n", "o")


@query(
    "c4_bind",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey * CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 100000 END END AS sup, list_value(o_custkey, o_orderkey % 11) AS keys FROM orders),
    w AS (SELECT s_suppkey AS k, s_suppkey + 1 AS e FROM supplier), x AS (SELECT o_orderkey, unnest(keys) AS k FROM r),
    b AS (SELECT o_orderkey, min(e) AS lo, max(e) AS hi FROM x JOIN w ON x.k = w.k GROUP BY 1), h AS (SELECT o_orderkey, 5 AS e FROM orders WHERE o_orderkey % 13 = 0),
    j AS (SELECT r.o_orderkey, sup, c.c_custkey AS known, lo, hi, h.e AS hand FROM r LEFT JOIN customer c ON sup = c_custkey LEFT JOIN b ON r.o_orderkey = b.o_orderkey LEFT JOIN h ON r.o_orderkey = h.o_orderkey),
    k AS (SELECT *, coalesce(known, CASE WHEN NOT coalesce(lo <> hi, false) THEN coalesce(lo, hand) END) AS bound_to FROM j)
    SELECT o_orderkey, bound_to, CASE WHEN known IS NOT NULL THEN NULL WHEN lo <> hi THEN 'ambiguous_contract_binding:' || lo || ',' || hi WHEN bound_to IS NULL THEN 'no_explicit_binding' WHEN sup IS NOT NULL THEN 'unknown_supplied_id' END AS diagnostic FROM k""",
)
def c4(t: Tables):
    key = F.col("o_orderkey")
    records = t.orders.select("o_orderkey", F.when(key % 7 == 0, F.col("o_custkey") * F.when(key % 2 == 0, 1).otherwise(100000)).alias("sup"), F.array_distinct(F.array(F.col("o_custkey"), key % 11)).alias("ids"))
    owners = t.supplier.select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") + 1).alias("c_custkey"))
    curated = t.orders.filter("o_orderkey % 13 = 0").select("o_orderkey", F.lit(5).cast("bigint").alias("c_custkey"))
    return resolve.bind(records, "o_orderkey", "sup", "ids", t.customer, "c_custkey", owners, "k", curated).select("o_orderkey", "bound_to", "diagnostic")


@query("c5_unique_index", "SELECT c_nationkey * 100 + c_custkey % 90 AS k, CASE WHEN count(DISTINCT c_custkey) = 1 THEN max(c_custkey) END AS entity, count(DISTINCT c_custkey) AS holders FROM customer GROUP BY 1")
def c5(t: Tables):
    return resolve.unique_index(t.customer.withColumn("k", F.col("c_nationkey") * 100 + F.col("c_custkey") % 90), "k", "c_custkey")


@query(
    "c6_guarded_resolve",
    """WITH r AS (SELECT s_nationkey AS k, s_suppkey % 10 AS sub, s_suppkey FROM supplier), x AS (SELECT k, sub, min(s_suppkey) AS e FROM r GROUP BY 1, 2), u AS (SELECT k, CASE WHEN count(*) = 1 THEN max(s_suppkey) END AS e FROM r GROUP BY 1),
    d AS (SELECT c_custkey, c_nationkey AS k, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 10 END AS sub FROM customer)
    SELECT c_custkey, CASE WHEN d.k < 20 THEN x.e ELSE coalesce(x.e, u.e) END AS resolved,
    CASE WHEN CASE WHEN d.k < 20 THEN x.e ELSE coalesce(x.e, u.e) END IS NOT NULL THEN NULL WHEN d.k < 20 AND d.sub IS NULL THEN 'shared_key_without_sub_key' WHEN d.k < 20 THEN 'shared_key_unresolved' ELSE 'unresolved' END AS error
    FROM d LEFT JOIN x ON d.k = x.k AND d.sub = x.sub LEFT JOIN u ON d.k = u.k""",
)
def c6(t: Tables):
    records = t.supplier.select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") % 10).alias("sub"), "s_suppkey")
    df = t.customer.select("c_custkey", F.col("c_nationkey").alias("k"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey") % 10).alias("sub"))
    return resolve.guarded_resolve(df, "k", "sub", t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("k")), records, "s_suppkey").select("c_custkey", "resolved", "error")


@query(
    "c7_majority",
    "WITH v AS (SELECT c_nationkey, c_mktsegment, count(*) AS votes, min(c_custkey) AS seen FROM customer GROUP BY 1, 2) SELECT c_nationkey, arg_max(c_mktsegment, (votes, -seen)) AS c_mktsegment, max(votes) AS votes FROM v GROUP BY 1",
)
def c7(t: Tables):
    return resolve.majority(t.customer, "c_nationkey", "c_mktsegment", "c_custkey")


@query(
    "c8_token_overlap",
    """WITH a AS (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_size AS n FROM part), x AS (SELECT DISTINCT p_partkey, unnest(string_split(trim(regexp_replace(lower(n), '[^a-z0-9]+', ' ', 'g')), ' ')) AS w FROM a),
    k AS (SELECT p_partkey, w AS k FROM x WHERE length(w) > 4 UNION ALL SELECT x.p_partkey, x.w || ' ' || y.w FROM x JOIN x y ON x.p_partkey = y.p_partkey AND x.w < y.w UNION ALL SELECT p_partkey, '=' || n FROM a),
    f AS (SELECT k, min(p_partkey) AS first FROM k GROUP BY k)
    SELECT p_partkey AS id, min(first) AS first FROM k JOIN f ON k.k = f.k WHERE first < p_partkey GROUP BY 1""",
)
def c8(t: Tables):
    return resolve.token_duplicates(t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_size").alias("n")), "p_partkey", "n")


@query(
    "c9_contains_match",
    "SELECT p_partkey AS left_id, min(n_nationkey) AS right_id FROM part JOIN nation ON contains('nation_' || (p_size % 30), lower(n_name)) OR contains(lower(n_name), 'nation_' || (p_size % 30)) GROUP BY 1",
)
def c9(t: Tables):
    return resolve.contains_match(t.part, "p_partkey", F.concat(F.lit("nation_"), (F.col("p_size") % 30).cast("string")), t.nation, "n_nationkey", F.lower("n_name"))


@query(
    "c9_contains_large",
    """WITH a AS (SELECT p_partkey, lower(p_name) || ' ' || p_size AS n FROM part), b AS (SELECT min(s_suppkey) AS s, s_suppkey % 50 || ' ' || s_nationkey AS n FROM supplier GROUP BY 2),
    d AS (SELECT DISTINCT n FROM a), m AS (SELECT d.n, min(s) AS right_id FROM d JOIN b ON contains(d.n, b.n) OR contains(b.n, d.n) GROUP BY 1) SELECT p_partkey AS left_id, right_id FROM a JOIN m ON a.n = m.n""",
)
def c9b(t: Tables):
    """Both sides grow: names of parts, and short ones made of suppliers."""
    name = F.concat_ws(" ", (F.col("s_suppkey") % 50).cast("string"), F.col("s_nationkey").cast("string"))
    return resolve.contains_match(t.part, "p_partkey", F.concat_ws(" ", F.lower("p_name"), F.col("p_size").cast("string")), t.supplier, "s_suppkey", name)


@query(
    "c10_find_missing",
    """SELECT id, name FROM (SELECT s_suppkey * 20 + 500000000 AS id, s_name AS name FROM supplier UNION SELECT p_partkey, p_name || ' ' || p_size FROM part)
    WHERE id NOT IN (SELECT c_custkey FROM customer) AND lower(replace(name, ' ', '')) NOT IN (SELECT lower(replace(p_name, ' ', '')) || (p_size + 1) FROM part)""",
)
def c10(t: Tables):
    a = t.supplier.select((F.col("s_suppkey") * 20 + 500_000_000).alias("id"), F.col("s_name").alias("name"))
    b = t.part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_size").alias("name"))
    catalog = t.customer.select(F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("name")).unionByName(t.part.select(F.lit(None).cast("bigint").alias("id"), F.concat("p_name", (F.col("p_size") + 1).cast("string")).alias("name")))
    return resolve.find_missing([a, b], "id", F.lower(F.replace("name", F.lit(" "))), catalog.filter("id is not null or name is not null"))


@query(
    "c11_verify_identity",
    """WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey * CASE WHEN o_orderkey % 19 = 0 THEN 90001 ELSE 1 END END AS c_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment, o_orderkey % 3 + c_nationkey % 5 AS c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
    k AS (SELECT DISTINCT c_custkey, c_nationkey % 5 + 1 AS nk FROM customer)
    SELECT o_orderkey, CASE WHEN h.c_custkey IS NULL THEN 'incomplete' WHEN c.c_custkey IS NULL THEN 'not_found' WHEN c.c_mktsegment <> h.c_mktsegment THEN 'group_mismatch' WHEN c.c_nationkey % 5 = h.c_nationkey THEN 'primary' WHEN k.nk IS NOT NULL THEN 'secondary' ELSE 'mismatch' END AS reason
    FROM h LEFT JOIN customer c ON h.c_custkey = c.c_custkey LEFT JOIN k ON h.c_custkey = k.c_custkey AND h.c_nationkey = k.nk""",
)
def c11(t: Tables):
    key = F.col("o_orderkey")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    hits = rows.select(
        "o_orderkey",
        F.when(key % 17 != 0, F.col("o_custkey") * F.when(key % 19 == 0, 90001).otherwise(1)).alias("c_custkey"),
        F.when(key % 5 == 0, "X").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        (key % 3 + F.col("c_nationkey") % 5).alias("c_nationkey"),
    )
    catalog = t.customer.select("c_custkey", "c_mktsegment", (F.col("c_nationkey") % 5).alias("c_nationkey"))
    keys = t.customer.select("c_custkey", (F.col("c_nationkey") % 5 + 1).cast("bigint").alias("c_nationkey"))
    return resolve.verify_identity(hits, catalog, "c_custkey", "c_mktsegment", "c_nationkey", keys).select("o_orderkey", "reason")


@query(
    "c12_url_conflicts",
    """WITH p AS (SELECT page_id, regexp_replace(regexp_replace(lower(url), '^https?://(m\\.|blog\\.)?', ''), '[?#].*$|/$', '', 'g') AS u FROM pages), b AS (SELECT u, min(page_id) AS bound FROM p GROUP BY 1)
    SELECT page_id, bound AS other FROM p JOIN b ON p.u = b.u WHERE page_id <> bound""",
)
def c12(t: Tables):
    u = F.regexp_replace(F.regexp_replace(F.lower("url"), r"^https?://(m\.|blog\.)?", ""), r"[?#].*$|/$", "")
    catalog = t.pages.groupBy(u.alias("url")).agg(F.array(F.min("page_id")).alias("ids"))
    return resolve.url_identity_conflicts(t.pages.select("page_id", "url"), u, "page_id", catalog, F.col("url"), "ids").select("page_id", F.col("bound")[0].alias("other"))


@query(
    "c13_key_scope",
    """WITH u AS (SELECT c_nationkey AS e, c_mktsegment AS ch, lower(c_name) AS ad, c_custkey % 2 = 0 AS p, NULL::DOUBLE AS bal, 0 AS r FROM customer UNION ALL SELECT c_nationkey, c_mktsegment, lower(c_name), false, c_acctbal, 1 FROM customer WHERE c_custkey % 3 = 0)
    SELECT e, ch, ad, bool_or(p) AS p, CAST(min(r) AS INTEGER) AS source_rank, arg_min(bal, r) FILTER (bal IS NOT NULL) AS bal FROM u GROUP BY 1, 2, 3""",
)
def c13(t: Tables):
    base = t.customer.select(F.col("c_nationkey").alias("e"), F.col("c_mktsegment").alias("ch"), F.col("c_name").alias("ad"), (F.col("c_custkey") % 2 == 0).alias("p"), F.lit(None).cast("double").alias("bal"))
    more = t.customer.filter("c_custkey % 3 = 0").select(F.col("c_nationkey").alias("e"), F.col("c_mktsegment").alias("ch"), F.col("c_name").alias("ad"), F.lit(False).alias("p"), F.col("c_acctbal").alias("bal"))
    return resolve.key_scope([base, more], "e", "ch", "ad", "p", ["bal"])


@query(
    "c14_merge_duplicates",
    "SELECT o_custkey, count(*) AS merged, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderstatus <> 'P') AS priority, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1",
)
def c14(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise("").alias("priority"), F.col("o_orderstatus").alias("status"))
    return resolve.merge_duplicates(rows, "o_custkey", "o_orderkey", ["priority", "status"])


@query(
    "c14_merge_entities",
    """WITH m AS (SELECT CASE WHEN o_custkey % 2 = 1 THEN o_custkey - 1 ELSE o_custkey END AS k, o_orderpriority AS pr, o_custkey % 2 = 1 AS moved, o_orderkey AS id FROM orders)
    SELECT k AS o_custkey, pr AS o_orderpriority, arg_min(id, (moved, id)) AS o_orderkey FROM m GROUP BY 1, 2""",
)
def c14b(t: Tables):
    renames = t.customer.filter("c_custkey % 2 = 1").select(F.col("c_custkey").alias("loser"), (F.col("c_custkey") - 1).alias("survivor"))
    return resolve.merge_entities(t.orders.select("o_custkey", "o_orderpriority", "o_orderkey"), "o_custkey", renames, ["o_custkey", "o_orderpriority"])


@query(
    "c14_follow_renames",
    """WITH RECURSIVE r AS (SELECT c_custkey AS a, CASE WHEN c_custkey % 40 = 1 THEN c_custkey + 3 ELSE c_custkey - 1 END AS b FROM customer WHERE c_custkey % 8 > 0),
    w AS (SELECT a, b, 0 AS n FROM r UNION ALL SELECT w.a, r.b, n + 1 FROM w JOIN r ON w.b = r.a WHERE n < 10), e AS (SELECT a, b FROM w WHERE b NOT IN (SELECT a FROM r)), m AS (SELECT o_orderkey, coalesce(b, o_custkey) AS k, b IS NOT NULL AS moved, o_orderpriority AS p FROM orders LEFT JOIN e ON o_custkey = a)
    SELECT k AS o_custkey, p AS o_orderpriority, arg_min(o_orderkey, (moved, o_orderkey)) AS o_orderkey FROM m GROUP BY 1, 2""",
)
def c14c(t: Tables):
    key = F.col("c_custkey")
    renames = t.customer.filter(key % 8 > 0).select(key.alias("loser"), F.when(key % 40 == 1, key + 3).otherwise(key - 1).alias("survivor"))
    return resolve.merge_entities(t.orders.select("o_custkey", "o_orderpriority", "o_orderkey"), "o_custkey", renames, ["o_custkey", "o_orderpriority"])


@query(
    "c15_cascade_delete",
    "SELECT 'customer' AS name, count(*) AS n FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def c15(t: Tables):
    left = resolve.cascade_delete({"customer": (t.customer, "c_custkey"), "orders": (t.orders, "o_custkey")}, t.customer.filter("c_acctbal < 0"), "c_custkey")
    out = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in left.items()]
    return out[0].unionByName(out[1])


@query(
    "c16_enrich",
    """WITH a AS (SELECT o_custkey, min(o_orderpriority) AS pr FROM orders GROUP BY 1), b AS (SELECT s_nationkey, min(s_name) AS nm FROM supplier WHERE s_nationkey <> 3 GROUP BY 1)
    SELECT c_custkey, pr, CASE WHEN c_custkey % 10 > 0 THEN c_name ELSE nm END AS nm FROM customer LEFT JOIN a ON c_custkey = o_custkey LEFT JOIN b ON c_nationkey = s_nationkey""",
)
def c16(t: Tables):
    base = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 10 > 0, F.col("c_name")).alias("nm"))
    out = resolve.enrich(base, "c_custkey", [(t.orders.select("o_custkey", F.col("o_orderpriority").alias("pr")), "o_custkey", ["pr"])])
    shared = t.nation.filter("n_nationkey = 3").select("n_nationkey")
    return resolve.enrich(out, "c_nationkey", [(t.supplier.select("s_nationkey", F.col("s_name").alias("nm")), "s_nationkey", ["nm"])], shared).select("c_custkey", "pr", "nm")


@query(
    "c17_valid_hits",
    "SELECT DISTINCT o_custkey, l_partkey FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity > 45",
)
def c17(t: Tables):
    bindings = t.orders.select("o_orderkey", "o_custkey")
    tasks = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    observations = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return resolve.valid_hits(bindings, tasks, observations, "o_orderkey", (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45), ["o_custkey", "l_partkey"])


@query(
    "c18_latest_evidence",
    """WITH e AS (SELECT user_id, arg_max(event_type, event_id) AS et, arg_max(value, event_id) AS v FROM events GROUP BY 1)
    SELECT c_custkey, et IS NOT NULL AS observed, coalesce(et, c_mktsegment) AS latest_event_type, coalesce(v, c_acctbal) AS latest_value FROM customer LEFT JOIN e ON c_custkey = user_id""",
)
def c18(t: Tables):
    out = resolve.latest_evidence(t.customer, "c_custkey", t.events.withColumnRenamed("user_id", "c_custkey"), "event_id", ["event_type", "value"], {"event_type": F.col("c_mktsegment"), "value": F.col("c_acctbal")})
    return out.select("c_custkey", "observed", "latest_event_type", "latest_value")


_PAIR = """WITH a AS (SELECT c_nationkey AS k, max(c_name) AS name, sum(c_acctbal) AS balance, count(*) AS n FROM customer WHERE c_nationkey < 20 GROUP BY 1), b AS (SELECT c_nationkey AS k, min(upper(c_name)) AS name, sum(c_acctbal) * 1.01 AS balance, count(*) AS n FROM customer WHERE c_nationkey > 4 AND c_custkey % 50 > 0 GROUP BY 1),
    j AS (SELECT coalesce(a.k, b.k) AS k, a.name AS an, b.name AS bn, a.balance AS ab, b.balance AS bb, a.n AS ac, b.n AS bc FROM a FULL JOIN b ON a.k = b.k),
    c AS (SELECT k, 'name' AS field, an IS NOT NULL AS ha, bn IS NOT NULL AS hb, lower(an) = lower(bn) AS agrees FROM j UNION ALL SELECT k, 'balance', ab IS NOT NULL, bb IS NOT NULL, abs(ab - bb) / greatest(abs(ab), abs(bb), 1) <= 0.02 FROM j
      UNION ALL SELECT k, 'n', ac IS NOT NULL, bc IS NOT NULL, abs(ac - bc) / greatest(abs(ac), abs(bc), 1) <= 0.02 FROM j) """


def compared(t: Tables):
    a = t.customer.filter("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_name").alias("name"), F.sum("c_acctbal").alias("balance"), F.count("*").alias("n"))
    b = t.customer.filter("c_nationkey > 4 and c_custkey % 50 > 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.min(F.upper("c_name")).alias("name"), (F.sum("c_acctbal") * 1.01).alias("balance"), F.count("*").alias("n"))
    return consensus.compare_sources(a, b, "k", {"name": "text", "balance": "number", "n": "number"})


@query("g9_compare_sources", _PAIR + "SELECT k, field, ha, hb, agrees FROM c")
def g9(t: Tables):
    return compared(t).select("k", "field", F.col("a").isNotNull().alias("ha"), F.col("b").isNotNull().alias("hb"), "agrees")


@query("d7_agreement", _PAIR + "SELECT field, count(agrees) AS compared, count(*) FILTER (agrees) AS agreed, count(*) FILTER (NOT agrees) AS conflicted FROM c GROUP BY field")
def d7(t: Tables):
    from ..operators.rollup import agreement

    return agreement(compared(t))


_STATES = _PAIR + ", s AS (SELECT *, CASE WHEN agrees THEN 'corroborated' WHEN NOT agrees THEN 'conflict' WHEN ha AND NOT hb THEN 'single_source_a' WHEN hb AND NOT ha THEN 'single_source_b' ELSE 'unobserved' END AS state FROM c) "


@query("g10_consensus", _STATES + "SELECT k, field, state, state <> 'conflict' AND (ha OR hb) AS has_preferred FROM s")
def g10(t: Tables):
    return consensus.consensus(compared(t)).select("k", "field", "state", F.col("preferred").isNotNull().alias("has_preferred"))


@query("g10_review_queue", _STATES + "SELECT k, count(*) FILTER (state = 'conflict') AS conflicts, 0 AS errors FROM s GROUP BY k HAVING count(*) FILTER (state = 'conflict') > 0")
def g10b(t: Tables):
    return consensus.review_queue(consensus.consensus(compared(t)), "k").select("k", "conflicts", F.col("errors").cast("int").alias("errors"))


@query(
    "g11_authority",
    """WITH o AS (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 'corroborated' ELSE 'absent' END) AS s FROM orders GROUP BY 1), e AS (SELECT user_id, max(CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'corroborated' ELSE 'absent' END) AS s FROM events GROUP BY 1),
    j AS (SELECT c_custkey, (coalesce(o.s = 'corroborated', false)::INT + coalesce(e.s = 'corroborated', false)::INT) AS corroborating, coalesce(e.s = 'error', false)::INT AS errors FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id)
    SELECT c_custkey, corroborating, errors, CASE WHEN errors > 0 THEN 'review' WHEN corroborating >= 2 THEN 'authoritative' WHEN corroborating = 1 THEN 'corroborated' ELSE 'unobserved' END AS authority FROM j""",
)
def g11(t: Tables):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "corroborated").otherwise("absent").alias("status"))
    events = t.events.select(F.col("user_id").alias("c_custkey"), F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "corroborated").otherwise("absent").alias("status"))
    return consensus.authority(t.customer.select("c_custkey"), "c_custkey", [("orders", orders), ("events", events)], "status").select("c_custkey", "corroborating", "errors", "authority")


@query(
    "g12_preserve_last_good",
    """WITH f AS (SELECT s_suppkey AS k, s_nationkey AS n, CASE WHEN s_suppkey % 3 = 0 THEN 'rate_limited' WHEN s_suppkey % 7 = 0 THEN 'http' END AS error, s_suppkey % 4 = 0 AS ok, s_acctbal AS v FROM supplier), p AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN -1 ELSE s_nationkey END AS n, s_suppkey % 2 = 0 AS ok, -s_acctbal AS v FROM supplier),
    j AS (SELECT f.*, coalesce(f.error = 'rate_limited' AND NOT coalesce(f.ok, false) AND p.ok, false) AS keep, p.v AS pv FROM f LEFT JOIN p ON f.k = p.k AND f.n = p.n)
    SELECT k, n, error, CASE WHEN keep THEN true ELSE ok END AS ok, CASE WHEN keep THEN pv ELSE v END AS v, keep AS preserved FROM j""",
)
def g12(t: Tables):
    k = F.col("s_suppkey")
    fresh = t.supplier.select(k.alias("k"), F.col("s_nationkey").alias("n"), F.when(k % 3 == 0, "rate_limited").when(k % 7 == 0, "http").alias("error"), (k % 4 == 0).alias("ok"), F.col("s_acctbal").alias("v"))
    prior = t.supplier.select(k.alias("k"), F.when(k % 5 == 0, -1).otherwise(F.col("s_nationkey")).alias("n"), (k % 2 == 0).alias("ok"), (-F.col("s_acctbal")).alias("v"))
    return consensus.preserve_last_good(fresh, prior, ["k", "n"], "ok", "error", ["v"])


@query(
    "a9_upsert_fill",
    """WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg, c_name AS nm FROM customer), n AS (SELECT 2 * o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS seg, arg_max(o_orderstatus, o_orderkey) AS nm FROM orders GROUP BY 1)
    SELECT coalesce(t.k, n.k) AS k, CASE WHEN coalesce(t.seg, '') = '' THEN n.seg ELSE t.seg END AS seg, CASE WHEN coalesce(t.nm, '') = '' THEN n.nm ELSE t.nm END AS nm FROM t FULL JOIN n ON t.k = n.k""",
)
def a9_fill(t: Tables):
    return merge.upsert(*_upsert_sides(t), ["k"], "fill", "o")


def _upsert_sides(t: Tables):
    target = t.customer.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"), F.col("c_name").alias("nm"))
    return target, t.orders.select((2 * F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("seg"), F.col("o_orderstatus").alias("nm"), F.col("o_orderkey").alias("o"))


_UPSERT = "WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg, c_name AS nm FROM customer), n AS (SELECT 2 * o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS seg, arg_max(o_orderstatus, o_orderkey) AS nm FROM orders GROUP BY 1) "


@query("a9_upsert_replace", _UPSERT + "SELECT coalesce(t.k, n.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.seg ELSE t.seg END AS seg, CASE WHEN t.k IS NOT NULL THEN t.nm ELSE n.nm END AS nm FROM t FULL JOIN n ON t.k = n.k")
def a9_replace(t: Tables):
    return merge.upsert(*_upsert_sides(t), ["k"], "replace", "o", protect=["nm"])


@query("a9_upsert_ignore", _UPSERT + "SELECT k, seg, nm FROM t UNION ALL SELECT k, seg, nm FROM n WHERE k NOT IN (SELECT k FROM t)")
def a9_ignore(t: Tables):
    return merge.upsert(*_upsert_sides(t), ["k"], "ignore", "o")


@query("a9_upsert_nonblank", _UPSERT + "SELECT coalesce(t.k, n.k) AS k, coalesce(nullif(trim(n.seg), ''), t.seg) AS seg, coalesce(nullif(trim(n.nm), ''), t.nm) AS nm FROM t FULL JOIN n ON t.k = n.k")
def a9_nonblank(t: Tables):
    return merge.upsert(*_upsert_sides(t), ["k"], "overwrite_if_nonblank", "o")


@query(
    "g13_merge_strict",
    "SELECT c_nationkey AS e, c_mktsegment AS f, count(*) AS shards, CASE WHEN count(DISTINCT c_acctbal > 9000) <= 1 THEN 'merged' ELSE 'quarantined' END AS side FROM customer GROUP BY 1, 2",
)
def g13(t: Tables):
    rows = t.customer.select(F.col("c_nationkey").alias("e"), F.col("c_mktsegment").alias("f"), (F.col("c_acctbal") > 9000).alias("v"))
    ok, bad = merge.merge_strict(rows, ["e", "f"], "v")
    return ok.select("e", "f", "shards", F.lit("merged").alias("side")).unionByName(bad.select("e", "f", "shards", F.lit("quarantined").alias("side")))


@query(
    "g14_overlay",
    """WITH b AS (SELECT c_custkey AS e, '$.tier' AS path, CASE WHEN c_custkey % 4 = 0 THEN '[]' ELSE c_mktsegment END AS v FROM customer), i AS (SELECT 2 * o_custkey AS e, '$.tier' AS path, min(CASE WHEN o_custkey % 6 = 0 THEN '' ELSE o_orderpriority END) AS v FROM orders GROUP BY 1),
    j AS (SELECT coalesce(b.e, i.e) AS e, b.v AS old, i.v AS new, b.e IS NOT NULL AS known FROM b FULL JOIN i ON b.e = i.e),
    o AS (SELECT *, CASE WHEN NOT known THEN 'unknown_entity' WHEN coalesce(new, '') IN ('', '[]', '{}', 'null') THEN 'same' WHEN coalesce(old, '') IN ('', '[]', '{}', 'null') THEN 'filled' WHEN old = new THEN 'same' ELSE 'preserved' END AS outcome FROM j)
    SELECT e, '$.tier' AS path, CASE WHEN outcome = 'filled' THEN new ELSE old END AS v, outcome FROM o""",
)
def g14(t: Tables):
    base = t.customer.select(F.col("c_custkey").alias("e"), F.lit("$.tier").alias("path"), F.when(F.col("c_custkey") % 4 == 0, "[]").otherwise(F.col("c_mktsegment")).alias("v"))
    incoming = t.orders.select((2 * F.col("o_custkey")).alias("e"), F.lit("$.tier").alias("path"), F.when(F.col("o_custkey") % 6 == 0, "").otherwise(F.col("o_orderpriority")).alias("v"))
    return merge.overlay(base, incoming, "e", "path", "v")


@query(
    "g15_non_destructive",
    """WITH b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END AS nm, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE c_mktsegment END AS seg, c_mktsegment AS note FROM customer), l AS (SELECT o_custkey AS k, min(o_orderstatus) AS nm, min(o_orderpriority) AS seg, min(o_orderstatus) AS note FROM orders GROUP BY 1)
    SELECT b.k, CASE WHEN b.nm IS NULL AND l.nm IS NOT NULL THEN l.nm ELSE b.nm END AS nm, CASE WHEN b.seg = 'unknown' AND l.seg IS NOT NULL THEN l.seg ELSE b.seg END AS seg, CASE WHEN l.note IS NOT NULL AND NOT contains(b.note, l.note) THEN b.note || '; ' || l.note ELSE b.note END AS note,
    concat_ws(',', CASE WHEN b.nm IS NULL AND l.nm IS NOT NULL THEN 'nm' END, CASE WHEN b.seg = 'unknown' AND l.seg IS NOT NULL THEN 'seg' END, CASE WHEN l.note IS NOT NULL AND NOT contains(b.note, l.note) THEN 'note' END) AS changes FROM b LEFT JOIN l ON b.k = l.k""",
)
def g15(t: Tables):
    k = F.col("c_custkey")
    base = t.customer.select(k.alias("k"), F.when(k % 2 != 0, F.col("c_name")).alias("nm"), F.when(k % 3 == 0, "unknown").otherwise(F.col("c_mktsegment")).alias("seg"), F.col("c_mktsegment").alias("note"))
    leads = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("nm"), F.col("o_orderpriority").alias("seg"), F.col("o_orderstatus").alias("note"))
    return merge.non_destructive(base, leads, "k", ["nm"], ["seg"], "note").withColumn("changes", F.array_join("changes", ","))


@query(
    "g16_apply_decisions",
    """WITH d AS (SELECT 2 * c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'include' WHEN c_custkey % 7 = 0 THEN 'exclude' WHEN c_custkey % 11 = 0 THEN 'maybe' END AS d FROM customer)
    SELECT c_custkey AS k, nullif(d, 'maybe') AS v, 'applied' AS side FROM customer LEFT JOIN d ON c_custkey = k UNION ALL SELECT k, CASE WHEN c_custkey IS NULL THEN 'unknown_entity' ELSE 'invalid_decision' END, 'problem' FROM d LEFT JOIN customer ON c_custkey = k WHERE d IS NOT NULL AND (c_custkey IS NULL OR d = 'maybe')""",
)
def g16(t: Tables):
    k = F.col("c_custkey")
    decisions = t.customer.select((2 * k).alias("k"), F.when(k % 5 == 0, "include").when(k % 7 == 0, "exclude").when(k % 11 == 0, "maybe").alias("d")).filter("d is not null")
    applied, problems = merge.apply_decisions(t.customer.select(k.alias("k"), F.lit(None).cast("string").alias("d")), "k", decisions, "d", ["include", "exclude"])
    return applied.select("k", F.col("d").alias("v"), F.lit("applied").alias("side")).unionByName(problems.select("k", F.col("problem").alias("v"), F.lit("problem").alias("side")))


@query(
    "g17_materialize",
    """WITH r AS (SELECT 2 * o_custkey AS k, 'status' AS f, o_orderstatus AS v FROM orders UNION ALL SELECT 2 * o_custkey, 'priority', o_orderpriority FROM orders), w AS (SELECT k, min(v) FILTER (f = 'status') AS s, min(v) FILTER (f = 'priority') AS p FROM r GROUP BY 1)
    SELECT coalesce(c_custkey, k) AS k, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'S' END, s) AS status, p AS priority FROM customer FULL JOIN w ON c_custkey = k""",
)
def g17(t: Tables):
    base = t.customer.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, "S").alias("status"), F.lit("").alias("priority"))
    research = t.orders.select((2 * F.col("o_custkey")).alias("k"), F.lit("status").alias("f"), F.col("o_orderstatus").alias("v"))
    research = research.unionByName(t.orders.select((2 * F.col("o_custkey")).alias("k"), F.lit("priority").alias("f"), F.col("o_orderpriority").alias("v")))
    return merge.materialize(base, "k", research, "f", "v", ["status", "priority"])[0]


@query(
    "g18_evidence_ledger",
    """SELECT o_custkey AS k, 'orders' AS source, arg_max(o_orderstatus, (o_orderdate, o_orderstatus)) AS status, max(o_orderdate) AS seen_at, count(*) AS reports FROM orders GROUP BY 1
    UNION ALL SELECT user_id, 'events', arg_max(event_type, (ts, event_type)), max(ts), count(*) FROM events GROUP BY 1""",
)
def g18(t: Tables):
    orders, events = t.orders.withColumnRenamed("o_custkey", "k"), t.events.withColumnRenamed("user_id", "k")
    return merge.evidence_ledger([("orders", orders, F.col("o_orderstatus"), F.col("o_orderdate")), ("events", events, F.col("event_type"), F.col("ts"))], "k")


@query(
    "g20_reconcile",
    """WITH h AS (SELECT o_custkey, min(o_orderkey) AS u FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000 GROUP BY 1)
    SELECT c_custkey, u AS proof_url, CASE WHEN u IS NULL THEN 'unchanged' WHEN c_acctbal > 5000 THEN 'kept_confirmed' ELSE 'updated' END AS outcome FROM customer LEFT JOIN h ON c_custkey = o_custkey""",
)
def g20(t: Tables):
    hits = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    entities, _ = merge.reconcile(hits, "c_custkey", "o_orderkey", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000), t.customer, F.col("c_acctbal") > 5000, t.lineitem, "l_orderkey")
    return entities.select("c_custkey", "proof_url", "outcome")


@query("g21_cumulate", "SELECT o_custkey AS k, o_orderkey AS id, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'current' ELSE 'previous' END AS run FROM orders")
def g21(t: Tables):
    run = lambda df, name: df.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.lit(name).alias("run"))
    return merge.cumulate(run(t.orders, "previous"), run(t.orders.filter("o_orderdate >= timestamp '1998-01-01'"), "current"), ["k", "id"])


@query(
    "a9_changes",
    "SELECT c_custkey AS k, 'seg' AS field, c_mktsegment AS old, 'BUILDING' AS new FROM customer WHERE c_custkey % 3 = 0 AND c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR), NULL FROM customer WHERE c_custkey % 5 = 0",
)
def ledger(t: Tables):
    before = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nation"))
    after = before.select("k", F.when(F.col("k") % 3 == 0, "BUILDING").otherwise(F.col("seg")).alias("seg"), F.when(F.col("k") % 5 != 0, F.col("nation")).alias("nation"))
    return merge.changes(before, after, "k", ["seg", "nation"])


@query(
    "g1_resolve_field",
    """SELECT d.doc_id, CASE WHEN quality = 1 OR toxic = 1 OR (lang = 'fr' AND d.doc_id % 2 = 0) THEN true ELSE false END AS ok, CASE WHEN quality = 1 OR toxic = 1 THEN 'value' WHEN lang = 'fr' AND d.doc_id % 2 = 0 THEN 'none' ELSE 'missing' END AS state
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def g1(t: Tables):
    rows = t.documents.join(t.labels, "doc_id", "left")
    v = quality.resolve_field(F.when((F.col("quality") == 1) | (F.col("toxic") == 1), F.lit("x")), F.when(F.col("lang") == "fr", "none"), F.col("doc_id") % 2 == 0)
    return rows.select("doc_id", v.alias("v")).select("doc_id", "v.ok", "v.state")


_ORDER_ROLLUP = "WITH r AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS pub, count(*) FILTER (o_totalprice > 200000) AS big FROM orders GROUP BY 1), b AS (SELECT c_custkey, c_mktsegment AS seg, c_acctbal AS bal, n, pub, big FROM customer LEFT JOIN r ON c_custkey = k) "


def order_rollup(t: Tables):
    r = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("pub"), F.count_if(F.col("o_totalprice") > 200000).alias("big"))
    return t.customer.select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal")).join(r, "c_custkey", "left")


@query(
    "g2_inventory_state",
    _ORDER_ROLLUP + """SELECT c_custkey, CASE WHEN seg = 'BUILDING' AND bal > 0 AND coalesce(pub, 0) + coalesce(big, 0) = 0 THEN 'complete' WHEN seg = 'MACHINERY' AND bal > 0 AND coalesce(pub, 0) > 0 THEN 'complete'
    WHEN bal > 8000 AND coalesce(pub, 0) + coalesce(big, 0) > 0 THEN 'complete' WHEN coalesce(pub, 0) + coalesce(big, 0) > 0 THEN 'partial' ELSE 'unknown' END AS state FROM b""",
)
def g2(t: Tables):
    state = F.when(F.col("seg") == "BUILDING", "none").when(F.col("seg") == "MACHINERY", "complete")
    return order_rollup(t).select("c_custkey", quality.inventory_state(state, F.col("bal") > 0, F.col("pub"), F.col("big"), F.col("bal") > 8000).alias("state"))


@query("g3_storage_types", "SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'ipfs' WHEN page_id % 5 = 0 THEN 'http,ipfs' ELSE 'http' END AS types FROM pages")
def g3(t: Tables):
    urls = F.when(F.col("page_id") % 5 == 0, F.array("url", F.concat(F.lit("ipfs://c"), F.col("page_id").cast("string")))).otherwise(F.array("url"))
    return t.pages.select("page_id", joined(quality.storage_types(urls, F.when(F.col("page_id") % 7 == 0, "ipfs"))).alias("types"))


@query("g4_rights_known", "SELECT c_custkey, c_mktsegment <> 'BUILDING' OR c_nationkey > 20 AS known FROM customer")
def g4(t: Tables):
    terms = F.when(F.col("c_mktsegment") == "BUILDING", "Unknown").otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", quality.rights_known([terms], [F.when(F.col("c_nationkey") > 20, F.col("c_nationkey"))]).alias("known"))


@query(
    "g5_access_mode",
    _ORDER_ROLLUP + "SELECT c_custkey, CASE WHEN seg = 'BUILDING' AND bal > 0 THEN 'holder_gated' WHEN n > 0 AND pub = n AND bal > -500 THEN 'public' WHEN coalesce(n, 1) = 1 AND big > 0 THEN 'public' ELSE 'unknown' END AS mode FROM b",
)
def g5(t: Tables):
    mode = quality.access_mode(F.when(F.col("seg") == "BUILDING", "holder_gated"), F.col("bal") > 0, F.col("n"), F.col("pub"), F.col("bal") > -500, F.coalesce("n", F.lit(1)), F.when(F.col("big") > 0, "u"))
    return order_rollup(t).select("c_custkey", mode.alias("mode"))


_AUDIT = _ORDER_ROLLUP + ", a AS (SELECT *, concat_ws(',', CASE WHEN NOT coalesce(n > 5, false) THEN 'inventory' END, CASE WHEN NOT coalesce(pub > 2, false) THEN 'access' END, CASE WHEN NOT bal > 0 THEN 'rights' END) AS missing FROM b) "


def audited(t: Tables):
    rows = order_rollup(t)
    return quality.audit(rows, "c_custkey", {"inventory": F.col("n") > 5, "access": F.col("pub") > 2, "rights": F.col("bal") > 0})


@query("g6_audit", _AUDIT + "SELECT c_custkey, missing, missing = '' AS complete FROM a")
def g6(t: Tables):
    return audited(t).select("c_custkey", F.array_join("missing", ",").alias("missing"), "complete")


@query(
    "g7_gate",
    _ORDER_ROLLUP + """, g AS (SELECT c_custkey, concat_ws(',', CASE WHEN n IS NULL THEN 'no_rows' END, CASE WHEN seg = 'BUILDING' AND bal < 0 THEN 'gated_without_proof' END, CASE WHEN n > 0 AND pub = 0 THEN 'probe_failed' END) AS reasons FROM b)
    SELECT c_custkey, reasons, reasons = '' AS passed FROM g""",
)
def g7(t: Tables):
    return gated(t).select("c_custkey", F.array_join("reasons", ",").alias("reasons"), "passed")


def gated(t: Tables):
    rules = [(F.col("n").isNull(), "no_rows"), ((F.col("seg") == "BUILDING") & (F.col("bal") < 0), "gated_without_proof"), ((F.col("n") > 0) & (F.col("pub") == 0), "probe_failed")]
    return quality.gate(order_rollup(t), rules)


@query(
    "g7_gate_summary",
    _ORDER_ROLLUP + """, g AS (SELECT n IS NULL OR (seg = 'BUILDING' AND bal < 0) OR (n > 0 AND pub = 0) AS bad FROM b)
    SELECT count(*) AS audited, count(*) FILTER (bad) AS failing, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS omitted, count(*) + (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS denominator, count(*) - count(*) FILTER (bad) AS passing FROM g""",
)
def g7b(t: Tables):
    return quality.gate_summary(gated(t), t.supplier.filter("s_suppkey % 2 = 0"))


_READY = _ORDER_ROLLUP + """, f AS (SELECT c_custkey, seg <> 'BUILDING' AS license_ok, coalesce(n > 0, false) AS identity_ok, coalesce(pub > 0, false) AS asset_ok, bal > 0 AS c1, coalesce(big > 3, false) AS c2, coalesce(n > 8, false) AS c3, bal > 3000 AS c4, coalesce(pub > 3, false) AS c5 FROM b),
    s AS (SELECT *, license_ok::INT + identity_ok::INT + asset_ok::INT + c1::INT + c2::INT + c3::INT + c4::INT + c5::INT AS score, license_ok AND identity_ok AND asset_ok AS ready FROM f) """


def ready(t: Tables):
    critical = {"license_ok": F.col("seg") != "BUILDING", "identity_ok": F.col("n") > 0, "asset_ok": F.col("pub") > 0}
    more = {"c1": F.col("bal") > 0, "c2": F.col("big") > 3, "c3": F.col("n") > 8, "c4": F.col("bal") > 3000, "c5": F.col("pub") > 3}
    return quality.readiness(order_rollup(t), critical, more)


@query("g8_readiness", _READY + "SELECT c_custkey, score, ready, NOT ready AND score >= 6 AS near_ready FROM s")
def g8(t: Tables):
    return ready(t).select("c_custkey", "score", "ready", "near_ready")


@query("g8_blockers", _READY + " UNION ALL ".join(f"SELECT '{c}' AS criterion, count(*) FILTER (NOT {c}) AS blocked FROM s" for c in ("license_ok", "identity_ok", "asset_ok")))
def g8b(t: Tables):
    return quality.blockers(ready(t), ["license_ok", "identity_ok", "asset_ok"])


@query(
    "g22_normalize_license",
    """WITH f AS (SELECT c_custkey AS e, 'terms' AS layer, 'use_scope' AS d, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'everyone' ELSE 'holder' END AS v FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'url', 'use_scope', 'everyone' FROM customer WHERE c_nationkey < 5
      UNION ALL SELECT c_custkey, 'manual', 'commercial_scope', CASE WHEN c_acctbal > 5000 THEN 'corporation' ELSE 'none' END FROM customer WHERE c_custkey % 2 = 0),
    p AS (SELECT e, d, arg_min(v, CASE layer WHEN 'url' THEN 0 WHEN 'terms' THEN 1 ELSE 3 END) AS v, count(DISTINCT v) AS n FROM f GROUP BY 1, 2), h AS (SELECT e, bool_or(layer IN ('url', 'terms')) AS c FROM f GROUP BY 1)
    SELECT p.e, max(v) FILTER (d = 'use_scope') AS use_scope, max(v) FILTER (d = 'commercial_scope') AS commercial_scope, coalesce(max('LICENSE_CONFLICT:' || d) FILTER (n > 1), '') AS codes, CASE WHEN bool_or(c) THEN 'collection' ELSE 'manual' END AS confidence FROM p JOIN h ON p.e = h.e GROUP BY 1""",
)
def g22(t: Tables):
    return normalized(t).select("e", "use_scope", "commercial_scope", F.array_join("reason_codes", ",").alias("codes"), "confidence")


def normalized(t: Tables):
    mapping = t.spark.createDataFrame(
        [("terms", "building", "use_scope", "everyone"), ("terms", "machinery", "use_scope", "everyone"), ("terms", "e", "use_scope", "holder"), ("terms", "i", "use_scope", "holder"), ("url", "customer", "use_scope", "everyone")],
        "layer string, pattern string, dimension string, value string",
    )
    e = t.customer.withColumnRenamed("c_custkey", "e")
    manual = e.filter("e % 2 = 0").select("e", F.lit("manual").alias("layer"), F.lit("commercial_scope").alias("dimension"), F.when(F.col("c_acctbal") > 5000, "corporation").otherwise("none").alias("value"))
    found = license.statements(e.filter("e % 3 > 0"), "e", "terms", "c_mktsegment", mapping).unionByName(license.statements(e.filter("c_nationkey < 5"), "e", "url", "c_name", mapping)).unionByName(manual)
    return license.normalize_license(found, "e")


@query(
    "g23_first_rule",
    """SELECT c_custkey, CASE WHEN c_nationkey < 12 AND c_mktsegment <> 'BUILDING' AND c_custkey % 7 > 0 AND c_custkey % 5 > 1 THEN 'green'
    WHEN c_nationkey BETWEEN 12 AND 17 OR c_custkey % 5 = 1 OR c_mktsegment = 'BUILDING' OR c_custkey % 9 = 0 THEN 'yellow' WHEN c_custkey % 5 = 0 THEN 'red' ELSE 'gray' END AS color FROM customer""",
)
def g23(t: Tables):
    key = F.col("c_custkey")
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 12, "everyone").when(F.col("c_nationkey") <= 17, "holder").alias("use_scope"),
        F.when(F.col("c_mktsegment") == "BUILDING", "0").otherwise("1").alias("redistribute_original"),
        F.when(key % 7 > 0, "1").alias("modify"),
        F.when(key % 5 == 0, "none").when(key % 5 == 1, "personal_non_profit").when(key % 5 == 2, "personal_profit").otherwise("corporation").alias("commercial_scope"),
        F.when(key % 9 == 0, "1").when(key % 9 == 1, "0").alias("corporate_use"),
    )
    return rows.select("c_custkey", license.color().alias("color"))


@query(
    "g26_license_labels",
    """WITH x AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'CC-BY 4.0' WHEN 'MACHINERY' THEN 'cc by-nc' WHEN 'FURNITURE' THEN 'CC0' WHEN 'HOUSEHOLD' THEN '' ELSE 'All rights reserved' END AS l FROM customer)
    SELECT c_custkey, CASE l WHEN 'CC-BY 4.0' THEN 'green' WHEN 'cc by-nc' THEN 'yellow' WHEN 'CC0' THEN 'green' WHEN '' THEN 'unknown' ELSE 'red' END AS category, CASE l WHEN 'CC-BY 4.0' THEN 'CC BY' WHEN 'cc by-nc' THEN 'CC BY-NC' WHEN 'CC0' THEN 'CC0' WHEN '' THEN 'Unknown' ELSE l END AS label,
    CASE l WHEN '' THEN NULL WHEN 'cc by-nc' THEN true WHEN 'All rights reserved' THEN true ELSE false END AS gated, CASE l WHEN '' THEN NULL ELSE l IN ('CC-BY 4.0', 'CC0') END AS commercial FROM x""",
)
def g26(t: Tables):
    s = F.col("c_mktsegment")
    c = F.when(s == "BUILDING", "CC-BY 4.0").when(s == "MACHINERY", "cc by-nc").when(s == "FURNITURE", "CC0").when(s == "HOUSEHOLD", "").otherwise("All rights reserved")
    rows = t.customer.select("c_custkey", license.license_category(c).alias("category"), license.license_label(c).alias("label"))
    return rows.select("c_custkey", "category", "label", license.license_gated(F.col("category")).alias("gated"), license.permissions(F.col("category"))["commercial"].alias("commercial"))


@query(
    "g25_verify_artifacts",
    """WITH a AS (SELECT 2 * c_custkey AS k, c_custkey AS i, CASE WHEN c_custkey % 4 = 0 THEN 'BUILDING' ELSE c_mktsegment END AS seg FROM customer), j AS (SELECT a.*, c.c_custkey AS c, c.c_mktsegment AS own FROM a LEFT JOIN customer c ON k = c.c_custkey)
    SELECT k, 'unknown_key' AS violation FROM j WHERE c IS NULL UNION ALL SELECT k, 'snapshot_mismatch' FROM j WHERE c IS NOT NULL AND i % 9 = 0 UNION ALL SELECT k, 'differs:seg' FROM j WHERE seg <> own""",
)
def g25(t: Tables):
    k = F.col("c_custkey")
    canonical = t.customer.select(k.alias("k"), F.lit("s1").alias("snap"), F.col("c_mktsegment").alias("seg"))
    artifacts = t.customer.select((2 * k).alias("k"), F.when(k % 9 == 0, "s0").otherwise("s1").alias("snap"), F.when(k % 4 == 0, "BUILDING").otherwise(F.col("c_mktsegment")).alias("seg"))
    return quality.verify_artifacts(artifacts, canonical, "k", "snap", ["seg"])


@query(
    "g25_secret_scan",
    "SELECT doc_id, " + " + ".join(f"regexp_matches(text, '{p}')::INT" for p in ("AKIA[0-9A-Z]{16}", "gh[pousr]_[A-Za-z0-9]{36}", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "(?i)(api[_-]?key|secret|token|password)\\s*[:=]\\s*[A-Za-z0-9+/_.=-]{12,}")) + " AS patterns FROM documents WHERE patterns > 0",
)
def g25b(t: Tables):
    return quality.secret_scan(t.documents, "doc_id", "text")


@query(
    "g27_stage",
    _ORDER_ROLLUP + """, x AS (SELECT *, concat_ws(',', CASE WHEN seg = 'FURNITURE' THEN 'unsupported_chain' END, CASE WHEN n IS NULL THEN 'no_binary_proof' END) AS blockers FROM b)
    SELECT c_custkey, CASE WHEN blockers <> '' THEN 'deferred' WHEN n > 0 AND pub = n THEN 'bulk_ready' WHEN pub > 0 THEN 'partial_ready' ELSE 'preview_ready' END AS stage, CASE WHEN n IS NULL THEN 1.0 ELSE round(coalesce(pub, 0) / n, 6) END AS coverage FROM x""",
)
def g27(t: Tables):
    return staged(t).select("c_custkey", "stage", "coverage")


def staged(t: Tables):
    return quality.stage(order_rollup(t), [(F.col("seg") == "FURNITURE", "unsupported_chain"), (F.col("n").isNull(), "no_binary_proof")], F.col("n"), F.col("pub"), F.col("n"))


@query(
    "g28_bundle_summary",
    _ORDER_ROLLUP + "SELECT CASE WHEN seg = 'FURNITURE' OR n IS NULL THEN 'deferred' WHEN n > 0 AND pub = n THEN 'bulk_ready' WHEN pub > 0 THEN 'partial_ready' ELSE 'preview_ready' END AS stage, count(*) AS n FROM b GROUP BY 1",
)
def g28(t: Tables):
    return quality.bundle_summary(staged(t), "stage")


@query(
    "g28_validate_bundle",
    "SELECT o_custkey AS k, 'duplicate_key' AS violation FROM orders GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT o_custkey, 'missing_proof' FROM orders WHERE o_orderstatus <> 'F'",
)
def g28b(t: Tables):
    rows = t.orders.withColumnRenamed("o_custkey", "k")
    return quality.validate_bundle(rows, "k", {"missing_proof": F.col("o_orderstatus") == "F"})


@query(
    "g29_supply_status",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 900 END AS t, CASE WHEN o_orderkey % 3 > 0 THEN 600 END AS m, date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-06-01') AS age FROM orders)
    SELECT o_orderkey, CASE WHEN t >= m THEN 'capped' WHEN t > 0 AND m IS NOT NULL THEN 'ongoing' WHEN t > 0 AND age > 365 THEN 'likely_capped' WHEN t > 0 THEN 'no_max_supply' ELSE 'unknown' END AS status, CASE WHEN t > 0 AND t < m THEN round(t * 100.0 / m, 1)::DOUBLE END AS progress FROM x""",
)
def g29(t: Tables):
    k = F.col("o_orderkey")
    status, progress = quality.supply_status(F.col("t"), F.col("m"), F.col("age"))
    rows = t.orders.select("o_orderkey", F.when(k % 7 > 0, k % 900).alias("t"), F.when(k % 3 > 0, 600).alias("m"), F.datediff(F.lit("1999-06-01").cast("date"), F.col("o_orderdate").cast("date")).alias("age"))
    return rows.select("o_orderkey", status.alias("status"), progress.cast("double").alias("progress"))


@query("g30_sanitize", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'entity' ELSE 'item' END AS scope, o_orderstatus AS source, CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey AS VARCHAR) END AS token_id FROM orders")
def g30(t: Tables):
    ev = F.array(F.struct(F.col("o_orderstatus").alias("source"), F.col("o_custkey").cast("string").alias("token_id")))
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "entity").otherwise("item").alias("scope"), ev.alias("evidence"))
    return quality.sanitize(rows, "scope", "evidence", ["token_id"]).select("o_orderkey", "scope", F.col("evidence")[0]["source"].alias("source"), F.col("evidence")[0]["token_id"].alias("token_id"))


@query(
    "g31_classify_link",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 4 AS v, l_orderkey % 6 AS st, l_suppkey % 3 AS failed, l_quantity > 25 AS good, l_suppkey % 2 = 0 AS fb, l_orderkey % 11 AS e FROM lineitem),
    c AS (SELECT *, CASE WHEN v = 0 AND (failed > 0 OR fb) THEN 'healthy_with_transport_degradation' WHEN v = 0 THEN 'healthy' WHEN v = 1 AND st = 0 THEN 'non_vrm_glb' WHEN v = 1 AND st = 1 THEN 'not_glb' WHEN v = 1 AND st = 2 THEN 'invalid_glb' WHEN v = 1 THEN 'validation_rejected'
        WHEN e IN (0, 1) THEN 'missing' WHEN e IN (2, 3) THEN 'access_blocked' WHEN e IN (4, 5) THEN 'blocked_or_invalid_uri' WHEN e IN (6, 7, 8, 9) AND good THEN 'unstable_transport' WHEN e IN (6, 7) THEN 'transient_transport_failure' ELSE 'unclassified_error' END AS health FROM x)
    SELECT l_orderkey, l_linenumber, l_partkey, health, CASE health WHEN 'healthy' THEN 'info' WHEN 'healthy_with_transport_degradation' THEN 'warning' WHEN 'unstable_transport' THEN 'warning' WHEN 'transient_transport_failure' THEN 'warning' ELSE 'error' END AS severity FROM c""",
)
def g31(t: Tables):
    lists = ["http_404", "http_404 http_410", "http_401", "http_403 http_401", "blocked_uri", "http_404 unsupported_scheme", "timeout", "http_404 server_error", "http_404 http_401", "internal_error", ""]
    errors = F.split(F.element_at(F.array(*(F.lit(x) for x in lists)), (F.col("l_orderkey") % 11 + 1).cast("int")), " ")
    v = F.col("l_partkey") % 4
    statuses = F.element_at(F.array(*(F.lit(x) for x in ("valid_glb_not_vrm", "not_glb", "invalid_glb", "too_large", "", "other"))), (F.col("l_orderkey") % 6 + 1).cast("int"))
    health, severity = quality.classify_link(F.when(v == 0, True).when(v == 1, False), F.when(v == 1, statuses), F.col("l_suppkey") % 3, (F.col("l_quantity") > 25).cast("int"), F.col("l_suppkey") % 2 == 0, errors)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", health.alias("health"), severity.alias("severity"))


@query(
    "g32_fetch_status",
    """SELECT event_id, CASE WHEN event_type = 'error' AND value > 40 THEN 'timeout' WHEN event_type = 'error' AND value > 20 THEN 'dns' WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN CASE WHEN value > 30 THEN 'http_5xx' ELSE 'http_4xx' END
    WHEN event_type = 'signup' THEN 'soft_404' WHEN event_type = 'click' THEN 'ok' ELSE 'not_model' END AS status FROM events""",
)
def g32(t: Tables):
    k, v = F.col("event_type"), F.col("value")
    error = F.when(k == "error", F.when(v > 40, "Read timed out").when(v > 20, "could not resolve host").otherwise("reset"))
    code = F.when(k == "view", F.when(v > 30, 503).otherwise(404)).otherwise(200)
    return t.events.select("event_id", quality.fetch_status(code, k == "click", error, F.when(k == "signup", "Sorry, Page Not Found")).alias("status"))


@query(
    "g33_transfer_evidence",
    """SELECT l_suppkey, count(*) AS sampled, count(DISTINCT l_partkey) AS items, count(DISTINCT l_orderkey) AS uris, count(*) FILTER (l_discount > 0.05) AS signals, count(CASE WHEN l_returnflag = 'R' THEN l_linestatus END) AS errors, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_linestatus END) AS error_kinds FROM lineitem GROUP BY 1""",
)
def g33(t: Tables):
    rows = t.lineitem.withColumn("err", F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")))
    return quality.transfer_evidence(rows, "l_suppkey", "l_partkey", "l_orderkey", F.col("l_discount") > 0.05, "err")


@query(
    "g34_tree_inventory",
    """SELECT 'root/' || p_brand || '/' || p_partkey || '.fbx' AS path, CASE WHEN p_partkey % 5 = 0 THEN 'no_sidecar' WHEN p_size <= 10 THEN 'no_evidence' ELSE 'ok' END AS state FROM part WHERE p_type <> 'PROMO'""",
)
def g34(t: Tables):
    base = F.concat(F.when(F.col("p_type") == "PROMO", "other/").otherwise("root/"), F.col("p_brand"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".fbx"))
    files = t.part.select(base.alias("path"), "p_size")
    tree = files.unionByName(t.part.filter("p_partkey % 5 > 0").select(F.concat(base, F.lit(".meta")).alias("path"), "p_size"))
    return quality.tree_inventory(tree, "path", "root/", ".fbx", F.col("p_size") > 10)


@query(
    "g35_promote_validated",
    """SELECT 'checked' AS counter, count(*) AS n FROM orders UNION ALL SELECT 'imported', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 > 0 UNION ALL SELECT 'skipped', count(*) FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 3 > 0)""",
)
def g35(t: Tables):
    catalog = t.orders.filter("o_orderkey % 3 = 0").select(F.concat(F.lit("osa-"), F.col("o_orderkey").cast("string")).alias("id"))
    _, counts = quality.promote_validated(t.orders, "o_orderkey", F.col("o_orderstatus") == "F", F.concat(F.lit("osa-"), F.col("o_orderkey").cast("string")), catalog, "id")
    return counts.withColumn("_", F.lit(0)).unpivot("_", ["checked", "imported", "skipped"], "counter", "n").drop("_")


