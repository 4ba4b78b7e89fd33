"""Thin queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitslice import top_k
from .codes import codebooks_digest, label_errors, vector_codes
from .common import cut, table
from .html_text import extract_text
from .infill import fill_in_middle, restore_text
from .minhash import near_duplicates
from .mixing import mix
from .neighbours import near_vectors
from .packing import pack
from .secrets import find_secrets, span_digests
from .substring import remove_repeats
from .suffix import remove_long_repeats
from .toxicity import toxicity_scores
from .warc import normalise_archives, read_archives, write_archives


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 75).select("doc_id", "n_shingles", "component_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_secrets(table(spark, sf_dir, "documents")))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    careless = cut(write_archives(table(spark, sf_dir, "pages")), "archives")
    return read_archives(cut(normalise_archives(careless), "normal")).drop("payload", "url")


def op11_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_long_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("repeats").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_hash = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    both = restore_text(fill_in_middle(table(spark, sf_dir, "documents")))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", text_hash("output").alias("output_sha256"), text_hash("restored").alias("restored_sha256"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = vector_codes(table(spark, sf_dir, "embeddings"))
    return label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_minhash, op2_toxicity, op3_packing, op4_substring, op5_secrets, op6_html_text, op7_mixing, op8_neighbours, op9_bitslice, op10_warc, op11_suffix, op12_infill, op13_codes)}

#: Smallest node that each reaches by the links (a, b), a < b, of table ``links``; nodes without links have no row.
_REACHED = """
            e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
            r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
            low AS (SELECT a, min(b) AS low FROM r GROUP BY a)
"""


def _codes_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """The quantiser with all distances, one pair of table expressions a round."""
    kept = """
        v AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        )"""
    steps = [
        kept,
        f"x AS MATERIALIZED (SELECT vec_id, p, q[p * len(q) // {parts} + 1 : (p + 1) * len(q) // {parts}] AS x FROM v, range({parts}) t(p))",
        f"c0 AS MATERIALIZED (SELECT p, e, x AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v) USING (vec_id) WHERE e < {entries})",
    ]
    near = f"SELECT vec_id, p, x, min(CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + e) AS m FROM x JOIN c{{}} USING (p) GROUP BY ALL"
    for k in range(rounds):
        mean = f"SELECT p, m % {entries} AS e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY ALL"
        steps += [
            f"a{k} AS MATERIALIZED ({near.format(k)})",
            f"s{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM ({mean}) GROUP BY ALL)",
            f"c{k + 1} AS MATERIALIZED (SELECT o.p AS p, o.e AS e, coalesce(s.c, o.c) AS c FROM c{k} o LEFT JOIN s{k} s ON o.p = s.p AND o.e = s.e)",
        ]
    steps += [
        f"a{rounds} AS ({near.format(rounds)})",
        f"f AS MATERIALIZED (SELECT vec_id, label, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} JOIN v USING (vec_id) GROUP BY ALL)",
        f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})",
    ]
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f, h"


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: DuckDB SQL of the queries that it can express and run on whole tables.
ORACLES = {
    "op1_minhash": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
            s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM d)),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            m AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
            links AS (SELECT a, b FROM m JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
            {_REACHED}
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, low IS NULL OR low >= d.doc_id AS kept
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN low ON d.doc_id = low.a
    """,
    "op4_substring": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
            t AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(w[i : i + 49], ' ')) END AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
            f AS (SELECT h, min(doc_id) AS first FROM t WHERE h IS NOT NULL GROUP BY h),
            k AS (SELECT doc_id, i, word, coalesce(max(CASE WHEN first < doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM t LEFT JOIN f USING (h)),
            o AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM k GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN o USING (doc_id)
    """,
    "op8_neighbours": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
        ), links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.93
        ), {_REACHED}, n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, low IS NULL OR low >= vec_id AS kept
        FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN low ON vec_id = low.a
    """,
    "op9_bitslice": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(list_transform(q.x, lambda a: CAST(a AS DOUBLE)), list_transform(c.x, lambda a: CAST(a AS DOUBLE))) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_suffix": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
            c AS (SELECT doc_id, n, s, substring(x, 2 * s + 1, 2 * 1399) AS x FROM (SELECT *, unnest(range(0, n, 1000)) AS s FROM d)),
            t AS (SELECT doc_id, s + i AS pos, substring(x, 2 * i + 1, 2) AS byte, CASE WHEN s + i + 400 <= n THEN md5(substring(x, 2 * i + 1, 800)) END AS h FROM (SELECT *, unnest(range(0, least(1000, n - s))) AS i FROM c)),
            f AS (SELECT h FROM t WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
            k AS (SELECT doc_id, pos, byte, max(CASE WHEN f.h IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS gone FROM t LEFT JOIN f ON t.h = f.h),
            e AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS before FROM k),
            o AS (SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans, string_agg(byte, '' ORDER BY pos) FILTER (gone = 0) AS kept FROM e GROUP BY doc_id)
        SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN o ON d.doc_id = o.doc_id
    """,
    "op12_infill": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents
        ), d AS (
            SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                    WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t
        ), c AS (
            SELECT doc_id, n, form, text, array_to_string(u[1 : least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1 : n], '') AS s FROM d
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
        FROM c
    """,
    "op13_codes": _codes_sql(),
    "op10_warc": """
        WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest AS payload_digest,
            CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
    """,
}
