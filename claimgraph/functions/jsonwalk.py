"""JSON walked to its leaves, and links classified on them (H4, H5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cols import first_match

#: Fixed confidence of each kind of link evidence: (reason, kind, confidence).
EVIDENCE = {
    "vrm_field": ("asset", 0.95),
    "vrm_extension": ("asset", 0.98),
    "vrm_mime": ("asset", 0.98),
    "gltf_mime": ("asset", 0.65),
    "metadata_field": ("metadata", 0.90),
    "json_mime": ("metadata", 0.90),
    "json_extension": ("metadata", 0.85),
}
#: Fixed patterns of model links: by address, and by what the path to them is called.
URL = r"(?i)(?:https?|ipfs|ar)://[^\s\"'<>]+"
VRM_FILE, GLB_FILE, MML_FILE = (rf"(?i)\.(?:{x})(?:$|[?#])" for x in ("vrm", "glb|gltf", "mml"))
_WORD = r"(?i)(?:^|[.\[_-])(?:{})(?:$|[.\]_-])"
VRM_PATH = _WORD.format("vrm|vrmurl|vrmurls|vrm_url|vrm_urls")
GLB_PATH = _WORD.format("glb|glbs|glburl|glburls|glb_url|glb_urls|model|modelurl|modelurls|model_url|model_urls")
MML_PATH = _WORD.format("mml|mmlurl|mmlurls|mml_url|mml_urls")
ANIMATION_PATH = _WORD.format("animation|animations|animationurl|animation_url|idle|talk|talking|emote|motion")
ANIMATION_FILE = r"(?i)(?:^|[-_.])animations?(?:[-_.]|$)"
MML_SOURCE = r"""(?is)<m-(?:character|model)\b[^>]*?\bsrc\s*=\s*("[^"]+"|'[^']+'|[^\s>]+)"""
MEDIA_FILE = r"(?i)\.(?:png|jpe?g|gif|webp|svg|avif|mp4|webm|mov|mp3|wav|ogg)(?:$|[?#])"
DATA_JSON = r"(?i)^data:(?:application/(?:ld\+)?json|text/json)[^,]*,"
LONGEST_EMBEDDED = 1_000_000
LINKS_PER_DOCUMENT = 500


def data_json(c: Column) -> Column:
    """The document in a data URI of JSON, base64 or percent-encoded; null for other texts and for broken encodings."""
    body = F.regexp_replace(c, DATA_JSON, "")
    based = F.regexp_extract(c, r"(?i)^data:[^,]*;base64,", 0) != ""
    raw = F.try_to_binary(F.when(based, F.try_url_decode(F.replace(body, F.lit("+"), F.lit("%2B")))), F.lit("base64"))
    text = F.when(based, raw.cast("string")).otherwise(F.try_url_decode(F.replace(body, F.lit("+"), F.lit("%2B"))))
    return F.when(c.rlike(DATA_JSON), F.nullif(text, F.lit("")))


def json_leaves(df: DataFrame, key: str, c: str, max_depth: int = 6) -> DataFrame:
    """(key, path, name, value, mime, truncated) of every scalar leaf; JSON inside strings is parsed again.

    Documents and texts may be data URIs of JSON. One pass: each level explodes the containers that are left and hands the leaves on; the loop is over depth, not rows.
    ``mime`` is a sibling's type. Containers below ``max_depth`` come as rows without a value and texts with JSON of over
    ``LONGEST_EMBEDDED`` characters unparsed, both with ``truncated`` set.
    """
    names = [key, "path", "name", "v", "mime", "truncated"]
    no_text = F.lit(None).cast("string")
    document = F.coalesce(F.when(F.col(c).startswith("data:"), data_json(F.col(c))), F.col(c))
    rows = df.select(key, F.lit("$").alias("path"), no_text.alias("name"), F.try_parse_json(document).alias("v"), no_text.alias("mime"), F.lit(False).alias("truncated"))
    # no filter on what is parsed: Spark would push it down to the source, and parse each document there as well. A text that
    # is none has no type, and is left out with the first level
    if max_depth == 0:
        rows = rows.filter("v is not null")
    # a container's type and text cost a walk through all of it: the type is taken once a level, the text of strings only
    said = F.when(F.col("kind") == "STRING", F.expr("try_variant_get(v, '$', 'string')"))
    for depth in range(max_depth + 1):
        rows = rows.withColumn("kind", F.schema_of_variant("v")).withColumn("said", said)
        rows = rows.withColumn("text", F.coalesce(F.when(F.col("said").startswith("data:"), data_json(F.col("said"))), "said"))
        rows = rows.withColumn("embedded", F.coalesce(F.col("text").rlike(r"^\s*[\[{]"), F.lit(False))).withColumn("long", F.length("text") > LONGEST_EMBEDDED)
        rows = rows.withColumn("inner", F.when(F.col("embedded") & ~F.col("long"), F.try_parse_json("text")))
        rows = rows.withColumn("truncated", F.col("truncated") | (F.col("embedded") & F.col("long"))).withColumn("v", F.coalesce("inner", "v"))
        rows = rows.withColumn("nested", F.coalesce(F.when(F.col("inner").isNotNull(), F.schema_of_variant("inner")), "kind").rlike("^(OBJECT|ARRAY)"))
        if depth == max_depth:
            break
        rows = rows.select(*names, "nested")
        own = rows.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.when(F.col("nested").outer(), F.col("v").outer())).toDF("_pos", "_key", "_value")).filter("not nested or _pos is not null")
        below = lambda there, here: F.when(F.col("nested"), there).otherwise(here)
        mime = F.coalesce(*(F.expr(f"try_variant_get(v, '$.{k}', 'string')") for k in ("mimeType", "mime_type", "type")), "mime")
        path = F.when(F.col("_key").isNull(), F.concat("path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(F.concat("path", F.lit("."), "_key"))
        rows = own.select(key, below(path, F.col("path")).alias("path"), below(F.coalesce("_key", "name"), F.col("name")).alias("name"), below(F.col("_value"), F.col("v")).alias("v"), below(mime, F.col("mime")).alias("mime"), "truncated").select(names)
    said = F.expr("try_variant_get(v, '$', 'string')")
    return rows.select(key, "path", "name", F.when(~F.col("nested"), said).alias("value"), "mime", (F.col("truncated") | F.col("nested")).alias("truncated"))


def classify_links(leaves: DataFrame, key: str) -> DataFrame:
    """(key, url, kind, reason, confidence, path, beyond_limit): links on the leaves, the first evidence of each kind and URL by path.

    ``beyond_limit`` marks the links of a document that come after its first ``LINKS_PER_DOCUMENT``; none is dropped.
    """
    low, name, mime = F.lower("value"), F.lower("name"), F.lower(F.coalesce("mime", F.lit("")))
    is_link = F.col("value").rlike(r"^(?i)(https?|ipfs|ar)://\S+$")
    reason = first_match(
        [
            (name.contains("vrm"), "vrm_field"),
            (low.rlike(r"\.vrm(\?|#|$)"), "vrm_extension"),
            (mime.contains("vrm"), "vrm_mime"),
            (mime.contains("gltf"), "gltf_mime"),
            (name.isin("metadata", "metadata_url", "token_uri", "tokenuri"), "metadata_field"),
            (mime.contains("json"), "json_mime"),
            (low.rlike(r"\.json(\?|#|$)"), "json_extension"),
        ]
    )
    rows = leaves.filter(is_link).withColumn("reason", reason).filter("reason is not null")
    kind = first_match([(F.col("reason") == r, k) for r, (k, _) in EVIDENCE.items()])
    confidence = first_match([(F.col("reason") == r, c) for r, (_, c) in EVIDENCE.items()])
    rows = rows.select(key, F.col("value").alias("url"), kind.alias("kind"), "reason", confidence.alias("confidence"), "path")
    first = rows.groupBy(key, "kind", "url").agg(F.min(F.struct("path", "reason", "confidence")).alias("f"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("f.path", "kind", "url"))
    return first.withColumn("place", place).select(key, "url", "kind", "f.reason", "f.confidence", "f.path", (F.col("place") > LINKS_PER_DOCUMENT).alias("beyond_limit"))


def _hint(path: Column) -> Column:
    return F.regexp_replace(path, r"^\$\.?", "")


def model_links(leaves: DataFrame, key: str) -> DataFrame:
    """(key, url, kind, form, reason, via, path): the addresses in a document's texts, told apart by address, path and siblings.

    Kinds are asset (vrm, glb), animation (glb), document (mml), metadata (json) and media; an address of none is left out. The
    address and the names on the path to it come first, then the type that a sibling states for its container, then
    file endings of media. Models that markup inside a text refers to count as its inline links. Each address counts once
    a kind, with its strongest source (inline before record) and of these the first path.
    """
    trimmed = lambda u: F.regexp_replace(F.trim(u), r"[.,;)]+$", "")
    unquoted = lambda u: F.regexp_replace(u, """^["']|["']$""", "")
    found = F.transform(F.regexp_extract_all("value", F.lit(URL), F.lit(0)), lambda u: F.struct(trimmed(u).alias("url"), F.lit("record").alias("via"), F.lit(0).alias("rank")))
    inline = F.transform(F.regexp_extract_all("value", F.lit(MML_SOURCE), F.lit(1)), lambda u: F.struct(trimmed(unquoted(u)).alias("url"), F.lit("mml_inline").alias("via"), F.lit(1).alias("rank")))
    rows = leaves.filter("value is not null").select(key, "path", "name", "mime", F.explode(F.concat(found, inline)).alias("x")).select(key, "path", F.lower("name").alias("name"), F.lower(F.coalesce("mime", F.lit(""))).alias("mime"), "x.*").filter("url <> ''")
    url = F.col("url")
    hint = F.when(F.col("rank") == 0, _hint(F.col("path"))).otherwise("")
    file = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1)
    sibling = F.when(F.col("rank") == 0, F.regexp_extract("mime", r"^([^;]*)", 1)).otherwise("")
    rules = [
        (url.rlike(VRM_FILE), "asset:vrm:vrm_address"),
        (hint.rlike(VRM_PATH), "asset:vrm:vrm_path"),
        (url.rlike(GLB_FILE) & hint.rlike(ANIMATION_PATH), "animation:glb:animation_path"),
        (url.rlike(GLB_FILE) & file.rlike(ANIMATION_FILE), "animation:glb:animation_file"),
        (url.rlike(GLB_FILE), "asset:glb:glb_address"),
        (sibling.contains("vrm"), "asset:vrm:sibling_type"),
        (sibling.startswith("model/gltf"), "asset:glb:sibling_type"),
        (url.rlike(MEDIA_FILE), "media:file:media_address"),
        (sibling.rlike("^(image|video|audio)/"), "media:file:sibling_type"),
        (hint.rlike(ANIMATION_PATH), "animation:glb:animation_path"),
        (hint.rlike(GLB_PATH), "asset:glb:model_path"),
        (url.rlike(MML_FILE) | hint.rlike(MML_PATH), "document:mml:mml"),
        (F.col("name").isin("metadata", "metadata_url", "metadata_uri", "token_uri", "tokenuri", "manifest", "manifest_url", "json_url"), "metadata:json:metadata_field"),
        (url.rlike(r"(?i)\.json(?:ld)?(?:$|[?#])"), "metadata:json:json_address"),
        (sibling.isin("application/json", "application/ld+json", "text/json"), "metadata:json:sibling_type"),
    ]
    rows = rows.withColumn("c", F.split(first_match(rules), ":")).filter("c is not null")
    best = rows.groupBy(key, "url", F.col("c")[0].alias("kind")).agg(F.min_by(F.struct(F.col("c")[1].alias("form"), F.col("c")[2].alias("reason"), "via", "path"), F.struct(-F.col("rank"), "path", F.col("c")[2])).alias("b"))
    return best.select(key, "url", "kind", "b.form", "b.reason", "b.via", "b.path")


def model_pointer(leaves: DataFrame, key: str) -> DataFrame:
    """(key, has_vrm, vrm_url, vrm_field): each document's first pointer to a model, in the order of a walk from the root.

    On entering an object its ``vrm_url`` counts, then an ``animation_url`` that ends so, and at the root the first of
    ``properties.files`` whose ``uri`` ends so or whose sibling type says so; then its members in the order of their paths,
    of which any text that ends so counts. A member's path orders it, numbers by value.
    """
    # regular expressions run on the few texts and paths that may need them
    leaves = leaves.withColumn("ends", F.lower("value").contains(".vrm") & F.lower(F.regexp_replace("value", r"[?#].*$", "")).endswith(".vrm"))
    at = lambda c: F.regexp_replace(c, r"(\.[^.\[\]]*|\[\d+\])$", "")
    listed = (F.col("name") == "uri") & at(F.col("path")).rlike(r"^\$\.properties\.files\[\d+\]$") & (F.col("ends") | F.lower(F.coalesce("mime", F.lit(""))).contains("vrm"))
    rank = first_match([((F.col("name") == "vrm_url") & (F.col("value") != ""), 0), ((F.col("name") == "animation_url") & F.col("ends"), 1), (listed, 2), (F.col("ends"), 3)])
    padded = F.col("path")
    for n in range(1, 6):
        padded = F.regexp_replace(padded, rf"\[(\d{{{n}}})\]", f"[{'0' * (6 - n)}$1]")
    rows = leaves.withColumn("rank", rank).withColumn("padded", F.when(F.col("rank").isNotNull(), F.when(F.contains("path", F.lit("[")), padded).otherwise(F.col("path"))))
    rows = rows.withColumn("at", first_match([(F.col("rank") == 3, F.col("padded")), (F.col("rank") == 2, F.lit("$"))], at(F.col("padded"))))
    field = first_match([(F.col("rank") == 0, "vrm_url"), (F.col("rank") == 1, "animation_url"), (F.col("rank") == 2, "properties.files[].uri"), (F.col("rank") == 3, F.coalesce(F.nullif(_hint(F.col("path")), F.lit("")), F.lit("string")))])
    first = rows.groupBy(key).agg(F.min_by(F.struct("value", field.alias("field")), F.when(F.col("rank").isNotNull(), F.struct("at", "rank", "padded"))).alias("f"))
    return first.select(key, F.col("f").isNotNull().alias("has_vrm"), F.col("f.value").alias("vrm_url"), F.col("f.field").alias("vrm_field"))
