"""Sources: tables, records, shards, text tables, pages and model files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.shared import cut
from ..functions.uri import resolve_uri


def read_catalog(spark: SparkSession, folder: str, name: str, schema: str | StructType) -> DataFrame:
    """A table with its declared schema."""
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def read_records(df: DataFrame, key: str, c: str, list_keys: Sequence[str] = ("records", "items", "results", "data"), wrappers: Sequence[str] = ("data", "result", "response")) -> DataFrame:
    """(key, place, record): the rows of a bare list, or of a list under one of the keys, at most two wrappers deep."""
    paths = ["$"] + [f"$.{k}" for k in list_keys]
    paths += [f"$.{w}.{k}" for w in wrappers for k in list_keys] + [f"$.{a}.{b}.{k}" for a in wrappers for b in wrappers for k in list_keys]
    found = F.coalesce(*(F.expr(f"try_variant_get(v, '{p}', 'array<variant>')") for p in paths))
    rows = df.select(key, F.try_parse_json(F.col(c)).alias("v")).select(key, F.posexplode(found).alias("place", "record"))
    return rows.select(key, F.col("place").cast("long").alias("place"), F.to_json("record").alias("record"))


def read_seeds(spark: SparkSession, path: str, kinds: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Seeds (kind, key, source) of newline-delimited JSON with # comments or of JSON arrays; and the lines that are no valid seed."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> '' and not startswith(line, '#') and line not in ('[', ']')")
    lines = lines.withColumn("line", F.regexp_replace("line", ",$", ""))
    many = F.when(F.col("line").startswith("["), F.from_json("line", "array<struct<kind:string,key:string,source:string>>")).otherwise(F.array(F.from_json("line", "struct<kind:string,key:string,source:string>")))
    rows = lines.select("line", F.explode(many).alias("s")).select("line", "s.*")
    ok = F.coalesce(F.col("kind").isin(*kinds) & F.col("key").isNotNull(), F.lit(False))
    return rows.filter(ok).drop("line"), rows.filter(~ok).select("line")


def read_shards(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """(entity, document, shard, valid): the JSON documents of entities, and the file that each is from.

    One document a file, named after its entity; or, ``packed``, many entities a file, each line a JSON object of ``entity``
    and ``document``, the latter as text, so that one that is no JSON spoils no other. A line that is no such object is a
    row that is not valid.
    """
    if packed:
        raw = spark.read.schema("entity string, document string").json(path).select("entity", "document", F.col("_metadata.file_path").alias("shard"))
    else:
        raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("document"), F.col("_metadata.file_path").alias("shard"))
        raw = raw.select(F.regexp_extract("shard", r"([^/]+)\.[A-Za-z]+$", 1).alias("entity"), "document", "shard")
    return raw.withColumn("valid", F.try_parse_json("document").isNotNull())


def read_markdown_tables(df: DataFrame, key: str, c: str) -> DataFrame:
    """(key, section, table, line, cells) of pipe tables in prose; ``cells`` maps header to value; ragged rows are dropped."""
    lines = df.select(key, F.posexplode(F.split(F.col(c), "\n")).alias("line", "text")).withColumn("text", F.trim("text"))
    per = Window.partitionBy(key).orderBy("line")
    lines = lines.withColumn("section", F.last(F.when(F.col("text").rlike(r"^#+\s"), F.regexp_replace("text", r"^#+\s*", "")), ignorenulls=True).over(per))
    is_row = F.col("text").rlike(r"^\|.*\|$")
    lines = lines.withColumn("is_row", is_row).withColumn("begins", is_row & ~F.coalesce(F.lag(is_row).over(per), F.lit(False)))
    rows = lines.withColumn("table", F.sum(F.col("begins").cast("int")).over(per)).filter("is_row")
    cells = F.transform(F.split(F.regexp_replace("text", r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = rows.withColumn("cells", cells)
    header = F.first("cells").over(Window.partitionBy(key, "table").orderBy("line"))
    rows = rows.withColumn("header", header).filter(~F.col("begins") & ~F.col("text").rlike(r"^[|:\-\s]+$") & (F.size("cells") == F.size("header")))
    return rows.select(key, "section", F.col("table").cast("long").alias("table"), F.col("line").cast("long").alias("line"), F.map_from_arrays("header", "cells").alias("cells"))


def page_signals(df: DataFrame, key: str, c: str, words: Sequence[str]) -> DataFrame:
    """Title, description, links, model files, addresses and keyword counts of landed pages, all native."""
    html = F.col(c)
    count = [F.regexp_count(F.lower(html), F.lit(rf"\b{w}\b")).cast("long").alias(f"n_{w}") for w in words]
    return df.select(
        key,
        F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit("")).alias("title"),
        F.nullif(F.regexp_extract(html, r'(?i)<meta[^>]+name="description"[^>]+content="([^"]*)"', 1), F.lit("")).alias("description"),
        F.array_distinct(F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1))).alias("links"),
        F.array_distinct(F.regexp_extract_all(html, F.lit(r"""(https?://[^"'\s<>]+\.(?:vrm|glb|fbx))"""), F.lit(1))).alias("models"),
        F.array_distinct(F.regexp_extract_all(F.lower(html), F.lit(r"(0x[0-9a-f]{40})"), F.lit(1))).alias("addresses"),
        *count,
    )


def page_meta(df: DataFrame, key: str, c: str) -> DataFrame:
    """Meta tags of landed pages: (key, meta, title, description, image); ``meta`` maps a tag's name or property to its content.

    Names are lower-cased, attributes may stand in any order and quotation, the first of tags of one name counts, and tags
    without a name or content do not. The description is that of the page, else of its preview; title and image are those
    of the preview, else the page's title.
    """
    source = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script>", "")
    tags = F.regexp_extract_all(source, F.lit(r"""(?is)<meta\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), F.lit(0))
    named = F.transform(tags, lambda t: F.struct(F.lower(F.coalesce(_attribute(t, "property"), _attribute(t, "name"))).alias("key"), _line(_attribute(t, "content")).alias("value")))
    named = F.filter(named, lambda e: e["key"].isNotNull() & (e["value"] != ""))
    # the first of each name
    first = F.filter(named, lambda e, i: ~F.exists(F.slice(named, F.lit(1), i), lambda x: x["key"] == e["key"]))
    out = df.select(key, F.map_from_entries(first).alias("meta"), F.nullif(_line(F.regexp_extract(source, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit("")).alias("_title"))
    get = lambda *names: F.coalesce(*(F.try_element_at("meta", F.lit(n)) for n in names))
    return out.select(key, "meta", F.coalesce(get("og:title"), F.col("_title")).alias("title"), get("description", "og:description", "twitter:description").alias("description"), get("og:image", "twitter:image").alias("image"))


#: Fixed labels that say nothing of a link's target, address schemes that are no pages, and character references.
EMPTY_LABELS = "image|logo|learn more|website|visit"
NO_PAGES = "javascript:|mailto:|tel:|#"
REFERENCES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&#160;", " "), ("&amp;", "&"))


def _decoded(c: Column) -> Column:
    for name, sign in REFERENCES:
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def _attribute(tag: Column, name: str) -> Column:
    """An attribute of a tag, quoted or bare; null if it is absent or blank."""
    found = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    value = F.regexp_replace(F.regexp_replace(found, rf"(?is)^\s{name}\s*=\s*", ""), """^["']|["']$""", "")
    return F.nullif(F.trim(_decoded(value)), F.lit(""))


def _line(c: Column) -> Column:
    return F.trim(F.regexp_replace(_decoded(c), r"\s+", " "))


def page_leads(df: DataFrame, key: str, url: str, c: str, kind: str) -> DataFrame:
    """Labelled leads of landed pages: (key, lead_id, kind, label, url, image_url, role), each once a page.

    A page is cut into its anchors and its images outside anchors, in order; comments, scripts and styles are none. An
    anchor's lead is its target, the first image in it, and as label the first of its text and its images' alt and title
    that says something, else the target's host. An image outside anchors that no anchor of the page shows is a lead
    without a target. Targets are resolved against the page's address; addresses within the page, of mail, telephone or
    script are none. All native: one pass over the pages writes the
    pieces, and only images are joined, by page and address.
    """
    source = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>", "")
    rows = df.select(key, F.col(url).alias("_base"), F.posexplode(F.regexp_extract_all(source, F.lit(r"(?is)<a\b[^>]*>.*?</a\s*>|<img\b[^>]*>"), F.lit(0))).alias("_at", "_piece"))
    rows = rows.withColumn("_anchor", F.lower(F.substring("_piece", 1, 2)) == "<a")
    target = lambda raw: F.when(raw.isNotNull() & ~F.lower(raw).rlike(f"^({NO_PAGES})"), resolve_uri(F.col("_base"), raw))
    images = F.regexp_extract_all("_piece", F.lit(r"(?is)<img\b[^>]*>"), F.lit(0))
    rows = rows.withColumn("_images", images).withColumn("_src", _attribute(F.get("_images", F.lit(0)), "src"))
    rows = rows.withColumn("_href", F.when(F.col("_anchor"), _attribute(F.regexp_extract("_piece", r"(?is)^<a\b[^>]*>", 0), "href")))
    rows = rows.withColumn("image_url", F.coalesce(target(F.col("_src")), F.lit(""))).withColumn("url", target(F.col("_href")))
    inner = F.regexp_replace("_piece", r"(?s)<[^>]*>", " ")
    said = F.concat(F.array(_line(inner)), F.flatten(F.transform("_images", lambda i: F.array(_line(_attribute(i, "alt")), _line(_attribute(i, "title"))))))
    telling = F.get(F.filter(said, lambda x: (x != "") & ~x.rlike(f"(?i)^({EMPTY_LABELS})$")), F.lit(0))
    host = F.replace(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("www."), F.lit(""))
    only = F.coalesce(F.nullif(_line(_attribute(F.col("_piece"), "alt")), F.lit("")), F.nullif(_line(_attribute(F.col("_piece"), "title")), F.lit("")), F.lit(""))
    label = F.when(F.col("_anchor"), F.coalesce(telling, F.nullif(host, F.lit("")), "url", F.lit(""))).otherwise(only)
    # written once: the filters below would otherwise parse each page again, for themselves and for what they keep
    rows = cut(rows.select(key, "_anchor", label.alias("label"), F.coalesce("url", F.lit("")).alias("url"), "image_url"), "leads")
    shown = rows.filter(F.col("_anchor") & (F.col("image_url") != "")).select(key, "image_url").distinct()
    anchors = rows.filter(F.col("_anchor") & ((F.col("url") != "") | (F.col("image_url") != "") | (F.col("label") != "")))
    loose = rows.filter(~F.col("_anchor") & (F.col("image_url") != "")).join(shown, [key, "image_url"], "left_anti")
    leads = anchors.withColumn("role", F.lit("relationship")).unionByName(loose.withColumn("role", F.lit("image"))).withColumn("kind", F.lit(kind))
    lead_id = F.substring(F.sha2(F.concat_ws("|", "kind", "label", "url", "image_url"), 256), 1, 20)
    out = leads.select(key, lead_id.alias("lead_id"), "kind", "label", "url", "image_url", "role")
    return out.groupBy(key, "lead_id", "kind", "label", "url", "image_url").agg(F.max("role").alias("role"))



def read_assets(spark: SparkSession, glob: str, most: int = 64 << 20) -> DataFrame:
    """Binary model files; of those longer than ``most`` bytes the content is null and never read. Files of no bytes have no row, since Spark's file sources skip them."""
    files = spark.read.format("binaryFile").load(glob)
    large = files.filter(F.col("length") > most).select(*(F.lit(None).cast("binary").alias(c) if c == "content" else c for c in files.columns))
    return files.filter(F.col("length") <= most).unionByName(large)


def flatten_stats(df: DataFrame, key: str, c: str, intervals: Sequence[str]) -> DataFrame:
    """Totals of a market document, and its intervals pivoted to columns; a repeated interval counts once, the larger volume."""
    kind = "struct<total:struct<volume:double,sales:bigint,num_owners:bigint,floor_price:double>,intervals:array<struct<interval:string,volume:double,sales:bigint>>>"
    d = df.select(key, F.from_json(c, kind).alias("d"))
    volume = lambda name: F.array_max(F.transform(F.filter("d.intervals", lambda x: x["interval"] == name), lambda x: x["volume"]))
    return d.select(key, "d.total.*", *(volume(n).alias(f"volume_{n}") for n in intervals))


