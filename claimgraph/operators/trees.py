"""Trees of files and hierarchies of coverage: every level from one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match

#: Fixed patterns of rig evidence in importer metadata, and the reasons a file fails for, in their order.
HUMAN_NAME = r"(?m)^\s*humanName:\s*\S+"
HUMANOID_TYPE = r"(?m)^\s*animationType:\s*3\s*$"
AVATAR_SETUP = r"(?m)^\s*avatarSetup:\s*([1-9]\d*)\s*$"
SKELETON_ENTRY = r"(?m)^\s*- name:\s*\S+"
FAILURES = ("missing_fbx_meta", "meta_fetch_error", "rigging_unproven")


def rigged(meta: Column) -> Column:
    """Whether importer metadata proves a rig: a humanoid mapping, or a humanoid type with avatar setup and skeleton entries."""
    setup = meta.rlike(HUMANOID_TYPE) & meta.rlike(AVATAR_SETUP) & meta.rlike(SKELETON_ENTRY)
    return F.coalesce(meta.rlike(HUMAN_NAME) | setup, F.lit(False))


def lane_files(tree: DataFrame, repo: str, path: str, kind: str, blob: str, blobs: DataFrame, root: Column, suffix: str = ".fbx") -> DataFrame:
    """(repo, path, reason): the files of each repository's lane, and why one is no proven asset; null if it is one.

    ``tree`` lists paths with their kind and blob; ``blobs`` is (blob, text, error), the landed metadata. A file's metadata
    is the blob beside it with ``.meta`` behind its name. Distinct texts are looked at once.
    """
    own = tree.filter((F.col(kind) == "blob") & F.col(path).isNotNull()).select(F.col(repo).alias("repo"), F.col(path).alias("path"), F.col(blob).alias("blob"), root.alias("root"))
    files = own.filter(F.startswith("path", F.concat("root", F.lit("/"))) & F.lower("path").endswith(suffix)).select("repo", "path").distinct()
    metas = own.filter(F.col("path").endswith(".meta") & F.col("blob").isNotNull()).groupBy("repo", F.expr("substring(path, 1, length(path) - 5)").alias("path")).agg(F.min("blob").alias("blob"))
    known = blobs.groupBy("blob").agg(F.bool_or(rigged(F.col("text"))).alias("rigged"), F.bool_and(F.col("error").isNotNull() | F.col("text").isNull()).alias("failed"))
    out = files.join(metas, ["repo", "path"], "left").join(known, "blob", "left")
    reason = first_match([(F.col("blob").isNull(), FAILURES[0]), (F.coalesce("failed", F.lit(True)), FAILURES[1]), (~F.col("rigged"), FAILURES[2])], F.lit(None).cast("string"))
    return out.select("repo", "path", reason.alias("reason"))


def folder_rollup(files: DataFrame, truncated: DataFrame) -> DataFrame:
    """Every folder of every repository, '' being the whole: files, proven files, failures by reason, coverage and state.

    Each file counts for all its ancestors, in partial sums before anything moves, so that a root costs a row a task.
    ``truncated`` is (repo, truncated). A folder is complete if its list is whole and all its files are proven, partial if
    any is, else unknown; a repository without files has its root.
    """
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    rows = files.select("repo", F.explode(folders).alias("folder"), "reason")
    sums = rows.groupBy("repo", "folder").agg(F.count("*").alias("files"), F.count_if(F.col("reason").isNull()).alias("proven"), *(F.count_if(F.col("reason") == r).alias(r) for r in FAILURES))
    whole = truncated.groupBy("repo").agg(F.bool_or(F.coalesce("truncated", F.lit(False))).alias("truncated"))
    bare = whole.join(files.select("repo").distinct(), "repo", "left_anti").select("repo", F.lit("").alias("folder"), *(F.lit(0).cast("long").alias(c) for c in ("files", "proven", *FAILURES)))
    out = sums.unionByName(bare).join(whole, "repo", "left").withColumn("truncated", F.coalesce("truncated", F.lit(False)))
    complete = ~F.col("truncated") & (F.col("files") > 0) & (F.col("proven") == F.col("files"))
    depth = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/")))
    return out.withColumn("depth", depth).withColumn("coverage_complete", complete).withColumn("state", F.when(complete, "complete").when(F.col("proven") > 0, "partial").otherwise("unknown"))


def parent_coverage(items: DataFrame, parent: str, key: str, item: str, link: Column, urls: Column, declared: Column, api_total: Column, exhausted: Column, truncated: Column, error: Column) -> DataFrame:
    """Coverage of each key and of each parent in one pass: (parent, key, scope, ...), the key of a parent's row being null.

    Rows of one item are united first. Of a key: items, those with a link, what is expected (the largest positive of the
    declared counts and the reported total), whether supply is covered and metadata complete. Of a parent, over its keys:
    counts and totals are summed, exhausted, covered and complete need all keys, truncated any; distinct links are counted
    anew, as keys may share them.
    """
    item_rows = items.groupBy(F.col(parent).alias("parent"), F.col(key).alias("key"), F.col(item).alias("item")).agg(
        F.bool_or(F.coalesce(link, F.lit(False))).alias("linked"), F.max(declared).alias("declared"), F.max(api_total).alias("api"), F.bool_and(F.coalesce(exhausted, F.lit(False))).alias("exhausted"), F.bool_or(F.coalesce(truncated, F.lit(False))).alias("truncated"), F.max(error).alias("error")
    )
    n = F.count("item")  # a row without an item says something of its key, and is none
    per = item_rows.groupBy("parent", "key").agg(
        n.alias("items"), F.count_if(F.col("linked") & F.col("item").isNotNull()).alias("with_links"), F.max(F.when(F.col("declared") > 0, F.col("declared"))).alias("declared"), F.max(F.when(F.col("api") > 0, F.col("api"))).alias("api_total"), F.bool_and("exhausted").alias("exhausted"), F.bool_or("truncated").alias("truncated"), F.count("error").alias("errors")
    )
    per = per.withColumn("expected", F.greatest("declared", "api_total")).withColumn("covered", F.col("expected").isNull() | (F.col("items") >= F.col("expected")))
    per = per.withColumn("complete", F.col("exhausted") & ~F.col("truncated") & (F.col("items") > 0) & (F.col("with_links") == F.col("items")) & F.col("covered"))
    both = per.groupingSets([["parent", "key"], ["parent"]], "parent", "key").agg(
        F.grouping("key").alias("_all"),
        F.count("*").alias("keys"),
        *(F.sum(c).alias(c) for c in ("items", "with_links", "errors", "api_total", "expected")),
        *(F.bool_and(c).alias(c) for c in ("exhausted", "covered", "complete")),
        F.bool_or("truncated").alias("truncated"),
    )
    links = items.filter(urls.isNotNull()).select(F.col(parent).alias("parent"), F.col(key).alias("key"), urls.alias("url")).distinct()
    unique = links.groupingSets([["parent", "key"], ["parent"]], "parent", "key").agg(F.grouping("key").alias("_all"), F.count_distinct("url").alias("unique_urls"))
    same = [F.col("parent").eqNullSafe(F.col("_p")), F.col("key").eqNullSafe(F.col("_k")), F.col("_all") == F.col("_a")]
    out = both.join(unique.select(F.col("parent").alias("_p"), F.col("key").alias("_k"), F.col("_all").alias("_a"), "unique_urls"), same, "left")
    return out.select("parent", "key", F.when(F.col("_all") == 1, "parent").otherwise("key").alias("scope"), "keys", "items", "with_links", (F.col("items") - F.col("with_links")).alias("without_links"), "errors", "api_total", "expected", "exhausted", "truncated", "covered", "complete", F.coalesce("unique_urls", F.lit(0)).alias("unique_urls"))

