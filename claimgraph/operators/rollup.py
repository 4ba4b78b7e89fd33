"""Counts, profiles and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import first_match, missing


def facet_counts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows by dimension and value in one pass; null is '?'."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("?")).alias("value")) for d in dims)))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """have, missing and floor percent of each field; null, '' and 'unknown' are missing."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(~missing(c)).alias(c) for c in fields))
    long = one.unpivot("total", list(fields), "field", "have")
    pct = F.when(F.col("total") == 0, F.lit(0)).otherwise(F.floor(F.col("have") * 100 / F.col("total")))
    return long.select("field", "have", (F.col("total") - F.col("have")).alias("missing"), pct.cast("long").alias("pct"))


def gaps(df: DataFrame, key: str, name: str, fields: Sequence[str], all_up_to: int = 15, keep: int = 8) -> DataFrame:
    """The rows each field is missing from: all of them if few, else the first by name, with the full count."""
    miss = F.array_compact(F.array(*(F.when(missing(c), F.lit(c)) for c in fields)))
    rows = df.select(key, name, F.explode(miss).alias("field"))
    counts = rows.groupBy("field").agg(F.count("*").alias("missing"))
    top = _first_by(rows, "field", [name, key], all_up_to)
    out = top.join(counts, "field")
    return out.filter((F.col("missing") <= all_up_to) | (F.col("place") <= keep)).select("field", "missing", "place", key, name)


def _first_by(rows: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark cuts groups down before it shuffles them."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("place") <= n)


def child_rollup(child: DataFrame, key: str, url: Column, public: Column, ok: Column) -> DataFrame:
    """Rows, rows with a URL, public, non-public, ok and bad rows, and distinct URLs by parent; unknown is neither."""
    return child.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        F.count_if(url.isNotNull()).alias("with_url"),
        F.count_if(public).alias("public_rows"),
        F.count_if(~public).alias("nonpublic_rows"),
        F.count_if(ok).alias("ok_rows"),
        F.count_if(~ok).alias("bad_rows"),
        F.count_distinct(url).alias("n_urls"),
    )


def reason_counts(df: DataFrame, array_col: str) -> DataFrame:
    """How often each reason occurs, by count down and then by name."""
    return df.select(F.explode(array_col).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def link_summary(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    return facet_counts(df, dims)


def link_summary_by_entity(df: DataFrame, ids: str, healthy: Column) -> DataFrame:
    """Healthy and problem links by entity; links of no entity count as '<unbound>'."""
    bound = F.when(F.size(F.coalesce(F.col(ids), F.array().cast("array<string>"))) > 0, F.col(ids)).otherwise(F.array(F.lit("<unbound>")))
    rows = df.select(F.explode(bound).alias("entity"), healthy.alias("h"))
    return rows.groupBy("entity").agg(F.count("*").alias("links"), F.count_if(F.col("h")).alias("healthy"), F.count_if(~F.coalesce("h", F.lit(False))).alias("problem"))


def agreement(df: DataFrame, field: str = "field", agrees: str = "agrees") -> DataFrame:
    """Compared, agreed and conflicted by field; an unknown comparison is none."""
    return df.groupBy(field).agg(F.count(agrees).alias("compared"), F.count_if(F.col(agrees)).alias("agreed"), F.count_if(~F.col(agrees)).alias("conflicted"))


def counters(tables: Mapping[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """Named counts of rows, one row each."""
    out = None
    for name, (df, condition) in tables.items():
        one = (df if condition is None else df.filter(condition)).agg(F.count("*").alias("value")).select(F.lit(name).alias("counter"), "value")
        out = one if out is None else out.unionByName(one)
    return out


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counters before and after, and the change."""
    a, b = before.withColumnRenamed("value", "before"), after.withColumnRenamed("value", "after")
    return a.join(b, "counter", "full").withColumn("change", F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0)))


def coverage(items: DataFrame, key: str, item: str, link: Column, expected: Sequence[Column], exhausted: Column, truncated: Column) -> DataFrame:
    """Distinct items, those with a link, what is expected at most, and whether enumeration is complete."""
    per = items.groupBy(key, item).agg(F.bool_or(F.coalesce(link, F.lit(False))).alias("linked"), F.max(F.greatest(*expected) if len(expected) > 1 else expected[0]).alias("e"), F.bool_and(exhausted).alias("x"), F.bool_or(truncated).alias("t"))
    out = per.groupBy(key).agg(F.count("*").alias("items"), F.count_if(F.col("linked")).alias("with_links"), F.max(F.when(F.col("e") > 0, F.col("e"))).alias("expected"), F.bool_and("x").alias("x"), F.bool_or("t").alias("t"))
    done = F.col("x") & ~F.col("t") & (F.col("items") > 0) & (F.col("items") == F.col("with_links")) & (F.col("expected").isNull() | (F.col("items") >= F.col("expected")))
    return out.select(key, "items", "with_links", (F.col("items") - F.col("with_links")).alias("without_links"), "expected", F.coalesce(done, F.lit(False)).alias("complete"))


def page_coverage(rows: DataFrame, key: str, row: str, page: str, total: str, truncated: str) -> DataFrame:
    """Rows of paged answers, each once by its content, against the total they report."""
    once = rows.withColumn("h", F.sha2(F.col(row).cast("string"), 256))
    out = once.groupBy(key).agg(F.count_distinct("h").alias("rows"), F.count_distinct(page).alias("pages"), F.max(total).alias("reported"), F.bool_or(truncated).alias("truncated"))
    return out.withColumn("complete", ~F.col("truncated") & (F.col("reported").isNull() | (F.col("rows") >= F.col("reported"))))


def attribute_profile(df: DataFrame, group: str, item: str, name: str, kind: str, value: str) -> DataFrame:
    """A group's kind, from how its items' attributes vary: generative, 1of1_series, 1of1_art, numbered, no_traits or mixed."""
    attributes = df.filter(F.col(kind).isNotNull())
    per_item = df.groupBy(group, item).agg(F.count(kind).alias("n"), F.min(name).alias("name"), F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", kind, value))), "|").alias("combo"))
    items = per_item.groupBy(group).agg(
        F.count("*").alias("items"), F.avg("n").alias("avg_attributes"), F.count_distinct("n").alias("counts"), F.count_distinct("name").alias("names"), F.count_if(F.col("name").rlike(r"#?\d+\s*$")).alias("numbered"), F.count_distinct("combo").alias("combos")
    )
    types = attributes.groupBy(group, kind).agg(F.count_distinct(value).alias("v")).groupBy(group).agg(F.count("*").alias("types"), F.count_if(F.col("v") > 1).alias("varied"))
    out = items.join(types, group, "left").fillna(0, ["types", "varied"])
    a, v = F.col("avg_attributes"), F.col("varied") / F.greatest(F.col("types"), F.lit(1))
    kind_of = first_match(
        [
            (a == 0, "no_traits"),
            ((a >= 5) & (v > 0.5), "generative"),
            ((a >= 3) & (v > 0.3), "generative"),
            ((a >= 2) & (F.col("counts") == 1) & (v > 0.3), "1of1_series"),
            ((a <= 2) & (F.col("names") == F.col("items")) & (F.col("numbered") == 0), "1of1_art"),
            (F.col("numbered") / F.col("items") > 0.5, "numbered"),
        ],
        "mixed",
    )
    return out.select(group, "items", F.round(a, 4).alias("avg_attributes"), "types", F.round(v, 4).alias("variation"), "names", "combos", kind_of.alias("classified"))


def reverse_index(refs: DataFrame, url: Column, fields: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Canonical URL to the distinct entities, children and forms that refer to it; and the references without a valid URL."""
    rows = refs.withColumn("url_key", url)
    index = rows.filter("url_key is not null").groupBy("url_key").agg(F.count("*").alias("refs"), *(F.sort_array(F.collect_set(c)).alias(n) for n, c in fields.items()))
    return index, rows.filter("url_key is null").drop("url_key")


def expand_results(results: DataFrame, bindings: DataFrame, key: str) -> DataFrame:
    """One shared result back to every binding of its key."""
    return bindings.join(results, key, "left")


def feed_health(records: DataFrame, probes: DataFrame, bound: str, probe: str, valid: Column) -> DataFrame:
    """Distinct bound, probed and valid keys; validation is complete if every bound key was probed."""
    b = records.select(F.col(bound).alias("k")).filter("k is not null").distinct()
    p = probes.groupBy(F.col(probe).alias("k")).agg(F.bool_or(valid).alias("v"))
    both = b.join(p.withColumn("seen", F.lit(True)), "k", "left")
    out = both.agg(F.count("*").alias("bound"), F.count_if(F.col("seen")).alias("probed"), F.count_if(F.col("v")).alias("valid"))
    return out.withColumn("complete", F.col("bound") == F.col("probed"))


def probe_rollup(inventory: DataFrame, probes: DataFrame, key: str, url: str, complete: str, valid: str, fmt: str) -> DataFrame:
    """Per entity: ready if its inventory is complete, not empty and every probe is valid; its formats and invalid URLs."""
    rows = inventory.join(probes, url, "left")
    out = rows.groupBy(key).agg(F.bool_and(complete).alias("complete"), F.count_distinct(url).alias("urls"), F.count_if(F.col(valid)).alias("valid"), F.count_distinct(fmt).alias("formats"), F.count_if(~F.coalesce(F.col(valid), F.lit(False))).alias("invalid"))
    return out.withColumn("ready", F.coalesce(F.col("complete") & (F.col("urls") > 0) & (F.col("invalid") == 0), F.lit(False)))


def evidence_counters(entity: DataFrame, key: str, evidence: DataFrame, candidates: DataFrame, source: str, seen: str, flags: Mapping[str, Column]) -> DataFrame:
    """Counters of evidence and candidates on every entity, 0 where there is none."""
    e = evidence.groupBy(key).agg(F.count_distinct(source).alias("sources"), F.max(seen).alias("last_seen"), *(F.count_if(c).alias(n) for n, c in flags.items()))
    c = candidates.groupBy(key).agg(F.count("*").alias("candidates"))
    return entity.join(e, key, "left").join(c, key, "left").fillna(0, ["sources", "candidates", *flags])
