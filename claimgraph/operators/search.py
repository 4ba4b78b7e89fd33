"""Filters, search and projections over a catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cols import all_of, any_of, contains_ci, first_match, missing


def faceted_search(
    df: DataFrame, query: str | None = None, text_cols: Sequence[str] = (), facets: Mapping[str, object] | None = None, date_col: str | None = None, since: str | None = None, until: str | None = None, without: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Rows that match the text in any column, every facet, the date range and every "missing" flag, in order."""
    keep = []
    if query:
        keep.append(any_of([contains_ci(c, query) for c in text_cols]))
    keep += [F.col(c) == v for c, v in (facets or {}).items()]
    if since:
        keep.append(F.col(date_col) >= F.lit(since).cast("timestamp"))
    if until:
        keep.append(F.col(date_col) <= F.lit(until).cast("timestamp"))
    keep += [missing(c, ()) for c in without]
    out = df.filter(all_of(keep))
    return out.orderBy(*order) if order else out


def search_children(child: DataFrame, parent: DataFrame, key: str, parent_key: str, parent_name: str, query: str, text_cols: Sequence[str], order: Sequence[str], limit: int = 50) -> DataFrame:
    """Children that match, with their parent's name, in order; the limit is part of the operator."""
    found = child.filter(any_of([contains_ci(c, query) for c in text_cols]))
    names = parent.select(F.col(parent_key).alias(key), F.col(parent_name).alias("parent_name"))
    return found.join(names, key, "left").orderBy(*order).limit(limit)


def lookup(df: DataFrame, wanted: str, id_cols: Sequence[str], name_col: str) -> DataFrame:
    """The one best row: an exact match of name or id, else the name contains the text, else another id column does."""
    low = wanted.lower()
    rank = first_match(
        [
            (any_of([F.coalesce(F.lower(F.col(c).cast("string")) == low, F.lit(False)) for c in (name_col, *id_cols)]), 0),
            (contains_ci(name_col, wanted), 1),
            (any_of([contains_ci(c, wanted) for c in id_cols]), 2),
        ]
    )
    return df.withColumn("match_rank", rank).filter("match_rank is not null").orderBy("match_rank", name_col, *id_cols).limit(1)


def haystack_search(df: DataFrame, query: str, cols: Sequence[str], facets: Mapping[str, object] | None, status_col: str, ranks: Mapping[str, int], name_col: str, other: int = 2) -> DataFrame:
    """Rows whose joined columns contain the text, ranked by status and then name; an unknown facet value counts as 'unknown'."""
    hay = F.lower(F.concat_ws(" ", *(F.col(c).cast("string") for c in cols)))
    keep = hay.contains(query.lower()) & all_of([F.coalesce(F.col(c).cast("string"), F.lit("unknown")) == str(v) for c, v in (facets or {}).items()])
    rank = first_match([(F.col(status_col) == k, v) for k, v in ranks.items()], other)
    return df.filter(keep).withColumn("status_rank", rank).orderBy("status_rank", name_col)


def sql(spark: SparkSession, tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    """SQL over tables given by name."""
    return spark.sql(text, **tables) if "{" in text else _views(spark, tables, text)


def _views(spark: SparkSession, tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def select_targets(df: DataFrame, done: DataFrame, key: str, keep: Column, tier_col: str, tiers: Sequence[str], order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows still to be worked on: wanted, not yet targeted, by tier rank and order."""
    rank = first_match([(F.col(tier_col) == t, i) for i, t in enumerate(tiers)], len(tiers))
    out = df.filter(keep).join(done.select(key).distinct(), key, "left_anti").withColumn("tier_rank", rank).orderBy("tier_rank", *order)
    return out if limit is None else out.limit(limit)


def pending(child: DataFrame, link: DataFrame, key: str, has_url: Column, proof: Column) -> DataFrame:
    """Children that have a URL and no proven link."""
    return child.filter(has_url).join(link.filter(proof).select(key).distinct(), key, "left_anti")


def has_child(parent: DataFrame, child: DataFrame, key: str, condition: Column, unconfirmed: Column) -> DataFrame:
    """Unconfirmed parents with any child that meets the condition."""
    return parent.filter(unconfirmed).join(child.filter(condition).select(key), key, "left_semi")


def detail(parent: DataFrame, child: DataFrame, key: str, child_order: Sequence[Column], fields: Sequence[str], first: int) -> DataFrame:
    """Each parent with its ordered children, the first of them, and their number."""
    kids = F.array_sort(F.collect_list(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(child_order)), F.struct(*fields).alias("child"))))
    grouped = child.groupBy(key).agg(kids.alias("k"), F.count("*").alias("n_children"))
    grouped = grouped.select(key, F.transform("k", lambda x: x["child"]).alias("children"), F.transform(F.slice("k", 1, first), lambda x: x["child"]).alias("first_children"), "n_children")
    return parent.join(grouped, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))


def project_registry(df: DataFrame, mapped: Column, fields: Mapping[str, Column], reason: Column) -> tuple[DataFrame, DataFrame]:
    """Projected rows, and the rows that cannot be mapped with the reason why; an unknown outcome is unmapped."""
    ok = F.coalesce(mapped, F.lit(False))
    return df.filter(ok).select(*(c.alias(n) for n, c in fields.items())), df.filter(~ok).withColumn("reason", reason)


def project_manifest(df: DataFrame, namespace: Column, reference: Column, template: Column, metadata: Column, param: Column, identifiers: Sequence[Column]) -> DataFrame:
    """Chain-neutral id, the strategy by which an asset resolves, and the identifier that takes precedence."""
    strategy = first_match([(template.isNotNull(), "template"), (metadata.isNotNull(), "metadata"), (param.isNotNull(), "param")], "unavailable")
    caip = F.when(namespace.isNotNull() & reference.isNotNull(), F.concat_ws(":", namespace, reference))
    return df.withColumn("caip_id", caip).withColumn("strategy", strategy).withColumn("resolver", F.coalesce(template, metadata, param)).withColumn("identifier", F.coalesce(*identifiers))


def chain_neutral(df: DataFrame, col: str, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Namespace and reference of a legacy name; unmapped names keep null in both."""
    low = F.lower(F.trim(F.col(col).cast("string")))
    part = lambda i: first_match([(low == k.lower(), v[i]) for k, v in mapping.items()])
    return df.withColumn("namespace", part(0)).withColumn("reference", part(1))
