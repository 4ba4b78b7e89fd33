"""Posting lists in segments: what belongs to a hub, in order, however much it is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import all_of
from .ranking import numbered


def postings(rows: DataFrame, hub: Sequence[str], order: Sequence[str], size: int = 1000) -> DataFrame:
    """(hub, segment, first_place, members, n_members, total, segments): the rows of each hub in segments of at most ``size``.

    ``order`` are the columns that a member consists of and is sorted by; repeated members count once. Segments are
    numbered from 0, ``first_place`` is the place of a segment's first member in its hub, from 1, and ``total`` the number
    of the hub's members. All rows are numbered over range partitions of hub and order, and a segment is a block of equal
    numbers: a hub of any number of members is cut into blocks by its place alone, and no task or row ever holds more of
    it than a block. The first segment may hold fewer than ``size``, as blocks do not begin at hubs.
    """
    names = [*hub, *order]
    at = numbered(rows.select(*names).distinct(), names).withColumn("_block", F.floor((F.col("place") - 1) / size))
    blocks = at.groupBy(*hub, "_block").agg(F.array_sort(F.collect_list(F.struct("place", F.struct(*order).alias("member")))).alias("m"))
    blocks = blocks.select(*hub, "_block", F.transform("m", lambda x: x["member"]).alias("members"), F.col("m")[0]["place"].alias("_from"), F.size("m").alias("n_members"))
    per = at.groupBy(*hub).agg(F.min("place").alias("_start"), F.min("_block").alias("_first"), F.max("_block").alias("_last"), F.count("*").alias("total"))
    # null hubs are hubs as well
    out = blocks.join(per.select(*(F.col(h).alias(f"_{h}") for h in hub), "_start", "_first", "_last", "total"), [F.col(h).eqNullSafe(F.col(f"_{h}")) for h in hub])
    return out.select(*hub, (F.col("_block") - F.col("_first")).alias("segment"), (F.col("_from") - F.col("_start") + 1).alias("first_place"), "members", "n_members", "total", (F.col("_last") - F.col("_first") + 1).alias("segments"))


def reverse_postings(refs: DataFrame, url: Column, fields: Mapping[str, str], size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Canonical URL and field to the distinct values that refer to it, in segments; and the references without a valid URL.

    Rows are (url_key, field, segment, ...) as ``postings`` gives them, members being values as text; null values do not count.
    """
    rows = refs.withColumn("url_key", url)
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("field"), F.col(c).cast("string").alias("value")) for n, c in fields.items())))
    long = rows.filter("url_key is not null").select("url_key", pairs.alias("p")).select("url_key", "p.field", "p.value").filter("value is not null")
    return postings(long, ["url_key", "field"], ["value"], size), rows.filter("url_key is null").drop("url_key")


def detail_segments(parent: DataFrame, child: DataFrame, key: str, child_order: Sequence[str], size: int = 1000) -> DataFrame:
    """Parents with their ordered children in segments, one row a segment; parents without children have one row with none."""
    lists = postings(child.filter(F.col(key).isNotNull()), [key], child_order, size)
    out = parent.join(lists.withColumnRenamed("members", "children"), key, "left")
    return out.withColumn("total", F.coalesce("total", F.lit(0))).withColumn("segment", F.coalesce("segment", F.lit(0)))


def hit_postings(df: DataFrame, keys: Sequence[str], query: str, size: int = 1000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One lead a key with the number of its hits, the queries of each lead in segments, and the hits without a whole key.

    What ``merge_hits`` gives, for leads that any number of queries may find: a null query is a hit and no query, and a
    lead that no query names has no segment.
    """
    whole = all_of([F.col(k).isNotNull() for k in keys])
    hits = df.filter(whole)
    leads = hits.groupBy(*keys).agg(F.count("*").alias("hits"))
    return leads, postings(hits.filter(F.col(query).isNotNull()), keys, [query], size), df.filter(~whole)


def asset_postings(df: DataFrame, key: Sequence[str], fmt: str, rigged: str, evidence: str, unknown: str = "unknown", size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """One asset a key, as ``merge_assets`` merges them, and the evidence of each in segments; null evidence is none."""
    known = F.when(F.col(fmt) != unknown, F.col(fmt))
    merged = df.groupBy(*key).agg(F.coalesce(F.min(known), F.lit(unknown)).alias(fmt), F.bool_or(rigged).alias(rigged))
    return merged, postings(df.filter(F.col(evidence).isNotNull()), key, [evidence], size)
