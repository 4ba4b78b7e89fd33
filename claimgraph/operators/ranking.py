"""Scores, orders, top-k and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import first_match
from ..functions.shared import cut

#: Fixed weights of the lead score and fixed field priorities.
LEAD_WEIGHTS = {"vrm": 8, "avatar": 5, "3d": 3, "metaverse": 2}
QUERY_HIT, BASE_SCORE = 2, 1
FIELD_PRIORITIES = {"inventory": 100, "access": 95, "status": 90, "rights": 85, "banner": 80, "logo": 80, "social": 75, "launch": 70, "description": 65, "storage": 60}
OTHER_PRIORITY = 50


def top_leads(df: DataFrame, slug: str, text: Column, query_col: str, weights: Mapping[str, int], k: int) -> DataFrame:
    """The k best leads: keyword score, the best of each lead, ties by slug, with all queries that found it."""
    low = F.lower(text)
    score = F.lit(BASE_SCORE)
    for word, weight in weights.items():
        score = score + F.when(low.contains(word), weight).otherwise(0)
    score = score + F.when(low.contains(F.lower(F.col(query_col))), QUERY_HIT).otherwise(0)
    leads = df.withColumn("score", score).groupBy(slug).agg(F.max("score").alias("score"), F.sort_array(F.collect_set(query_col)).alias("queries"))
    return leads.orderBy(F.desc("score"), slug).limit(k)


def sample_per_group(df: DataFrame, key: str, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows of each group in a fixed order."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("place") <= n)


def priority_queue(failures: DataFrame, key: str, name: str, fields: str, priorities: Mapping[str, int], plans: Mapping[str, str]) -> DataFrame:
    """Entities by their most urgent missing field, the number of fields, and name, with a plan for each field."""
    spark = failures.sparkSession
    table = F.broadcast(spark.createDataFrame([(f, p, plans.get(f)) for f, p in priorities.items()], "field string, priority int, plan string"))  # one row a field name
    rows = failures.select(key, name, F.explode(fields).alias("field")).join(table, "field", "left")
    out = rows.groupBy(key, name).agg(
        F.max(F.coalesce("priority", F.lit(OTHER_PRIORITY))).alias("priority"), F.count("*").alias("n_fields"), F.array_sort(F.collect_list(F.concat_ws(":", "field", F.coalesce("plan", F.lit("review"))))).alias("plan")
    )
    return out.orderBy(F.desc("priority"), F.desc("n_fields"), F.lower(F.col(name)))


def natural_order(c: Column) -> list[Column]:
    """Sort keys: numbers by value before texts."""
    return [F.when(c.rlike(r"^\d+$"), 0).otherwise(1), F.when(c.rlike(r"^\d+$"), c.try_cast("decimal(38,0)")), c]


def numbered(df: DataFrame, keys: Sequence[Column | str], name: str = "place") -> DataFrame:
    """``df`` with each row's place (from 1) in the order of ``keys``, which have to tell all rows apart.

    Range partitions are sorted by themselves; a partition's rows start behind the counts of those before it, and only
    these counts, one a partition, are summed up.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    rows = cut(rows.withColumn("_part", F.shiftright("_id", 33)).withColumn("_nth", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id"), "numbered")
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_nth") + 1).drop("_part", "_nth", "_before")


def strongest(df: DataFrame, key: str, rank: Column, seq: str) -> DataFrame:
    """One row a key: the strongest rank, the first seen of those."""
    cols = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(rank.alias("r"), (-F.col(seq)).alias("s"))).alias("b"))
    return best.select(key, *(F.col(f"b.{c}").alias(c) for c in cols))


def candidate_order(df: DataFrame, key: str, url: str, extensions: Sequence[str]) -> DataFrame:
    """Each key's first candidate, by extension rank and then URL, in that order."""
    low = F.lower(F.col(url))
    rank = first_match([(low.endswith(e), i) for i, e in enumerate(extensions)], len(extensions))
    out = df.groupBy(key).agg(F.min(F.struct(rank.alias("rank"), F.col(url).alias("url"))).alias("m"))
    return out.select(key, "m.rank", "m.url").orderBy("rank", "url", key)


def merge_hits(df: DataFrame, keys: Sequence[str], query: str) -> tuple[DataFrame, DataFrame]:
    """One lead a key with its queries, and the hits without a whole key."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    leads = df.filter(whole).groupBy(*keys).agg(F.count("*").alias("hits"), F.sort_array(F.collect_set(query)).alias("queries"))
    return leads, df.filter(~whole)


def distinct_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def scope_omissions(expected: DataFrame, actual: DataFrame, id_col: str, name: Column) -> DataFrame:
    """Expected leads that are absent by id and by normalised name."""
    wanted, have = expected.withColumn("name_key", name), actual.withColumn("name_key", name)
    return wanted.join(have.select(id_col), id_col, "left_anti").join(have.select("name_key").filter("name_key is not null"), "name_key", "left_anti").drop("name_key")


def union_candidates(sources: Sequence[DataFrame], key: str, status: str, tag: str) -> DataFrame:
    """Candidates of all sources: the latest source's status, and every tag once, in source order."""
    rows = None
    for i, df in enumerate(sources):
        one = df.select(key, status, tag).withColumn("source_rank", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    tags = F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("source_rank", F.col(tag).alias("t")))), lambda x: x["t"])), ",")
    return rows.groupBy(key).agg(F.max_by(status, F.struct("source_rank", status)).alias(status), tags.alias("tags"))


def merge_assets(df: DataFrame, key: Sequence[str], fmt: str, rigged: str, evidence: str, unknown: str = "unknown") -> DataFrame:
    """One asset a key: a known format beats an unknown one, rigged if any says so, all evidence once."""
    known = F.when(F.col(fmt) != unknown, F.col(fmt))
    return df.groupBy(*key).agg(F.coalesce(F.min(known), F.lit(unknown)).alias(fmt), F.bool_or(rigged).alias(rigged), F.sort_array(F.collect_set(evidence)).alias("evidence"))
