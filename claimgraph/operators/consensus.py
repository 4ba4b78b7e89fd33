"""Comparing sources and reaching consensus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match, text


def text_agrees(a: Column, b: Column) -> Column:
    """Equal but for case; unknown if either is blank."""
    return F.lower(text(a)) == F.lower(text(b))


def number_agrees(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    """Within a relative tolerance; unknown if either is no number."""
    x, y = a.cast("string").try_cast("double"), b.cast("string").try_cast("double")
    return F.abs(x - y) / F.greatest(F.abs(x), F.abs(y), F.lit(1.0)) <= tolerance


def compare_sources(a: DataFrame, b: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """(key, field, a, b, agrees) of all fields; ``fields`` maps each to 'text' or 'number'."""
    left = a.select(key, *(F.col(f).alias(f"a_{f}") for f in fields))
    right = b.select(key, *(F.col(f).alias(f"b_{f}") for f in fields))
    both = left.join(right, key, "full")
    rows = []
    for f, kind in fields.items():
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        rows.append(F.struct(F.lit(f).alias("field"), text(x).alias("a"), text(y).alias("b"), (text_agrees(x, y) if kind == "text" else number_agrees(x, y)).alias("agrees")))
    return both.select(key, F.explode(F.array(*rows)).alias("c")).select(key, "c.*")


def consensus(compared: DataFrame) -> DataFrame:
    """State and preferred value of each compared field; a conflict prefers none."""
    a, b, agrees = F.col("a"), F.col("b"), F.col("agrees")
    state = first_match([(agrees, "corroborated"), (~agrees, "conflict"), (a.isNotNull() & b.isNull(), "single_source_a"), (a.isNull() & b.isNotNull(), "single_source_b"), (a.isNull() & b.isNull(), "unobserved")], "incomparable")
    return compared.withColumn("state", state).withColumn("preferred", F.when(F.col("state").isin("conflict", "incomparable"), None).otherwise(F.coalesce(a, b)))


def review_queue(states: DataFrame, key: str, errors: DataFrame | None = None) -> DataFrame:
    """Entities with a conflict or an error, and how many of each."""
    found = states.groupBy(key).agg(F.count_if(F.col("state") == "conflict").alias("conflicts"))
    if errors is not None:
        found = found.join(errors.groupBy(key).agg(F.count("*").alias("errors")), key, "full")
    else:
        found = found.withColumn("errors", F.lit(0).cast("long"))
    found = found.fillna(0, ["conflicts", "errors"])
    return found.filter((F.col("conflicts") > 0) | (F.col("errors") > 0))


def authority(entities: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame]], status: str) -> DataFrame:
    """How many evidence sources corroborate an entity; review if any is in conflict or in error."""
    out, names = entities, []
    for name, df in sources:
        out = out.join(df.groupBy(key).agg(F.max(status).alias(f"_{name}")), key, "left")
        names.append(f"_{name}")
    count = lambda value: sum((F.coalesce(F.col(n) == value, F.lit(False)).cast("int") for n in names), F.lit(0))
    out = out.withColumn("corroborating", count("corroborated")).withColumn("conflicts", count("conflict")).withColumn("errors", count("error"))
    return out.withColumn("authority", first_match([((F.col("conflicts") > 0) | (F.col("errors") > 0), "review"), (F.col("corroborating") >= 2, "authoritative"), (F.col("corroborating") == 1, "corroborated")], "unobserved")).drop(*names)


def preserve_last_good(fresh: DataFrame, prior: DataFrame, key: Sequence[str], corroborated: str, error: str, payload: Sequence[str], limited: str = "rate_limited") -> DataFrame:
    """Fresh evidence, but the prior one where the fresh was rate-limited and lost a corroboration of the same identity."""
    old = prior.select(*key, F.col(corroborated).alias("_ok"), *(F.col(p).alias(f"_{p}") for p in payload))
    out = fresh.join(old, list(key), "left")
    keep = F.coalesce((F.col(error) == limited) & ~F.coalesce(corroborated, F.lit(False)) & F.col("_ok"), F.lit(False))
    cols = [F.when(keep, F.col(f"_{p}")).otherwise(F.col(p)).alias(p) for p in payload]
    return out.select(*key, error, F.when(keep, F.lit(True)).otherwise(F.col(corroborated)).alias(corroborated), *cols, keep.alias("preserved"))


def all_failed(fresh: DataFrame, error: str) -> DataFrame:
    """One row: whether every fresh answer is an error, in which case nothing may be published."""
    return fresh.agg(F.count("*").alias("answers"), F.count_if(F.col(error).isNotNull()).alias("errors")).withColumn("fail_closed", (F.col("answers") > 0) & (F.col("answers") == F.col("errors")))
