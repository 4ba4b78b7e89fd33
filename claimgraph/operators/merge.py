"""Merging, upserts, overlays and ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import text


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str, order: str | None = None, protect: Sequence[str] = ()) -> DataFrame:
    """Keyed upsert: 'replace', 'ignore' (existing rows stay), 'overwrite_if_nonblank' or 'fill' (only blank values change).

    Incoming rows are first reduced to one a key: the last by ``order``, or the smallest. Protected columns of existing rows never change.
    """
    values = [c for c in target.columns if c not in keys]
    pick = F.max_by(F.struct(*values), F.struct(F.col(order), *values)) if order else F.min(F.struct(*values))
    new = incoming.groupBy(*keys).agg(pick.alias("n"), F.lit(True).alias("_new"))
    if mode == "ignore":
        return target.unionByName(new.join(target, list(keys), "left_anti").select(*keys, "n.*").select(*target.columns))
    both = target.select(*keys, F.struct(*values).alias("o"), F.lit(True).alias("_old")).join(new, list(keys), "full")
    out = []
    for c in values:
        old, fresh = F.col(f"o.{c}"), F.col(f"n.{c}")
        blank_new, blank_old = text(fresh).isNull(), text(old).isNull()
        if c in protect:
            value = F.when(F.col("_old").isNotNull(), old).otherwise(fresh)
        elif mode == "replace":
            value = F.when(F.col("_new").isNotNull(), fresh).otherwise(old)
        elif mode == "overwrite_if_nonblank":
            value = F.when(blank_new, old).otherwise(fresh)
        elif mode == "fill":
            value = F.when(blank_old, fresh).otherwise(old)
        else:
            raise ValueError(f"unknown mode {mode}")
        out.append(value.alias(c))
    return both.select(*keys, *out).select(*target.columns)


def merge_strict(shards: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """One value a key if all shards agree; the keys on which they differ are quarantined."""
    seen = shards.groupBy(*keys).agg(F.min(value).alias(value), F.count_distinct(value).alias("values"), F.count("*").alias("shards"))
    return seen.filter("values <= 1").drop("values"), seen.filter("values > 1").drop(value)


def overlay(base: DataFrame, incoming: DataFrame, entity: str, path: str, value: str) -> DataFrame:
    """Deep fill over leaf paths: blank values (null, '', [], {}) are filled; each path is filled, preserved, same or unknown_entity."""
    blank = lambda c: text(c).isNull() | text(c).isin("[]", "{}", "null")
    left = base.select(entity, path, F.col(value).alias("old"))
    right = incoming.groupBy(entity, path).agg(F.min(value).alias("new"))
    known = base.select(entity).distinct().withColumn("_known", F.lit(True))
    both = left.join(right, [entity, path], "full").join(known, entity, "left")
    outcome = F.when(F.col("_known").isNull(), "unknown_entity").when(blank(F.col("new")), "same").when(blank(F.col("old")), "filled").when(F.col("old") == F.col("new"), "same").otherwise("preserved")
    merged = F.when(outcome == "filled", F.col("new")).otherwise(F.col("old"))
    return both.select(entity, path, merged.alias(value), outcome.alias("outcome"))


def non_destructive(base: DataFrame, leads: DataFrame, key: str, fill: Sequence[str], keep_known: Sequence[str], notes: str, unknown: Sequence[str] = ("unknown", "—")) -> DataFrame:
    """Fill blank fields, set a group only where it is unknown, append a note once; with the list of changes."""
    new = leads.groupBy(key).agg(*(F.min(c).alias(f"_{c}") for c in (*fill, *keep_known, notes)))
    out, changes, cols = base.join(new, key, "left"), [], {}
    for c in fill:
        does = text(F.col(c)).isNull() & text(F.col(f"_{c}")).isNotNull()
        cols[c] = F.when(does, F.col(f"_{c}")).otherwise(F.col(c))
        changes.append(F.when(does, F.lit(c)))
    for c in keep_known:
        does = (text(F.col(c)).isNull() | F.col(c).cast("string").isin(*unknown)) & text(F.col(f"_{c}")).isNotNull() & ~F.coalesce(F.col(f"_{c}").cast("string").isin(*unknown), F.lit(False))
        cols[c] = F.when(does, F.col(f"_{c}")).otherwise(F.col(c))
        changes.append(F.when(does, F.lit(c)))
    does = text(F.col(f"_{notes}")).isNotNull() & ~F.coalesce(F.contains(F.col(notes), F.col(f"_{notes}")), F.lit(False))
    cols[notes] = F.when(does, F.concat_ws("; ", text(F.col(notes)), F.col(f"_{notes}"))).otherwise(F.col(notes))
    changes.append(F.when(does, F.lit(notes)))
    return out.select(*(cols.get(c, F.col(c)).alias(c) for c in base.columns), F.array_compact(F.array(*changes)).alias("changes"))


def apply_decisions(df: DataFrame, key: str, decisions: DataFrame, decision: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Entities with their valid decision, or none; and the decisions that are invalid or name no entity."""
    valid = decisions.filter(F.col(decision).isin(*allowed)).groupBy(key).agg(F.min(decision).alias(decision))
    applied = df.drop(decision).join(valid, key, "left")
    known = df.select(key).distinct().withColumn("_known", F.lit(True))
    rows = decisions.join(known, key, "left")
    problem = F.when(F.col("_known").isNull(), "unknown_entity").when(~F.coalesce(F.col(decision).isin(*allowed), F.lit(False)), "invalid_decision")
    return applied, rows.withColumn("problem", problem).filter("problem is not null").drop("_known")


def evidence_ledger(reports: Sequence[tuple[str, DataFrame, Column, Column]], key: str) -> DataFrame:
    """One row per (entity, source) from reports of different shapes: (source, table, status, time)."""
    rows = None
    for source, df, status, time in reports:
        one = df.select(key, F.lit(source).alias("source"), status.cast("string").alias("status"), time.cast("timestamp").alias("seen_at"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(key, "source").agg(F.max_by("status", F.struct("seen_at", "status")).alias("status"), F.max("seen_at").alias("seen_at"), F.count("*").alias("reports"))


def materialize(df: DataFrame, key: str, research: DataFrame, field: str, value: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Research values in the entities' blank columns, research-only entities added; and the ledger of what research said."""
    wide = research.groupBy(key).agg(*(F.min(F.when(F.col(field) == f, F.col(value))).alias(f"_{f}") for f in fields))
    both = df.join(wide, key, "full")
    out = both.select(key, *(F.coalesce(text(F.col(f)), F.col(f"_{f}")).alias(f) for f in fields))
    ledger = research.filter(F.col(field).isin(*fields)).groupBy(key, field).agg(F.min(value).alias(value), F.count("*").alias("evidence"))
    return out, ledger


def reconcile(hits: DataFrame, entity: str, url: str, proven: Column, catalog: DataFrame, confirmed: Column, children: DataFrame, child_url: str) -> tuple[DataFrame, DataFrame]:
    """Complete proofs update only unconfirmed entities, by the smallest URL; children are linked on the exact URL only."""
    good = hits.filter(F.coalesce(proven, F.lit(False)))
    best = good.groupBy(entity).agg(F.min(url).alias("proof_url"))
    entities = catalog.withColumn("_confirmed", F.coalesce(confirmed, F.lit(False))).join(best, entity, "left")
    entities = entities.withColumn("outcome", F.when(F.col("proof_url").isNull(), "unchanged").when(F.col("_confirmed"), "kept_confirmed").otherwise("updated")).drop("_confirmed")
    linked = children.join(good.select(F.col(url).alias(child_url)).distinct(), child_url, "left_semi")
    return entities, linked


def cumulate(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A ledger of proofs by key in which the current run wins."""
    return upsert(previous, current, keys, "replace")


def changes(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Ledger of (key, field, old, new) for what differs."""
    left = before.select(key, *(F.col(f).cast("string").alias(f"o_{f}") for f in fields))
    right = after.select(key, *(F.col(f).cast("string").alias(f"n_{f}") for f in fields))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"o_{f}").alias("old"), F.col(f"n_{f}").alias("new")) for f in fields))
    return left.join(right, key, "full").select(key, F.explode(rows).alias("c")).select(key, "c.*").filter(~F.col("old").eqNullSafe(F.col("new")))
