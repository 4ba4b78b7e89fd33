"""Sinks: snapshot-named outputs, sidecars and table digests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def table_digest(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row (rows, digest): a fingerprint of schema and rows that does not depend on their order.

    Rows are hashed, hashes hashed by bucket and buckets hashed once more. A bucket sums its rows' hashes instead of
    listing them, so its size does not matter, and counts them, so that repeated rows are seen.
    """
    cols = sorted(c for c in df.columns if c not in exclude)
    row = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"p{i}") for i in range(8)]
    buckets = df.select(row.alias("h")).groupBy(F.pmod(F.xxhash64("h"), F.lit(BUCKETS)).alias("b")).agg(F.count("*").alias("n"), *parts)
    whole = F.sha2(F.concat_ws("|", F.lit(";".join(f"{c}:{dict(df.dtypes)[c]}" for c in cols)), F.array_join(F.array_sort(F.collect_list(F.concat_ws(",", F.lpad(F.col("b").cast("string"), 5, "0"), "n", *(f"p{i}" for i in range(8))))), "|")), 256)
    return buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), whole.alias("digest"))


def snapshot_id(tables: Mapping[str, DataFrame], transient: Sequence[str] = ()) -> DataFrame:
    """One row (snapshot_id) over all tables but the transient ones."""
    out = None
    for name in sorted(tables):
        if name not in transient:
            one = table_digest(tables[name]).select(F.concat_ws("=", F.lit(name), "digest").alias("d"))
            out = one if out is None else out.unionByName(one)
    return out.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ";"), 256).alias("snapshot_id"))


def write_snapshot(df: DataFrame, folder: str, name: str) -> str:
    """Write the table under a name that carries its digest; the same rows always get the same path."""
    digest = table_digest(df).first()["digest"]
    path = f"{folder}/{name}.{digest[:16]}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_sidecars(df: DataFrame, key: str, folder: str) -> None:
    """One JSON partition an entity; an entity with many rows is dealt over tasks and has several files in its folder."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).json(folder)
