"""Shared plumbing of the training-data operators: input tables, written tables, whole groups in Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import cut, fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Join the batches of a partition that is sorted by ``keys`` into tables that never split a group."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.concat_tables(held).combine_chunks()
        last = [whole[k][size - 1].as_py() for k in keys]
        lo, hi = 0, size - 1  # the first row of the last group, by bisection: the rows are sorted
        while lo < hi:
            mid = (lo + hi) // 2
            if [whole[k][mid].as_py() for k in keys] == last:
                hi = mid
            else:
                lo = mid + 1
        if lo:
            yield whole.slice(0, lo).combine_chunks()
            whole = whole.slice(lo)
        held, size = [whole], whole.num_rows
        rows = max(rows, 2 * size) if not lo else rows
    if size:
        yield pa.concat_tables(held).combine_chunks()


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None], schema: str, size: int = 20_000, order: list[str] | None = None) -> DataFrame:
    """Apply ``fn`` to tables of whole groups of ``keys``, sorted by ``order`` within; groups have to be bounded by the caller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, keys, size):
            out = fn(whole)
            if out is not None and out.num_rows:
                yield from out.to_batches(max_chunksize=10_000)

    n = partitions(df.sparkSession)
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(run, schema)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component_id), the smallest id of each component.

    Alternating large-star and small-star steps. Minima are aggregated before any row moves, the tables of minima are
    written and reread, so that a hub's edges meet them in a join that Spark may split. Self-loops and repeated edges
    are harmless; ids without edges have no row.
    """
    own = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    # a few hundred thousand edges a task: many small tasks would cost more than their work
    tasks = max(8, -(-own.count() // 200_000))
    slim = lambda df, name: cut(df.coalesce(tasks) if tasks < partitions(df.sparkSession) else df, name)
    for _ in range(rounds):
        if _is_star(own):
            break
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = slim(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large")
        own = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        own = slim(own, "edges")
        low = slim(own.groupBy("u").agg(F.min("v").alias("m")), "small")
        kept = own.join(low, "u")
        own = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        own = slim(own.distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = own.select(F.col("v").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return own.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)


def _is_star(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads to a root and no id has two."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


class Written:
    """A table written to the shared folder that can be deleted once a later table has taken its place."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, fresh_path(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
