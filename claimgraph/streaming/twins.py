"""Structured Streaming operators and their batch twins."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.cols import first_match
from ..functions.shared import fresh_path

#: Fixed classes of the freshness policy: seconds to live; -1 never expires.
NEVER = -1


def dedup_observations(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each observation once: in a stream within the watermark, in a batch altogether."""
    if df.isStreaming:
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.groupBy(*keys).agg(F.min(F.struct(ts, *[c for c in df.columns if c not in (*keys, ts)])).alias("r")).select(*keys, "r.*").select(*df.columns)


def latest_by_key(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The last row of each key, ties to the larger ``tie``."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(ts, tie)).alias("r")).select(key, "r.*").select(*df.columns)


def latest_stream(stream: DataFrame, key: str, ts: str, tie: str, folder: str):
    """A query that keeps the latest row of each key in its state and appends the keys that changed; returns the started query.

    A batch writes ``folder/batch=<n>``, nothing but its own changes, and rewrites only that when it runs again.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return latest_by_key(stream, key, ts, tie).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{folder}_checkpoint").trigger(availableNow=True).start()


def read_latest(spark: SparkSession, folder: str, key: str, ts: str, tie: str) -> DataFrame:
    """The latest row of each key from the changes that ``latest_stream`` has appended."""
    return latest_by_key(spark.read.parquet(folder).drop("batch"), key, ts, tie)


def _finished(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers n of the tables ``folder/name=n`` that were written to their end."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = [x.getPath() for x in fs.listStatus(top) if x.getPath().getName().startswith(f"{name}=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _forget(spark: SparkSession, folder: str, name: str, below: int) -> None:
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for n in _finished(spark, folder, name):
        if n < below:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={n}"), True)


def compact(spark: SparkSession, folder: str, key: str, ts: str, tie: str) -> int | None:
    """Unite the newest base and the deltas behind it to a new base; its number, or None if there is no delta.

    A base counts from the moment its last file stands, by the marker that Spark writes then; until then readers take the
    one before, which stays, with the deltas behind it, until the new one is whole. A compaction that fails leaves nothing
    that counts, and one that is repeated writes the same rows.
    """
    bases, deltas = _finished(spark, folder, "base"), _finished(spark, folder, "batch")
    if not deltas or bases and deltas[-1] <= bases[-1]:
        return None
    read_compacted(spark, folder, key, ts, tie).write.mode("overwrite").parquet(f"{folder}/base={deltas[-1]}")
    if bases:  # the last base but one and what it held; readers that began on the last one still find it
        _forget(spark, folder, "base", bases[-1])
        _forget(spark, folder, "batch", bases[-1] + 1)
    return deltas[-1]


def compacted_stream(stream: DataFrame, key: str, ts: str, tie: str, folder: str, every: int = 16):
    """Like ``latest_stream``, with the changes compacted after each ``every`` batches; returns the started query.

    A batch that is run again writes its delta again, or nothing if a base has it already.
    """

    def put(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        bases = _finished(own, folder, "base")
        last = bases[-1] if bases else -1
        if number > last:
            batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        if number - last >= every:
            compact(own, folder, key, ts, tie)

    return latest_by_key(stream, key, ts, tie).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{folder}_checkpoint").trigger(availableNow=True).start()


def read_compacted(spark: SparkSession, folder: str, key: str, ts: str, tie: str) -> DataFrame:
    """The latest row of each key from the newest whole base and the whole deltas behind it: at most the keys and ``every`` deltas."""
    bases = _finished(spark, folder, "base")
    last = bases[-1] if bases else -1
    paths = [f"{folder}/base={last}"] if bases else []
    paths += [f"{folder}/batch={n}" for n in _finished(spark, folder, "batch") if n > last]
    if not paths:
        raise FileNotFoundError(f"no batch was written to {folder} yet")
    return latest_by_key(spark.read.parquet(*paths), key, ts, tie)


def ttl_of(kind: Column, policy: Mapping[str, int], default: int) -> Column:
    return first_match([(kind == k, v) for k, v in policy.items()], default)


def freshness(df: DataFrame, kind: str, ts: str, policy: Mapping[str, int], default: int, as_of: Column) -> DataFrame:
    """expires_at of each row by its class, and whether it is fresh at a time; classes of -1 never expire."""
    ttl = ttl_of(F.col(kind), policy, default)
    expires = F.when(ttl != NEVER, F.col(ts) + F.make_dt_interval(secs=ttl.cast("decimal(18,6)")))
    return df.withColumn("expires_at", expires).withColumn("fresh", F.col("expires_at").isNull() | (F.col("expires_at") > as_of))


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB, as timers need."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def _expiry() -> StatefulProcessor:
    """The processor of ``expiry_stream``; a local class travels whole, so a worker started without this package can load it."""

    class Expiry(StatefulProcessor):
        """Emits a key when its latest row expires; keys that never expire set no timer. Of rows of one time the longest class counts."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._seen = handle.getValueState("seen", "at long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            last, ttl = -1, 0
            for pdf in rows:
                at = int(pdf["at_ms"].max())
                if at >= last:
                    own = pdf["ttl"][pdf["at_ms"] == at]
                    longest = NEVER if (own == NEVER).any() or at == last and ttl == NEVER else max(int(own.max()), ttl if at == last else 0)
                    last, ttl = at, longest
            known = self._seen.get()[0] if self._seen.exists() else -1
            if last > known:
                for timer in list(self._handle.listTimers()):
                    self._handle.deleteTimer(timer)
                self._seen.update((last,))
                if ttl != NEVER:
                    self._handle.registerTimer(last + 1000 * ttl)
            yield pd.DataFrame({"key": [], "expired_ms": []}).astype({"key": "str", "expired_ms": "int64"})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self._seen.clear()
            yield pd.DataFrame({"key": [str(key[0])], "expired_ms": [int(expiredTimerInfo.getExpiryTimeInMs())]})

        def close(self) -> None:
            pass

    return Expiry()


def expiry_stream(stream: DataFrame, key: str, ts: str, ttl: Column, delay: str) -> DataFrame:
    """(key, expired_ms) rows as keys expire in event time."""
    rows = stream.withWatermark(ts, delay).select(F.col(key).cast("string").alias("key"), F.col(ts), F.unix_millis(ts).alias("at_ms"), ttl.cast("long").alias("ttl"))
    return rows.groupBy("key").transformWithStateInPandas(statefulProcessor=_expiry(), outputStructType="key string, expired_ms long", outputMode="append", timeMode="eventTime")


def run_once(stream: DataFrame, name: str, spark: SparkSession) -> DataFrame:
    """Run a stream over all that is there into Parquet in the shared folder, and read the result."""
    folder = fresh_path(spark, name)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
