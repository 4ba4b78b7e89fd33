"""Tables written to the shared folder, where a lineage ends."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, it is a temporary folder if all runs in one process. On a cluster it is a folder in the
    warehouse, unless that lies on the machines' own disks, where executors would not find each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="claimgraph-")
        return _LOCAL[context.applicationId]
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
        raise ValueError("name a folder that all machines share in spark.checkpoint.dir: the warehouse is on a local disk")
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/claimgraph/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and a lost executor costs no rework."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, hours: float = 24.0) -> int:
    """Delete the tables in the shared folder that are older than ``hours``; run it when no query that wrote them still runs.

    Results that have not been written elsewhere read such tables, so none is deleted as long as it may be needed.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/claimgraph")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x.getPath() for x in fs.listStatus(top) if x.getModificationTime() < (time.time() - 3600 * hours) * 1000] if fs.exists(top) else []
    return sum(bool(fs.delete(p, True)) for p in old)
