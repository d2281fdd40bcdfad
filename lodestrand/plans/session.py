"""Session helpers: local sessions for tests, table loading, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, name: str = "lodestrand", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Only a local session, whose executors are
    on this machine, gets one of its own where that is unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="spark-lodestrand-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone; the cluster clears its shared folder
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the driver ends."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    atexit.register(_drop, spark, path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result's plan is a plain Parquet scan: iterative plans stay small, nothing is computed twice, and a lost
    executor costs only the tasks it ran. The files are deleted when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores: rows of a table that is read in fewer parts than there are cores are spread before costly work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df``, the result of ``cut`` or a selection from one, is read from."""
    spark = df.sparkSession
    total = 0
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def lookup(df: DataFrame, small: DataFrame, on: str | list[str], how: str = "left", broadcast_rows: int = 200_000, broadcast_bytes: int = 16 << 20, written: bool = False) -> DataFrame:
    """Join with a side that is usually small: measured, and broadcast up to ``broadcast_rows`` rows in files of
    ``broadcast_bytes``, else shuffled.

    It is written first, so that measuring doesn't compute it twice, unless it is ``written`` already.
    """
    small = small if written else cut(small)
    fits = written_bytes(small) <= broadcast_bytes and small.count() <= broadcast_rows
    return df.join(F.broadcast(small) if fits else small, on, how)
