"""What several operators share: the newest of re-delivered rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import lookup


def newest_rows(df: DataFrame, key: str, at: str) -> DataFrame:
    """One row for each ``key``: the one with the greatest ``at``.

    Only the keys delivered more than once are looked up, so wide rows are not shuffled unless very many are. Nulls of ``at`` count as
    earliest; of rows equal in ``at`` one stays, chosen by hash. Rows whose key is null are left out.
    """
    mark = F.struct(F.coalesce(F.col(at).cast("double"), F.lit(float("-inf"))), F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]))
    marked = df.where(F.col(key).isNotNull()).withColumn("_mark", mark)
    again = marked.groupBy(key).agg(F.max("_mark").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    left = lookup(marked, again, key).where("_last is null or _mark = _last")
    whole_repeats = F.col("_last").isNotNull()
    once = left.where(~whole_repeats)
    return once.unionByName(left.where(whole_repeats).dropDuplicates([key])).drop("_mark", "_last")


def pack_counts(counts: np.ndarray, block: int) -> pa.RecordBatch:
    """The non-zero blocks of an array of counters, compressed, as (block, counts)."""
    rows = counts.astype("f8").reshape(-1, block)
    some = np.flatnonzero(rows.any(axis=1))
    packed = [zlib.compress(rows[k].tobytes(), 3) for k in some]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])


def add_counts(df: DataFrame, size: int, block: int) -> np.ndarray:
    """The sum of the tasks' counters, added up block by block; the driver gets ``size`` numbers, whatever the data."""

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(block)
        for x in t.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(x), "f8")
        return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 3)], pa.binary())})

    out = np.zeros((size // block, block))
    for r in df.groupBy("block").applyInArrow(add, "block int, counts binary").collect():
        out[r[0]] = np.frombuffer(zlib.decompress(r[1]), "f8")
    return out.ravel()
