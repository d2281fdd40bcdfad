"""Per-key results when a few keys hold most of the rows: exact offset chunking.

Rows are put in (key, value) order across all tasks, every task's rows are counted, a prefix sum over the tasks gives
each row its exact number, and equal runs of numbers are the chunks. A chunk holds the same number of rows whether it
belongs to one hot key or to thousands of small ones. Each chunk yields one state per key it touches; the states of a
key are merged in chunk order, where equal values on both sides of a boundary count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import cut


def numbered_chunks(df: DataFrame, order: list[str], chunk_rows: int) -> DataFrame:
    """``df`` with ``_row``, its exact number in ``order`` from 0, and ``_chunk``, that number div ``chunk_rows``.

    Nulls sort first. Ties may be numbered either way. An empty table stays empty. The only thing broadcast is one row
    for each task of the sort.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn("_row", F.col("_start") + F.col("_at"))  # one row per task
    return numbered.withColumn("_chunk", F.floor(F.col("_row") / chunk_rows)).drop("_part", "_at", "_start")


def chunk_states(counted: DataFrame, chunk_rows: int) -> DataFrame:
    """One state for each chunk and key of (k, v, n): rows, distinct non-null values, the smallest and largest value."""
    chunks = numbered_chunks(counted, ["k", "v"], chunk_rows)
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_value = chunks.repartition(parts, "_chunk").groupBy("_chunk", "k", "v").agg(F.sum("n").alias("n"))
    return by_value.groupBy("_chunk", "k").agg(F.sum("n").alias("rows"), F.count("v").alias("values"), F.min("v").alias("first"), F.max("v").alias("last"))


def key_counts(df: DataFrame, keys: list[str], value: str, chunk_rows: int = 200_000) -> DataFrame:
    """For each combination of ``keys``: ``n_rows``, and ``n_values`` as the number of distinct non-null ``value``.

    Equal (keys, value) rows are added up before the first shuffle, so repeated rows cost nothing there. Null keys are
    a group of their own; a key whose values are all null has ``n_values`` 0; an empty table has no keys. Columns beside
    keys and value are ignored, whatever their names.
    """
    k = F.struct(*[F.col(f"`{c}`") for c in keys])
    counted = df.select(k.alias("k"), F.col(f"`{value}`").alias("v")).groupBy("k", "v").agg(F.count("*").alias("n"))
    states = chunk_states(counted, chunk_rows)
    # A key's states in chunk order: a value that ends one chunk and begins the next is one value.
    before = Window.partitionBy("k").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    again = F.coalesce((F.last("last", ignorenulls=True).over(before) == F.col("first")).cast("int"), F.lit(0))
    merged = states.withColumn("again", again).groupBy("k").agg(F.sum("rows").alias("n_rows"), (F.sum("values") - F.sum("again")).cast("long").alias("n_values"))
    return merged.select("k.*", "n_rows", "n_values")
