"""The vector table: mock and caller-given embeddings, batches, points and idempotent upserts."""

from __future__ import annotations

import hashlib
import os
import random
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.comments import embedding_text
from ..functions.uri import identity_key, point_id
from ..plans.session import cut

REQUIRED = ["global_uri", "repo_name", "file_path", "entity_type", "entity_name", "code_text"]


def mock_embedding(text: Column, dimension: int) -> Column:
    """Repeatable numbers in [-1, 1], seeded by the MD5 of the text."""

    @F.pandas_udf("array<float>")
    def embed(s: pd.Series) -> pd.Series:
        def one(t):
            r = random.Random(int(hashlib.md5((t or "").encode()).hexdigest(), 16))
            return [r.uniform(-1, 1) for _ in range(dimension)]

        return s.map(one)

    return embed(text)


def embed_with(df: DataFrame, text: str, function: Callable[[list[str]], list[list[float]]], batch: int = 100, chars: int = 160_000) -> DataFrame:
    """``df`` with ``vector`` from ``function``, called on batches of at most ``batch`` texts and about ``chars`` characters;
    a null text is an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out: list[list[float]] = []
            texts = pdf[text].fillna("").tolist()
            for part in greedy_batches([len(t) for t in texts], batch, chars):
                got = function(texts[part])
                if len(got) != len(range(*part.indices(len(pdf)))):
                    raise ValueError("one vector for each text is needed")
                out += got
            yield pdf.assign(vector=out)

    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInPandas(run, f"{kinds}, vector array<float>")


def greedy_batches(sizes: list[int], batch: int, chars: int) -> Iterator[slice]:
    """Runs that end before an item would exceed the budget; an item above it is a run of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= batch or total + n > chars):
            yield slice(start, i)
            start, total = i, 0
        total += n
    if sizes:
        yield slice(start, len(sizes))


def points(entities: DataFrame, vector: Column | None = None, dimension: int | None = None) -> DataFrame:
    """Entities as points: id, identity key, payload and text; with ``reason`` where one must be dropped."""
    e = entities.withColumn("identity_key", identity_key("global_uri", "function_sig_hash")).withColumn("id", point_id("identity_key"))
    e = e.withColumn("text", embedding_text(F.col("docstring"), F.col("code_text")))
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    reason = F.when(missing != "", F.concat(F.lit("missing:"), missing))
    if vector is not None:
        e = e.withColumn("vector", vector)
        if dimension:
            reason = F.coalesce(reason, F.when(F.coalesce(F.size("vector"), F.lit(-1)) != dimension, "dimension_mismatch"))
    return e.withColumn("reason", reason)


def newest_points(df: DataFrame, key: str, at: str) -> DataFrame:
    """The last version of each point; of equal times one is kept, by hash."""
    w = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def declare_table(spark: SparkSession, path: str, dimension: int, recreate: bool = False) -> None:
    """Make the vector table at ``path`` for vectors of one ``dimension``. One that exists stays as it is, and may not have
    another dimension, unless ``recreate`` drops it first."""
    fs, jvm = _fs(spark, path), spark.sparkContext._jvm
    root, note = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(os.path.join(path, _NOTE))
    if recreate:
        fs.delete(root, True)
    elif fs.exists(root):
        if (known := declared_dimension(spark, path)) != dimension:
            raise ValueError(f"the table has dimension {known}, not {dimension}")
        return
    fs.mkdirs(root)
    out = fs.create(note, True)
    out.write(bytearray(str(dimension).encode()))
    out.close()


def declared_dimension(spark: SparkSession, path: str) -> int | None:
    """The dimension a table was declared with, or None if it never was."""
    note = os.path.join(path, _NOTE)
    fs, jvm = _fs(spark, path), spark.sparkContext._jvm
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(note)):
        return None
    source = fs.open(jvm.org.apache.hadoop.fs.Path(note))
    text = jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return int(text)


def upsert(path: str, new: DataFrame, key: str, at: str, buckets: int = 64) -> None:
    """Add ``new`` to the table at ``path``; for each ``key`` the row with the latest ``at`` counts, whenever it came.

    Rows are appended to the bucket of their key's hash, so that the work is that of the new rows alone, a batch that is
    written twice changes nothing, and readers see no half-written rows. ``compact`` drops what is outdated. A table that
    was declared takes vectors of its dimension only.
    """
    spark = new.sparkSession
    dimension = declared_dimension(spark, path)
    if dimension is not None:
        size = F.coalesce(F.size("vector"), F.lit(-1))
        new = new.withColumn("vector", F.when(size == dimension, F.col("vector")).otherwise(F.raise_error(F.concat(F.lit(f"a vector for a table of dimension {dimension} has "), size.cast("string")))))
    new.withColumn("_bucket", _bucket(key, buckets)).write.partitionBy("_bucket").mode("append").parquet(path)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, path: str, key: str, at: str) -> DataFrame | None:
    """The newest row of each key of an upserted table, or None before the first."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not _fs(spark, path).exists(folder) or not any(f.isDirectory() for f in _fs(spark, path).listStatus(folder)):
        return None
    return newest_points(spark.read.parquet(path).drop("_bucket"), key, at)


def compact(spark: SparkSession, path: str, key: str, at: str, buckets: int = 64, most_files: int = 16) -> None:
    """Rewrite the buckets of more than ``most_files`` files with the newest row of each key."""
    rows = spark.read.parquet(path)
    files = rows.select("_bucket", F.input_file_name().alias("f")).distinct().groupBy("_bucket").agg(F.count("*").alias("n"))
    crowded = [r["_bucket"] for r in files.where(F.col("n") > most_files).collect()]
    if crowded:
        kept = cut(newest_points(rows.where(F.col("_bucket").isin(crowded)).drop("_bucket"), key, at))
        kept.withColumn("_bucket", _bucket(key, buckets)).repartition(len(crowded), "_bucket").write.partitionBy("_bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


_NOTE = "_dimension"  # a name that readers of Parquet folders pass over


def _fs(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
