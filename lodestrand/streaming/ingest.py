"""Streams of entity files into the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.vectors import declare_table, mock_embedding, points, upsert
from ..sources.entities import ENTITY


def ingest_entities(spark: SparkSession, source: str, target: str, checkpoint: str, dimension: int = 256, files_per_batch: int = 16) -> StreamingQuery:
    """Embed and upsert every entity of the JSON lines under ``source``, in bounded batches, until none is left.

    Rows that lack a required field are left out; a batch that is run again changes nothing, and costs the work of its own
    rows only. Read the table with ``vectors.read_table``.
    """
    declare_table(spark, target, dimension)
    rows = spark.readStream.schema(ENTITY).option("mode", "FAILFAST").option("maxFilesPerTrigger", files_per_batch).json(source)

    def write(batch: DataFrame, number: int) -> None:
        p = points(batch.withColumn("updated_at", F.lit(number)), None)
        good = p.where("reason is null").withColumn("vector", mock_embedding(F.col("text"), dimension))
        upsert(target, good.drop("reason", "text"), "id", "updated_at")

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
