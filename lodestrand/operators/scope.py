"""Innermost enclosing span of a line: a range join on line buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def innermost(points: DataFrame, spans: DataFrame, on: list[str], line: str, start: str, end: str, name: str, bucket: int = 64) -> DataFrame:
    """``points`` with ``name`` of the narrowest span that holds ``line`` (then the latest start, then the smallest name).

    The scope is found once for each distinct place, that is, ``on`` and ``line``, and joined back by it. A span of up to
    64 buckets stands in each bucket it touches; longer ones are compared within their file alone, so that no span makes
    many rows. Points without a span, or with a null line, get null.
    """
    s = spans.select(*on, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(name).alias("_n")).where("_s is not null and _e >= _s").distinct()
    s = s.withColumns({"_first": F.floor(F.col("_s") / bucket), "_last": F.floor(F.col("_e") / bucket)})
    short = F.col("_last") - F.col("_first") < 64
    near = s.where(short).withColumn("_b", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    far = s.where(~short).drop("_first", "_last")
    p = points.select(*on, F.col(line).alias("_l")).where("_l is not null").distinct().withColumn("_b", F.floor(F.col("_l") / bucket))
    inside = (F.col("_l") >= F.col("_s")) & (F.col("_l") <= F.col("_e"))
    place = [*on, "_l"]
    hits = p.join(near, [*on, "_b"]).where(inside).select(*place, "_s", "_e", "_n").unionByName(p.join(far, on).where(inside).select(*place, "_s", "_e", "_n"))
    best = hits.groupBy(*place).agg(F.min_by("_n", F.struct(F.col("_e") - F.col("_s"), -F.col("_s"), F.col("_n"))).alias(name))
    return points.join(best.withColumnRenamed("_l", line), [*on, line], "left").select(*points.columns, name)
