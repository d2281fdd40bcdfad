"""Connected components of an undirected graph by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.where("b < a")
    least = side.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = side.join(least, "a")
    kept = linked.where("b > a") if large else linked
    out = kept.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links; a component is named by its smallest node.

    Links with a null are left out, loops and repeated links change nothing, and an empty table gives none. Rounds grow
    with the logarithm of the size, also for long chains; each is written to the shared folder. It is an error if
    ``max_rounds`` don't suffice. Hot nodes are
    aggregated before they are joined; adaptive skew joins split what remains.
    """
    known = edges.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b")).where("a is not null and b is not null")
    loops = known.where("a = b").select("a").distinct()
    now = cut(known.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    check = F.struct(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b")))
    seen = now.select(check).first()
    for _ in range(max_rounds):
        now = cut(_star(_star(now, True), False))
        this = now.select(check).first()
        if this == seen:
            break
        seen = this
    else:
        raise RuntimeError(f"the components are not finished after {max_rounds} rounds")
    named = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("component")).join(named.select("node"), "node", "left_anti").join(heads.select("node"), "node", "left_anti")
    return named.unionByName(heads).unionByName(alone)
