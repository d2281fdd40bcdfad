"""Queries over the code graph and the vector table."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from threading import Timer

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import cut, lookup

RELATIONSHIPS = ("CALLS", "INHERITS", "OVERRIDES", "USES_TYPE")


def relationships(wanted: list[str] | None) -> list[str]:
    """Upper-cased, known, in order, once each; None stands for all."""
    if wanted is None:
        return list(RELATIONSHIPS)
    out = list(dict.fromkeys(x.upper() for x in wanted))
    if bad := [x for x in out if x not in RELATIONSHIPS]:
        raise ValueError(f"unknown relationships {bad}")
    return out


def blast_radius(edges: DataFrame, roots: DataFrame, max_depth: int = 5, upstream: bool = True, wanted: list[str] | None = None) -> DataFrame:
    """(node, depth, chain): what reaches the roots (or is reached), with its least distance and relationship chain.

    ``edges`` has (src, tgt, relationship_type), ``roots`` one column ``node``. The roots are left out; of several
    shortest chains the smallest counts. Each level is one pass over the links, with what it
    found written to the shared folder; a level that finds nothing ends the search.
    """
    if max_depth < 1:
        raise ValueError("max_depth must be at least 1")
    a, b = ("tgt", "src") if upstream else ("src", "tgt")
    kinds = relationships(wanted)
    links = cut(edges.where(F.col("relationship_type").isin(*kinds) if kinds else F.lit(False)).select(F.col(a).alias("node"), F.col(b).alias("next"), "relationship_type").where("node is not null and next is not null").distinct())
    seen = roots.select("node").distinct().withColumns({"depth": F.lit(0), "chain": F.array().cast("array<string>")})
    front = seen = cut(seen)
    for depth in range(1, max_depth + 1):
        met = lookup(links, front.select("node", "chain"), "node", "inner", written=True)
        step = met.groupBy("next").agg(F.min(F.concat("chain", F.array("relationship_type"))).alias("chain"))
        found = step.select(F.col("next").alias("node"), F.lit(depth).alias("depth"), "chain")
        front = cut(found.join(seen.select("node"), "node", "left_anti"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen.where("depth > 0")


def in_repository(found: DataFrame, nodes: DataFrame, repo: str | None, node: str = "node", key: str = "identity_key") -> DataFrame:
    """Results whose node belongs to ``repo``, all if it is None. The walk itself may have passed through others."""
    if repo is None:
        return found
    mine = nodes.where(F.col("repo_name") == repo).select(F.col(key).alias(node)).distinct()
    return found.join(mine, node, "left_semi")


def closure(links: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor, depth) for everything above a node by any of its parents, with the least distance.

    Each round joins what is known with itself, so that rounds grow with the logarithm of the depth; it ends on cycles too,
    where a node is its own ancestor. Links with a null are left out, repeated ones count once.
    """
    known = links.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth")).where("node is not null and ancestor is not null").distinct()
    known, before = cut(known), None
    while True:
        below, above = known.withColumnsRenamed({"ancestor": "via", "depth": "d"}), known.withColumnsRenamed({"node": "via", "depth": "e"})
        further = below.join(above, "via").select("node", "ancestor", (F.col("d") + F.col("e")).alias("depth"))
        known = cut(known.unionByName(further).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")))
        now = known.agg(F.count("*"), F.sum("depth")).first()
        if now == before:
            return known
        before = now


def inheritance(links: DataFrame, child: str, parent: str, limit: int = 200, root: str | None = None) -> DataFrame:
    """(uri, relation, other, depth): the first ``limit`` ancestors and descendants of ``root``, or of every type, by depth
    and then by name."""
    all_ = closure(links, child, parent) if root is None else None
    if root is not None:
        edges = links.select(F.col(child).alias("src"), F.col(parent).alias("tgt"), F.lit("INHERITS").alias("relationship_type"))
        at = links.sparkSession.createDataFrame([(root,)], "node string")
        side = lambda up: blast_radius(edges, at, 2**31 - 2, upstream=up).select(F.lit(root).alias("uri"), F.lit("descendant" if up else "ancestor").alias("relation"), F.col("node").alias("other"), "depth")
        both = side(False).unionByName(side(True))
    else:
        both = all_.select(F.col("node").alias("uri"), F.lit("ancestor").alias("relation"), F.col("ancestor").alias("other"), "depth")
        both = both.unionByName(all_.select(F.col("ancestor").alias("uri"), F.lit("descendant").alias("relation"), F.col("node").alias("other"), "depth"))
    w = Window.partitionBy("uri", "relation").orderBy("depth", "other")
    return both.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit).drop("_r")


def neighbors(edges: DataFrame, node: str, limit: int = 200) -> DataFrame:
    """(direction, relationship_type, neighbor) one step away, at most ``limit`` each way, in order."""
    def side(name: str, here: str, there: str) -> DataFrame:
        return edges.where(F.col(here) == node).select(F.lit(name).alias("direction"), "relationship_type", F.col(there).alias("neighbor")).distinct().orderBy("relationship_type", "neighbor").limit(limit)

    return side("inbound", "tgt", "src").unionByName(side("outbound", "src", "tgt"))


def page(rows: DataFrame, size: int, cursor: str | None = None) -> tuple[DataFrame, str | None]:
    """One page of (depth, node, ...) in order, and the cursor behind it if more follow."""
    if size < 1:
        raise ValueError("a page has at least one row")
    if cursor is not None:
        depth, _, key = cursor.partition("|")
        if not depth.isdigit() or not key:
            raise ValueError("bad cursor")
        d = F.lit(int(depth))
        rows = rows.where((F.col("depth") > d) | ((F.col("depth") == d) & (F.col("node") > key)))
    ahead = cut(rows.orderBy("depth", "node").limit(size + 1))
    shown = ahead.orderBy("depth", "node").limit(size)
    if ahead.count() <= size:
        return shown, None
    last = shown.orderBy(F.desc("depth"), F.desc("node")).first()
    return shown, f"{last['depth']}|{last['node']}"


def resolve_root(nodes: DataFrame, **selector: str | None) -> tuple[str, list[str]]:
    """Status and identity keys of the one node selected by identity_key, global_uri, or scip_symbol (with owner_repo)."""
    given = {k: v for k, v in selector.items() if v is not None}
    if len(given.keys() - {"owner_repo"}) != 1 or "owner_repo" in given and "scip_symbol" not in given:
        raise ValueError("give exactly one of identity_key, global_uri, scip_symbol (with owner_repo)")
    found = nodes
    for k, v in given.items():
        found = found.where(F.col(k) == v)
    keys = sorted(r[0] for r in found.select("identity_key").distinct().collect())
    return ("missing_root" if not keys else "ok" if len(keys) == 1 else "ambiguous_root"), keys


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double; null if either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(points: DataFrame, query: list[float], vector: str, id_col: str, k: int = 3, payload: list[str] | None = None) -> DataFrame:
    """The ``k`` points nearest to one query vector: (id, score) and the payload, best first."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = points.where(F.size(vector) == len(query)).select(id_col, F.round(cosine(F.col(vector), q), 6).alias("score"), *(payload or []))
    return scored.where("score is not null and not isnan(score)").orderBy(F.desc("score"), id_col).limit(k)


def ask(points: DataFrame, question: str, function: Callable[[list[str]], list[list[float]]], vector: str, id_col: str, payload: list[str], k: int = 3) -> DataFrame:
    """The ``k`` points nearest to a question in words, embedded by ``function``: (id, score) and the payload, best first."""
    return top_k(points, function([question])[0], vector, id_col, k, payload)


@contextmanager
def time_limit(spark: SparkSession, seconds: float, group: str | None = None):
    """Cancel the jobs of the block when it takes longer."""
    name = group or f"limited-{time.time_ns()}"
    spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
    timer = Timer(seconds, lambda: spark.sparkContext.cancelJobGroup(name))
    timer.start()
    try:
        yield
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
