"""Parent-child links to full hierarchies: contract fragments, solve the smaller quotient forest, expand.

Links are spread over fragments. Inside a fragment every chain of parents is followed to its exit, the first node that
lives in another fragment or has no parent. Only nodes that are an exit of some other fragment remain in the quotient
forest, whose links are the contracted chains; it is solved the same way until it fits one fragment. Expanding joins
each node with the solution of its exit.

A node lives beside its parent if a coin, tossed for the parent by hash, says so, else at its own hash. A parent with
coin 0 whose own parent has coin 1 has all children beside it and leaves the quotient; that is a quarter of the nodes
a round however deep the chains are. Parents with very many children are never gathered: their children stay at their
own hashes. Childless nodes take no part in the rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut

ON_CYCLE, TO_CYCLE = -1, -2
_SOLVED = "node string, exit string, w long, low string, code int, root string, path array<string>"


def _solve_fragment(pdf: pd.DataFrame, paths: bool) -> pd.DataFrame:
    """Follow all chains of one fragment by pointer doubling."""
    node, parent = pdf["node"].to_numpy(object), pdf["parent"].to_numpy(object)
    n = len(node)
    at = pd.Series(np.arange(n), index=node)
    nxt = at.reindex(parent).fillna(-1).to_numpy("int64")
    names, low = np.unique(pdf["low"].to_numpy(object).astype(str), return_inverse=True)
    first, dist, end = nxt.copy(), pdf["w"].to_numpy("int64").copy(), np.arange(n)
    for _ in range(max(1, int(n).bit_length()) + 1):
        go = np.flatnonzero(nxt >= 0)
        if not len(go):
            break
        to = nxt[go]
        dist[go], low[go], end[go], nxt[go] = dist[go] + dist[to], np.minimum(low[go], low[to]), end[to], nxt[to]
    code = np.zeros(n, "int32")
    loops = nxt >= 0  # never left the fragment: on a cycle, or led into one
    code[loops] = TO_CYCLE
    code[np.unique(nxt[loops])] = ON_CYCLE
    root = np.full(n, None, object)
    root[loops] = names[low[nxt[loops]]]
    exits = np.where(loops, None, parent[np.where(loops, 0, end)] if n else parent)
    out = pd.DataFrame({"node": node, "exit": exits, "w": dist, "low": names[low] if n else low, "code": code, "root": root})
    if paths:
        steps: list[list | None] = [None] * n
        own = pdf["path"].to_numpy(object)
        for i in np.argsort(np.where(loops, np.iinfo("int64").max, dist), kind="stable"):
            if not loops[i]:
                steps[i] = list(own[i]) + (steps[first[i]] if first[i] >= 0 else [])
        out["path"] = steps
    else:
        out["path"] = None
    return out


def _mark_cycle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a fragment's chains that end in a cycle: the nodes behind an entry that is on the cycle are on it too."""
    pdf = pdf.sort_values("w", ascending=False)
    on = dict(zip(pdf["node"], pdf["on_cycle"]))
    for node, parent in zip(pdf["node"], pdf["parent"]):
        if on[node] and parent in on:
            on[parent] = True
    return pd.DataFrame({"node": list(on), "on_cycle": list(on.values())})


def _fragments(links: DataFrame, parts: int, level: int, fragment_rows: int) -> DataFrame:
    if parts == 1:
        return links.withColumn("frag", F.lit(0))
    coin = lambda c: F.xxhash64(F.lit(level), c).bitwiseAND(1)
    crowded = links.groupBy("parent").agg(F.count("*").alias("_c")).where(F.col("_c") > max(1, fragment_rows // 10)).select("parent", F.lit(True).alias("_crowded"))
    beside = (coin(F.col("parent")) == 0) & F.col("_crowded").isNull()
    anchor = F.when(beside, F.col("parent")).otherwise(F.col("node"))
    return links.join(crowded, "parent", "left").withColumn("frag", F.pmod(F.xxhash64(F.lit(level), anchor), F.lit(parts)).cast("int")).drop("_crowded")


def _solve(links: DataFrame, level: int, paths: bool, fragment_rows: int, least: int) -> DataFrame:
    """(node, root, depth, path) of every node of ``links`` (node, parent, w, low, path); path leads up, root last."""
    count = links.count()
    parts = 1 if level and count <= fragment_rows else max(least, -(-2 * count // fragment_rows))
    placed = cut(_fragments(links, parts, level, fragment_rows))
    local = cut(
        placed.groupBy("frag").applyInPandas(lambda k, pdf: _solve_fragment(pdf, paths).assign(frag=np.int32(k[0])), _SOLVED + ", frag int")
    )
    if parts == 1:
        return local.select(
            "node",
            F.coalesce("root", "exit").alias("root"),
            F.when(F.col("code") < 0, F.col("code").cast("long")).otherwise(F.col("w")).alias("depth"),
            F.when(F.col("code") == 0, F.concat("path", F.array("exit"))).alias("path"),
        )
    targets = local.where("exit is not null").select(F.col("exit").alias("node")).distinct()
    quotient = local.where("exit is not null").join(targets, "node", "left_semi").select("node", F.col("exit").alias("parent"), "w", "low", "path")
    upper = cut(_solve(cut(quotient), level + 1, paths, fragment_rows, least))
    up = upper.select(F.col("node").alias("exit"), F.col("root").alias("u_root"), F.col("depth").alias("u_depth"), F.col("path").alias("u_path"))
    met = local.join(up, "exit", "left")
    into = F.coalesce(F.col("u_depth") < 0, F.lit(False))
    done = met.select(
        "node",
        F.coalesce("root", "u_root", "exit").alias("root"),
        F.when(F.col("code") < 0, F.col("code").cast("long"))
        .when(into, F.lit(TO_CYCLE).cast("long"))
        .otherwise(F.col("w") + F.coalesce("u_depth", F.lit(0)))
        .alias("depth"),
        F.when((F.col("code") == 0) & ~into, F.concat("path", F.coalesce("u_path", F.array("exit")))).alias("path"),
    )
    # A chain may end at a node that one fragment alone found to be on, or before, a cycle.
    loops = local.where("code < 0").select(F.col("node").alias("root"), F.col("root").alias("_loop"))
    done = done.join(loops, "root", "left")
    ended = F.col("_loop").isNotNull() & (F.col("depth") >= 0)
    done = done.select(
        "node",
        F.when(ended, F.col("_loop")).otherwise(F.col("root")).alias("root"),
        F.when(ended, F.lit(TO_CYCLE).cast("long")).otherwise(F.col("depth")).alias("depth"),
        F.when(~ended, F.col("path")).alias("path"),
    )
    # Cycles that cross fragments: what lies between an entry on the cycle and that entry's exit is on it too.
    ring = upper.where(F.col("depth") == ON_CYCLE).select("node", F.lit(True).alias("on_cycle"))
    suspects = met.where((F.col("code") == 0) & (F.col("u_depth") == ON_CYCLE)).select("frag", "node", "w")
    marked = (
        suspects.join(placed.select("node", "parent"), "node")
        .join(ring, "node", "left")
        .withColumn("on_cycle", F.coalesce("on_cycle", F.lit(False)))
        .groupBy("frag")
        .applyInPandas(_mark_cycle, "node string, on_cycle boolean")
        .where("on_cycle")
    )
    return done.join(marked, "node", "left").select("node", "root", F.when(F.col("on_cycle"), F.lit(ON_CYCLE).cast("long")).otherwise(F.col("depth")).alias("depth"), "path")


def resolve(links: DataFrame, child: str, parent: str, paths: bool = False, fragment_rows: int = 200_000, least_fragments: int = 8) -> DataFrame:
    """One row (node, root, depth, path) for every node that occurs in ``links``.

    ``depth`` is the distance to the root (0 for a root). Nodes on a cycle have depth -1, nodes leading into one -2;
    for both ``root`` is the cycle's smallest node. ``path`` runs from the root to the node and is null at or before a
    cycle, and everywhere unless ``paths`` is set. Rows with a null on either side are left out; repeated rows count
    once; of several parents of a node the smallest is followed (``descendants`` takes all); a node that is its own parent is a cycle of one. An
    empty table gives an empty result; other columns are ignored. No task holds more than about ``fragment_rows`` links.
    """
    pairs = links.select(F.col(f"`{child}`").cast("string").alias("node"), F.col(f"`{parent}`").cast("string").alias("parent")).where("node is not null and parent is not null")
    one = cut(pairs.groupBy("node").agg(F.min("parent").alias("parent")))
    inner_names = one.select(F.col("parent").alias("node")).distinct()
    inner = one.join(inner_names, "node", "left_semi")
    own = F.array("node") if paths else F.lit(None).cast("array<string>")
    solved = cut(_solve(inner.select("node", "parent", F.lit(1).cast("long").alias("w"), F.col("node").alias("low"), own.alias("path")), 0, paths, fragment_rows, least_fragments))
    up = solved.select(F.col("node").alias("parent"), F.col("root").alias("u_root"), F.col("depth").alias("u_depth"), F.col("path").alias("u_path"))
    leaves = one.join(inner_names, "node", "left_anti").join(up, "parent", "left")
    into = F.coalesce(F.col("u_depth") < 0, F.lit(False))
    leaf_path = F.when(~into, F.concat(F.array("node"), F.coalesce("u_path", F.array("parent")))) if paths else F.lit(None).cast("array<string>")
    bottom = leaves.select(
        "node",
        F.coalesce("u_root", "parent").alias("root"),
        F.when(into, F.lit(TO_CYCLE).cast("long")).otherwise(F.coalesce("u_depth", F.lit(0)) + 1).alias("depth"),
        leaf_path.alias("path"),
    )
    roots = inner_names.join(one, "node", "left_anti").select("node", F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"), (F.array("node") if paths else F.lit(None).cast("array<string>")).alias("path"))
    out = solved.unionByName(bottom).unionByName(roots)
    return out.withColumn("depth", F.col("depth").cast("int")).withColumn("path", F.reverse("path"))


def descendants(resolved: DataFrame, links: DataFrame | None = None, child: str = "child", parent: str = "parent") -> DataFrame:
    """(ancestor, descendant, distance) for every node below another, from ``resolve(..., paths=True)``; cycles have none.

    With the ``links`` themselves, nodes with several parents are below all of them, at the least distance: what the paths
    say is composed with the links they don't follow until nothing changes. Without such links this costs one look.
    """
    n = F.size("path")
    up = resolved.where("path is not null").select(F.col("node").alias("descendant"), n.alias("_n"), F.posexplode("path").alias("_at", "ancestor"))
    below = up.where("ancestor <> descendant").select("ancestor", "descendant", (F.col("_n") - 1 - F.col("_at")).alias("distance"))
    if links is None:
        return below
    pairs = links.select(F.col(f"`{child}`").alias("c"), F.col(f"`{parent}`").alias("p")).where("c is not null and p is not null and c <> p").distinct()
    several = pairs.groupBy("c").agg(F.count("*").alias("k")).where("k > 1").select("c")
    followed = below.where("distance = 1").select(F.col("descendant").alias("c"), F.col("ancestor").alias("p"))
    extra = cut(pairs.join(several, "c", "left_semi").join(followed, ["c", "p"], "left_anti"))
    if extra.isEmpty():
        return below
    below = cut(below)
    self_ = extra.select(F.col("c").alias("x")).unionByName(extra.select(F.col("p").alias("x"))).distinct()
    near = cut(below.unionByName(self_.select(F.col("x").alias("ancestor"), F.col("x").alias("descendant"), F.lit(0).alias("distance"))))
    over = near.select(F.col("descendant").alias("p"), "ancestor", F.col("distance").alias("above"))
    known = below
    front = near
    while True:
        crossed = front.select(F.col("ancestor").alias("c"), "descendant", "distance").join(extra, "c").join(over, "p").select("ancestor", "descendant", (F.col("distance") + 1 + F.col("above")).alias("distance"))
        least = crossed.where("ancestor <> descendant").groupBy("ancestor", "descendant").agg(F.min("distance").alias("distance"))
        better = least.join(known.withColumnRenamed("distance", "had"), ["ancestor", "descendant"], "left").where("had is null or distance < had").drop("had")
        front = cut(better)
        if front.isEmpty():
            return known
        known = cut(known.unionByName(front).groupBy("ancestor", "descendant").agg(F.min("distance").alias("distance")))
