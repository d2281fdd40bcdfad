"""The k most similar vectors of every vector: vantage-point trees per shard.

A bounded sample of the vectors are the pivots of the shards; every vector belongs to the shard of its nearest pivot
and is also a query there and in each shard the triangle inequality cannot rule out. Each shard builds a vantage-point
tree over its own vectors. Its queries go down in sets: first each to the one leaf it falls into, which bounds the distance
of its k-th neighbour, then to all leaves that this bound, which shrinks on the way, leaves open. Both pruning bounds are
divided by a factor; with factors of one nothing within the radius is lost.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import cut, lookup
from .common import newest_rows

_ROUTED = "shard long, part int, role tinyint, id string, vector array<float>, ids array<string>"
_HITS = "id string, top array<struct<s: double, other: string>>"
_OWN, _ASKS = 1, 2  # a row is a point, a query or both
_BAND = 4e-6  # what single precision may be wrong by


def usable_vectors(df: DataFrame, id_col: str, vector: str, newest: str, dim: int) -> DataFrame:
    """(id, vector) of the newest row of each id, if its vector has ``dim`` elements, none null or NaN, not all zero."""
    rows = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{newest}`").alias("at"))
    v = F.col("vector")
    good = (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return newest_rows(rows, "id", "at").where(v.isNotNull() & good).select("id", v.cast("array<float>").alias("vector"))


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), "f4").reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    d = x.astype("f8")
    d /= np.abs(d).max(axis=1, keepdims=True)  # squares of tiny or huge values stay finite
    return (d / np.sqrt((d * d).sum(axis=1, keepdims=True))).astype("f4")


def _router(pivots: np.ndarray, splits: np.ndarray, asked: np.ndarray, slack: float):
    """Rows of a batch to the shards they belong to or must search. ``splits`` and ``asked``: in how many parts the points
    and the queries of each shard are kept; each part of the points meets each part of the queries."""

    def route(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(_matrix(b.column("vector")))
            out_row, out_shard = [], []
            home = np.empty(len(x), "i4")
            for s in range(0, len(x), 4096):
                d = np.sqrt(np.maximum(0, 2 - 2 * x[s : s + 4096] @ pivots.T))
                home[s : s + 4096] = d.argmin(axis=1)
                r, c = np.nonzero(d <= d.min(axis=1, keepdims=True) + slack)
                out_row.append(r + s)
                out_shard.append(c)
            row, shard = np.concatenate(out_row), np.concatenate(out_shard)
            crowded = (splits > 1).any() or (asked > 1).any()
            spread = np.array([zlib.crc32(i.encode()) for i in b.column("id").to_pylist()]) if crowded else np.zeros(len(x), "i8")
            points, queries = splits[shard], asked[shard]
            mine, asks = spread[row] % points, spread[row] // points % queries
            of, p = _numbered(points)  # as a query, to each part of the points
            part = p * queries[of] + asks[of]
            role = _ASKS + _OWN * ((shard == home[row])[of] & (p == mine[of]))
            also, q = _numbered(np.where(shard == home[row], queries, 0))  # as a point, to the other parts of the queries
            rest = q != asks[also]
            also, q = also[rest], q[rest]
            of, part, role = np.r_[of, also], np.r_[part, mine[also] * queries[also] + q], np.r_[role, np.full(len(also), _OWN)]
            row, shard = row[of], shard[of]
            for s in range(0, len(row), 20_000):
                cut_ = slice(s, s + 20_000)
                t = b.take(pa.array(row[cut_]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[cut_], pa.int64()), pa.array(part[cut_], pa.int32()), pa.array(role[cut_], pa.int8()), t.column("id"), t.column("vector"), t.column("ids")],
                    names=["shard", "part", "role", "id", "vector", "ids"],
                )

    return route


def _numbered(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as ``n`` says, and the number of the copy."""
    return np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class _Tops:
    """The ``k`` best points of each query so far, by exact similarity and then ``rank``. Pairs are gathered up to
    ``most`` and then cut down to these, so that memory does not grow with the pairs within the radius."""

    def __init__(self, raw: np.ndarray, asks: np.ndarray, own: np.ndarray, rank: np.ndarray, k: int, floor: float, most: int = 1_000_000):
        self.raw, self.asks, self.own, self.rank, self.k, self.floor, self.most = raw, asks, own, rank, k, floor, most
        self.least = np.full(len(asks), floor - 1e-5, "f4")  # what a pair needs to count, by single precision
        self.last = np.full(len(asks), len(raw))  # rank of the last of k points that are all as near as can be
        self.q, self.p, self.sim = np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0)
        self.new, self.size = [], 0

    def add(self, qi: np.ndarray, pi: np.ndarray, sims: np.ndarray):
        """The pairs of a block, given with all their similarities."""
        ok = sims >= self.least[qi][:, None]
        last = self.last[qi]
        if (last < len(self.raw)).any():
            ok &= self.rank[self.own[pi]] < last[:, None]
        if sims.shape[1] > self.k + 1 and np.count_nonzero(ok) > 4 * self.k * len(qi):
            ok &= sims >= np.partition(sims, -self.k - 1, axis=1)[:, -self.k - 1, None] - _BAND  # one of them may be the query itself
        r, c = np.nonzero(ok)
        apart = self.asks[qi[r]] != self.own[pi[c]]
        r, c = r[apart], c[apart]
        if len(r):
            self.new.append((qi[r], pi[c], sims[r, c]))
            self.size += len(r)
            if self.size > self.most:
                self.settle()

    def settle(self):
        if not self.new:
            return
        q, p, s = (np.concatenate(x) for x in zip(*self.new))
        self.new, self.size, old = [], 0, len(self.q)
        q, p, s = np.r_[self.q, q], np.r_[self.p, p], np.r_[self.sim.astype("f4"), s]
        exact = np.r_[self.sim, np.full(len(s) - old, np.nan)]
        order = np.lexsort((-s, q))
        q, p, s, exact = q[order], p[order], s[order], exact[order]
        # The k best by single precision, and all that might tie with the last of them.
        begin, count = _runs(q)
        near = s >= np.repeat(s[np.minimum(begin + self.k, begin + count) - 1], count) - _BAND
        q, p, exact = q[near], p[near], exact[near]
        todo = np.flatnonzero(np.isnan(exact))
        for a in range(0, len(todo), 50_000):
            at = todo[a : a + 50_000]
            x, y = self.raw[self.asks[q[at]]].astype("f8"), self.raw[self.own[p[at]]].astype("f8")
            exact[at] = np.round((x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))), 6)
        ok = exact >= self.floor
        q, p, exact = q[ok], p[ok], exact[ok]
        order = np.lexsort((self.rank[self.own[p]], -exact, q))
        q, p, exact = q[order], p[order], exact[order]
        begin, count = _runs(q)
        best = np.arange(len(q)) - np.repeat(begin, count) < self.k
        self.q, self.p, self.sim = q[best], p[best], exact[best]
        full = begin[count >= self.k] + self.k - 1
        self.least[q[full]] = np.maximum(self.least[q[full]], exact[full] - _BAND)
        top = full[exact[full] >= 1]
        self.last[q[top]] = self.rank[self.own[p[top]]]


def _runs(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values begin, and how long they are."""
    begin = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, "i8")
    return begin, np.diff(np.r_[begin, len(q)])


class _Tree:
    """A vantage-point tree: nodes of (vantage point, median distance, inside, outside), and leaves of point numbers."""

    def __init__(self, p: np.ndarray, leaf: int, rng: np.random.Generator):
        self.nodes: list = [None]
        todo = [(0, np.arange(len(p)))]
        while todo:
            at, pi = todo.pop()
            self.nodes[at] = pi
            if len(pi) <= leaf:
                continue
            tries = p[rng.choice(pi, 8)]
            some = p[rng.choice(pi, min(len(pi), 512), replace=False)]
            vantage = tries[np.argmax(_distances(some, tries).std(axis=0))]
            d = _distances(p[pi], vantage)
            mu = np.median(d)
            inside = d <= mu
            if inside.all():
                continue
            n = len(self.nodes)
            self.nodes[at] = (vantage, mu, n, n + 1)
            self.nodes += [None, None]
            todo += [(n, pi[inside]), (n + 1, pi[~inside])]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Between points on the unit sphere."""
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))


def _descend(p: np.ndarray, q: np.ndarray, tops: _Tops, relax: float, leaf: int, rng: np.random.Generator) -> int:
    """Give ``tops`` the pairs (query, point) of one vantage-point tree over ``p``, and count them."""
    tree, home, compared = _Tree(p, leaf, rng), np.full(len(q), -1), 0

    def meet(at: int, qi: np.ndarray):
        pi = tree.nodes[at]
        for s in range(0, len(qi), 2048):
            block = q[qi[s : s + 2048]]
            for u in range(0, len(pi), 512):
                tops.add(qi[s : s + 2048], pi[u : u + 512], block @ p[pi[u : u + 512]].T)
        return len(pi) * len(qi)

    todo = [(0, np.arange(len(q)))]
    while todo:  # every query to the leaf it falls into
        at, qi = todo.pop()
        if not len(qi):
            continue
        if isinstance(tree.nodes[at], tuple):
            vantage, mu, inner, outer = tree.nodes[at]
            near = _distances(q[qi], vantage) <= mu
            todo += [(inner, qi[near]), (outer, qi[~near])]
        else:
            home[qi] = at
            compared += meet(at, qi)
    tops.settle()
    todo = [(0, np.arange(len(q)))]
    while todo:  # and to the others that may hold something nearer than its k-th neighbour so far
        at, qi = todo.pop()
        if not len(qi):
            continue
        if isinstance(tree.nodes[at], tuple):
            vantage, mu, inner, outer = tree.nodes[at]
            d = _distances(q[qi], vantage)
            slack = np.sqrt(np.maximum(0, 2 - 2 * tops.least[qi])) / relax + 1e-3 / relax
            todo += [(inner, qi[d <= mu + slack]), (outer, qi[d >= mu - slack])]
        else:
            compared += meet(at, qi[home[qi] != at])
    tops.settle()
    return compared


def _search(k: int, floor: float, relax: float, leaf: int):
    def shard(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        role = t.column("role").to_numpy()
        ids = t.column("id").to_numpy(zero_copy_only=False)
        raw = _matrix(t.column("vector"))
        unit = _unit(raw)
        at, asks = np.flatnonzero(role & _OWN), np.flatnonzero(role & _ASKS)
        rank = np.empty(len(ids), "i8")
        rank[np.argsort(ids)] = np.arange(len(ids))
        tops = _Tops(raw, asks, at, rank, k, floor)
        if len(at):
            _descend(unit[at], unit[asks], tops, relax, leaf, np.random.default_rng(len(at)))
        q, p, sim = asks[tops.q], at[tops.p], tops.sim
        groups = t.column("ids").to_pylist() if t.column("ids").null_count < len(t) else None
        if groups:  # the smallest ids of equal vectors stand for the group
            reach = [groups[i] or [ids[i]] for i in p]
            n = np.array([len(x) for x in reach], "i8")
            q, sim, other = np.repeat(q, n), np.repeat(sim, n), np.array([i for x in reach for i in x], object)
        else:
            other = ids[p]
        out = pd.DataFrame({"q": q, "s": -sim, "other": other}).sort_values(["q", "s", "other"]).groupby("q", sort=False).head(k + 1)
        q = out["q"].to_numpy()
        begin = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, "i8")
        struct = pa.StructArray.from_arrays([pa.array(out["s"], pa.float64()), pa.array(out["other"], pa.string())], names=["s", "other"])
        top = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(q)], pa.int32()), struct)
        return pa.table({"id": pa.array(ids[q[begin]], pa.string()), "top": top})

    return shard


def most_similar(
    vectors: DataFrame, k: int = 5, min_similarity: float = -1.0, relax_route: float = 13.0, relax_tree: float = 5.5, shard_rows: int = 8192, least_shards: int = 16, max_pivots: int = 65_536, leaf: int = 64
) -> DataFrame:
    """(id, other, sim) of the ``k`` most similar other vectors of each of (id, vector), nearest first in rank order.

    ``sim`` is the cosine in double, rounded to 6 decimals; ties go to the smaller id; pairs below ``min_similarity``
    are left out. Ids must be unique and vectors usable (see ``usable_vectors``). Equal vectors are searched once: the
    k + 1 smallest ids of a group stand for it, and every member gets its own result. An empty table gives none.

    ``min_similarity`` bounds the search radius. ``relax_route`` and ``relax_tree`` divide the bounds of the shards and of
    the trees; 1 and 1 make the search exact. The shards' pivots are a sample of one row in ``shard_rows``, or of
    ``least_shards`` of 800 rows or more, at most ``max_pivots``, and how crowded they are is told by 16 more rows for each,
    at most 262,144; all rows are indexed and all are queries. The points and the queries of a shard of more than four
    times the usual size are kept in parts, and each part of the points is searched by each part of the queries; so shards
    may hold any number of rows beyond ``max_pivots`` of them.
    """
    spark = vectors.sparkSession
    v = vectors.select("id", "vector")
    hashed = v.select("id", F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2"))
    groups = hashed.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = cut(lookup(hashed, groups, ["h1", "h2"], "inner").select("id", "rep"))
    firsts = _smallest(members, k + 1)
    n = v.count()
    if not n:
        return spark.createDataFrame([], "id string, other string, sim double")
    m = min(max_pivots, max(1, -(-n // shard_rows), min(least_shards, n // 800)))
    sample = _unit(_matrix(v.orderBy(F.xxhash64(F.lit(7), "id"), "id").limit(min(17 * m, m + 262_144)).select("vector").toArrow().column("vector")))
    pivots, radius = sample[:m], math.sqrt(max(0.0, 2 - 2 * min_similarity))
    slack, splits, asked = 2 * radius / relax_route, np.ones(m, "i8"), np.ones(m, "i8")
    if m > 1 and len(sample) > m:  # how crowded the shards are, by a sample of their rows
        own, visits = np.zeros(m, "i8"), np.zeros(m, "i8")
        for s in range(m, len(sample), 4096):
            d = np.sqrt(np.maximum(0, 2 - 2 * sample[s : s + 4096] @ pivots.T))
            own += np.bincount(d.argmin(axis=1), minlength=m)
            visits += (d <= d.min(axis=1, keepdims=True) + slack).sum(axis=0)
        part = (len(sample) - m) * 4 * max(1, min(shard_rows, -(-n // m))) / n
        splits, asked = np.maximum(1, np.ceil(own / part)).astype("i8"), np.maximum(1, np.ceil(visits / part)).astype("i8")
    reps = lookup(lookup(v, members.where("id <> rep").select("id"), "id", "left_anti", written=True), firsts, "id")
    routed = reps.select("id", "vector", "ids").mapInArrow(_router(pivots, splits, asked, slack), _ROUTED)
    hits = routed.groupBy("shard", "part").applyInArrow(_search(k, min_similarity, relax_tree, leaf), _HITS)
    # A group's own ids are hits of each other.
    own = firsts.select("id", F.transform("ids", lambda i: F.struct(F.lit(-1.0).alias("s"), i.alias("other"))).alias("top"))
    merged = hits.unionByName(own).groupBy("id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("top")))), 1, k + 1).alias("top"))
    everyone = lookup(merged, members.withColumnsRenamed({"id": "member", "rep": "id"}), "id", written=True)
    named = everyone.select(F.coalesce("member", "id").alias("id"), "top")
    each = named.select("id", F.explode(F.slice(F.filter("top", lambda x: x["other"] != F.col("id")), 1, k)).alias("x"))
    return each.select("id", F.col("x.other").alias("other"), (-F.col("x.s")).alias("sim"))


def _smallest(members: DataFrame, k: int) -> DataFrame:
    """(id, ids): the ``k`` smallest ids of each group, under its smallest; a hot group is cut down in parts first."""
    w = Window.partitionBy("rep", "_p").orderBy("id")
    few = members.withColumn("_p", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return few.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k).alias("ids")).withColumnRenamed("rep", "id")
