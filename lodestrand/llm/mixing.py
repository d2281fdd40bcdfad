"""Mixing sources to target weights by min-cost flow over membership patterns.

Equal texts are one document, a member of every source that has it. Documents are added up by the set of their sources;
a flow routes each pattern's tokens to the quotas of its sources, where the n-th use of a pattern costs more than the
one before. The flow through a pattern is then cut from a tape on which its documents lie in seeded order, pass by pass.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import cut, lookup
from .tokens import TOKENIZER, with_token_counts

BUCKETS = 4096


class _Flow:
    """Min-cost flow by successive shortest paths, in whole tokens."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> int:
        total = 0
        while True:
            far, via, queue, inside = {s: 0}, {}, deque([s]), {s}
            while queue:
                u = queue.popleft()
                inside.discard(u)
                for e in self.out[u]:
                    v = self.to[e]
                    if self.room[e] > 0 and far[u] + self.cost[e] < far.get(v, 1 << 60):
                        far[v], via[v] = far[u] + self.cost[e], e
                        if v not in inside:
                            inside.add(v)
                            queue.append(v)
            if t not in far:
                return total
            path, v = [], t
            while v != s:
                path.append(via[v])
                v = self.to[via[v] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount
            total += amount


def route(tokens: dict[tuple[str, ...], int], target: dict[str, float], repeats: dict[str, int], total: int | None = None):
    """The flow (pattern, source) -> tokens that meets ``target`` shares of the largest possible total (at most ``total``)."""
    patterns = [p for p in tokens if tokens[p] > 0 and any(s in target for s in p)]
    have = {s for p in patterns for s in p if target.get(s, 0) > 0}
    weight = sum(target[s] for s in have)
    if not have or weight <= 0:
        return {}, 0
    sources = sorted(have)
    at_p = {p: 1 + i for i, p in enumerate(patterns)}
    at_s = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)

    def solve(size: int):
        f = _Flow(end + 1)
        for p in patterns:
            for k in range(max(repeats[s] for s in p if s in have)):
                f.arc(0, at_p[p], tokens[p], k)
        mine = {(p, s): f.arc(at_p[p], at_s[s], tokens[p] * repeats[s]) for p in patterns for s in p if s in have}
        quota = {s: int(size * target[s] / weight) for s in sources}
        for s in sources:
            f.arc(at_s[s], end, quota[s])
        done = f.run(0, end)
        return done == sum(quota.values()), {k: f.room[e ^ 1] for k, e in mine.items() if f.room[e ^ 1]}

    most = sum(tokens[p] * max(repeats[s] for s in p if s in have) for p in patterns)
    low, high = 0, min(most, total) if total else most
    if solve(high)[0]:
        low = high
    while high - low > max(1, high // 10_000_000):
        mid = (low + high) // 2
        low, high = (mid, high) if solve(mid)[0] else (low, mid)
    return solve(low)[1], low


def mixed(documents: DataFrame, targets: DataFrame, seed: int = 0, total_tokens: int | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """(mix_name, source, doc_id, occurrence, n_tokens): the documents of each mix, one row for each use of one.

    Takes ``doc_id, text, source``, and few rows of ``mix_name, source, target_share, max_repeats``. Sources are
    compared trimmed and in lower case; rows with a null source or no tokens take no part. Equal texts are one document,
    named by its smallest id. Each source gets its share of the largest total its mix allows (at most ``total_tokens``),
    to within half a document at each end of a stretch; a source without documents gets none, and the others keep their
    proportions. No document is used more often for a source than its ``max_repeats``. The flow's network has a node for
    each set of wanted sources that share a document, and one for each source, whatever the number of documents.
    """
    spark: SparkSession = documents.sparkSession
    goal = targets.where("target_share > 0 and source is not null").select("mix_name", F.lower(F.trim("source")).alias("source"), "target_share", F.greatest(F.lit(1), F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    wanted = goal.select("source").distinct()
    rows = documents.where("text is not null and source is not null").select("doc_id", F.lower(F.trim("source")).alias("source"), "text")
    rows = lookup(rows, wanted, "source", "left_semi").withColumns({"h1": F.xxhash64("text"), "h2": F.hash("text")})
    sized = cut(with_token_counts(rows, "text", tokenizer).where("n_tokens > 0"))
    units = sized.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.array_sort(F.collect_set("source")).alias("pattern"))
    units = cut(units.withColumns({"spot": F.xxhash64(F.lit(seed), "h1", "h2"), "key": F.array_join("pattern", "\x1f")}).select("doc_id", "n_tokens", "key", "spot", F.shiftrightunsigned("spot", 52).cast("int").alias("bucket")))
    sums = cut(units.groupBy("key").agg(F.sum("n_tokens").alias("length")))
    tokens = {tuple(r["key"].split("\x1f")): r["length"] for r in sums.collect()}
    goals = goal.collect()
    stretches = []
    for mix in sorted({r["mix_name"] for r in goals}):
        mine = [r for r in goals if r["mix_name"] == mix]
        flow, _ = route(tokens, {r["source"]: r["target_share"] for r in mine}, {r["source"]: r["max_repeats"] for r in mine}, total_tokens)
        begin: dict[tuple, int] = {}
        for (p, s), n in sorted(flow.items()):
            a = begin.get(p, 0)
            stretches.append((mix, "\x1f".join(p), s, a, a + n))
            begin[p] = a + n
    # Where each document lies on its pattern's tape: sums over buckets first, then inside a bucket.
    by_bucket = units.groupBy("key", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    w = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket_at = by_bucket.withColumn("base", F.coalesce(F.sum("in_bucket").over(w), F.lit(0))).drop("in_bucket")
    inner = Window.partitionBy("key", "bucket").orderBy("spot", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("within", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(bucket_at, ["key", "bucket"])
    tape = placed.select("doc_id", "n_tokens", "key", (F.col("base") + F.col("within")).alias("at"))
    cuts = spark.createDataFrame(stretches, "mix_name string, key string, source string, a long, b long")
    used = lookup(lookup(tape, sums, "key", "inner", written=True), cuts, "key", "inner")
    # Passes k in which the document's middle lies in the stretch: a <= at + n / 2 + k * length < b.
    middle = F.col("at") + F.col("n_tokens") / 2
    first = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("a") - middle) / F.col("length")))
    last = F.ceil((F.col("b") - middle) / F.col("length")) - 1
    used = used.withColumns({"first": first, "last": last}).where("last >= first")
    return used.select("mix_name", "source", "doc_id", F.explode(F.sequence("first", "last")).alias("occurrence"), "n_tokens")


def mix_report(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached share, tokens, documents and most uses of one document, for each mix and source."""
    goal = targets.select("mix_name", F.lower(F.trim("source")).alias("source"), "target_share")
    uses = chosen.groupBy("mix_name", "source", "doc_id").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("tokens"))
    got = uses.groupBy("mix_name", "source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"), F.max("uses").alias("most_uses"))
    all_ = got.groupBy("mix_name").agg(F.sum("tokens").alias("all_tokens"))
    out = goal.join(got, ["mix_name", "source"], "left").join(all_, "mix_name", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("mix_name", "source", "target_share", F.round(zero(F.col("tokens")) / F.col("all_tokens"), 6).alias("reached_share"), zero(F.col("tokens")).alias("tokens"), zero(F.col("documents")).alias("documents"), zero(F.col("most_uses")).alias("most_uses"))
