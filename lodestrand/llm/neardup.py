"""Near-duplicate records with small edits: a grouped prefix join over sets of word shingles.

Shingles are ordered from rare to frequent by a sketch of their counts over all records. A record's prefix is as many
of its rarest shingles as any partner must share one of. Records with equal prefixes and sizes form one group; groups
that share a prefix shingle, and whose sizes and positions leave the threshold possible, are candidates; their members
are then filtered by parity bitmaps, which never lose a pair, and verified on the whole sets. Records with equal sets are
one class: only its representative is joined, and members are listed apart.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..plans.session import cut, lookup

SKETCH = 1 << 22  # counters of the sketch; one byte each is broadcast, whatever the data
BLOCK = 1 << 12  # counters that travel together
_WORD = re.compile("[a-z0-9_]+")
# Odd multipliers that mix word hashes into shingle hashes.
_ODD, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _sets(batch: pa.RecordBatch, width: int, least: int, seen: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of a batch's texts, ordered by row and hash, and the row of each."""
    sizes, flat = [], []
    for text in batch.column("text").to_pylist():
        w = _WORD.findall(text.lower()) if text else []
        if len(w) < least:
            w = []
        sizes.append(len(w))
        for x in w:
            h = seen.get(x)
            if h is None:
                h = seen[x] = xxhash.xxh64_intdigest(x)
            flat.append(h)
    if len(seen) > 1_000_000:
        seen.clear()
    n = np.array(sizes, "i8")
    word, row = np.array(flat, "u8"), np.repeat(np.arange(len(n)), n)
    if len(word) < width:
        return np.empty(0, "i8"), np.empty(0, "i8")
    h = np.zeros(len(word) - width + 1, "u8")
    for j in range(width):
        h = (h ^ word[j : len(h) + j]) * _ODD
        h ^= h >> np.uint64(29)
    h *= _END
    h ^= h >> np.uint64(32)
    inside = row[: len(h)] == row[width - 1 :]
    h, row = h[inside].view("i8"), row[: len(h)][inside]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.empty(0, bool)
    return h[new], row[new]


def _lists(n: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(values))


def _sketch(width: int, least: int):
    """The counts of a task, as compressed blocks of counters."""

    def run(batches):
        total, seen = np.zeros(SKETCH, "u4"), {}
        for b in batches:
            at, n = np.unique(_sets(b, width, least, seen)[0] & (SKETCH - 1), return_counts=True)
            total[at] += n.astype("u4")
        blocks = total.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        packed = [zlib.compress(blocks[k].tobytes(), 3) for k in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])

    return run


def _add_blocks(t: pa.Table) -> pa.Table:
    """One block's counts over all tasks, on a logarithmic scale of one byte."""
    total = np.zeros(BLOCK, "u8")
    for x in t.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(x), "u4")
    scale = np.minimum(255, np.round(8 * np.log2(1 + total))).astype("u1")
    return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "counts": pa.array([scale.tobytes()], pa.binary())})


BITS = 512  # of the parity bitmap of a set


def _prefixes(counts, width: int, least: int, threshold: float):
    """(id, n, whole, key, prefix, bits): the number of shingles, hashes of the set and of its prefix, the prefix's shingles
    cut to 32 bits, rarest first, and the parity of the shingles that fall on each bit."""

    def run(batches):
        freq, seen = counts.value, {}
        for b in batches:
            v, row = _sets(b, width, least, seen)
            n = np.bincount(row, minlength=b.num_rows)
            some, ends = n > 0, np.cumsum(n)
            whole = [xxhash.xxh64_intdigest(v[e - k : e].tobytes()) for e, k in zip(ends[some], n[some])]
            odd = np.bincount(row * BITS + ((v >> 22) & (BITS - 1)), minlength=b.num_rows * BITS).reshape(-1, BITS) & 1
            bits = np.packbits(odd[some].astype("u1"), axis=1).view("i8")
            order = np.lexsort((v, freq[v & (SKETCH - 1)], row))
            v, row = v[order], row[order]
            keep = np.where(some, (n - np.ceil(threshold * n - 1e-9) + 1).astype("i8"), 0)
            inside = np.arange(len(v)) - (ends - n)[row] < keep[row]
            v, row = v[inside], row[inside]
            ends = np.cumsum(keep)
            key = [xxhash.xxh64_intdigest(v[e - k : e].tobytes()) for e, k in zip(ends[some], keep[some])]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").filter(pa.array(some)), pa.array(n[some], pa.int32()), pa.array(np.array(whole, "u8").view("i8")), pa.array(np.array(key, "u8").view("i8")), _lists(keep[some], (v >> 32).astype("i4")), _lists(np.full(some.sum(), BITS // 64), bits.ravel())],
                names=["id", "n", "whole", "key", "prefix", "bits"],
            )

    return run


def _shingled(width: int, least: int):
    def run(batches):
        seen: dict[str, int] = {}
        for b in batches:
            v, row = _sets(b, width, least, seen)
            yield pa.RecordBatch.from_arrays([b.column("id"), _lists(np.bincount(row, minlength=b.num_rows), v)], names=["id", "shingles"])

    return run


def similar_classes(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, width: int = 5, min_words: int = 0, hot_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(a, b, similarity), a < b, of the classes of records with equal shingle sets whose Jaccard similarity is ``threshold``
    or more, and (id, rep) of all records with shingles: a class is named by its smallest id.

    Takes what ``similar_pairs`` takes. A prefix shingle of more than ``hot_rows`` groups is joined in blocks of groups by
    blocks of groups, so that no task gets all of them.
    """
    spark, least = df.sparkSession, max(width, min_words)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    id_type = dict(rows.dtypes)["id"]
    freq = np.zeros((SKETCH // BLOCK, BLOCK), "u1")
    for r in rows.select("text").mapInArrow(_sketch(width, least), "block int, counts binary").groupBy("block").applyInArrow(_add_blocks, "block int, counts binary").collect():
        freq[r[0]] = np.frombuffer(r[1], "u1")
    freq = freq.ravel()
    prefixed = cut(rows.mapInArrow(_prefixes(spark.sparkContext.broadcast(freq), width, least, threshold), f"id {id_type}, n int, whole long, key long, prefix array<int>, bits array<long>"))
    same = prefixed.groupBy("n", "whole").agg(F.min("id").alias("rep"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = cut(lookup(prefixed.select("id", "n", "whole"), same, ["n", "whole"], "inner").where("id <> rep").select("id", "rep"))
    reps = lookup(prefixed, copies.select("id"), "id", "left_anti", written=True)
    # Classes with equal prefixes and sizes are one group, named by its smallest id.
    crowds = reps.groupBy("n", "key").agg(F.min("id").alias("gid"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = cut(lookup(reps.select("id", "n", "key"), crowds, ["n", "key"], "inner").select("gid", "id"))
    heads = lookup(reps, members.where("gid <> id").select("id"), "id", "left_anti", written=True)
    at = heads.select(F.col("id").alias("gid"), "n", F.posexplode("prefix").alias("p", "s")).select("s", "gid", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("p").cast("long")).alias("np"))
    hot = at.groupBy("s").agg(F.count("*").alias("c")).where(F.col("c") > hot_rows).select("s", F.ceil(F.col("c") / hot_rows).cast("int").alias("blocks"))
    at = lookup(at, hot, "s").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    n, p = (lambda c: F.shiftright(c, 32)), (lambda c: F.col(c).bitwiseAND((1 << 32) - 1))
    x = at.select("s", F.col("mine").alias("i"), others.alias("j"), F.col("gid").alias("ga"), F.col("np").alias("xnp"))
    y = at.select("s", others.alias("i"), F.col("mine").alias("j"), F.col("gid").alias("gb"), F.col("np").alias("ynp"))
    xn, yn = n("xnp"), n("ynp")
    # The first shared shingle of a pair is at both positions the first of an overlap that must reach ``need``.
    need = F.lit(threshold / (1 + threshold)) * (xn + yn) - 1e-9
    room = F.least(xn - p("xnp"), yn - p("ynp"))
    met = x.join(y, ["s", "i", "j"]).where((F.col("ga") < F.col("gb")) & (room >= need) & (xn >= threshold * yn - 1e-9) & (yn >= threshold * xn - 1e-9))
    across = met.select("ga", "gb").distinct()
    pairs = across.unionByName(members.select(F.col("gid").alias("ga"), F.col("gid").alias("gb")).distinct())
    for side in ("a", "b"):
        pairs = lookup(pairs, members.withColumnsRenamed({"gid": f"g{side}", "id": side}), f"g{side}", written=True).withColumn(side, F.coalesce(side, f"g{side}"))
    pairs = cut(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # Two sets differ in at least as many shingles as their bitmaps in bits.
    maps = prefixed.select("id", "n", "bits")
    marked = pairs.join(maps.toDF("a", "na", "ba"), "a").join(maps.toDF("b", "nb", "bb"), "b")
    apart = F.aggregate(F.zip_with("ba", "bb", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, v: s + v)
    pairs = cut(marked.where(apart <= (1 - threshold) / (1 + threshold) * (F.col("na") + F.col("nb")) + 1e-9).select("a", "b"))
    named = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    known = cut(lookup(rows, named, "id", "left_semi").mapInArrow(_shingled(width, least), f"id {id_type}, shingles array<long>"))
    joined = pairs.join(known.toDF("a", "sa"), "a").join(known.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    sim = common / (F.size("sa") + F.size("sb") - common)
    classes = lookup(prefixed.select("id"), copies, "id", written=True).select("id", F.coalesce("rep", "id").alias("rep"))
    return joined.select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12), classes


def similar_pairs(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, width: int = 5, min_words: int = 0, hot_rows: int = 4096) -> DataFrame:
    """(a, b, similarity), a < b, for all pairs whose shingle sets have a Jaccard similarity of ``threshold`` or more.

    Words are the runs of ``[a-z0-9_]`` of the lower-cased text, shingles ``width`` of them in a row. ``id_col`` must be
    unique and not null; null texts, and texts with fewer than ``width`` or ``min_words`` words, have no partners. Texts
    are taken whole. An empty table gives none; other columns are ignored. No partner is left out: the sketch only
    decides the order of shingles, never which pairs are found.
    """
    linked, classes = similar_classes(df, id_col, text, threshold, width, min_words, hot_rows)
    linked = cut(linked)
    crowd = cut(classes.where("id <> rep"))
    crowd = cut(crowd.unionByName(crowd.select(F.col("rep").alias("id"), "rep").distinct()))
    within = crowd.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("similarity")).distinct()
    pairs = linked.unionByName(within).toDF("ra", "rb", "similarity")
    for side in ("a", "b"):
        pairs = lookup(pairs, crowd.toDF(side, f"r{side}"), f"r{side}", written=True).withColumn(side, F.coalesce(side, f"r{side}"))
    inner = F.col("ra") == F.col("rb")
    return pairs.where(~inner | (F.col("a") < F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")


def duplicate_groups(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, class_id, group_id, links) for every record with a partner, from ``similar_classes``: the group is the component
    of its links. Copies are counted by class and never paired."""
    linked, classes = cut(linked.select("a", "b")), cut(classes)
    size = classes.groupBy("rep").agg(F.count("*").alias("copies"))
    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = lookup(both, size.withColumnRenamed("rep", "b"), "b", "inner").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("near"))
    named = components(linked, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("group_id"))
    of_class = size.join(near, "rep", "left").join(named, "rep", "left").withColumn("links", F.col("copies") - 1 + F.coalesce("near", F.lit(0))).where("links > 0")
    told = of_class.select("rep", F.coalesce("group_id", "rep").alias("group_id"), "links")
    return classes.join(told, "rep").select("id", F.col("rep").alias("class_id"), "group_id", "links")
