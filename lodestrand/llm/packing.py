"""Filling fixed-capacity containers: online best fit with a fixed number of open containers.

Items are spread over tasks; each task keeps a bounded number of containers open, found by free space in a bitset. An
item goes where the least room is left over; when none of them has room and all may be open, the fullest is closed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut


def best_fit(sizes: list[int], capacity: int, open_bins: int) -> list[int]:
    """The container of each size (at most ``capacity``), numbered from 0 in the order they were opened."""
    free: dict[int, list[int]] = {}  # free space to the open containers that have it
    bits, count, made, out = 0, 0, 0, []
    for size in sizes:
        room = bits >> size
        if room:
            space = size + (room & -room).bit_length() - 1
            bin_ = free[space].pop()
            if not free[space]:
                del free[space]
                bits &= ~(1 << space)
        else:
            if count == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                free[fullest].pop()
                if not free[fullest]:
                    del free[fullest]
                    bits &= ~(1 << fullest)
                count -= 1
            bin_, space = made, capacity
            made += 1
            count += 1
        out.append(bin_)
        left = space - size
        if left:
            free.setdefault(left, []).append(bin_)
            bits |= 1 << left
        else:
            count -= 1  # full, so closed
    return out


def _pack(open_bins: int):
    def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "item", "piece"], kind="stable")
        capacity = int(pdf["capacity"].iloc[0])
        pdf["bin"] = best_fit(pdf["n_tokens"].tolist(), capacity, open_bins)
        return pdf[["pack_name", "capacity", "part", "bin", "item", "piece", "start_token", "n_tokens"]]

    return group


def packed(items: DataFrame, specs: DataFrame, id_col: str, size: str, open_bins: int = 64, tokens_per_task: int = 4_000_000) -> DataFrame:
    """(pack_name, capacity, container, item, piece, start_token, n_tokens): where each item lies, for each pack.

    ``items`` has ids and sizes, ``specs`` at most 1000 rows of
    ``pack_name, capacity_tokens``. An item longer than a container
    is cut into full pieces and a rest; no other is cut. Items of size 0 or null take no room and are left out; null or
    non-positive capacities give no pack. Repeated rows are items of their own. No container exceeds its capacity, and
    at most ``open_bins`` containers of a task stay partly filled for want of further items. A task takes about
    ``tokens_per_task`` tokens, in the order of a hash of the ids.
    """
    sized = cut(items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{size}`").cast("long").alias("size")).where(F.col(f"`{size}`") > 0))
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(1, -(-total // tokens_per_task))
    wanted = specs.where("pack_name is not null and capacity_tokens > 0").select("pack_name", F.col("capacity_tokens").cast("int").alias("capacity")).distinct().limit(1001).collect()
    if len(wanted) > 1000:
        raise ValueError("more than 1000 packs")
    packs = [F.struct(F.lit(r[0]).alias("pack_name"), F.lit(r[1]).alias("capacity")) for r in wanted]
    each = sized.withColumn("pack", F.explode(F.array(*packs) if packs else F.lit(None).cast("array<struct<pack_name:string,capacity:int>>"))).select("item", "size", "pack.*")
    order = F.xxhash64("item")
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / F.col("capacity")).cast("int"))))
    pieces = pieces.withColumn("start_token", F.col("piece").cast("long") * F.col("capacity"))
    pieces = pieces.withColumn("n_tokens", F.least(F.col("capacity").cast("long"), F.col("size") - F.col("start_token")))
    pieces = pieces.withColumn("order", order).withColumn("part", F.pmod(F.xxhash64(F.lit(3), "item", "piece"), F.lit(parts)).cast("int"))
    kind = dict(sized.dtypes)["item"]
    rows = pieces.groupBy("pack_name", "capacity", "part").applyInPandas(
        _pack(open_bins), f"pack_name string, capacity int, part int, bin long, item {kind}, piece int, start_token long, n_tokens long"
    )
    container = F.col("part").cast("long") * (1 << 32) + F.col("bin")
    return rows.select("pack_name", "capacity", container.alias("container"), "item", "piece", "start_token", "n_tokens")


def fill_report(placed: DataFrame) -> DataFrame:
    """Containers, tokens and the share of the room that is filled, for each pack."""
    bins = placed.groupBy("pack_name", "capacity", "container").agg(F.sum("n_tokens").alias("used"))
    return bins.groupBy("pack_name", "capacity").agg(
        F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.round(F.sum("used") / (F.count("*") * F.first("capacity")), 6).alias("filled")
    )
