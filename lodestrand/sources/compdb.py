"""Compile databases written on another machine: map Windows paths into the project, drop entries whose file is missing."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How a Windows path begins, drivers whose command lines only a Windows toolchain
# understands, and folders that are built into.
WINDOWS = r"^[A-Za-z]:[\\/]"
WINDOWS_DRIVERS = ("cl", "cl.exe", "clang-cl", "clang-cl.exe")
BUILD_FOLDERS = ("build", "cmake-build-debug", "cmake-build-release", "cmake-build-relwithdebinfo", "cmake-build-minsizerel", "out")
ENTRY = "directory string, file string, command string, arguments array<string>, output string"


def read_compdb(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a compile database, a JSON array of objects."""
    return spark.read.schema(ENTRY).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def _segments(path: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(path, r"\\", "/"), "/"), lambda x: (x != "") & (x != "."))


def common_anchor(paths: DataFrame, column: str) -> list[str]:
    """The first one or two segments that all Windows paths share, whatever their case; empty if there is none.

    Segments are compared by position in one aggregate; only the two first positions come to the driver.
    """
    win = paths.where(F.col(column).rlike(WINDOWS)).select(_segments(F.col(column)).alias("s"))
    lead = win.agg(*[F.count_distinct(F.coalesce(F.lower(F.get("s", F.lit(i))), F.lit("")).alias(f"d{i}")).alias(f"n{i}") for i in (0, 1)], *[F.min(F.get("s", F.lit(i))).alias(f"s{i}") for i in (0, 1)]).first()
    out = []
    for i in (0, 1):
        if lead[f"n{i}"] != 1 or lead[f"s{i}"] is None:
            break
        out.append(lead[f"s{i}"])
    return out


def mapped(path: Column, anchor: list[str], root: str, trim: int = 0) -> Column:
    """A Windows path below ``anchor`` as a path below ``root``, ``trim`` more segments cut; other paths stay."""
    rest = F.slice(_segments(path), len(anchor) + 1 + trim, 1_000_000)
    return F.when(path.rlike(WINDOWS), F.concat(F.lit(root.rstrip("/") + "/"), F.array_join(rest, "/"))).otherwise(path)


def localise(entries: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """The entries whose file exists among ``files`` (one column ``path``), with their paths in the project at ``root``.

    A Windows path is tried as mapped, then with one more segment cut; a relative path counts from its directory.
    """
    anchor = common_anchor(entries, "file")
    plain = F.when(F.col("file").rlike(WINDOWS) | F.col("file").startswith("/"), F.col("file")).otherwise(F.concat_ws("/", F.regexp_replace("directory", r"[\\/]+$", ""), "file"))
    known = files.select("path").distinct()
    e = entries.withColumn("_plain", plain).withColumns({"_a": mapped(F.col("_plain"), anchor, root), "_b": mapped(F.col("_plain"), anchor, root, 1)})
    e = e.join(known.select(F.col("path").alias("_a"), F.lit(True).alias("_at_a")), "_a", "left").join(known.select(F.col("path").alias("_b"), F.lit(True).alias("_at_b")), "_b", "left")
    found = e.where(F.col("_at_a") | F.col("_at_b"))
    return found.select(F.lit(root).alias("directory"), F.when(F.col("_at_a"), F.col("_a")).otherwise(F.col("_b")).alias("file"), "command", "arguments", "output")


def foreign_toolchain(entries: DataFrame, sample: int = 200, least: int = 5, share: float = 0.6) -> bool:
    """Whether, of the first ``sample`` entries by file, at least ``least`` and ``share`` are driven by a Windows compiler."""
    driver = F.lower(F.element_at(_segments(F.coalesce(F.get("arguments", F.lit(0)), F.regexp_extract("command", r'^\s*"?([^"\s]+)', 1))), -1))
    r = entries.orderBy("file").limit(sample).agg(F.count("*").alias("n"), F.count_if(driver.isin(*WINDOWS_DRIVERS)).alias("hits")).first()
    return r["hits"] >= max(least, int(r["n"] * share))


def project_root(path: str) -> str:
    """The project of a compile database: its folder, or the one above where that is built into."""
    folder = os.path.dirname(os.path.abspath(path))
    return os.path.dirname(folder) if os.path.basename(folder) in BUILD_FOLDERS else folder
