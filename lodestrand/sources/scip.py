"""Compiler index files as a Spark data source: one partition for each file, one row for each document."""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.symbols import line_bounds, range4, role

DOCUMENT = (
    "repo string, doc_seq int, relative_path string,"
    " symbols array<struct<symbol:string,kind:int,display_name:string,relationships:array<struct<symbol:string,is_reference:boolean,is_implementation:boolean,is_type_definition:boolean,is_definition:boolean>>>>,"
    " occurrences array<struct<symbol:string,range:array<int>,symbol_roles:int,enclosing_range:array<int>>>"
)


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[i] & 127) << shift
        i, shift = i + 1, shift + 7
        if b[i - 1] < 128:
            return n, i


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields; fixed-width values come as bytes."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = b[i : i + n], i + n
        elif kind == 2:
            n, i = _varint(b, i)
            if i + n > len(b):
                raise ValueError("the index file is cut short")
            value, i = b[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def _ints(values: list) -> list[int]:
    out = []
    for v in values:
        if isinstance(v, int):
            out.append(v)
        else:
            i = 0
            while i < len(v):
                n, i = _varint(v, i)
                out.append(n)
    return out


def _of(b: bytes) -> dict[int, list]:
    out: dict[int, list] = {}
    for k, v in fields(b):
        out.setdefault(k, []).append(v)
    return out


def _text(m: dict, k: int) -> str:
    return m[k][-1].decode("utf-8") if k in m else ""


# Field numbers of the index format.
def _document(b: bytes) -> tuple[str, list, list]:
    d = _of(b)
    symbols = []
    for s in map(_of, d.get(3, [])):
        links = [(_text(r, 1), *(bool(r.get(k, [0])[-1]) for k in (2, 3, 4, 5))) for r in map(_of, s.get(4, []))]
        symbols.append((_text(s, 1), s.get(5, [0])[-1], _text(s, 6), links))
    occurrences = [(_text(o, 2), _ints(o.get(1, [])), o.get(3, [0])[-1], _ints(o.get(7, []))) for o in map(_of, d.get(2, []))]
    return _text(d, 1), symbols, occurrences


class _File(InputPartition):
    pass


class ScipReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.repo = options["path"], options.get("repo", "")

    def partitions(self):
        found = sorted(glob.glob(os.path.join(self.path, "**", "*.scip"), recursive=True)) if os.path.isdir(self.path) else [self.path]
        return [_File(p) for p in found]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            n = 0
            for k, v in fields(f.read()):
                if k == 2:
                    yield (self.repo, n, *_document(v))
                    n += 1


class ScipSource(DataSource):
    """``spark.read.format("scip").option("repo", name).load(path)`` after ``spark.dataSource.register(ScipSource)``."""

    @classmethod
    def name(cls):
        return "scip"

    def schema(self):
        return DOCUMENT

    def reader(self, schema):
        return ScipReader(self.options)


def definitions(documents: DataFrame) -> DataFrame:
    """(repo, seq, scip_symbol, file_path, kind, display_name, has_definition, definition_range, relationships)."""
    occ = documents.select("repo", "relative_path", F.posexplode("occurrences").alias("at", "o")).where(F.col("o.symbol_roles").bitwiseAND(1) != 0)
    where = occ.groupBy("repo", "relative_path", F.col("o.symbol").alias("scip_symbol")).agg(F.min_by(range4(F.col("o.range")), "at").alias("definition_range"))
    defined = occ.select("repo", F.col("o.symbol").alias("scip_symbol")).distinct().withColumn("has_definition", F.lit(True))
    s = documents.select("repo", "doc_seq", "relative_path", F.posexplode("symbols").alias("at", "s"))
    s = s.select("repo", (F.col("doc_seq").cast("long") * (1 << 32) + F.col("at")).alias("seq"), F.col("s.symbol").alias("scip_symbol"), "relative_path", F.col("s.kind").alias("kind"), F.col("s.display_name").alias("display_name"), F.col("s.relationships").alias("relationships"))
    s = s.join(where, ["repo", "relative_path", "scip_symbol"], "left").join(defined, ["repo", "scip_symbol"], "left")
    return s.select("repo", "seq", "scip_symbol", F.col("relative_path").alias("file_path"), "kind", "display_name", F.coalesce("has_definition", F.lit(False)).alias("has_definition"), "definition_range", "relationships")


def references(documents: DataFrame) -> DataFrame:
    """(repo, seq, scip_symbol, file_path, role, line) of every occurrence that is no definition."""
    o = documents.select("repo", "doc_seq", "relative_path", F.posexplode("occurrences").alias("at", "o")).where((F.col("o.symbol_roles").bitwiseAND(1) == 0) & (F.size("o.range") >= 3))
    return o.select("repo", (F.col("doc_seq").cast("long") * (1 << 32) + F.col("at")).alias("seq"), F.col("o.symbol").alias("scip_symbol"), F.col("relative_path").alias("file_path"), role(F.col("o.symbol_roles")).alias("role"), F.get("o.range", F.lit(0)).alias("line"))


def spans(documents: DataFrame) -> DataFrame:
    """(repo, file_path, scip_symbol, first, last): the lines of every definition."""
    o = documents.select("repo", "relative_path", F.explode("occurrences").alias("o")).where(F.col("o.symbol_roles").bitwiseAND(1) != 0)
    b = line_bounds(F.col("o.range"), F.col("o.enclosing_range"))
    return o.select("repo", F.col("relative_path").alias("file_path"), F.col("o.symbol").alias("scip_symbol"), b["first"].alias("first"), b["last"].alias("last")).where("first is not null")


def totals(documents: DataFrame, definitions_: DataFrame, disposition: str = "disposition") -> DataFrame:
    """(repo, documents, symbols, dropped_symbols, references) of each repository, added up over all of its index files.

    ``definitions_`` are those of ``definitions`` with their ``disposition``.
    """
    d = documents.groupBy("repo").agg(F.count("*").alias("documents"), F.sum(F.size("occurrences")).alias("occurrences"))
    s = definitions_.groupBy("repo").agg(F.count_if(F.col(disposition) != "drop").alias("symbols"), F.count_if(F.col(disposition) == "drop").alias("dropped_symbols"))
    r = references(documents).groupBy("repo").agg(F.count("*").alias("references"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "occurrences", "symbols", "dropped_symbols", "references")]
    return d.join(s, "repo", "left").join(r, "repo", "left").select("repo", *zero)
