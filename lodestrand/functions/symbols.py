"""Compiler index symbols: parsing, classification, roles and ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .uri import collapse, cpp_name

# Kinds of symbols in the index format, by what becomes of them.
KIND_TYPES = {7: "Class", 49: "Struct", 59: "Struct", 17: "Function", 26: "Function", 9: "Function"}
DROPPED_KINDS = (30, 61, 37, 58, 15, 11, 12, 25, 55)
# A symbol is a scheme, a package of three fields and descriptors: a name, plain or between backticks, and what it is a
# name of: a namespace /, a type #, a term ., a macro !, a method with its disambiguator (..). or a parameter (..).
_DESCRIPTOR = r"(?:`[^`]*`|[^/#.!()\[\]`]*)(?:\([^)]*\)\.?|[/#.!\[\]])"
_METHOD = r"\([^)]*\)\.$"
PARSED = ("entity_type", "entity_name", "first_namespace", "package_local", "function_sig_hash")


def _name(descriptor: Column) -> Column:
    quoted = F.regexp_extract(descriptor, "^`([^`]*)`", 1)
    return F.when(descriptor.startswith("`"), quoted).otherwise(F.regexp_extract(descriptor, r"^[^/#.!()\[\]]*", 0))


def _what(descriptor: Column) -> Column:
    return F.when(descriptor.rlike(_METHOD), "method").otherwise(F.right(descriptor, F.lit(1)))


def parsed_symbol(symbol: Column, kind: Column) -> Column:
    """The fields of ``PARSED`` as a struct, or null for symbols that stand for no class, struct or function."""
    head = F.split(symbol, " ", 5)
    every = F.regexp_extract_all(F.get(head, F.lit(4)), F.lit(_DESCRIPTOR), F.lit(0))
    first_method = F.array_position(F.transform(every, lambda x: x.rlike(_METHOD)), True)
    used = F.when(first_method > 0, F.slice(every, 1, first_method.cast("int"))).otherwise(every)  # what follows a method is inside it
    last = F.try_element_at(F.filter(used, lambda x: _what(x).isin("#", ".", "method")), F.lit(-1))
    scopes = F.transform(F.filter(used, lambda x: _what(x).isin("/", "#")), _name)
    of_kind = F.coalesce(*[F.when(kind == k, v) for k, v in KIND_TYPES.items()], F.lit("Class"))
    entity_type = F.when(_what(last) == "#", of_kind).otherwise("Function")
    own_scope = (entity_type != "Function") & F.coalesce(F.try_element_at(scopes, F.lit(-1)) == _name(last), F.lit(False))
    path = F.when(own_scope, scopes).otherwise(F.concat(scopes, F.array(_name(last))))
    mark = F.regexp_extract(last, r"\(([^)]*)\)\.$", 1)
    hashed = F.when(F.lower(mark).rlike("^[0-9a-z_-]{4,64}$"), F.lower(mark)).otherwise(F.substring(F.sha1(collapse(mark)), 1, 12))
    sig = F.when((_what(last) == "method") & (mark != ""), F.concat(F.lit("sig_"), hashed))
    local = (F.get(head, F.lit(1)) == ".") & (F.get(head, F.lit(2)) == ".")
    known = (F.size(head) == 5) & (F.get(head, F.lit(0)) == "cxx") & ~kind.isin(*DROPPED_KINDS) & ~F.exists(used, lambda x: _what(x) == "!") & last.isNotNull() & ~_name(last).startswith("<file>/")
    values = (entity_type, cpp_name(F.array_join(path, "::")), F.coalesce(F.get(scopes, F.lit(0)), F.lit("")), local, sig)
    return F.when(known, F.struct(*[v.alias(k) for k, v in zip(PARSED, values)]))


def parse_symbols(df: DataFrame, symbol: str, kind: str | None = None) -> DataFrame:
    """One row of parsed fields for each distinct symbol (and kind) of ``df``; what can't be parsed has null fields."""
    of_kind = F.coalesce(F.col(kind), F.lit(0)) if kind else F.lit(0)
    keys = df.select(F.col(symbol).alias("scip_symbol"), of_kind.cast("int").alias("kind")).where("scip_symbol is not null").distinct()
    return keys.withColumn("p", parsed_symbol(F.col("scip_symbol"), F.col("kind"))).select("scip_symbol", "kind", "p.*")


def is_external(package_local: Column, first_namespace: Column, monitored: tuple[str, ...]) -> Column:
    """Not of this package, or in a top namespace that is not monitored."""
    return ~package_local | ((first_namespace != "") & ~first_namespace.isin(*monitored))


def disposition(entity_type: Column, first_namespace: Column, defined: Column, monitored: tuple[str, ...], ignored: tuple[str, ...]) -> Column:
    """keep, drop or stub."""
    return (
        F.when(entity_type.isNull() | first_namespace.isin(*ignored), "drop")
        .when(first_namespace.isin(*monitored) & ~defined, "stub")
        .otherwise("keep")
    )


def role(bits: Column) -> Column:
    """Write access before read access; everything else is a call."""
    return F.when(bits.bitwiseAND(4) != 0, "WRITE").when(bits.bitwiseAND(8) != 0, "READ").otherwise("CALL")


def range4(r: Column) -> Column:
    """(start line, start column, end line, end column) of a range of three or four numbers; null for fewer."""
    at = lambda i: F.get(r, F.lit(i))
    four = F.struct(at(0).alias("sl"), at(1).alias("sc"), F.when(F.size(r) >= 4, at(2)).otherwise(at(0)).alias("el"), F.when(F.size(r) >= 4, at(3)).otherwise(at(2)).alias("ec"))
    return F.when(F.size(r) >= 3, four)


def line_bounds(r: Column, enclosing: Column) -> Column:
    """First and last line, of the enclosing range if there is one."""
    best = F.when(F.size(enclosing) > 0, enclosing).otherwise(r)
    q = range4(best)
    return F.when(q.isNotNull(), F.struct(q["sl"].alias("first"), q["el"].alias("last")))
