"""Building the code graph from compiler indexes: nodes, relationship edges, reference edges, stubs.

Every (repository, symbol) that is mentioned anywhere is resolved once: parsed, classified, given its owner and its file.
Nodes and edges then are joins with that table. All repositories are built together, with one dedupe at the end; a single
repository is the same with one ``repo``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import disposition, is_external, parse_symbols
from ..functions.uri import global_uri, identity_key
from ..plans.session import cut
from .graph import TYPES, dedupe_edges, dedupe_nodes, drop_reason, implementation_relation, reference_relation

EXTERNAL = "<external>"
NODE = ["owner_repo", "scip_symbol", "repo_name", "ingestion_repo", "global_uri", "identity_key", "function_sig_hash", "file_path", "entity_type", "entity_name", "is_external"]
EDGE = ["src_owner_repo", "src_scip_symbol", "tgt_owner_repo", "tgt_scip_symbol", "relationship_type", "src_uri", "tgt_uri", "is_cross_repo"]


class Namespaces(NamedTuple):
    """Top namespaces: those whose missing definitions become stubs, those that are dropped, and who owns which."""

    monitored: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    owners: dict[str, str] = {}


class Graph(NamedTuple):
    """Nodes and valid edges, deduped over all repositories, and (reason, relationship_type, n_edges) of what was dropped."""

    nodes: DataFrame
    edges: DataFrame
    dropped: DataFrame


def _owner(rules: Namespaces) -> Column:
    """The catalog's owner, else that of the namespace, else the repository itself."""
    mapped = [F.when(F.col("first_namespace") == k, F.lit(v)) for k, v in rules.owners.items()]
    return F.coalesce("catalog_owner", *mapped, "repo")


def resolved_symbols(definitions: DataFrame, mentioned: DataFrame, catalog: DataFrame, rules: Namespaces) -> DataFrame:
    """One row for each (repo, scip_symbol) that is defined or mentioned: kind and file of its last definition, its parsed
    fields, owner, catalog file and disposition; what can't be parsed is left out."""
    last = definitions.groupBy("repo", "scip_symbol").agg(F.max_by(F.struct("file_path", "kind"), "seq").alias("d"))
    names = mentioned.where("scip_symbol is not null").distinct().join(last, ["repo", "scip_symbol"], "full_outer")
    rows = names.select("repo", "scip_symbol", F.coalesce("d.kind", F.lit(0)).cast("int").alias("kind"), F.col("d.file_path").alias("local_file"), F.col("d").isNotNull().alias("in_index"))
    parsed = rows.join(parse_symbols(rows, "scip_symbol", "kind"), ["scip_symbol", "kind"]).where("entity_type is not null")
    owned = parsed.join(catalog.select("scip_symbol", F.col("owner_repo").alias("catalog_owner"), F.col("file_path").alias("catalog_file")), "scip_symbol", "left")
    what = disposition(F.col("entity_type"), F.col("first_namespace"), F.col("in_index"), rules.monitored, rules.ignored)
    return owned.select("*", _owner(rules).alias("owner"), what.alias("disposition"), is_external(F.col("package_local"), F.col("first_namespace"), rules.monitored).alias("external"))


def symbol_uri(repo: str, file: Column, external: str, entity_type: str, entity_name: str) -> Column:
    """The URI of a parsed symbol; externals without a file get a placeholder."""
    return global_uri(repo, F.when(F.col(external) & (file == ""), EXTERNAL).otherwise(file), entity_type, entity_name, F.lit(None).cast("string"))


def _node(rows: DataFrame, stub: Column, rank: Column) -> DataFrame:
    uri = symbol_uri("owner", F.col("file"), "external", "entity_type", "entity_name")
    sig = F.when(F.col("entity_type") == "Function", F.col("function_sig_hash"))
    n = rows.withColumns({"owner_repo": F.col("owner"), "repo_name": F.col("owner"), "ingestion_repo": F.col("repo"), "global_uri": uri, "function_sig_hash": sig, "file_path": F.col("file"), "is_external": stub, "rank": rank})
    return n.withColumn("identity_key", identity_key("global_uri", "function_sig_hash")).where("global_uri is not null").select(*NODE, "rank")


def symbol_nodes(definitions: DataFrame, catalog: DataFrame, rules: Namespaces) -> DataFrame:
    """A node for each definition row that is not dropped: a stub where its namespace is only monitored here, or where
    another repository owns what is defined here."""
    local = definitions.groupBy("repo", "scip_symbol").agg(F.max_by("file_path", "seq").alias("local_file"))
    d = definitions.withColumn("kind", F.coalesce("kind", F.lit(0)).cast("int"))
    d = d.join(parse_symbols(d, "scip_symbol", "kind"), ["scip_symbol", "kind"]).where("entity_type is not null").join(local, ["repo", "scip_symbol"])
    d = d.join(catalog.select("scip_symbol", F.col("owner_repo").alias("catalog_owner"), F.col("file_path").alias("catalog_file")), "scip_symbol", "left")
    d = d.withColumns({"owner": _owner(rules), "external": is_external(F.col("package_local"), F.col("first_namespace"), rules.monitored), "disposition": disposition(F.col("entity_type"), F.col("first_namespace"), F.col("has_definition"), rules.monitored, rules.ignored)})
    stub = (F.col("disposition") == "stub") | (F.col("has_definition") & (F.col("owner") != F.col("repo")))
    file = F.when(stub, F.coalesce("catalog_file", "local_file", F.lit(EXTERNAL))).otherwise(F.col("file_path"))
    return _node(d.where("disposition <> 'drop'").withColumn("file", file), stub, F.struct(F.col("position"), F.lit(0).alias("phase"), F.col("seq")))


def _sided(rows: DataFrame, symbols: DataFrame, name: str, side: str) -> DataFrame:
    """``rows`` with the resolved fields of the symbol in column ``name``, each prefixed."""
    fields = ["owner", "local_file", "catalog_file", "external", "entity_type", "entity_name", "disposition", "function_sig_hash", "catalog_owner", "first_namespace"]
    return rows.join(symbols.select("repo", F.col("scip_symbol").alias(name), *[F.col(c).alias(f"{side}_{c}") for c in fields]), ["repo", name])


def _linked(rows: DataFrame, src_file: Column, tgt_file: Column, symbols: DataFrame) -> DataFrame:
    """Rows of (repo, src, tgt, ...) with both ends resolved; targets that are dropped are gone."""
    j = _sided(_sided(rows, symbols, "src", "src"), symbols, "tgt", "tgt").where("tgt_disposition <> 'drop'")
    j = j.withColumns({"src_file": src_file, "tgt_file": tgt_file})
    uris = {f"{x}_uri": symbol_uri(f"{x}_owner", F.col(f"{x}_file"), f"{x}_external", f"{x}_entity_type", f"{x}_entity_name") for x in ("src", "tgt")}
    cross = (F.col("src_owner") != F.col("tgt_owner")) | (F.col("tgt_disposition") == "stub")
    return j.withColumns(uris).withColumn("is_cross_repo", cross).where("src_uri is not null and tgt_uri is not null")


def _edges(linked: DataFrame, relation: Column, phase: int, seq: Column) -> DataFrame:
    e = linked.withColumn("relationship_type", relation).where("relationship_type is not null")
    named = {"src_owner": "src_owner_repo", "src": "src_scip_symbol", "tgt_owner": "tgt_owner_repo", "tgt": "tgt_scip_symbol"}
    return e.withColumn("rank", F.struct(F.col("position"), F.lit(phase).alias("phase"), seq.alias("seq"))).withColumnsRenamed(named).select(*EDGE, "rank")


def _stubs(linked: DataFrame, phase: int) -> DataFrame:
    """Stub nodes for the targets that no catalog knows and no index here defines."""
    s = linked.where("tgt_disposition = 'stub' and tgt_catalog_owner is null")
    fields = {"tgt": "scip_symbol", "tgt_owner": "owner", "tgt_file": "file", "tgt_external": "external", "tgt_entity_type": "entity_type", "tgt_entity_name": "entity_name", "tgt_function_sig_hash": "function_sig_hash"}
    s = s.select("repo", "position", "seq", *fields).withColumnsRenamed(fields)
    return _node(s, F.lit(True), F.struct(F.col("position"), F.lit(phase).alias("phase"), F.col("seq")))


def build_graph(definitions: DataFrame, relationships: DataFrame, references: DataFrame, catalog: DataFrame, precedence: DataFrame, rules: Namespaces, nodes_only: bool = False) -> Graph:
    """The graph of one or many repositories.

    Takes ``definitions`` (repo, seq, scip_symbol, file_path, kind, has_definition), ``relationships`` (repo, seq,
    scip_symbol, target, is_implementation, is_type_definition), ``references`` (repo, seq, scip_symbol, file_path,
    enclosing_symbol, role), each with ``seq`` unique in its repository, the ``catalog`` of ``graph.ownership`` (may be empty) and ``precedence`` (repo, position). Where
    a key comes twice, the repository first in ``precedence`` wins, then nodes of symbols before stubs, edges of
    relationships before those of references, and the smaller ``seq``. References without an enclosing symbol, and symbols
    that can't be parsed, give no edges; null roles none; empty tables an empty graph. References are added up by
    repository, file, both ends and role before anything is joined. ``nodes_only`` leaves references and relationships out.
    """
    place = precedence.select("repo", "position")
    placed = lambda df: df.join(F.broadcast(place), "repo", "left").withColumn("position", F.coalesce("position", F.lit(2**31 - 1)))  # noqa: E731  # one row for each repository
    d = placed(definitions)
    nodes = symbol_nodes(d, catalog, rules)
    if nodes_only:
        none = nodes.sparkSession.createDataFrame([], ", ".join(f"{c} {'boolean' if c == 'is_cross_repo' else 'string'}" for c in EDGE))
        return Graph(dedupe_nodes(nodes, "rank").select(*NODE), none, none.sparkSession.createDataFrame([], "reason string, relationship_type string, n_edges long"))
    flags = F.bool_or("is_implementation").alias("is_implementation"), F.bool_or("is_type_definition").alias("is_type_definition")
    rel = cut(placed(relationships.where("scip_symbol is not null and target is not null").groupBy("repo", F.col("scip_symbol").alias("src"), F.col("target").alias("tgt")).agg(F.min("seq").alias("seq"), *flags)))
    ref = cut(placed(references.where("enclosing_symbol is not null and scip_symbol is not null").groupBy("repo", "file_path", F.col("enclosing_symbol").alias("src"), F.col("scip_symbol").alias("tgt"), "role").agg(F.min("seq").alias("seq"))))
    ends = [df.select("repo", F.col(c).alias("scip_symbol")) for df in (rel, ref) for c in ("src", "tgt")]
    symbols = cut(resolved_symbols(definitions, ends[0].unionByName(ends[1]).unionByName(ends[2]).unionByName(ends[3]), catalog, rules))
    own = definitions.select("repo", "seq", F.struct("file_path", "has_definition").alias("own"))
    rel = rel.join(own, ["repo", "seq"])
    moved = F.when(F.col("own.has_definition"), F.col("src_owner") != F.col("repo")).otherwise(F.col("src_first_namespace").isin(*rules.monitored))
    src_file = F.when(moved, F.coalesce("src_catalog_file", "src_local_file", F.lit(EXTERNAL))).otherwise(F.col("own.file_path"))
    stub = F.col("tgt_disposition") == "stub"
    away = F.coalesce("tgt_catalog_file", "tgt_local_file", F.lit(EXTERNAL))
    by_rel = cut(_linked(rel, src_file, F.when(stub, away).otherwise(F.coalesce("tgt_local_file", "own.file_path")), symbols))
    by_ref = cut(_linked(ref, F.coalesce("src_catalog_file", "src_local_file", "file_path"), F.when(stub, away).otherwise(F.coalesce("tgt_catalog_file", "tgt_local_file", "file_path")), symbols))
    typed = F.col("tgt_entity_type").isin(*TYPES) & F.col("src_entity_type").isin("Function", *TYPES)
    edges = (
        _edges(by_rel.where("is_implementation"), implementation_relation(F.col("src_entity_type"), F.col("tgt_entity_type")), 0, F.col("seq"))
        .unionByName(_edges(by_rel.where("is_type_definition"), F.when(typed, "USES_TYPE"), 0, F.col("seq")))
        .unionByName(_edges(by_ref, reference_relation(F.col("src_entity_type"), F.col("tgt_entity_type"), F.col("role")), 1, F.col("seq")))
    )
    all_nodes = nodes.unionByName(_stubs(by_rel, 1)).unionByName(_stubs(by_ref, 2))
    once = dedupe_edges(edges, [F.col("rank")]).select(*EDGE).withColumn("reason", drop_reason(F.col("src_uri"), F.col("tgt_uri"), F.col("relationship_type")))
    dropped = once.where("reason is not null").groupBy("reason", "relationship_type").agg(F.count("*").alias("n_edges"))
    return Graph(dedupe_nodes(all_nodes, "rank").select(*NODE), once.where("reason is null").drop("reason"), dropped)


def relationships(definitions: DataFrame) -> DataFrame:
    """The relationships of index definitions as rows, for ``build_graph``."""
    r = definitions.select("repo", "seq", "scip_symbol", F.explode("relationships").alias("r"))
    return r.select("repo", "seq", "scip_symbol", F.col("r.symbol").alias("target"), F.col("r.is_implementation").alias("is_implementation"), F.col("r.is_type_definition").alias("is_type_definition"))


def namespace_owners(text: str) -> dict[str, str]:
    """Owners of namespaces from a JSON object or from ``a=b,c=d``; what is neither is no owner."""
    import json

    text = (text or "").strip()
    if text.startswith("{"):
        try:
            pairs = json.loads(text).items()
        except (ValueError, AttributeError):
            return {}
    else:
        pairs = (x.split("=", 1) for x in text.split(",") if "=" in x)
    named = ((str(k).strip(), str(v).strip()) for k, v in pairs)
    return {k: v for k, v in named if k and v}
