"""Building and keeping the code graph: ownership, nodes, edges, stubs, validity, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The type pairs each relationship may join.
TYPES = ("Class", "Struct")
ALLOWED = {
    "INHERITS": [(a, b) for a in TYPES for b in TYPES],
    "OVERRIDES": [("Function", "Function")],
    "CALLS": [("Function", "Function")],
    "USES_TYPE": [(a, b) for a in ("Function", *TYPES) for b in TYPES],
}
EDGE_KEY = ["src_owner_repo", "src_scip_symbol", "tgt_owner_repo", "tgt_scip_symbol", "relationship_type"]


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in ``order``. Groups are cut down by rank before they meet in one task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def dedupe_nodes(nodes: DataFrame, seq: str) -> DataFrame:
    """By owner and symbol: the first node that is no stub, else the first stub."""
    return first_by(nodes, ["owner_repo", "scip_symbol"], [F.col("is_external"), F.col(seq)])


def dedupe_edges(edges: DataFrame, order: list[Column]) -> DataFrame:
    return first_by(edges, EDGE_KEY, order)


def drop_reason(src_uri: Column, tgt_uri: Column, relation: Column) -> Column:
    """Why an edge can't be in the graph, or null."""
    kind = lambda u: F.get(F.split(u, "::", -1), F.lit(2))
    short = lambda u: u.isNull() | (F.size(F.split(u, "::", -1)) < 4)
    fits = F.concat_ws(">", relation, kind(src_uri), kind(tgt_uri)).isin([f"{r}>{x}>{y}" for r, pairs in ALLOWED.items() for x, y in pairs])
    return F.when(short(src_uri) | short(tgt_uri), "malformed_uri").when(~fits, "type_pair_not_allowed")


def reference_relation(src_type: Column, tgt_type: Column, role: Column) -> Column:
    """The relationship a reference stands for, or null."""
    known = role.isin("CALL", "READ", "WRITE")
    return F.when(known & tgt_type.isin(*TYPES), "USES_TYPE").when(known & (src_type == "Function") & (tgt_type == "Function"), "CALLS")


def implementation_relation(src_type: Column, tgt_type: Column) -> Column:
    return F.when((src_type == "Function") & (tgt_type == "Function"), "OVERRIDES").when(src_type.isin(*TYPES) & tgt_type.isin(*TYPES), "INHERITS")


def ownership(definitions: DataFrame, precedence: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(scip_symbol, owner_repo, file_path, candidates, is_conflict, reason) from (scip_symbol, repo, file_path, seq).

    The owner is an override if it is a candidate, else the candidate that the symbol names as its package, else the one
    first in ``precedence`` (repo, position), then in ``seq``; its first file counts. A symbol with several entries is a
    conflict; ``reason`` says what decided.
    """
    package = F.get(F.split("scip_symbol", " ", 5), F.lit(2))
    named = F.col("scip_symbol").startswith("cxx ") & (package == F.col("repo")) & (package != ".")
    d = definitions.where("scip_symbol is not null").join(precedence, "repo", "left").withColumn("place", F.coalesce("position", F.lit(2**31 - 1))).withColumn("rank", F.when(named, 0).otherwise(1))
    if overrides is not None:
        d = d.join(overrides.select("scip_symbol", F.col("repo").alias("_chosen")), "scip_symbol", "left").withColumn("rank", F.when(F.col("_chosen") == F.col("repo"), -1).otherwise(F.col("rank")))
    best = F.min_by(F.struct("repo", "file_path", "rank"), F.struct("rank", "place", "seq", "repo"))
    g = d.groupBy("scip_symbol").agg(best.alias("b"), F.array_sort(F.collect_set("repo")).alias("candidates"), (F.count("*") > 1).alias("is_conflict"))
    reason = F.when(F.col("b.rank") == -1, "override").when(~F.col("is_conflict"), "single_local_definition").when(F.col("b.rank") == 0, "package_hint").otherwise("stable_order")
    return g.select("scip_symbol", F.col("b.repo").alias("owner_repo"), F.col("b.file_path").alias("file_path"), "candidates", "is_conflict", reason.alias("reason"))


def conflicts(catalog: DataFrame) -> DataFrame:
    """(scip_symbol, owner_repo, candidates, reason) of the symbols with several definitions."""
    return catalog.where("is_conflict").select("scip_symbol", "owner_repo", "candidates", "reason")


def existing_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges both of whose ends are nodes, once each."""
    keys = nodes.select("owner_repo", "scip_symbol").distinct()
    for side in ("src", "tgt"):
        edges = edges.join(keys.select(F.col("owner_repo").alias(f"{side}_owner_repo"), F.col("scip_symbol").alias(f"{side}_scip_symbol")), [f"{side}_owner_repo", f"{side}_scip_symbol"], "left_semi")
    return edges.select(*EDGE_KEY, "is_cross_repo").distinct()


def merge_edges(old: DataFrame, new: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The store of edges after new ones arrive, and (relationship_type, offered, merged, vanished): how many distinct new
    edges there were, and how many of them went missing because an end is no node. The newer flag of an edge wins."""
    distinct = new.groupBy(*EDGE_KEY).agg(F.bool_or("is_cross_repo").alias("is_cross_repo"))
    kept = existing_edges(distinct, nodes)
    both = kept.withColumn("_new", F.lit(1)).unionByName(old.select(*EDGE_KEY, "is_cross_repo").withColumn("_new", F.lit(0)))
    store = both.groupBy(*EDGE_KEY).agg(F.max_by("is_cross_repo", "_new").alias("is_cross_repo"))
    count = lambda df, name: df.groupBy("relationship_type").agg(F.count("*").alias(name))
    report = count(distinct, "offered").join(count(kept, "merged"), "relationship_type", "left")
    merged = F.coalesce("merged", F.lit(0))
    return store, report.select("relationship_type", "offered", merged.alias("merged"), (F.col("offered") - merged).alias("vanished"))


def defined_in(nodes: DataFrame) -> DataFrame:
    """(owner_repo, scip_symbol, repo_name, file_path): each node's file, but for externals."""
    return nodes.where("file_path <> '<external>'").select("owner_repo", "scip_symbol", "repo_name", "file_path").distinct()


def merge_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The store after new nodes arrive: new columns win, but ``ingestion_repo`` stays while the new one is null, and a
    stub never replaces a real node."""
    key = ["owner_repo", "scip_symbol"]
    rest = [c for c in old.columns if c not in key]
    o, n = old.select(*key, F.struct(*rest).alias("o")), new.select(*key, F.struct(*rest).alias("n"))
    both = o.join(n, key, "full_outer")
    keep = F.col("n").isNull() | (F.col("o").isNotNull() & F.col("n.is_external") & ~F.col("o.is_external"))
    cols = [F.coalesce("n.ingestion_repo", "o.ingestion_repo").alias(c) if c == "ingestion_repo" else F.when(keep, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in rest]
    return both.select(*key, *cols)


def delete_repository(nodes: DataFrame, edges: DataFrame, repo: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without those of one owner."""
    return nodes.where(~F.col("repo_name").eqNullSafe(repo)), edges.where(~F.col("src_owner_repo").eqNullSafe(repo) & ~F.col("tgt_owner_repo").eqNullSafe(repo))
