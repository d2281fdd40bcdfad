"""Queries of the code graph's own operators over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.comments import embedding_text, signature_source
from ..functions.symbols import disposition, is_external, parse_symbols
from ..functions.uri import SIG_PATTERN, WS, cpp_name, global_uri, identity_key, parse_uri, point_id, signature_hash, tight_scopes
from ..operators import construction, graph, search
from ..operators.scope import innermost
from ..operators.skew import numbered_chunks
from ..operators.vectors import compact, points, read_table, upsert
from ..sources import cpp
from .general_queries import ALL_LINKS as _ALL_LINKS
from .general_queries import _clean, inherits_links
from .session import cut, lookup, scratch, table

MONITORED = ("mica", "tessel", "lumen", "base")
IGNORED = ("obsv", "memory")

QUERIES: dict = {}
SQL: dict[str, str] = {}


_US = "unix_micros(ingested_at) as ingested_us"  # instants come out as microseconds, alike in both engines


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _squash(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


# -- names, URIs, keys

_NAME = _squash(f"regexp_replace({_clean('entity_name')}, '::{WS}*~', '::~', 'g')")


@query("prj_cpp_name", f"select distinct owner_repo, scip_symbol, {_NAME} as name from graph_node")
def prj_cpp_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_node").select("owner_repo", "scip_symbol", cpp_name("entity_name").alias("name")).distinct()


@query(
    "prj_global_uri",
    f"""select entity_id, repo_name || '::' || file_path || '::' || entity_type || '::' || {_NAME} ||
 case when entity_type = 'Function' and coalesce(function_sig_hash, '') <> '' then '::' || function_sig_hash else '' end as uri from code_entity""",
)
def prj_global_uri(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "code_entity").select("entity_id", global_uri("repo_name", "file_path", "entity_type", "entity_name", "function_sig_hash").alias("uri"))


@query(
    "prj_signature_hash",
    f"""with s as (select entity_id, epoch_us(ingested_at) as ingested_us, {_squash("regexp_extract(regexp_replace(code_text, '^" + WS + "+', ''), '^[^{;]*')")} as sig from code_entity where entity_type = 'Function' and code_text is not null)
select entity_id, ingested_us, sig, 'sig_' || substr(sha1(case when sig = '' then '<empty-signature>' else sig end), 1, 12) as sig_hash from s""",
)
def prj_signature_hash(spark: SparkSession, d: str) -> DataFrame:
    sig = signature_source(F.col("code_text"))
    return table(spark, d, "code_entity").where("entity_type = 'Function' and code_text is not null").select("entity_id", F.expr(_US), sig.alias("sig"), signature_hash(sig).alias("sig_hash"))


@query(
    "prj_parse_uri",
    f"""with u as (select distinct identity_key as uri, string_split(identity_key, '::') as p from graph_node where identity_key is not null),
k as (select *, len(p) >= 5 and p[3] = 'Function' and regexp_matches(p[-1], '{SIG_PATTERN}') as signed from u)
select uri, p[1] as repo, p[2] as file_path, p[3] as entity_type, array_to_string(p[4:len(p) - cast(signed as int)], '::') as entity_name, case when signed then p[-1] end as signature from k where len(p) >= 4""",
)
def prj_parse_uri(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "graph_node").select(F.col("identity_key").alias("uri")).where("uri is not null").distinct()
    return u.withColumn("p", parse_uri("uri")).where("p is not null").select("uri", "p.*")


_KEY = """case when function_sig_hash is null or function_sig_hash = '' or len(string_split(global_uri, '::')) < 4 or suffix(global_uri, '::' || function_sig_hash)
 then global_uri else global_uri || '::' || function_sig_hash end"""


@query("prj_identity_key", f"select entity_id, epoch_us(ingested_at) as ingested_us, {_KEY} as identity_key from code_entity")
def prj_identity_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "code_entity").select("entity_id", F.expr(_US), identity_key("global_uri", "function_sig_hash").alias("identity_key"))


@query("prj_point_id", "select distinct identity_key, id as point_id from vector_point where identity_key is not null")
def prj_point_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "vector_point").where("identity_key is not null").select("identity_key", point_id("identity_key").alias("point_id")).distinct()


@query(
    "prj_embedding_text",
    """with t as (select entity_id, epoch_us(ingested_at) as ingested_us, substr(case when coalesce(docstring, '') <> '' then docstring || chr(10) || code_text else code_text end, 1, 32764) as t from code_entity)
select entity_id, ingested_us, length(t) as chars, md5(t) as text_md5 from t""",
)
def prj_embedding_text(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "code_entity").select("entity_id", F.expr(_US), embedding_text(F.col("docstring"), F.col("code_text")).alias("t"))
    return t.select("entity_id", "ingested_us", F.length("t").cast("long").alias("chars"), F.md5(F.col("t").cast("binary")).alias("text_md5"))


# -- symbols

_PARSED_SQL = r"""s as (select distinct scip_symbol, regexp_replace(scip_symbol, '^cxx \. \. \$ ', '') as x from graph_node where scip_symbol is not null),
p as (select scip_symbol, case when starts_with(x, 'local ') then null when suffix(x, '#') then 'Class' else 'Function' end as entity_type,
 replace(regexp_replace(x, '(#|\([^)]*\)\.|\.)$', ''), '/', '::') as entity_name, split_part(x, '/', 1) as first_namespace,
 case when regexp_matches(x, '\([^)]+\)\.$') then 'sig_' || regexp_extract(x, '\(([^)]+)\)\.$', 1) end as function_sig_hash from s)"""


@query("flt_parse_symbol", f"with {_PARSED_SQL} select scip_symbol, entity_type, entity_name, first_namespace, function_sig_hash from p where entity_type is not null")
def flt_parse_symbol(spark: SparkSession, d: str) -> DataFrame:
    return parse_symbols(table(spark, d, "graph_node"), "scip_symbol").where("entity_type is not null").select("scip_symbol", "entity_type", "entity_name", "first_namespace", "function_sig_hash")


def _list(x: tuple) -> str:
    return "(" + ", ".join(f"'{v}'" for v in x) + ")"


@query(
    "flt_disposition",
    f"""with {_PARSED_SQL}, r as (select scip_symbol, count(*) as n from scip_reference where not starts_with(scip_symbol, 'local ') group by 1),
def as (select distinct scip_symbol from graph_node where not is_external),
j as (select r.n, p.*, r.scip_symbol in (select scip_symbol from def) as defined from r left join p on p.scip_symbol = r.scip_symbol)
select case when entity_type is null or first_namespace in {_list(IGNORED)} then 'drop' when first_namespace in {_list(MONITORED)} and not defined then 'stub' else 'keep' end as disposition,
 coalesce(first_namespace <> '' and first_namespace not in {_list(MONITORED)}, true) as is_external, count(*) as symbols, cast(sum(n) as bigint) as n_references from j group by 1, 2""",
)
def flt_disposition(spark: SparkSession, d: str) -> DataFrame:
    """Referenced symbols by what is to become of them."""
    r = table(spark, d, "scip_reference").where("not startswith(scip_symbol, 'local ')").groupBy("scip_symbol").agg(F.count("*").alias("n"))
    nodes = table(spark, d, "graph_node")
    known = nodes.select("scip_symbol").where("scip_symbol is not null").distinct()
    parsed = parse_symbols(r.join(known, "scip_symbol", "left_semi"), "scip_symbol").drop("kind")
    defined = nodes.where("not is_external").select("scip_symbol").distinct().withColumn("defined", F.lit(True))
    j = r.join(parsed, "scip_symbol", "left").join(defined, "scip_symbol", "left")
    what = disposition(F.col("entity_type"), F.col("first_namespace"), F.coalesce("defined", F.lit(False)), MONITORED, IGNORED)
    out = F.coalesce(is_external(F.col("package_local"), F.col("first_namespace"), MONITORED), F.lit(True))
    return j.groupBy(what.alias("disposition"), out.alias("is_external")).agg(F.count("*").alias("symbols"), F.sum("n").alias("n_references"))


# -- edges

_PAIRS = " or ".join(f"(relationship_type = '{r}' and coalesce(string_split(src_uri, '::')[3], '') || '>' || coalesce(string_split(tgt_uri, '::')[3], '') in {_list(tuple(f'{a}>{b}' for a, b in pairs))})" for r, pairs in graph.ALLOWED.items())
_REASON = f"case when src_uri is null or tgt_uri is null or len(string_split(src_uri, '::')) < 4 or len(string_split(tgt_uri, '::')) < 4 then 'malformed_uri' when not ({_PAIRS}) then 'type_pair_not_allowed' end"


def _tight_edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_edge").withColumns({c: tight_scopes(c) for c in ("src_uri", "tgt_uri")})


_EDGES = f"e as (select * replace ({_clean('src_uri')} as src_uri, {_clean('tgt_uri')} as tgt_uri) from graph_edge)"


@query("flt_edge_reasons", f"with {_EDGES} select coalesce({_REASON}, 'valid') as reason, relationship_type, count(*) as n_edges from e group by 1, 2")
def flt_edge_reasons(spark: SparkSession, d: str) -> DataFrame:
    reason = graph.drop_reason(F.col("src_uri"), F.col("tgt_uri"), F.col("relationship_type"))
    return _tight_edges(spark, d).groupBy(F.coalesce(reason, F.lit("valid")).alias("reason"), "relationship_type").agg(F.count("*").alias("n_edges"))


_KEYS = ", ".join(graph.EDGE_KEY)


@query(
    "agg_dedupe_edges",
    f"select {_KEYS}, epoch_us(min(ingested_at)) as first_seen_us, arg_min(src_uri, (ingested_at, src_uri, tgt_uri)) as src_uri, arg_min(tgt_uri, (ingested_at, src_uri, tgt_uri)) as tgt_uri from graph_edge where src_uri is not null and tgt_uri is not null group by {_KEYS}",
)
def agg_dedupe_edges(spark: SparkSession, d: str) -> DataFrame:
    e = graph.dedupe_edges(table(spark, d, "graph_edge").where("src_uri is not null and tgt_uri is not null"), [F.col(c) for c in ("ingested_at", "src_uri", "tgt_uri")])
    return e.select(*graph.EDGE_KEY, F.unix_micros("ingested_at").alias("first_seen_us"), "src_uri", "tgt_uri")


@query(
    "agg_dedupe_nodes",
    "select owner_repo, scip_symbol, file_path, is_external from (select *, row_number() over (partition by owner_repo, scip_symbol order by is_external, file_path, global_uri) as r from graph_node) where r = 1",
)
def agg_dedupe_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "graph_node").withColumn("seq", F.struct("file_path", "global_uri"))
    return graph.dedupe_nodes(n, "seq").select("owner_repo", "scip_symbol", "file_path", "is_external")


_ENDS = "(owner_repo, scip_symbol)"


@query(
    "snk_edge_merge",
    f"""select distinct {_KEYS}, is_cross_repo from graph_edge where (src_owner_repo, src_scip_symbol) in (select {_ENDS} from graph_node) and (tgt_owner_repo, tgt_scip_symbol) in (select {_ENDS} from graph_node)""",
)
def snk_edge_merge(spark: SparkSession, d: str) -> DataFrame:
    """The store of edges after all edges were merged into an empty one."""
    edges = table(spark, d, "graph_edge")
    return graph.merge_edges(edges.limit(0), edges, table(spark, d, "graph_node"))[0]


@query(
    "snk_edge_report",
    f"""with e as (select distinct {_KEYS} from graph_edge), k as (select *, (src_owner_repo, src_scip_symbol) in (select {_ENDS} from graph_node where not is_external) and (tgt_owner_repo, tgt_scip_symbol) in (select {_ENDS} from graph_node where not is_external) as kept from e)
select relationship_type, count(*) as offered, count(*) filter (where kept) as merged, count(*) filter (where not kept) as vanished from k group by 1""",
)
def snk_edge_report(spark: SparkSession, d: str) -> DataFrame:
    """How many edges were offered to a store without external nodes, and how many vanished for want of an end."""
    edges = table(spark, d, "graph_edge")
    return graph.merge_edges(edges.limit(0), edges, table(spark, d, "graph_node").where("not is_external"))[1]


@query("snk_defined_in", "select distinct owner_repo, scip_symbol, repo_name, file_path from graph_node where file_path <> '<external>'")
def snk_defined_in(spark: SparkSession, d: str) -> DataFrame:
    return graph.defined_in(table(spark, d, "graph_node"))


@query(
    "snk_node_merge",
    """select owner_repo, scip_symbol, case when entity_type = 'Function' then owner_repo else ingestion_repo end as ingestion_repo, case when is_external then '<external>' else file_path end as file_path, is_external
from (select *, row_number() over (partition by owner_repo, scip_symbol order by is_external, file_path, global_uri) as r from graph_node) where r = 1""",
)
def snk_node_merge(spark: SparkSession, d: str) -> DataFrame:
    """Stubs of every node arrive after the nodes themselves, with new ingestion repositories: real nodes stay."""
    old = graph.dedupe_nodes(table(spark, d, "graph_node").withColumn("seq", F.struct("file_path", "global_uri")), "seq").drop("seq")
    new = old.withColumns({"is_external": F.lit(True), "file_path": F.lit("<external>"), "ingestion_repo": F.when(F.col("entity_type") == "Function", F.col("owner_repo"))})
    return graph.merge_nodes(old, new).select("owner_repo", "scip_symbol", "ingestion_repo", "file_path", "is_external")


@query(
    "snk_delete_repo",
    """with f as (select min(repo_name) as r from repo_catalog)
select 'nodes' as kind, repo_name as repo, count(*) as n from graph_node, f where repo_name is distinct from r group by repo_name
union all select 'edges', src_owner_repo, count(*) from graph_edge, f where src_owner_repo is distinct from r and tgt_owner_repo is distinct from r group by src_owner_repo""",
)
def snk_delete_repo(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges that are left of each repository after the first one was deleted."""
    first = table(spark, d, "repo_catalog").agg(F.min("repo_name")).first()[0]
    nodes, edges = graph.delete_repository(table(spark, d, "graph_node"), table(spark, d, "graph_edge"), first)
    left = lambda df, kind, repo: df.groupBy(F.lit(kind).alias("kind"), F.col(repo).alias("repo")).agg(F.count("*").alias("n"))
    return left(nodes, "nodes", "repo_name").unionByName(left(edges, "edges", "src_owner_repo"))


# The graph built anew from what the tables say of the indexes: nodes as definitions, edges as their relationships.
_DEFS = f"""d as (select owner_repo as repo, scip_symbol, file_path, entity_type, not is_external as defined from graph_node where owner_repo is not null and scip_symbol is not null),
c as (select scip_symbol, arg_min(repo, (coalesce(precedence, 2147483647), repo)) as owner, arg_min(file_path, (coalesce(precedence, 2147483647), repo)) as file from d left join repo_catalog r on r.repo_name = d.repo where defined group by 1),
m as (select repo, scip_symbol from d union select src_owner_repo, src_scip_symbol from graph_edge union select src_owner_repo, tgt_scip_symbol from graph_edge
 union select repo, scip_symbol from scip_reference union select repo, enclosing_symbol from scip_reference),
x as (select *, regexp_replace(scip_symbol, '^cxx \\. \\. \\$ ', '') as rest from m where scip_symbol is not null and not starts_with(scip_symbol, 'local ')),
s as (select x.repo, x.scip_symbol, case when not suffix(rest, '#') then 'Function' when d.entity_type = 'Struct' then 'Struct' else 'Class' end as type,
 replace(regexp_replace(rest, '(#|\\([^)]*\\)\\.|\\.)$', ''), '/', '::') as name, split_part(rest, '/', 1) as ns, d.file_path as local_file, d.scip_symbol is not null as here, coalesce(d.defined, false) as defined, c.file as catalog_file, c.owner as catalog_owner,
 case when regexp_matches(rest, '\\([^)]+\\)\\.$') then 'sig_' || regexp_extract(rest, '\\(([^)]+)\\)\\.$', 1) end as sig
 from x left join d on d.repo = x.repo and d.scip_symbol = x.scip_symbol left join c on c.scip_symbol = x.scip_symbol),
t as (select *, coalesce(catalog_owner, case ns when 'base' then 'basalt-tools' end, repo) as owner, case when ns in {_list(IGNORED)} then 'drop' when ns in {_list(MONITORED)} and not here then 'stub' else 'keep' end as what,
 case when (defined and coalesce(catalog_owner, case ns when 'base' then 'basalt-tools' end, repo) <> repo) or (not defined and ns in {_list(MONITORED)}) then true else false end as away from s),
l as (select src_owner_repo as repo, src_scip_symbol as src, tgt_scip_symbol as tgt, relationship_type as kind, 0 as phase, cast(null as varchar) as file from graph_edge where relationship_type <> 'CALLS'
 union select repo, enclosing_symbol, scip_symbol, role, 1, file_path from scip_reference where enclosing_symbol is not null and scip_symbol is not null),
j as (select l.*, a.owner as ao, a.type as a_t, b.owner as bo, b.type as b_t, b.what as bw, b.catalog_owner as bc, b.name as bn, b.sig as bs,
 a.owner || '::' || case when phase = 1 then coalesce(a.catalog_file, a.local_file, l.file) when a.away then coalesce(a.catalog_file, a.local_file, '<external>') else a.local_file end || '::' || a.type || '::' || a.name as src_uri,
 case when b.what = 'stub' then coalesce(b.catalog_file, b.local_file, '<external>') when phase = 1 then coalesce(b.catalog_file, b.local_file, l.file) else coalesce(b.local_file, a.local_file) end as bf,
 b.owner || '::' || bf || '::' || b.type || '::' || b.name as tgt_uri from l join t a on a.repo = l.repo and a.scip_symbol = l.src join t b on b.repo = l.repo and b.scip_symbol = l.tgt where b.what <> 'drop')"""


def _index(spark: SparkSession, d: str) -> construction.Graph:
    n = table(spark, d, "graph_node").where("owner_repo is not null and scip_symbol is not null")
    kind = F.when(F.col("entity_type") == "Class", 7).when(F.col("entity_type") == "Struct", 49).otherwise(17)
    defs = n.select(F.col("owner_repo").alias("repo"), F.xxhash64("scip_symbol").alias("seq"), "scip_symbol", "file_path", kind.alias("kind"), (~F.col("is_external")).alias("has_definition"))
    e = table(spark, d, "graph_edge").where("relationship_type <> 'CALLS'")
    built = F.col("relationship_type").isin("INHERITS", "OVERRIDES")
    rel = e.select(F.col("src_owner_repo").alias("repo"), F.xxhash64("src_scip_symbol").alias("seq"), F.col("src_scip_symbol").alias("scip_symbol"), F.col("tgt_scip_symbol").alias("target"), built.alias("is_implementation"), (~built).alias("is_type_definition"))
    refs = table(spark, d, "scip_reference")
    order = table(spark, d, "repo_catalog").select(F.col("repo_name").alias("repo"), F.col("precedence").alias("position"))
    catalog = cut(graph.ownership(defs.where("has_definition"), order))
    return construction.build_graph(defs, rel, refs, catalog, order, construction.Namespaces(MONITORED, IGNORED, {"base": "basalt-tools"}))


_STUB_ROWS = "select distinct bo as owner_repo, tgt as scip_symbol, repo as ingestion_repo, tgt_uri as global_uri, bs as function_sig_hash, bf as file_path, b_t as entity_type, bn as entity_name, true as is_external, 1 as phase from j where bw = 'stub' and bc is null"


@query(
    "grf_nodes",
    f"""with {_DEFS}, o as (select t.owner as owner_repo, t.scip_symbol, t.repo as ingestion_repo, t.owner || '::' || case when t.away then coalesce(t.catalog_file, t.local_file, '<external>') else t.local_file end || '::' || t.type || '::' || t.name as global_uri,
 t.sig as function_sig_hash, case when t.away then coalesce(t.catalog_file, t.local_file, '<external>') else t.local_file end as file_path, t.type as entity_type, t.name as entity_name, t.away as is_external, 0 as phase from t where here and what <> 'drop'
 union all {_STUB_ROWS}),
r as (select o.*, row_number() over (partition by owner_repo, scip_symbol order by is_external, coalesce(precedence, 2147483647), phase) as r from o left join repo_catalog on repo_name = ingestion_repo)
select owner_repo, scip_symbol, global_uri, file_path, entity_type, entity_name, case when entity_type = 'Function' then function_sig_hash end as function_sig_hash, is_external from r where r = 1""",
)
def grf_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of all repositories, from their definitions and what they refer to."""
    return _index(spark, d).nodes.select("owner_repo", "scip_symbol", "global_uri", "file_path", "entity_type", "entity_name", "function_sig_hash", "is_external")


_EDGE_SQL = f"""{_DEFS}, e as (select phase, ao as src_owner_repo, src as src_scip_symbol, bo as tgt_owner_repo, tgt as tgt_scip_symbol, src_uri, tgt_uri, ao <> bo or bw = 'stub' as is_cross_repo,
 case when kind in ('INHERITS', 'OVERRIDES') then case when a_t = 'Function' and b_t = 'Function' then 'OVERRIDES' when a_t in ('Class', 'Struct') and b_t in ('Class', 'Struct') then 'INHERITS' end
  when kind = 'USES_TYPE' or (kind in ('CALL', 'READ', 'WRITE') and b_t in ('Class', 'Struct')) then case when b_t in ('Class', 'Struct') then 'USES_TYPE' end
  when kind in ('CALL', 'READ', 'WRITE') and a_t = 'Function' and b_t = 'Function' then 'CALLS' end as relationship_type from j)"""


@query("grf_edges", f"with {_EDGE_SQL} select {_KEYS}, arg_min(is_cross_repo, phase) as is_cross_repo, arg_min(src_uri, phase) as src_uri, arg_min(tgt_uri, phase) as tgt_uri from e where relationship_type is not null group by {_KEYS}")
def grf_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of all repositories, from relationships and references."""
    return _index(spark, d).edges.select(*graph.EDGE_KEY, "is_cross_repo", "src_uri", "tgt_uri")


@query(
    "grf_reference_edges",
    """with n as (select scip_symbol, min(entity_type) as t from graph_node where scip_symbol is not null group by 1),
r as (select distinct repo, seq, scip_symbol, enclosing_symbol, role from scip_reference where enclosing_symbol is not null)
select enclosing_symbol as src, r.scip_symbol as tgt, case when b.t in ('Class', 'Struct') then 'USES_TYPE' when a.t = 'Function' and b.t = 'Function' then 'CALLS' end as relationship_type, count(*) as n_references
from r join n a on a.scip_symbol = r.enclosing_symbol join n b on b.scip_symbol = r.scip_symbol where role in ('CALL', 'READ', 'WRITE')
group by 1, 2, 3 having relationship_type is not null""",
)
def grf_reference_edges(spark: SparkSession, d: str) -> DataFrame:
    """How many references stand behind each edge: the enclosing entity uses a type, or calls a function.

    Distinct (repo, seq) are counted by source, target and role before they meet the node types, so hot targets shrink first.
    """
    t = table(spark, d, "graph_node").where("scip_symbol is not null").groupBy("scip_symbol").agg(F.min("entity_type").alias("t"))
    r = table(spark, d, "scip_reference").where("enclosing_symbol is not null and role in ('CALL', 'READ', 'WRITE')").select("repo", "seq", "scip_symbol", "enclosing_symbol", "role").distinct()
    r = r.groupBy(F.col("enclosing_symbol").alias("src"), F.col("scip_symbol").alias("tgt"), "role").agg(F.count("*").alias("n"))
    j = lookup(lookup(r, t.toDF("src", "st"), "src", "inner"), t.toDF("tgt", "tt"), "tgt", "inner")
    e = j.withColumn("relationship_type", graph.reference_relation(F.col("st"), F.col("tt"), F.col("role"))).where("relationship_type is not null")
    return e.groupBy("src", "tgt", "relationship_type").agg(F.sum("n").alias("n_references"))


@query(
    "agg_ownership",
    """with f as (select d.scip_symbol, d.repo_name as repo, d.file_path, coalesce(c.precedence, 2147483647) as rank from graph_node d left join repo_catalog c on c.repo_name = d.repo_name where not is_external and scip_symbol is not null)
select scip_symbol, arg_min(repo, (rank, file_path, repo)) as owner_repo, arg_min(file_path, (rank, file_path, repo)) as file_path, len(list_distinct(list(repo))) as n_candidates, count(*) > 1 as is_conflict, case when count(*) > 1 then 'stable_order' else 'single_local_definition' end as reason from f group by 1""",
)
def agg_ownership(spark: SparkSession, d: str) -> DataFrame:
    defs = table(spark, d, "graph_node").where("not is_external").select("scip_symbol", F.col("repo_name").alias("repo"), "file_path", F.col("file_path").alias("seq"))
    order = table(spark, d, "repo_catalog").select(F.col("repo_name").alias("repo"), F.col("precedence").alias("position"))
    return graph.ownership(defs, order).select("scip_symbol", "owner_repo", "file_path", F.size("candidates").cast("long").alias("n_candidates"), "is_conflict", "reason")


@query(
    "set_missing_stubs",
    "select distinct repo, scip_symbol from scip_reference where scip_symbol is not null and (repo, scip_symbol) not in (select owner_repo, scip_symbol from graph_node where owner_repo is not null and scip_symbol is not null)",
)
def set_missing_stubs(spark: SparkSession, d: str) -> DataFrame:
    """Symbols that a repository refers to and owns no node for."""
    t = table(spark, d, "scip_reference").where("scip_symbol is not null").select("repo", "scip_symbol").distinct()
    return t.join(table(spark, d, "graph_node").select(F.col("owner_repo").alias("repo"), "scip_symbol"), ["repo", "scip_symbol"], "left_anti")


@query(
    "join_enclosing_scope",
    """with s as (select repo_name as repo, file_path, start_line as s, end_line as e, min(entity_name) as n from code_entity where end_line >= start_line group by all),
r as (select repo, seq, file_path, min(line) as line from scip_reference group by repo, seq, file_path)
select r.repo, r.seq, r.file_path, line, arg_min(n, (e - s, -s, n)) as scope from r left join s on s.repo = r.repo and s.file_path = r.file_path and line between s and e group by 1, 2, 3, 4""",
)
def join_enclosing_scope(spark: SparkSession, d: str) -> DataFrame:
    """Each reference with the innermost entity around its line."""
    spans = table(spark, d, "code_entity").groupBy(F.col("repo_name").alias("repo"), "file_path", "start_line", "end_line").agg(F.min("entity_name").alias("scope"))
    refs = table(spark, d, "scip_reference").groupBy("repo", "seq", "file_path").agg(F.min("line").alias("line"))
    return innermost(refs, spans, ["repo", "file_path"], "line", "start_line", "end_line", "scope")


# -- aggregates, windows, batches

_LAST = "(select *, row_number() over (partition by file_id order by extracted_at desc nulls last, arrived_at desc nulls last, parse_error_count desc nulls last, entity_count desc nulls last) as r from file_diagnostics)"


@query(
    "agg_extraction_stats",
    f"""select repo_name, count(*) as files, count(*) filter (where parse_error_count > 0) as files_with_errors, count(*) filter (where parse_error_count is null) as files_unknown,
 cast(sum(coalesce(parse_error_count, 0)) as bigint) as parse_errors, cast(sum(coalesce(entity_count, 0)) as bigint) as entities, round(1 - count(*) filter (where parse_error_count > 0) / count(*), 6) as clean_rate from {_LAST} where r = 1 group by 1""",
)
def agg_extraction_stats(spark: SparkSession, d: str) -> DataFrame:
    last = graph.first_by(table(spark, d, "file_diagnostics"), ["file_id"], [F.col(c).desc_nulls_last() for c in ("extracted_at", "arrived_at", "parse_error_count", "entity_count")])
    bad = F.count_if(F.col("parse_error_count") > 0)
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)).cast("long"))
    return last.groupBy("repo_name").agg(
        F.count("*").alias("files"), bad.alias("files_with_errors"), F.count_if(F.col("parse_error_count").isNull()).alias("files_unknown"), zero("parse_error_count").alias("parse_errors"), zero("entity_count").alias("entities"), F.round(1 - bad / F.count("*"), 6).alias("clean_rate")
    )


@query("agg_file_entities", "select repo_name, file_path, count(distinct entity_id) as entities, min(start_line) as first_line, max(end_line) as last_line from code_entity group by 1, 2")
def agg_file_entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "code_entity").groupBy("repo_name", "file_path").agg(F.count_distinct("entity_id").alias("entities"), F.min("start_line").alias("first_line"), F.max("end_line").alias("last_line"))


@query(
    "win_overload_salt",
    """with e as (select distinct entity_id, repo_name, file_path, entity_type, entity_name, function_sig_hash from code_entity where entity_type = 'Function'),
n as (select *, row_number() over (partition by repo_name, file_path, entity_type, entity_name, function_sig_hash order by entity_id) - 1 as k from e)
select entity_id, case when function_sig_hash is null or k = 0 then function_sig_hash else 'sig_' || substr(sha1(function_sig_hash || '|duplicate:' || k), 1, 12) end as function_sig_hash from n""",
)
def win_overload_salt(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "code_entity").where("entity_type = 'Function'").select("entity_id", "repo_name", "file_path", "entity_type", "entity_name", "function_sig_hash").distinct()
    return cpp.salted_overloads(e, "entity_id").select("entity_id", "function_sig_hash")


@query("win_fixed_batches", "select repo_name, cast(floor((r - 1) / 32) as bigint) as batch, count(*) as files from (select repo_name, row_number() over (partition by repo_name order by file_id, extracted_at, arrived_at) as r from file_diagnostics) group by 1, 2")
def win_fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 32 rows of each repository. Rows are numbered by prefix sums over tasks, whatever a repository's size."""
    order = ["repo_name", "file_id", "extracted_at", "arrived_at"]
    numbered = cut(numbered_chunks(table(spark, d, "file_diagnostics").select(*order), order, 200_000))
    first = numbered.groupBy("repo_name").agg(F.min("_row").alias("_first"))
    at = lookup(numbered.withColumnRenamed("repo_name", "r"), first.withColumnRenamed("repo_name", "q"), F.col("r").eqNullSafe(F.col("q")))
    return at.groupBy(F.col("r").alias("repo_name"), F.floor((F.col("_row") - F.col("_first")) / 32).alias("batch")).agg(F.count("*").alias("files"))


@query("agg_point_report", "select case when vector is null then 'missing_vector' when len(vector) <> 64 then 'dimension_mismatch' else 'ok' end as reason, count(*) as points, round(count(*) / (select count(*) from vector_point), 6) as share from vector_point group by 1")
def agg_point_report(spark: SparkSession, d: str) -> DataFrame:
    """How many points would be written, and why the others are dropped."""
    reason = F.when(F.col("vector").isNull(), "missing_vector").when(F.size("vector") != 64, "dimension_mismatch").otherwise("ok")
    g = table(spark, d, "vector_point").groupBy(reason.alias("reason")).agg(F.count("*").alias("points"))
    return g.withColumn("share", F.round(F.col("points") / F.sum("points").over(Window.partitionBy()), 6))


# -- the vector table

@query("snk_upsert", "select id, max(epoch_us(updated_at)) as updated_us from vector_point where id is not null group by id")
def snk_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The table after all versions of all points were written to it, one half of the ids again, and it was compacted."""
    p = table(spark, d, "vector_point").where("id is not null")
    path = scratch(spark, "points")
    upsert(path, p, "id", "updated_at")
    upsert(path, p.where(F.col("id") < "8"), "id", "updated_at")
    compact(spark, path, "id", "updated_at", most_files=1)
    return read_table(spark, path, "id", "updated_at").select("id", F.unix_micros("updated_at").alias("updated_us"))


@query(
    "qry_points",
    f"""select entity_id, epoch_us(ingested_at) as ingested_us, {_KEY} as identity_key, repo_name, file_path, entity_type, entity_name, start_line, end_line, is_templated, function_sig_hash, coalesce(code_text is null, false) as dropped from code_entity""",
)
def qry_points(spark: SparkSession, d: str) -> DataFrame:
    """Every entity as a point with its payload."""
    payload = ["repo_name", "file_path", "entity_type", "entity_name", "start_line", "end_line", "is_templated", "function_sig_hash"]
    return points(table(spark, d, "code_entity")).select("entity_id", F.expr(_US), "identity_key", *payload, F.col("reason").isNotNull().alias("dropped"))


@query(
    "qry_top_k",
    """with q as (select cast(embedding as double[]) as q from embeddings where vec_id = 0) select vec_id, round(list_cosine_similarity(cast(embedding as double[]), q), 6) as score from embeddings, q where len(embedding) = 64 order by score desc, vec_id limit 10""",
)
def qry_top_k(spark: SparkSession, d: str) -> DataFrame:
    """The ten vectors nearest to vector 0."""
    e = table(spark, d, "embeddings")
    return search.top_k(e, e.where("vec_id = 0").first()["embedding"], "embedding", "vec_id", 10)


@query(
    "join_node_points",
    """with p as (select identity_key, id, file_path, row_number() over (partition by identity_key order by file_path, id, updated_at) as r from vector_point)
select n.owner_repo, n.scip_symbol, n.identity_key, p.id, p.file_path from (select distinct owner_repo, scip_symbol, identity_key from graph_node) n left join p on p.identity_key = n.identity_key and p.r = 1""",
)
def join_node_points(spark: SparkSession, d: str) -> DataFrame:
    """Every node with the one point of its identity key."""
    p = table(spark, d, "vector_point").where("identity_key is not null").groupBy("identity_key").agg(F.min_by(F.struct("id", "file_path"), F.struct("file_path", "id", "updated_at")).alias("p"))
    n = table(spark, d, "graph_node").select("owner_repo", "scip_symbol", "identity_key").distinct()
    return n.join(p, "identity_key", "left").select("owner_repo", "scip_symbol", "identity_key", "p.id", "p.file_path")


# -- queries of the graph

_VALID = f"{_EDGES}, v as (select distinct src_uri as src, tgt_uri as tgt, relationship_type from e where ({_REASON}) is null)"
_ROOT = "(select tgt as root from v where not contains(tgt, '<external>') group by tgt order by count(*) desc, tgt limit 1)"


def _valid(spark: SparkSession, d: str) -> DataFrame:
    e = _tight_edges(spark, d)
    return e.where(graph.drop_reason(F.col("src_uri"), F.col("tgt_uri"), F.col("relationship_type")).isNull()).select(F.col("src_uri").alias("src"), F.col("tgt_uri").alias("tgt"), "relationship_type").distinct()


def _root(edges: DataFrame) -> str:
    """The entity most others point to, externals aside."""
    return edges.where("not contains(tgt, '<external>')").groupBy("tgt").count().orderBy(F.desc("count"), "tgt").first()["tgt"]


@query(
    "qry_blast_radius",
    f"""with recursive {_VALID}, walk as (select root as node, 0 as depth, '' as chain from {_ROOT} union select v.src, depth + 1, chain || case when depth = 0 then '' else ' > ' end || relationship_type from walk join v on v.tgt = walk.node where depth < 5)
select node, min(depth) as depth, arg_min(chain, (depth, chain)) as chain from walk group by node having min(depth) > 0""",
)
def qry_blast_radius(spark: SparkSession, d: str) -> DataFrame:
    """What depends on the entity most others point to, with the chain of relationships."""
    e = cut(_valid(spark, d))
    roots = spark.createDataFrame([(_root(e),)], "node string")
    return search.blast_radius(e, roots, 5).select("node", "depth", F.array_join("chain", " > ").alias("chain"))


@query(
    "qry_sample_class",
    f"""with recursive {_VALID}, c as (select repo_name as repo, min(global_uri) as root from graph_node where entity_type in ('Class', 'Struct') and not is_external and global_uri is not null group by 1),
walk as (select repo, root, root as node, 0 as depth from c union select repo, root, v.src, depth + 1 from walk join v on v.tgt = walk.node where depth < 3)
select repo, root, count(distinct node) - 1 as reached, max(depth) as deepest from walk group by 1, 2""",
)
def qry_sample_class(spark: SparkSession, d: str) -> DataFrame:
    """The first class of every repository, with how much depends on it within three steps."""
    n = table(spark, d, "graph_node").where("entity_type in ('Class', 'Struct') and not is_external and global_uri is not null")
    roots = n.groupBy(F.col("repo_name").alias("repo")).agg(F.min("global_uri").alias("root"))
    links = cut(_valid(spark, d).select(F.col("tgt").alias("node"), F.col("src").alias("next")).distinct())
    front = seen = cut(roots.select("repo", "root", F.col("root").alias("node"), F.lit(0).alias("depth")))
    for depth in range(1, 4):
        step = links.join(front, "node").select("repo", "root", F.col("next").alias("node"), F.lit(depth).alias("depth")).distinct()
        front = cut(step.join(seen.select("repo", "node"), ["repo", "node"], "left_anti"))
        seen = seen.unionByName(front)
    walked = seen.groupBy("repo", "root").agg((F.count("*") - 1).alias("reached"))
    ends = links.join(seen.where("depth < 3"), "node").groupBy("repo").agg(F.max(F.col("depth") + 1).alias("deepest"))
    return walked.join(ends, "repo", "left").select("repo", "root", "reached", F.coalesce("deepest", F.lit(0)).alias("deepest"))


@query(
    "qry_neighbors",
    f"""with {_VALID}, a as (select 'inbound' as direction, relationship_type, src as neighbor from v where tgt = (select root from {_ROOT}) union select 'outbound', relationship_type, tgt from v where src = (select root from {_ROOT})),
r as (select *, row_number() over (partition by direction order by relationship_type, neighbor) as r from a) select direction, relationship_type, neighbor from r where r <= 200""",
)
def qry_neighbors(spark: SparkSession, d: str) -> DataFrame:
    e = cut(_valid(spark, d))
    return search.neighbors(e, _root(e))


@query(
    "qry_inheritance",
    f"""with recursive {_ALL_LINKS}, up as (select child as node, parent as anc, 1 as depth from link union select up.node, link.parent, depth + 1 from up join link on link.child = up.anc where depth < 300),
least as (select node, anc, min(depth) as depth from up group by 1, 2),
both_ as (select node as uri, 'ancestor' as relation, anc as other, depth from least union all select anc, 'descendant', node, depth from least),
r as (select *, row_number() over (partition by uri, relation order by depth, other) as r from both_) select uri, relation, other, depth from r where r <= 200""",
)
def qry_inheritance(spark: SparkSession, d: str) -> DataFrame:
    """The first 200 ancestors and descendants of every type, by any of its parents, with the least distance."""
    return search.inheritance(inherits_links(spark, d), "child", "parent", 200)


@query("qry_graph_counts", "select owner_repo, entity_type, is_external, count(*) as nodes from graph_node group by all")
def qry_graph_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_node").groupBy("owner_repo", "entity_type", "is_external").agg(F.count("*").alias("nodes"))


@query("qry_edge_counts", "select src_owner_repo as repo, relationship_type, count(*) as edges, count(*) filter (where is_cross_repo) as cross_repo from graph_edge group by 1, 2")
def qry_edge_counts(spark: SparkSession, d: str) -> DataFrame:
    """Edges of every repository."""
    return table(spark, d, "graph_edge").groupBy(F.col("src_owner_repo").alias("repo"), "relationship_type").agg(F.count("*").alias("edges"), F.count_if("is_cross_repo").alias("cross_repo"))


@query(
    "qry_cross_file",
    f"with {_VALID} select relationship_type, string_split(src, '::')[1] = string_split(tgt, '::')[1] as same_repo, count(*) as n_edges from v where string_split(src, '::')[1] || '::' || string_split(src, '::')[2] <> string_split(tgt, '::')[1] || '::' || string_split(tgt, '::')[2] group by 1, 2",
)
def qry_cross_file(spark: SparkSession, d: str) -> DataFrame:
    """Edges between different files."""
    part = lambda c, n: F.get(F.split(c, "::", -1), F.lit(n))
    file = lambda c: F.concat_ws("::", part(c, 0), part(c, 1))
    e = _valid(spark, d).where(file("src") != file("tgt"))
    return e.groupBy("relationship_type", (part("src", 0) == part("tgt", 0)).alias("same_repo")).agg(F.count("*").alias("n_edges"))


@query(
    "qry_documents",
    """with p as (select identity_key, id, entity_type, row_number() over (partition by identity_key order by updated_at desc nulls last, id) as r from vector_point)
select d.doc_id, d.about_uri, p.id, p.entity_type from (select doc_id, about_uri from documents where about_uri is not null) d join p on p.identity_key = d.about_uri and p.r = 1""",
)
def qry_documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents about an entity, with its point."""
    p = table(spark, d, "vector_point").where("identity_key is not null").select("identity_key", "id", "entity_type", "updated_at")
    last = graph.first_by(p, ["identity_key"], [F.col("updated_at").desc_nulls_last(), F.col("id")]).drop("updated_at")
    docs = table(spark, d, "documents").where("about_uri is not null").select("doc_id", "about_uri")
    return docs.join(last, docs.about_uri == last.identity_key).select("doc_id", "about_uri", "id", "entity_type")


@query("ext_entities")
def ext_entities(spark: SparkSession, d: str) -> DataFrame:
    """Classes, structs and functions of every C++ file."""
    return cpp.entities(table(spark, d, "source_file")).drop("code_text")


@query("ext_declarations")
def ext_declarations(spark: SparkSession, d: str) -> DataFrame:
    """The entities of every C++ file, functions that are only declared included."""
    return cpp.entities(table(spark, d, "source_file"), include_declarations=True).drop("code_text")


@query("ext_diagnostics")
def ext_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Errors and entities of every C++ file."""
    return cpp.diagnostics(table(spark, d, "source_file"))
