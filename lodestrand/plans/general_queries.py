"""Queries of the two general problems: hierarchies (p2) and hot keys (p5), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.uri import WS, tight_scopes
from ..operators.hierarchy import descendants, resolve
from ..operators.skew import key_counts
from .session import cut, table


def inherits_links(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned (child, parent) pairs of the INHERITS rows between two well-formed class or struct URIs."""
    e = table(spark, d, "graph_edge").where("relationship_type = 'INHERITS'").select(tight_scopes("src_uri").alias("child"), tight_scopes("tgt_uri").alias("parent"))
    for c in ("child", "parent"):
        parts = F.split(c, "::", -1)
        e = e.where(F.col(c).isNotNull() & (F.size(parts) >= 4) & F.get(parts, F.lit(2)).isin("Class", "Struct"))
    return e


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    r = resolve(inherits_links(spark, d), "child", "parent")
    return r.select(F.col("node").alias("uri"), F.col("root").alias("root_uri"), "depth")


def p2_paths(spark: SparkSession, d: str) -> DataFrame:
    r = resolve(inherits_links(spark, d), "child", "parent", paths=True)
    return r.select(F.col("node").alias("uri"), F.col("root").alias("root_uri"), "depth", F.array_join("path", " > ").alias("full_path"))


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    links = cut(inherits_links(spark, d))
    return descendants(resolve(links, "child", "parent", paths=True), links).select("ancestor", "descendant", F.col("distance").cast("int").alias("distance"))


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "scip_reference").select(F.lit("scip_reference.scip_symbol").alias("field_name"), F.col("scip_symbol").alias("key_value"), "repo", F.col("enclosing_symbol").alias("caller"))
    e = table(spark, d, "graph_edge").select(F.lit("graph_edge.tgt_uri").alias("field_name"), F.col("tgt_uri").alias("key_value"), F.col("src_owner_repo").alias("repo"), F.col("src_uri").alias("caller"))
    return s.unionByName(e)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    counts = key_counts(_keyed(spark, d), ["field_name", "key_value"], "repo")
    rows = counts.groupBy("field_name").agg(F.sum("n_rows").alias("_all"))
    return counts.join(F.broadcast(rows), "field_name").where("key_value is not null and n_rows * 50 >= _all").select("field_name", "key_value")


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, repositories and callers of every value of both fields."""
    k = ["field_name", "key_value"]
    keyed = _keyed(spark, d).where("key_value is not null")
    repos = key_counts(keyed, k, "repo").select(*k, "n_rows", F.col("n_values").alias("n_repos"))
    callers = key_counts(keyed, k, "caller").select(*k, F.col("n_values").alias("n_callers"))
    return repos.join(callers, k)


QUERIES = {"p2_found": p2_found, "p2_paths": p2_paths, "p2_descendants": p2_descendants, "p5_found": p5_found, "p5_counts": p5_counts}



def _clean(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '{WS}*::{WS}*', '::', 'g'), '^{WS}+|{WS}+$', '', 'g')"


ALL_LINKS = f"""raw as (select {_clean('src_uri')} as child, {_clean('tgt_uri')} as parent from graph_edge where relationship_type = 'INHERITS'),
link as (select distinct child, parent from raw where len(string_split(child, '::')) >= 4 and len(string_split(parent, '::')) >= 4
  and string_split(child, '::')[3] in ('Class', 'Struct') and string_split(parent, '::')[3] in ('Class', 'Struct'))"""
_LINKS = f"""
raw as (select {_clean('src_uri')} as child, {_clean('tgt_uri')} as parent from graph_edge where relationship_type = 'INHERITS'),
link as (select child, min(parent) as parent from raw where len(string_split(child, '::')) >= 4 and len(string_split(parent, '::')) >= 4
  and string_split(child, '::')[3] in ('Class', 'Struct') and string_split(parent, '::')[3] in ('Class', 'Struct') group by child),
node as (select child as uri from link union select parent from link),
up as (select child as uri, parent as anc from link union select up.uri, link.parent from up join link on link.child = up.anc),
ring as (select uri from up where uri = anc),
ringroot as (select up.uri, min(up.anc) as root_uri from up join ring on ring.uri = up.anc group by up.uri),
tree as (select node.uri, coalesce(max(up.anc) filter (where up.anc not in (select child from link)), node.uri) as root_uri, cast(count(up.anc) as integer) as depth
  from node left join up on up.uri = node.uri group by node.uri)"""
_DEPTH = "select t.uri, coalesce(r.root_uri, t.root_uri) as root_uri, case when t.uri in (select uri from ring) then -1 when r.uri is not null then -2 else t.depth end as depth from tree t left join ringroot r on r.uri = t.uri"
_KEYED = """keyed as (select 'scip_reference.scip_symbol' as field_name, scip_symbol as key_value, repo, enclosing_symbol as caller from scip_reference
  union all select 'graph_edge.tgt_uri', tgt_uri, src_owner_repo, src_uri from graph_edge)"""

SQL = {
    "p2_found": f"with recursive {_LINKS} {_DEPTH}",
    "p2_paths": f"""with recursive {_LINKS}, solved as ({_DEPTH}),
path as (select uri, uri as full_path from solved where depth = 0 union all select link.child, path.full_path || ' > ' || link.child from path join link on link.parent = path.uri)
select s.uri, s.root_uri, s.depth, p.full_path from solved s left join path p on p.uri = s.uri""",
    "p2_descendants": f"""with recursive {_LINKS}, solved as ({_DEPTH}) select u.anc as ancestor, u.uri as descendant, a.depth - b.depth as distance
from up u join solved a on a.uri = u.uri join solved b on b.uri = u.anc where a.depth >= 0""",
    "p5_found": f"""with {_KEYED}, n as (select field_name, key_value, count(*) as c from keyed group by all)
select field_name, key_value from (select *, sum(c) over (partition by field_name) as t from n) where key_value is not null and c * 50 >= t""",
    "p5_counts": f"with {_KEYED} select field_name, key_value, count(*) as n_rows, count(distinct repo) as n_repos, count(distinct caller) as n_callers from keyed where key_value is not null group by all",
}
