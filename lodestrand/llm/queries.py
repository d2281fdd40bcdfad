"""Queries of the training-data operators, with SQL where SQL can say the same over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import table
from . import funcdocs, mixing, mojibake, neardup, neighbors, origin, packing, syntax, tokens
from .common import newest_rows


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    v = neighbors.usable_vectors(table(spark, d, "vector_point"), "id", "vector", "updated_at", 64)
    hits = neighbors.most_similar(v, k=5, min_similarity=0.85)
    return hits.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def p1_exact(spark: SparkSession, d: str) -> DataFrame:
    """``p1_found`` with both factors one: nothing is missed, at the cost of more comparisons."""
    v = neighbors.usable_vectors(table(spark, d, "vector_point"), "id", "vector", "updated_at", 64)
    hits = neighbors.most_similar(v, k=5, min_similarity=0.85, relax_route=1, relax_tree=1, least_shards=1)
    return hits.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return syntax.parsed_files(table(spark, d, "source_file")).where("n_errors > 0").select("file_id").distinct()


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    """Share of files that do not parse, for each repository and language."""
    return syntax.acceptance(syntax.parsed_files(table(spark, d, "source_file")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return funcdocs.described_functions(table(spark, d, "code_entity")).select("entity_id", "function_name").distinct()


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The code-description pairs themselves."""
    return funcdocs.described_functions(table(spark, d, "code_entity"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return origin.file_origins(table(spark, d, "source_file")).where("origin <> 'handwritten'").select("file_id").distinct()


def p6_repositories(spark: SparkSession, d: str) -> DataFrame:
    """How many files of each origin a repository has."""
    kinds = ["handwritten", "generated", "minified", "vendored", "blob"]
    o = origin.file_origins(table(spark, d, "source_file"))
    return o.groupBy("repo").agg(F.count("*").alias("files"), *[F.count_if(F.col("origin") == k).alias(k) for k in kinds])


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return newest_rows(table(spark, d, "code_entity").select("entity_id", "code_text", "ingested_at"), "entity_id", "ingested_at")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.similar_pairs(_entities(spark, d), "entity_id", "code_text", threshold=0.6, width=3, min_words=30)
    return pairs.select(F.col("a").alias("entity_id_a"), F.col("b").alias("entity_id_b"))


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    """The copied entities with the class of equal ones, the group and the number of links of each."""
    return neardup.duplicate_groups(*neardup.similar_classes(_entities(spark, d), "entity_id", "code_text", threshold=0.6, width=3, min_words=30)).withColumnRenamed("id", "entity_id")


def p8_placements(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document, or of each piece of one that is longer than a container."""
    sizes = tokens.with_token_counts(table(spark, d, "documents").select("doc_id", "text"))
    return packing.packed(sizes, table(spark, d, "pack_spec"), "doc_id", "n_tokens")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_placements(spark, d))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of every mix, once for each use."""
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(p9_mix(spark, d), table(spark, d, "mix_target"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restored_documents(table(spark, d, "documents")).where("garbled").select("doc_id").distinct()


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    """The documents with restored words, and their texts."""
    return mojibake.restored_documents(table(spark, d, "documents")).where("words > 0").select("doc_id", "words", "restored")


QUERIES = {"p1_found": p1_found, "p1_exact": p1_exact, "p3_found": p3_found, "p3_rates": p3_rates, "p4_found": p4_found, "p4_pairs": p4_pairs, "p6_found": p6_found, "p6_repositories": p6_repositories, "p7_found": p7_found, "p7_groups": p7_groups, "p8_placements": p8_placements, "p8_fill": p8_fill, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_restored": p10_restored}
_NEWEST = "(select *, row_number() over (partition by {key} order by {at} desc nulls last) as newest from {table} where {key} is not null)"

_SIMILAR = f"""w as (select entity_id, regexp_extract_all(lower(code_text), '[a-z0-9_]+') as w from {_NEWEST.format(key="entity_id", at="ingested_at", table="code_entity")} where newest = 1 and code_text is not null),
g as (select distinct entity_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from (select entity_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 30)),
n as (select entity_id, count(*) as n from g group by 1),
c as (select a.entity_id as a, b.entity_id as b, count(*) as c from g a join g b on a.s = b.s and a.entity_id < b.entity_id group by 1, 2),
p as (select a, b from c join n x on x.entity_id = a join n y on y.entity_id = b where c >= 0.6 * (x.n + y.n - c) - 1e-12)"""

SQL = {
    "p1_exact": f"""with v as (select id, cast(vector as double[]) as x from {_NEWEST.format(key="id", at="updated_at", table="vector_point")} where newest = 1 and len(vector) = 64
  and len(list_filter(vector, lambda y: y is null or isnan(y) or isinf(y))) = 0 and len(list_filter(vector, lambda y: y <> 0)) > 0),
s as (select a.id as a, b.id as b, round(list_cosine_similarity(a.x, b.x), 6) as sim from v a join v b on a.id <> b.id),
r as (select *, row_number() over (partition by a order by sim desc, b) as r from s where sim >= 0.85)
select distinct least(a, b) as id_a, greatest(a, b) as id_b from r where r <= 5""",
    "p7_found": f"""with {_SIMILAR} select a as entity_id_a, b as entity_id_b from p""",
    "p7_groups": f"""with recursive {_SIMILAR},
k as (select entity_id, min(entity_id) over (partition by shingles) as class_id from (select entity_id, list_sort(list(s)) as shingles from g group by 1)),
l as (select a, b from p union all select b, a from p),
reach as (select a as id, a as r from l union select reach.id, l.b from reach join l on l.a = reach.r),
o as (select id, min(r) as group_id from reach group by 1)
select o.id as entity_id, class_id, group_id, (select count(*) from l where l.a = o.id) as links from o join k on k.entity_id = o.id""",
}
