import pytest

from lodestrand.operators import graph
from lodestrand.operators.construction import Namespaces, build_graph, namespace_owners, relationships
from lodestrand.operators.scope import innermost
from lodestrand.sources import scip
from test_sources import field, occurrence

RULES = Namespaces(("app", "lib"), ("std",), {"lib": "lib-repo"})
RUN, ENCODE, WIDGET, BASE = "cxx . . $ app/run(ab12).", "cxx . . $ app/Codec#encode(cd34).", "cxx . . $ app/Widget#", "cxx . . $ lib/Base#"
DEFS = "repo string, seq long, scip_symbol string, file_path string, kind int, has_definition boolean"
RELS = "repo string, seq long, scip_symbol string, target string, is_implementation boolean, is_type_definition boolean"
REFS = "repo string, seq long, scip_symbol string, file_path string, enclosing_symbol string, role string"


def built(spark, defs, rels=(), refs=(), owners=True, **more):
    d = spark.createDataFrame(defs, DEFS)
    order = spark.createDataFrame([("repo-a", 0), ("repo-b", 1)], "repo string, position int")
    catalog = graph.ownership(d.where("has_definition"), order)
    return build_graph(d, spark.createDataFrame(rels, RELS), spark.createDataFrame(refs, REFS), catalog if owners else catalog.limit(0), order, RULES, **more)


def named(df):
    return {(r["src_scip_symbol"], r["relationship_type"], r["tgt_scip_symbol"]): (r["src_uri"], r["tgt_uri"], r["is_cross_repo"]) for r in df.collect()}


def test_index_to_graph(spark, tmp_path):
    link = field(4, field(1, WIDGET.encode()) + field(4, 1))
    doc = field(1, b"src/a.cc") + field(3, field(1, WIDGET.encode()) + field(5, 7)) + field(3, field(1, ENCODE.encode()) + field(5, 26) + link) + field(3, field(1, RUN.encode()) + field(5, 17))
    doc += occurrence(WIDGET, (0, 0, 3), 1) + occurrence(ENCODE, (2, 0, 3), 1, (2, 0, 4, 1)) + occurrence(RUN, (5, 0, 3), 1, (5, 0, 9, 1)) + occurrence(ENCODE, (6, 2, 4), 8)
    (tmp_path / "x.scip").write_bytes(field(2, doc))
    spark.dataSource.register(scip.ScipSource)
    docs = spark.read.format("scip").option("repo", "repo-a").load(str(tmp_path))
    d = scip.definitions(docs)
    refs = innermost(scip.references(docs), scip.spans(docs).withColumnRenamed("scip_symbol", "enclosing_symbol"), ["repo", "file_path"], "line", "first", "last", "enclosing_symbol")
    order = spark.createDataFrame([("repo-a", 0)], "repo string, position int")
    g = build_graph(d, relationships(d), refs, graph.ownership(d.where("has_definition"), order), order, RULES)
    assert {r["scip_symbol"]: (r["entity_type"], r["is_external"], r["file_path"]) for r in g.nodes.collect()} == {WIDGET: ("Class", False, "src/a.cc"), ENCODE: ("Function", False, "src/a.cc"), RUN: ("Function", False, "src/a.cc")}
    assert set(named(g.edges)) == {(ENCODE, "USES_TYPE", WIDGET), (RUN, "CALLS", ENCODE)} and g.dropped.count() == 0


def test_two_repositories(spark):
    defs = [("repo-a", 1, WIDGET, "w.h", 7, True), ("repo-b", 1, WIDGET, "copy.h", 7, True), ("repo-b", 2, RUN, "run.cc", 17, True), ("repo-b", 3, "local 1", "run.cc", 17, True), ("repo-b", 4, "cxx . . $ std/string#", "s.h", 7, False)]
    rels = [("repo-b", 2, RUN, WIDGET, False, True), ("repo-b", 1, WIDGET, BASE, True, False), ("repo-b", 1, WIDGET, "cxx . . $ std/string#", True, False), ("repo-a", 1, WIDGET, RUN, True, False)]
    refs = [("repo-b", 10, WIDGET, "run.cc", RUN, "READ"), ("repo-b", 11, WIDGET, "run.cc", RUN, "READ"), ("repo-b", 12, BASE, "run.cc", None, "CALL"), ("repo-b", 13, BASE, "run.cc", RUN, None), ("repo-b", 14, "local 1", "run.cc", RUN, "CALL")]
    g = built(spark, defs, rels, refs)
    nodes = {(r["owner_repo"], r["scip_symbol"]): r for r in g.nodes.collect()}
    assert {k: (r["is_external"], r["file_path"], r["ingestion_repo"]) for k, r in nodes.items()} == {
        ("repo-a", WIDGET): (False, "w.h", "repo-a"),
        ("repo-b", RUN): (False, "run.cc", "repo-b"),
        ("lib-repo", BASE): (True, "<external>", "repo-b"),
    }
    assert nodes["repo-b", RUN]["global_uri"] == "repo-b::run.cc::Function::app::run" and nodes["repo-b", RUN]["identity_key"] == "repo-b::run.cc::Function::app::run::sig_ab12"
    assert named(g.edges) == {
        (RUN, "USES_TYPE", WIDGET): ("repo-b::run.cc::Function::app::run", "repo-a::copy.h::Class::app::Widget", True),  # a relationship names its target by the file in its own index
        (WIDGET, "INHERITS", BASE): ("repo-a::w.h::Class::app::Widget", "lib-repo::<external>::Class::lib::Base", True),
    }
    only = built(spark, defs, rels, refs, nodes_only=True)
    assert {r["scip_symbol"] for r in only.nodes.collect()} == {WIDGET, RUN} and only.edges.count() == 0


def test_without_catalog(spark):
    defs = [("repo-a", 1, RUN, "a.cc", 17, True), ("repo-a", 2, "cxx . . $ app/stop(aa11).", "b.cc", 17, True), ("repo-a", 3, BASE, "base.h", 7, False)]
    g = built(spark, defs, [("repo-a", 1, RUN, "cxx . . $ app/stop(aa11).", True, False)], owners=False)
    assert {(r["owner_repo"], r["scip_symbol"], r["is_external"], r["file_path"]) for r in g.nodes.collect()} == {("repo-a", RUN, False, "a.cc"), ("repo-a", "cxx . . $ app/stop(aa11).", False, "b.cc"), ("lib-repo", BASE, True, "base.h")}
    assert set(named(g.edges)) == {(RUN, "OVERRIDES", "cxx . . $ app/stop(aa11).")}
    none = built(spark, [])
    assert none.nodes.count() == none.edges.count() == 0


@pytest.mark.parametrize("text, want", [('{"a": "x", "": "y"}', {"a": "x"}), ("a=x, b = y,c,=z", {"a": "x", "b": "y"}), ("{broken", {}), ("", {}), (None, {}), ("{}", {})])
def test_namespace_owners(text, want):
    assert namespace_owners(text) == want
