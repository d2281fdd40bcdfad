import pytest
from pyspark.sql import functions as F

from lodestrand.operators import graph, search
from lodestrand.operators.scope import innermost
from lodestrand.operators.vectors import compact, declare_table, declared_dimension, embed_with, greedy_batches, mock_embedding, points, read_table, upsert


def test_ownership(spark):
    d = spark.createDataFrame([("s", "b", "fb", 1), ("s", "a", "fa", 2), ("t", "b", "f", 1), (None, "a", "x", 1)], "scip_symbol string, repo string, file_path string, seq int")
    order = spark.createDataFrame([("a", 0), ("b", 1)], "repo string, position int")
    got = {r["scip_symbol"]: (r["owner_repo"], r["file_path"], r["is_conflict"]) for r in graph.ownership(d, order).collect()}
    assert got == {"s": ("a", "fa", True), "t": ("b", "f", False)}
    over = spark.createDataFrame([("s", "b")], "scip_symbol string, repo string")
    assert {r["scip_symbol"]: r["owner_repo"] for r in graph.ownership(d, order, over).collect()}["s"] == "b"


def test_ownership_reasons(spark):
    hinted = "cxx . b 1 n/S#"
    d = spark.createDataFrame([(hinted, "a", "fa", 1), (hinted, "b", "fb", 2), ("t", "a", "f", 1), ("u", "a", "f", 1), ("u", "b", "g", 2), ("v", "b", "f", 1), ("v", "b", "g", 2)], "scip_symbol string, repo string, file_path string, seq int")
    order = spark.createDataFrame([("a", 0), ("b", 1)], "repo string, position int")
    over = spark.createDataFrame([("u", "b"), ("t", "nobody")], "scip_symbol string, repo string")
    catalog = graph.ownership(d, order, over)
    got = {r["scip_symbol"]: (r["owner_repo"], r["file_path"], r["reason"]) for r in catalog.collect()}
    assert got == {hinted: ("b", "fb", "package_hint"), "t": ("a", "f", "single_local_definition"), "u": ("b", "g", "override"), "v": ("b", "f", "stable_order")}
    assert {(r["scip_symbol"], tuple(r["candidates"])) for r in graph.conflicts(catalog).collect()} == {(hinted, ("a", "b")), ("u", ("a", "b")), ("v", ("b",))}


def test_merge_keeps_real_nodes(spark):
    cols = "owner_repo string, scip_symbol string, ingestion_repo string, file_path string, is_external boolean"
    old = spark.createDataFrame([("r", "s", "i", "f.h", False), ("r", "t", "i", "<external>", True)], cols)
    new = spark.createDataFrame([("r", "s", None, "<external>", True), ("r", "t", "j", "t.h", False), ("r", "u", None, "u.h", False)], cols)
    got = {r["scip_symbol"]: tuple(r)[2:] for r in graph.merge_nodes(old, new).collect()}
    assert got == {"s": ("i", "f.h", False), "t": ("j", "t.h", False), "u": (None, "u.h", False)}


def test_relations(spark):
    rows = [("Function", "Class", "CALL"), ("Function", "Function", "READ"), ("Class", "Function", "CALL"), ("Function", "Function", "REF")]
    df = spark.createDataFrame(rows, "s string, t string, r string")
    assert [x[0] for x in df.select(graph.reference_relation(F.col("s"), F.col("t"), F.col("r"))).collect()] == ["USES_TYPE", "CALLS", None, None]
    assert [x[0] for x in df.select(graph.implementation_relation(F.col("s"), F.col("t"))).collect()] == [None, "OVERRIDES", None, "OVERRIDES"]


def test_innermost(spark):
    spans = spark.createDataFrame([("f", 0, 1_000_000, "outer"), ("f", 50, 60, "inner"), ("f", 9, 3, "bad")], "file string, a int, b int, name string")
    pts = spark.createDataFrame([("f", 55), ("f", 70), ("f", 999_999), ("g", 1), ("f", None)], "file string, line int")
    got = {(r["file"], r["line"]): r["name"] for r in innermost(pts, spans, ["file"], "line", "a", "b", "name").collect()}
    assert got == {("f", 55): "inner", ("f", 70): "outer", ("f", 999_999): "outer", ("g", 1): None, ("f", None): None}


EDGES = [("b", "a", "CALLS"), ("c", "b", "CALLS"), ("c", "a", "USES_TYPE"), ("d", "c", "INHERITS"), ("a", "d", "CALLS"), ("a", "a", "CALLS"), (None, "a", "CALLS")]


def edges(spark):
    return spark.createDataFrame(EDGES, "src string, tgt string, relationship_type string")


def test_blast_radius(spark):
    root = spark.createDataFrame([("a",)], "node string")
    got = {r["node"]: (r["depth"], list(r["chain"])) for r in search.blast_radius(edges(spark), root, 5).collect()}
    assert got == {"b": (1, ["CALLS"]), "c": (1, ["USES_TYPE"]), "d": (2, ["USES_TYPE", "INHERITS"])}
    assert {r["node"] for r in search.blast_radius(edges(spark), root, 1, upstream=False).collect()} == {"d"}
    assert search.blast_radius(edges(spark), root, 3, wanted=[]).count() == 0
    with pytest.raises(ValueError):
        search.blast_radius(edges(spark), root, 0)
    with pytest.raises(ValueError):
        search.relationships(["DEFINED_IN"])


def test_pages(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "B"), (2, "C")], "depth int, node string")
    first, cursor = search.page(rows, 2)
    assert [r["node"] for r in first.collect()] == ["A", "B"] and cursor == "2|B"
    second, end = search.page(rows, 2, cursor)
    assert [r["node"] for r in second.collect()] == ["C"] and end is None
    for bad in ("x|B", "2", "2|"):
        with pytest.raises(ValueError):
            search.page(rows, 2, bad)


def test_neighbors_show_self_loops(spark):
    got = {tuple(r) for r in search.neighbors(edges(spark), "a").collect()}
    assert ("inbound", "CALLS", "a") in got and ("outbound", "CALLS", "a") in got and ("outbound", "CALLS", "d") in got


def test_root_selectors(spark):
    nodes = spark.createDataFrame([("k1", "u"), ("k2", "u"), ("k3", "v")], "identity_key string, global_uri string")
    assert search.resolve_root(nodes, global_uri="u") == ("ambiguous_root", ["k1", "k2"])
    assert search.resolve_root(nodes, identity_key="k3") == ("ok", ["k3"])
    assert search.resolve_root(nodes, identity_key="no") == ("missing_root", [])
    with pytest.raises(ValueError):
        search.resolve_root(nodes, identity_key="k1", global_uri="u")


def test_questions(spark):
    p = spark.createDataFrame([("a", [1.0, 0.0], "A"), ("b", [0.6, 0.8], "B"), ("c", [0.0, 0.0], "C"), ("d", None, "D"), ("e", [1.0, 0.0], "E")], "id string, vector array<float>, entity_name string")
    got = [tuple(r) for r in search.ask(p, "what is it?", lambda texts: [[2.0, 0.0] for _ in texts], "vector", "id", ["entity_name"], 3).collect()]
    assert got == [("a", 1.0, "A"), ("e", 1.0, "E"), ("b", 0.6, "B")]


def test_greedy_batches():
    assert [s.indices(9)[:2] for s in greedy_batches([5, 5, 5, 50, 1], 2, 10)] == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(greedy_batches([], 2, 10)) == []


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path, "id", "at") is None
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 1)], "id string, v string, at int")
    for _ in range(2):
        upsert(path, rows, "id", "at", 2)
    upsert(path, spark.createDataFrame([("a", "old", 0)], "id string, v string, at int"), "id", "at", 2)
    for _ in range(2):
        assert {tuple(r) for r in read_table(spark, path, "id", "at").collect()} == {("a", "y", 2), ("b", "z", 1)}
        compact(spark, path, "id", "at", 2, most_files=1)
    assert spark.read.parquet(path).count() == 2


def test_declared_dimension(spark, tmp_path):
    path = str(tmp_path / "t")
    declare_table(spark, path, 2)
    declare_table(spark, path, 2)
    assert declared_dimension(spark, path) == 2 and read_table(spark, path, "id", "at") is None
    with pytest.raises(ValueError):
        declare_table(spark, path, 3)
    row = spark.createDataFrame([("a", [1.0, 2.0], 1)], "id string, vector array<float>, at int")
    upsert(path, row, "id", "at")
    with pytest.raises(Exception, match="dimension 2"):
        upsert(path, spark.createDataFrame([("b", [1.0], 1)], "id string, vector array<float>, at int"), "id", "at")
    assert read_table(spark, path, "id", "at").count() == 1
    declare_table(spark, path, 3, recreate=True)
    assert declared_dimension(spark, path) == 3 and read_table(spark, path, "id", "at") is None


def test_embed_with(spark):
    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(7)], "i int, text string")
    got = {r["i"]: list(r["vector"]) for r in embed_with(df, "text", lambda texts: [[float(len(t)), float(len(texts) <= 2)] for t in texts], batch=2).collect()}
    assert got == {i: [float(i), 1.0] for i in range(7)}
    with pytest.raises(Exception, match="one vector for each text"):
        embed_with(df, "text", lambda texts: []).collect()


def test_time_limit(spark):
    slow = F.udf(lambda x: __import__("time").sleep(20) or x, "long")
    with pytest.raises(Exception):
        with search.time_limit(spark, 1):
            spark.range(1).select(slow("id")).collect()
    with search.time_limit(spark, 60):
        assert spark.range(3).count() == 3


def test_edge_merge_counts_what_vanished(spark):
    nodes = spark.createDataFrame([("r", "a"), ("r", "b")], "owner_repo string, scip_symbol string")
    cols = "src_owner_repo string, src_scip_symbol string, tgt_owner_repo string, tgt_scip_symbol string, relationship_type string, is_cross_repo boolean"
    old = spark.createDataFrame([("r", "b", "r", "a", "CALLS", True)], cols)
    new = spark.createDataFrame([("r", "a", "r", "b", "CALLS", False)] * 2 + [("r", "a", "r", "gone", "CALLS", False), ("r", "b", "r", "a", "CALLS", False)], cols)
    store, report = graph.merge_edges(old, new, nodes)
    assert sorted(map(tuple, store.collect())) == [("r", "a", "r", "b", "CALLS", False), ("r", "b", "r", "a", "CALLS", False)]
    assert [tuple(r) for r in report.collect()] == [("CALLS", 3, 2, 1)]


def test_inheritance_over_all_parents(spark):
    links = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("e", "d"), ("e", "a"), ("x", "y"), ("y", "x"), (None, "a"), ("b", "a")], "child string, parent string")
    up = {(r["node"], r["ancestor"]): r["depth"] for r in search.closure(links, "child", "parent").collect()}
    assert up == {("d", "b"): 1, ("d", "c"): 1, ("d", "a"): 2, ("b", "a"): 1, ("c", "a"): 1, ("e", "d"): 1, ("e", "b"): 2, ("e", "c"): 2, ("e", "a"): 1, ("x", "y"): 1, ("y", "x"): 1, ("x", "x"): 2, ("y", "y"): 2}
    one = [tuple(r) for r in search.inheritance(links, "child", "parent", 2, root="e").orderBy("relation", "depth", "other").collect()]
    assert one == [("e", "ancestor", "a", 1), ("e", "ancestor", "d", 1)]
    some = {tuple(r) for r in search.inheritance(links, "child", "parent", 2).where("uri = 'a'").collect()}
    assert some == {("a", "descendant", "b", 1), ("a", "descendant", "c", 1)}


def test_results_of_one_repository(spark):
    nodes = spark.createDataFrame([("r", "a"), ("s", "b")], "repo_name string, identity_key string")
    found = spark.createDataFrame([("a", 1), ("b", 2)], "node string, depth int")
    assert [r["node"] for r in search.in_repository(found, nodes, "s").collect()] == ["b"] and search.in_repository(found, nodes, None).count() == 2


def test_points_and_embeddings(spark, data):
    e = spark.read.parquet(f"{data}/code_entity.parquet")
    p = points(e.withColumn("code_text", F.when(F.col("entity_id") != 1, F.col("code_text"))), mock_embedding(F.lit("x"), 8), 8)
    assert {r["reason"] for r in p.select("reason").distinct().collect()} == {None, "missing:code_text"}
    v = p.where("reason is null").select("vector").first()["vector"]
    assert len(v) == 8 and all(-1 <= x <= 1 for x in v)
