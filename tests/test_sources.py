import json

import pytest
from pyspark.sql import functions as F

from lodestrand.operators.scope import innermost
from lodestrand.operators.vectors import read_table
from lodestrand.sources import cpp, entities, scip
from lodestrand.streaming.ingest import ingest_entities


def varint(n):
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def occurrence(symbol, rng, roles=0, around=()):
    return field(2, field(1, b"".join(map(varint, rng))) + field(2, symbol.encode()) + field(3, roles) + (field(7, b"".join(map(varint, around))) if around else b""))


def test_index_files(spark, tmp_path):
    a, b, c = "cxx . . $ n/Outer#", "cxx . . $ n/inner(ab12).", "cxx . . $ m/Widget#"
    link = field(4, field(1, c.encode()) + field(4, 1))
    doc = field(1, b"src/a.cc") + field(3, field(1, a.encode()) + field(5, 7)) + field(3, field(1, b.encode()) + field(5, 17) + link)
    doc += occurrence(a, (0, 0, 3), 1, (0, 0, 20, 1)) + occurrence(b, (5, 0, 3), 1, (5, 0, 10, 1)) + occurrence(c, (6, 2, 4), 8)
    (tmp_path / "x.scip").write_bytes(field(1, b"") + field(2, doc))
    spark.dataSource.register(scip.ScipSource)
    docs = spark.read.format("scip").option("repo", "r").load(str(tmp_path))
    d = {r["scip_symbol"]: r for r in scip.definitions(docs).collect()}
    assert set(d) == {a, b} and d[b]["has_definition"] and d[b]["relationships"][0]["is_type_definition"] and d[a]["definition_range"]["ec"] == 3
    refs = innermost(scip.references(docs), scip.spans(docs).withColumnRenamed("scip_symbol", "enclosing"), ["repo", "file_path"], "line", "first", "last", "enclosing")
    assert [(r["scip_symbol"], r["role"], r["enclosing"]) for r in refs.collect()] == [(c, "READ", b)]
    (tmp_path / "y.scip").write_bytes(field(2, field(1, b"src/b.cc") + occurrence(c, (1, 2, 4), 8)))
    docs = spark.read.format("scip").option("repo", "r").load(str(tmp_path))
    told = scip.totals(docs, scip.definitions(docs).withColumn("disposition", F.when(F.col("kind") == 17, "drop").otherwise("keep")))
    assert [tuple(r) for r in told.collect()] == [("r", 2, 4, 1, 1, 2)]


CODE = """
namespace outer { namespace inner {
/** Adds. */
int add(int a, int b) { return a + b; }
/// Adds more.
double add(double a) { return a; }
// plain
template <typename T> class EXPORT_API Box final : public Base<T> { void method() {} };
}  // namespace inner
struct Point { int x; };
int declared(int);
}
bool operator==(const A& a, const A& b) { return "}" == a; }
"""


def test_cpp_entities(spark, tmp_path):
    for p in ("src/a.cpp", "src/build/b.cpp", ".git/c.cpp", "Build/d.hpp", "readme.md"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(CODE)
    files = cpp.discover(spark, str(tmp_path), "R")
    assert sorted(r["file_path"] for r in files.collect()) == ["Build/d.hpp", "src/a.cpp"]
    rows = cpp.entities(files.where("file_path = 'src/a.cpp'")).collect()
    got = {(r["entity_type"], r["entity_name"], r["docstring"], r["is_templated"]) for r in rows}
    assert got == {
        ("Function", "outer::inner::add", "Adds.", False), ("Function", "outer::inner::add", "Adds more.", False), ("Class", "outer::inner::Box", None, True),
        ("Struct", "outer::Point", None, False), ("Function", "operator==", None, False),
    }
    adds = [r for r in rows if r["entity_name"] == "outer::inner::add"]
    assert len({r["global_uri"] for r in adds}) == 1 and len({r["function_sig_hash"] for r in adds}) == 2
    broken = spark.createDataFrame([("R", "x.h", b"namespace a { int f() {"), ("R", "y.h", None)], "repo string, file_path string, content binary")
    assert [r["parse_errors"] > 0 for r in cpp.entities(broken).collect()] == [True]


def test_declarations(spark):
    code = """
int declared(int);
namespace n { void other(const char* name = "x") noexcept; MACRO(a, b); Foo x(3); using T = int (*)(int); }
extern "C" { int linked(void); void has_body() { } }
extern "C" int alone(int);
typedef int (*fn)(int);
class C;
static int value = call(1);
"""
    f = spark.createDataFrame([("R", "x.h", code.encode()), ("R", "y.h", b"}"), ("R", "z.py", b"")], "repo string, file_path string, content binary")
    names = lambda **more: {r["entity_name"] for r in cpp.entities(f, **more).collect()}
    assert names() == {"has_body"}
    assert names(extern_c_declarations=True) == {"has_body", "linked", "alone"}
    assert names(include_declarations=True) == {"has_body", "linked", "alone", "declared", "n::other"}
    got = {r["file_path"]: (r["parse_error_count"], r["entity_count"]) for r in cpp.diagnostics(f).collect()}
    assert got == {"x.h": (0, 1), "y.h": (1, 0)}
    assert [(r["file_path"], r["seq"]) for r in cpp.numbered_files(f).orderBy("seq").collect()] == [("x.h", 0), ("y.h", 1), ("z.py", 2)]


def test_many_comments_take_linear_time():
    import time

    code = "".join(f"/// Note {i}.\nint f{i}() {{ return {i}; }}\n" for i in range(4000))
    start = time.time()
    rows = list(cpp.scan(code))
    assert len(rows) == 4000 and rows[3999][2] == "/// Note 3999." and time.time() - start < 10


def test_one_file(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.cc").write_text("int f() { return 1; }")
    one = str(tmp_path / "src" / "a.cc")
    assert [r["file_path"] for r in cpp.read_file(spark, one, "R").collect()] == ["a.cc"]
    assert [r["file_path"] for r in cpp.read_file(spark, one, "R", str(tmp_path)).collect()] == ["src/a.cc"]
    with pytest.raises(ValueError):
        cpp.read_file(spark, str(tmp_path / "x.txt"), "R")
    with pytest.raises(FileNotFoundError):
        cpp.read_file(spark, str(tmp_path / "x.cc"), "R")


def test_json_lines_and_stream(spark, tmp_path, data):
    e = spark.read.parquet(f"{data}/code_entity.parquet").drop("entity_id", "extracted_at", "ingested_at")
    src = str(tmp_path / "in")
    entities.write_entities(e.limit(40), src)
    assert entities.read_entities(spark, src).count() == 40
    for _ in range(2):
        ingest_entities(spark, src, str(tmp_path / "out"), str(tmp_path / "state"), dimension=4).awaitTermination()
    t = read_table(spark, str(tmp_path / "out"), "id", "updated_at")
    assert t.count() == t.select("id").distinct().count() > 0


def test_manifest(tmp_path):
    p = tmp_path / "m.json"
    p.write_text(json.dumps({"repos": [{"name": "a", "source_dir": "/x"}]}))
    assert entities.read_manifest(str(p)).repositories[0].name == "a"
    p.write_text(json.dumps({"repos": [{"name": "a", "source_dir": "/x"}, {"name": "a", "source_dir": "/y"}]}))
    try:
        entities.read_manifest(str(p))
        raise AssertionError("repeated names must fail")
    except ValueError:
        pass
