import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from lodestrand.functions.comments import clean_doxygen, is_doxygen, signature_source
from lodestrand.functions.symbols import disposition, line_bounds, parsed_symbol, parse_symbols, range4, role
from lodestrand.functions.uri import cpp_name, global_uri, identity_key, parse_uri, point_id, signature_hash


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [(" a :: b ", "a::b"), ("A ::\t~A", "A::~A"), ("x   y", "x y"), ("", ""), (" n ", "n")])
def test_names(spark, raw, want):
    assert one(spark, cpp_name("c"), c=raw) == want


def test_uri_round_trip(spark):
    sig = "sig_0123456789ab"
    uri = one(spark, global_uri("r", "f", "t", "n", "s"), r="R", f="a/b.h", t="Function", n="x :: y", s=sig)
    assert uri == f"R::a/b.h::Function::x::y::{sig}"
    p = one(spark, parse_uri("u"), u=uri)
    assert (p["repo"], p["file_path"], p["entity_type"], p["entity_name"], p["signature"]) == ("R", "a/b.h", "Function", "x::y", sig)
    assert one(spark, parse_uri("u"), u="a::b::c") is None
    assert one(spark, parse_uri("u"), u="R::f::Class::sig_0123456789ab")["signature"] is None


def test_signature_and_keys(spark):
    assert one(spark, signature_hash("s"), s=" int  f( ) ") == "sig_" + hashlib.sha1(b"int f( )").hexdigest()[:12]
    assert one(spark, signature_hash("s"), s="  ") == "sig_" + hashlib.sha1(b"<empty-signature>").hexdigest()[:12]
    assert one(spark, identity_key("u", "s"), u="a::b::Function::f", s="sig_1") == "a::b::Function::f::sig_1"
    assert one(spark, identity_key("u", "s"), u="broken", s="sig_1") == "broken"
    for key in ("a::b", "ключ-中"):
        assert one(spark, point_id("k"), k=key) == str(uuid.uuid5(uuid.NAMESPACE_DNS, key))
    assert one(spark, signature_source(F.col("c")), c=" int f(int a)\n  { return 1; }") == "int f(int a)"


def test_comments(spark):
    assert one(spark, clean_doxygen(F.col("c")), c="/**\n * One.\n *\n * Two.\n */") == "One.\nTwo."
    assert one(spark, clean_doxygen(F.col("c")), c="/// a\n/// b") == "a\nb"
    assert one(spark, is_doxygen(F.col("c")), c="  //! x") and not one(spark, is_doxygen(F.col("c")), c="// x")


@pytest.mark.parametrize(
    "symbol,kind,want",
    [
        ("cxx . . $ YAML/Foo#", 7, ("Class", "YAML::Foo", "YAML", True, None)),
        ("cxx . . $ YAML/Foo#", 49, ("Struct", "YAML::Foo", "YAML", True, None)),
        ("cxx . . $ YAML/Foo#bar(3f1c).", 26, ("Function", "YAML::Foo::bar", "YAML", True, "sig_3f1c")),
        ("cxx pkg lib 1 f(12).", 0, ("Function", "f", "", False, "sig_" + hashlib.sha1(b"12").hexdigest()[:12])),
        ("cxx . . $ a/`operator ==`(abcd).", 0, ("Function", "a::operator ==", "a", True, "sig_abcd")),
        ("local 3", 0, None),
        ("cxx . . $ M!", 0, None),
        ("cxx . . $ a/x.", 61, None),
        ("rust . . $ a#", 0, None),
        ("broken", 0, None),
        (None, 0, None),
    ],
)
def test_symbols(spark, symbol, kind, want):
    got = spark.createDataFrame([(symbol, kind)], "s string, k int").select(parsed_symbol(F.col("s"), F.col("k")).alias("p")).first()["p"]
    assert (got and tuple(got)) == want


def test_symbol_table_and_disposition(spark):
    df = spark.createDataFrame([("cxx . . $ std/a#",), ("cxx . . $ YAML/b#",), ("cxx . . $ z/c#",), ("cxx . . $ z/c#",), (None,)], "s string")
    p = parse_symbols(df, "s")
    d = {r["entity_name"]: r["d"] for r in p.select("entity_name", disposition(F.col("entity_type"), F.col("first_namespace"), F.lit(False), ("YAML",), ("std",)).alias("d")).collect()}
    assert d == {"std::a": "drop", "YAML::b": "stub", "z::c": "keep"}


def test_ranges_and_roles(spark):
    r = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<int>")
    q = spark.range(1).select(range4(r(5, 1, 9)).alias("a"), range4(r(5, 1, 7, 2)).alias("b"), range4(r(5)).alias("c"), line_bounds(r(5, 1, 9), r(2, 0, 8, 0)).alias("d"), role(F.lit(4 | 8)).alias("e"), role(F.lit(8)).alias("f"), role(F.lit(0)).alias("g")).first()
    assert tuple(q["a"]) == (5, 1, 5, 9) and tuple(q["b"]) == (5, 1, 7, 2) and q["c"] is None and tuple(q["d"]) == (2, 8)
    assert (q["e"], q["f"], q["g"]) == ("WRITE", "READ", "CALL")
