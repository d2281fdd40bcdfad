from lodestrand.operators.components import components
from lodestrand.operators.skew import key_counts, numbered_chunks


def test_hot_key_over_many_chunks(spark):
    rows = [("hot", f"v{i % 37}") for i in range(900)] + [(f"k{i % 50}", f"v{i % 3}") for i in range(300)] + [(None, "x"), (None, None), ("only-null", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r["k"]: (r["n_rows"], r["n_values"]) for r in key_counts(df, ["k"], "v", chunk_rows=7).collect()}
    want = {}
    for k, v in rows:
        n, s = want.setdefault(k, [0, set()])
        want[k][0] += 1
        if v is not None:
            s.add(v)
    assert got == {k: (n, len(s)) for k, (n, s) in want.items()}


def test_exact_numbers(spark):
    df = spark.createDataFrame([(i * 7919 % 500,) for i in range(500)], "v int")
    rows = numbered_chunks(df, ["v"], 64).orderBy("_row").collect()
    assert [r["_row"] for r in rows] == list(range(500)) and [r["v"] for r in rows] == list(range(500))
    assert {c: sum(r["_chunk"] == c for r in rows) for c in {r["_chunk"] for r in rows}} == {**dict.fromkeys(range(7), 64), 7: 52}


def test_empty_and_clashing_names(spark):
    assert key_counts(spark.createDataFrame([], "k string, v string"), ["k"], "v").count() == 0
    df = spark.createDataFrame([("a", "b", 1, 2)], "_chunk string, n string, _row int, `k.x` int")
    assert [tuple(r) for r in key_counts(df, ["_chunk"], "n").collect()] == [("a", 1, 1)]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200}
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0
