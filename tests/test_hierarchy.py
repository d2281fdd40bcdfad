import random

import pytest

from lodestrand.operators.hierarchy import descendants, resolve


def brute(links):
    parent = {}
    for c, p in sorted(links):
        if c is not None and p is not None:
            parent.setdefault(c, p)
    out = {}
    for n in set(parent) | set(parent.values()):
        seen, x = [], n
        while x in parent and x not in seen:
            seen.append(x)
            x = parent[x]
        if x in seen:
            ring = seen[seen.index(x) :]
            out[n] = (min(ring), -1 if n in ring else -2)
        else:
            out[n] = (x, len(seen))
    return out


def run(spark, links, **kw):
    df = spark.createDataFrame(links, "child string, parent string")
    return {r["node"]: (r["root"], r["depth"]) for r in resolve(df, "child", "parent", **kw).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_forests_with_cycles(spark, seed):
    r = random.Random(seed)
    links = [(f"n{i}", f"n{r.randrange(300)}") for i in range(200)] + [(f"x{i}", f"x{i + 1}") for i in range(60)]
    assert run(spark, links, fragment_rows=40, least_fragments=3) == brute(links)


def test_long_chain_and_cross_fragment_cycle(spark):
    links = [(f"c{i:03}", f"c{i + 1:03}") for i in range(150)] + [(f"r{i}", f"r{(i + 1) % 30}") for i in range(30)] + [("tail", "r7"), ("self", "self")]
    assert run(spark, links, fragment_rows=20, least_fragments=4) == brute(links)


def test_nulls_repeats_ties_and_extra_columns(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("a", "c", 3), (None, "b", 4), ("b", None, 5)], "child string, parent string, depth int")
    assert {r["node"]: (r["root"], r["depth"]) for r in resolve(df, "child", "parent").collect()} == {"a": ("b", 1), "b": ("b", 0)}


def test_empty(spark):
    assert run(spark, []) == {}


def test_paths_and_descendants(spark):
    r = resolve(spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "c")], "child string, parent string"), "child", "parent", paths=True, least_fragments=3, fragment_rows=2)
    assert {x["node"]: x["path"] for x in r.collect()} == {"a": ["c", "b", "a"], "b": ["c", "b"], "c": ["c"], "d": ["c", "d"]}
    assert {tuple(x) for x in descendants(r).collect()} == {("c", "b", 1), ("c", "a", 2), ("b", "a", 1), ("c", "d", 1)}


def test_descendants_of_all_parents(spark):
    links = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "r"), ("e", "d"), ("f", "e"), ("x", "x")], "child string, parent string")
    got = {(r["ancestor"], r["descendant"]): r["distance"] for r in descendants(resolve(links, "child", "parent", paths=True), links).collect()}
    want = {("b", "d"): 1, ("a", "d"): 2, ("a", "b"): 1, ("c", "d"): 1, ("r", "c"): 1, ("r", "d"): 2}
    want |= {(a, "e"): k + 1 for (a, d), k in want.items() if d == "d"} | {("d", "e"): 1}
    want |= {(a, "f"): k + 1 for (a, d), k in want.items() if d == "e"} | {("e", "f"): 1}
    assert got == want
