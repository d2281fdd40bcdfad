import random

from lodestrand.llm.mixing import mix_report, mixed, route
from lodestrand.llm.packing import best_fit, fill_report, packed
from lodestrand.llm.tokens import with_token_counts


def brute_best_fit(sizes, capacity, limit):
    free, out, made = {}, [], 0
    for s in sizes:
        fits = sorted((f, b) for b, f in free.items() if f >= s)
        if fits:
            b = fits[0][1]
        else:
            if len(free) == limit:
                full = min(free.values())
                free.pop(next(b for b, g in free.items() if g == full))
            b, free[made], made = made, capacity, made + 1
        free[b] -= s
        if not free[b]:
            del free[b]
        out.append(b)
    return out


def room_taken(bins, sizes):
    """The free space each size was put into; which of several equal containers took it does not matter."""
    free, out = {}, []
    for b, s in zip(bins, sizes):
        out.append(free.setdefault(b, 100))
        free[b] -= s
        assert free[b] >= 0
    return out


def test_best_fit_against_brute_force():
    for seed in range(20):
        r = random.Random(seed)
        sizes = [r.randrange(1, 101) for _ in range(300)]
        assert room_taken(best_fit(sizes, 100, 5), sizes) == room_taken(brute_best_fit(sizes, 100, 5), sizes)


def test_packing(spark):
    r = random.Random(1)
    items = [(i, r.choice([0, 1, 5, 60, 99, 100, 101, 350, None]), "x") for i in range(400)] + [(7, 30, "x")]
    df = spark.createDataFrame(items, "doc_id long, n long, container string")
    spec = spark.createDataFrame([("a", 100), ("b", 512), ("c", None), (None, 5), ("d", 0)], "pack_name string, capacity_tokens int")
    rows = packed(df, spec, "doc_id", "n", open_bins=8, tokens_per_task=4000).collect()
    total = sum(n for _, n, _ in items if n)
    for pack, cap in (("a", 100), ("b", 512)):
        mine = [x for x in rows if x["pack_name"] == pack]
        assert sum(x["n_tokens"] for x in mine) == total
        used = {}
        for x in mine:
            used[x["container"]] = used.get(x["container"], 0) + x["n_tokens"]
            assert x["piece"] == 0 or x["start_token"] == x["piece"] * cap
        assert max(used.values()) <= cap
        cut = {x["item"] for x in mine if x["piece"] > 0}
        assert cut == {i for i, n, _ in items if n and n > cap}
    assert {x["pack_name"] for x in rows} == {"a", "b"}
    assert all(0 < x["filled"] <= 1 for x in fill_report(packed(df, spec, "doc_id", "n")).collect())
    assert packed(df.limit(0), spec, "doc_id", "n").count() == 0


def test_route_uses_overlap():
    flow, total = route({("a",): 100, ("a", "b"): 100}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})
    assert total == 200 and flow[("a", "b"), "b"] == 100 and flow[("a",), "a"] == 100
    flow, total = route({("a",): 100, ("b",): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 3})
    assert 59 <= total <= 61 and flow[("b",), "b"] <= 30
    assert route({}, {"a": 1.0}, {"a": 1}) == ({}, 0)


def test_mixing(spark):
    r = random.Random(2)
    docs = [(i, " ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(5, 40))), r.choice(["A ", "a", "B", "c"]), 1) for i in range(600)]
    docs += [(1000, docs[0][1], "B", 1), (1001, None, "a", 1), (1002, "x", None, 1), (1003, "", "a", 1), (1004, "other words", "unused", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, occurrence int")
    goal = spark.createDataFrame([("m", "a", 0.5, 1), ("m", "b", 0.2, 3), ("m", " C", 0.2, 2), ("m", "none", 0.1, 2)], "mix_name string, source string, target_share double, max_repeats int")
    rep = {x["source"]: x for x in mix_report(mixed(df, goal), goal).collect()}
    assert rep["none"]["tokens"] == 0
    for s, share, repeats in (("a", 0.5, 1), ("b", 0.2, 3), ("c", 0.2, 2)):
        assert abs(rep[s]["reached_share"] - share / 0.9) < 0.02 and rep[s]["most_uses"] <= repeats
    assert mixed(df.limit(0), goal).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "word " * 50000)], "doc_id int, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in with_token_counts(df).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 50000
