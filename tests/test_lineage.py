import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.lineage import topo_levels, upstream
from millrace.operators.profile import merge_metadata, profile
from millrace.operators.windows import merge_edges


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "consumer string, dep string")


def test_upstream_chain(spark, rows):
    edges = frame(spark, [("scores", "features"), ("features", "raw"), ("scores", "raw"), ("scores", "raw")])
    assert rows(upstream(edges), "asset", "upstream") == [
        ("features", "raw", 1), ("scores", "features", 1), ("scores", "raw", 1)]


def test_upstream_of_a_cycle_ends(spark, rows):
    edges = frame(spark, [("a", "b"), ("b", "c"), ("c", "a")])
    assert rows(upstream(edges).filter("asset = 'a'"), "depth") == [
        ("a", "b", 1), ("a", "c", 2), ("a", "a", 3)]


def test_too_deep_is_an_error(spark):
    edges = frame(spark, [(str(i), str(i + 1)) for i in range(6)])
    assert upstream(edges, 6).count() == 21
    with pytest.raises(ValueError):
        upstream(edges, 5)


def test_levels_against_brute_force(spark):
    rng = random.Random(3)
    nodes = [f"n{i}" for i in range(40)]
    pairs = {(nodes[j], nodes[i]) for _ in range(70)
             for i, j in [sorted(rng.sample(range(40), 2))] if j - i < 12}
    deps = {n: [d for c, d in pairs if c == n] for n in nodes}

    def level(n):
        return 1 + max(map(level, deps[n])) if deps[n] else 0

    def reach(n):
        best, todo, depth = {}, set(deps[n]), 1
        while todo:
            best.update({d: depth for d in todo})
            todo, depth = {d for t in todo for d in deps[t]} - set(best), depth + 1
        return best
    assets = spark.createDataFrame([(n,) for n in nodes], "uri string")
    edges = frame(spark, sorted(pairs))
    got = {r.uri: (r.level, r.rejected) for r in topo_levels(edges, assets).collect()}
    assert got == {n: (level(n), None) for n in nodes}
    closure = {(r.asset, r.upstream): r.depth for r in upstream(edges).collect()}
    assert closure == {(n, d): depth for n in nodes for d, depth in reach(n).items()}


def test_a_chain_of_a_thousand_in_few_rounds(spark, monkeypatch):
    from millrace.operators import lineage
    rounds, real = [], lineage.checkpoint
    monkeypatch.setattr(lineage, "checkpoint", lambda df: (rounds.append(1), real(df))[1])
    n = 1000
    chain = spark.range(1, n).select(F.col("id").cast("string").alias("consumer"), (F.col("id") - 1).cast("string").alias("dep"))
    got = upstream(chain).agg(F.count("*"), F.max("depth"), F.sum(F.col("asset").cast("int") - F.col("upstream").cast("int") - F.col("depth"))).first()
    assert tuple(got) == (n * (n - 1) // 2, n - 1, 0) and len(rounds) <= 11


def test_only_what_is_asked_for(spark, rows):
    edges = frame(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("x", "b"), ("c", "d"), ("d", "d")])
    start = spark.createDataFrame([("a",), ("d",), ("d",), ("nobody",)], "asset string")
    every = [r for r in rows(upstream(edges), "asset", "upstream") if r[0] in "ad"]
    assert rows(upstream(edges, start=start), "asset", "upstream") == every
    assert every == [("a", "a", 3), ("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("d", "d", 1)]
    with pytest.raises(ValueError):
        upstream(edges, 2, start)


def test_cycles_and_unknown_inputs_are_reported(spark):
    edges = frame(spark, [("b", "a"), ("c", "d"), ("d", "c"), ("e", "d"), ("f", "ghost"), ("g", "f"),
                          ("g", "a"), ("h", "h"), ("h", "f"), ("i", "h"), ("c", "a")])
    assets = spark.createDataFrame([(n,) for n in "abcdefghi"], "uri string")
    got = {r.uri: (r.level, r.rejected) for r in topo_levels(edges, assets).collect()}
    lost, behind = (None, "unknown dependency"), (None, "behind a cycle")
    assert got == {"a": (0, None), "b": (1, None), "c": (None, "cycle"), "d": (None, "cycle"), "e": behind,
                   "f": lost, "g": lost, "h": (None, "cycle"), "i": lost}
    implied = {r.uri: r.level for r in topo_levels(edges.filter("consumer in ('f', 'g')")).collect()}
    assert implied == {"ghost": 0, "a": 0, "f": 1, "g": 2}
    assert topo_levels(edges.filter("false")).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cycles_against_brute_force(spark, seed):
    """Random graphs with several tangled cycles, paths between them and tails on both sides."""
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(45)]
    pairs = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(48)} | {("n03", "gone")}
    deps = {n: {d for c, d in pairs if c == n} for n in [*nodes, "gone"]}

    def closure(n):
        found, todo = set(), deps[n]
        while todo:
            found |= todo
            todo = {d for t in todo for d in deps[t]} - found
        return found
    behind = {n: closure(n) for n in nodes}
    in_cycle = {n for n in nodes if n in behind[n]}
    want = {n: "cycle" if n in in_cycle else "unknown dependency" if "gone" in behind[n]
            else "behind a cycle" if behind[n] & in_cycle else None for n in nodes}
    assets = spark.createDataFrame([(n,) for n in nodes], "uri string")
    got = {r.uri: r.rejected for r in topo_levels(frame(spark, sorted(pairs)), assets).collect()}
    assert got == want and len(in_cycle) > 1


@pytest.mark.parametrize("explicit, extra, wanted", [
    ([], [("flour", "grain", 3)], {"flour": ["grain"]}),
    ([("loaf", "flour", 7)], [], {"loaf": ["flour"]}),
    ([("t", "a", 0), ("t", "b", 1)], [("t", "b", 0), ("t", "c", 1)], {"t": ["a", "b", "c"]}),
    ([], [], {}),
])
def test_edges_found_elsewhere_are_added_to_their_target(spark, explicit, extra, wanted):
    schema = "consumer string, dep string, ord int"
    merged = merge_edges(spark.createDataFrame(explicit, schema), spark.createDataFrame(extra, schema))
    found = {}
    for r in merged.orderBy("consumer", "source", "ord").collect():
        found.setdefault(r.consumer, []).append(r.dep)
    assert found == wanted


def test_metadata(spark, rows):
    schema = "uri string, key string, value string, seq int"
    user = spark.createDataFrame([("u", "rows", "1", 1), ("u", "rows", "2", 5), ("u", "none", None, 1)], schema)
    auto = spark.createDataFrame([("u", "rows", "9", 9), ("u", "none", "x", 9), ("u", "schema", "s", 1),
                                  ("u", "schema", "t", 2)], schema)
    assert rows(merge_metadata(user, auto), "key") == [
        ("u", "none", None), ("u", "rows", "2"), ("u", "schema", "t")]


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "id bigint, tags array<string>")
    assert rows(profile(df, "t"), "ord") == [
        ("t", 2, 0, "id", "bigint"), ("t", 2, 1, "tags", "array<string>")]
    assert rows(profile(df.filter("false"), "t"), "ord")[0][1] == 0
