"""Rivers of 10,000 edges in a row, with random ids: rounds grow with their logarithm."""

import numpy as np
import pandas as pd
import pytest

from brookflow.operators import network
from brookflow.operators.components import components

N = 10_000


@pytest.fixture(scope="module")
def river(spark):
    """A path of N edges whose nodes have random ids, with a tributary into every tenth node: (edges, nodes in order)."""
    ids = np.random.default_rng(4).permutation(2 * N).tolist()
    rows = [(f"e{i}", ids[i], ids[i + 1]) for i in range(N)] + [(f"t{i}", ids[N + 1 + i], ids[i]) for i in range(10, N, 10)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["code", "node_start", "node_end"])), ids


def test_components_of_a_long_path(spark, river):
    edges, ids = river
    rounds = []
    got = components(edges.where("code like 'e%'"), "node_start", "node_end", rounds)
    assert got.count() == N + 1 and [r[0] for r in got.select("component").distinct().collect()] == [min(ids[: N + 1])]
    assert len(rounds) < 40


def test_components_keep_apart(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (5, 5), (None, 4), (8, 9), (10, 8)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (9, 8), (8, 8), (10, 8), (5, 5)}
    assert components(edges.limit(0)).count() == 0


def test_accumulation_along_a_long_river(spark, river):
    edges, _ = river
    rounds = []
    got = {r["code"]: r["total"] for r in network.accumulate(edges.selectExpr("*", "1.0D own"), "own", rounds=rounds).select("code", "total").collect()}
    assert len(got) == edges.count() and len(rounds) < 40
    assert all(got[f"e{i}"] == i + 1 + (i // 10 if i >= 10 else 0) for i in range(N)) and all(v == 1 for k, v in got.items() if k[0] == "t")


def test_accumulation_with_splits_and_cycles(spark):
    """1 -> 2 splits to 3 and 4, which meet in 5; 7 <-> 8 is a ring that feeds 9."""
    rows = [("a", 1, 2, 8.0, 1.0), ("b", 2, 3, 0.0, 0.25), ("c", 2, 4, 1.0, 0.75), ("d", 3, 5, 0.0, 1.0), ("e", 4, 5, 0.0, None), ("f", 5, 6, 2.0, 1.0)]
    rows += [("g", 7, 8, 1.0, 1.0), ("h", 8, 7, 1.0, 1.0), ("i", 8, 9, 1.0, 1.0), ("j", 9, 10, None, 1.0), ("k", 11, 11, 3.0, 1.0)]
    edges = spark.createDataFrame(rows, "code string, node_start long, node_end long, own double, k double")
    got = {r["code"]: (r["total"], r["unresolved"]) for r in network.accumulate(edges, "own", "k").collect()}
    assert {c: got[c] for c in "abcdef"} == {"a": (8.0, False), "b": (2.0, False), "c": (7.0, False), "d": (2.0, False), "e": (7.0, False), "f": (11.0, False)}
    assert all(got[c] == (0.0, True) for c in "ghijk")
    assert network.accumulate(edges.limit(0), "own", "k").count() == 0


def test_trace_of_a_long_river(spark, river):
    edges, ids = river
    outflows = spark.createDataFrame([("low", f"e{N - 1}"), ("mid", "e5000"), ("again", "e5000")], "outflow_id string, code string")
    rounds = []
    got = network.trace(edges, outflows, rounds=rounds).groupBy("outflow_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"low": N + 999, "mid": 5001 + 500, "again": 5001 + 500} and len(rounds) < 40
    borders = spark.createDataFrame([(ids[4000],)], "node_id long")
    got = {r["code"] for r in network.trace(edges, outflows.where("outflow_id = 'mid'"), borders).collect()}
    assert got == {f"e{i}" for i in range(4000, 5001)} | {f"t{i}" for i in range(4010, 5001, 10)}
    down = {r["code"] for r in network.trace(edges, spark.createDataFrame([("x", "t9990")], "outflow_id string, code string"), direction="downstream").collect()}
    assert down == {"t9990"} | {f"e{i}" for i in range(9990, N)}


def test_trace_against_brute_force(spark):
    """Random graphs with splits, rings, parallel edges and borders."""
    rng = np.random.default_rng(8)
    for nodes, count in ((6, 9), (12, 14), (30, 33)):
        rows = [(f"c{i}", int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, nodes, (count, 2)))]
        starts = [("o1", "c0"), ("o2", "c1"), ("o3", "c0")]
        barred = {int(rng.integers(0, nodes))}
        want = set()
        for out, code in starts:
            todo = [code]
            while todo:
                one = todo.pop()
                if (out, one) not in want:
                    want.add((out, one))
                    node = next(r[1] for r in rows if r[0] == one)
                    todo += [r[0] for r in rows if r[2] == node and node not in barred]
        got = network.trace(spark.createDataFrame(rows, "code string, node_start long, node_end long"), spark.createDataFrame(starts, "outflow_id string, code string"), spark.createDataFrame([(b,) for b in barred], "node_id long"))
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_shortest_ways_along_a_long_river(spark, river):
    edges, ids = river
    rounds = []
    path = edges.where("code like 'e%'").selectExpr("node_start", "node_end", "1.5D length")
    got = {r["node_id"]: (r["source"], r["dist"]) for r in network.shortest(path, spark.createDataFrame([(ids[0],), (ids[N],)], "node_id long"), rounds=rounds).collect()}
    want = {ids[i]: min((1.5 * i, ids[0]), (1.5 * (N - i), ids[N])) for i in range(N + 1)}
    assert {k: (d, s) for k, (s, d) in got.items()} == want and len(rounds) < 40


def test_shortest_ways_in_any_network(spark):
    """Random networks with rings, parallel and looped edges, and parts without a source."""
    rng = np.random.default_rng(12)
    for nodes, count in ((8, 9), (30, 34)):
        rows = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, nodes, count), rng.integers(0, nodes, count), rng.integers(1, 9, count))]
        starts = {int(x) for x in rng.integers(0, nodes, 2)} | {nodes + 5}
        best = {s: (0.0, s) for s in starts}
        for _ in range(nodes + 1):
            for a, b, w in [*rows, *((b, a, w) for a, b, w in rows)]:
                if a in best:
                    best[b] = min(best.get(b, (1e9, 0)), (best[a][0] + w, best[a][1]))
        got = network.shortest(spark.createDataFrame(rows, "node_start long, node_end long, length double"), spark.createDataFrame([(s,) for s in starts], "node_id long"))
        assert {r["node_id"]: (r["dist"], r["source"]) for r in got.collect()} == best
