"""Order numbers, codes and traces that obey selections, against plain versions edge by edge."""

import random

import pytest

from brookflow.operators import network, orders

EDGES = "code string, edge_id long, node_start long, node_end long"
NODES = "node_id long, selected_upstream_edge string, selected_downstream_edge string"
OUTS = "code string, order_code string, rws_code string"


def plain_places(rows, selected, heads):
    """Least (order, chain's id, place, root) of each edge, bettered until nothing changes."""
    by = {r[0]: r for r in rows}
    best = {}
    todo = [(c, (2, by[c][1], 0, root)) for c, root in heads.items()]
    while todo:
        code, value = todo.pop()
        if code in best and best[code] <= value:
            continue
        best[code] = value
        for other, edge_id, _, end in rows:
            if end == by[code][2]:
                o, head, place, root = value
                todo.append((other, (o, head, place + 1, root) if selected.get(end) == other else (o + 1, edge_id, 0, root)))
    return best


def graph(seed, nodes, count):
    r = random.Random(seed)
    rows = [(f"c{i:02d}", r.randrange(1000) * 100 + i, *(sorted((r.randrange(nodes), r.randrange(nodes)), reverse=r.random() < 0.9))) for i in range(count)]
    into, out = {}, {}
    for c, _, a, b in rows:
        into.setdefault(b, []).append(c)
        out.setdefault(a, []).append(c)
    ups = {v: r.choice(cs) for v, cs in into.items() if r.random() < 0.8}
    downs = {v: r.choice(cs) for v, cs in out.items() if r.random() < 0.8}
    return rows, ups, downs


@pytest.mark.parametrize(("seed", "nodes", "count"), [(1, 8, 12), (2, 20, 30), (3, 40, 45), (4, 5, 14)])
def test_order_numbers_of_any_network(spark, seed, nodes, count):
    rows, ups, downs = graph(seed, nodes, count)
    heads = {rows[0][0]: ("A.1", "A"), rows[1][0]: ("B.2", "B")}
    n = spark.createDataFrame([(v, ups.get(v), downs.get(v, "")) for v in range(nodes)], NODES)
    out = orders.order_numbers(n, spark.createDataFrame(rows, EDGES), spark.createDataFrame([(c, *v) for c, v in heads.items()], OUTS), max_order_no=4)
    got = {r["code"]: (r["order_no"], r["outflow_edge"], r["order_edge_no"], r["rws_code"]) for r in out.collect()}
    ids = {r[1]: r[0] for r in rows}
    want = {c: (v[0], ids[v[1]], v[2], heads[v[3]][1]) for c, v in plain_places(rows, ups, {c: c for c in heads}).items() if v[0] <= 4}
    assert got == {r[0]: want.get(r[0], (-999, "", -999, "")) for r in rows}


def comb(n):
    """A river whose every edge is of the next order: at each node the side edge is selected."""
    rows = [(f"m{i:04d}", i, i + 1, i) for i in range(n)] + [(f"s{i:04d}", 10_000 + i, 50_000 + i, i + 1) for i in range(n - 1)]
    return rows, [(i + 1, f"s{i:04d}", None) for i in range(n - 1)]


def test_two_hundred_orders(spark):
    rows, nodes = comb(200)
    rounds, more = [], []
    outs = spark.createDataFrame([("m0000", "X.001", "X")], OUTS)
    numbered = orders.order_numbers(spark.createDataFrame(nodes, NODES), spark.createDataFrame(rows, EDGES), outs, rounds=rounds)
    got = {r["code"]: (r["order_no"], r["order_edge_no"]) for r in numbered.collect()}
    assert all(got[f"m{i:04d}"] == (i + 2, 0) and (i == 199 or got[f"s{i:04d}"] == (i + 2, 1)) for i in range(200)) and len(rounds) < 40
    coded = {r["code"]: r["order_code"] for r in orders.order_codes(numbered, outs, rounds=more).collect()}
    assert coded["m0003"] == "X.001.002.002.002.001" and coded["m0199"].count(".") == 201 and len(more) < 40


def test_codes_of_a_tree(spark):
    """One chain of four edges with tributaries: two at its second node, one at its third."""
    rows = [("a", 0, 1, 0), ("b", 1, 2, 1), ("c", 2, 3, 2), ("d", 3, 4, 3), ("t", 4, 9, 2), ("u", 5, 8, 2), ("v", 6, 7, 3), ("x", 7, 6, 9)]
    n = spark.createDataFrame([(1, "b", None), (2, "c", None), (3, "d", None), (9, None, None)], NODES)
    outs = spark.createDataFrame([("a", "Q.5", "Q")], OUTS)
    numbered = orders.order_numbers(n, spark.createDataFrame(rows, EDGES), outs)
    got = {r["code"]: r["order_code"] for r in orders.order_codes(numbered, outs).collect()}
    assert got == {"a": "Q.5.001", "b": "Q.5.001", "c": "Q.5.004", "d": "Q.5.006", "t": "Q.5.002.001", "u": "Q.5.003.001", "v": "Q.5.005.001", "x": "Q.5.002.002.001"}
    each = {r["code"]: r["order_code"] for r in orders.order_codes(numbered, outs, order_for_each_edge=True).collect()}
    assert each["a"] == "Q.5.001" and each["b"] == "Q.5.002" and each["c"] == "Q.5.005"


def plain_roles(rows, into, past, outflows, borders, strict, feed):
    """(outflow, code, role) by following single edges; into and past: selections on the two sides of a node."""
    found, todo, known = set(), [(o, c) for o, c in outflows], set()
    ends = {r[0]: r for r in rows}
    while todo:
        out, first = todo.pop()
        if (out, first) in known:
            continue
        known.add((out, first))
        found.add((out, first, "outflow"))
        open_, seen = [first], set()
        while open_:
            node = ends[open_.pop()][2]
            for code, _, start, end in rows:
                if end != node:
                    continue
                if (into.get(node) or (strict and node in into)) and into[node] != code:
                    found.add((out, code, "rejected"))
                    if feed:
                        todo.append((code, code))
                elif code not in seen:
                    seen.add(code)
                    found.add((out, code, "member"))
                    free = not (past.get(start) or (strict and start in past)) or past[start] == code
                    if start not in borders and free:
                        open_.append(code)
    return sorted(found)


@pytest.mark.parametrize(("seed", "nodes", "count"), [(11, 9, 14), (12, 25, 32)])
def test_traces_obey_selections(spark, seed, nodes, count):
    rows, ups, downs = graph(seed, nodes, count)
    outflows, borders = [("o1", rows[0][0]), ("o2", rows[1][0]), ("o3", rows[0][0])], {seed % nodes}
    known = [v for v in range(nodes) if v % 5]
    n = spark.createDataFrame([(v, ups.get(v), downs.get(v, "")) for v in known], NODES)
    ups, downs = {v: ups.get(v) for v in known}, {v: downs.get(v) for v in known}
    e, o, b = spark.createDataFrame(rows, EDGES), spark.createDataFrame(outflows, "outflow_id string, code string"), spark.createDataFrame([(x,) for x in borders], "node_id long")
    for strict, feed, first in ((False, False, False), (True, True, False), (False, True, True)) if seed == 11 else ((False, True, False), (True, False, False)):
        got = network.trace_selected(e, n, o, b, new_order_at_splits=strict, feed=feed, order_first=first)
        assert sorted(map(tuple, got.collect())) == plain_roles(rows, ups, {} if first else downs, outflows, borders, strict, feed), (strict, feed, first)
    turned = [(c, i, z, a) for c, i, a, z in rows]
    got = network.trace_selected(e, n, o, b, direction="downstream")
    assert sorted(map(tuple, got.collect())) == plain_roles(turned, downs, ups, outflows, borders, False, False)


def test_a_long_trace_of_rejected_edges(spark):
    """Every edge of a river of 300 is rejected by the one below: fed, each is an outflow of its own."""
    rows, nodes = comb(300)
    e, n = spark.createDataFrame(rows, EDGES), spark.createDataFrame(nodes, NODES)
    rounds = []
    got = network.trace_selected(e, n, spark.createDataFrame([("m0000", "m0000")], "outflow_id string, code string"), feed=True, rounds=rounds).collect()
    count = {role: sum(r["role"] == role for r in got) for role in ("outflow", "member", "rejected")}
    assert count == {"outflow": 300, "member": 299, "rejected": 299} and len(rounds) < 60


def test_nodes_in_one_place_stay_apart_where_lines_bring_them(spark, tmp_path):
    """Node 9 lies on the outlet 0, but its water runs to node 5 first: merged, the outlet would be no dead end and nothing would get an order."""
    from brookflow.plans.workflows import run_orders

    at = {0: (0.0, 0.0), 2: (100.0, 0.0), 5: (100.0, 100.0), 9: (0.0, 0.0)}
    given = [("a", 1, 2, 0), ("b", 2, 5, 2), ("c", 3, 9, 5)]
    rows = [(code, k, s, e, [dict(zip("xy", at[s])), dict(zip("xy", at[e]))]) for code, k, s, e in given]
    hydro = spark.createDataFrame(rows, "code string, edge_id long, node_start long, node_end long, coords array<struct<x:double,y:double>>")
    outs = spark.createDataFrame([(0, 3.0, 4.0, "VE.733", "VE")], "id long, x double, y double, order_code string, rws_code string")
    made = run_orders(spark, {"hydroobject": hydro, "outflow_nodes": outs}, f"file://{tmp_path}/out")
    assert {r["code"]: (r["order_no"], r["node_start"], r["node_end"]) for r in made["edges_hydro"].collect()} == {"a": (2, 2, 0), "b": (2, 5, 2), "c": (2, 9, 5)}
