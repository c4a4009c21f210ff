"""Hand-computed expectations for the network rules."""

import pytest
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import culverts, flood, lines, network, orders, raster, spatial, windows
from brookflow.plans import queries


def line(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


LINES = "code string, coords array<struct<x:double,y:double>>"


def test_order_numbers_and_codes(spark):
    ends = [("E1", 1, 0), ("E2", 2, 1), ("T1", 3, 1), ("E3", 4, 2), ("T2", 5, 2), ("T3", 6, 2)]
    edges = spark.createDataFrame([(c, i, a, b) for i, (c, a, b) in enumerate(ends)], "code string, edge_id long, node_start long, node_end long")
    nodes = spark.createDataFrame([(n, {1: "E2", 2: "E3"}.get(n)) for n in range(7)], "node_id long, selected_upstream_edge string")
    outs = spark.createDataFrame([("E1", "VE.733", "VE")], "code string, order_code string, rws_code string")
    numbered = orders.order_numbers(nodes, edges, outs)
    coded = {r["code"]: r for r in orders.order_codes(numbered, outs).collect()}
    want = {
        "E1": (2, "E1", 0, 1, 1, "VE.733.001"), "E2": (2, "E1", 1, 2, 3, "VE.733.003"), "E3": (2, "E1", 2, 0, 6, "VE.733.006"),
        "T1": (3, "T1", 0, 0, 1, "VE.733.002.001"), "T2": (3, "T2", 0, 0, 1, "VE.733.004.001"), "T3": (3, "T3", 0, 0, 1, "VE.733.005.001"),
    }
    assert {k: (r["order_no"], r["outflow_edge"], r["order_edge_no"], r["no_edge_codes"], r["order_code_no"], r["order_code"]) for k, r in coded.items()} == want


def test_accumulation_with_split_and_cycle(spark):
    kinds = "code string, node_start string, node_end string, own double"
    split = spark.createDataFrame([("S", "a", "b", 2.0), ("X", "b", "c", 1.0), ("Y", "b", "d", 1.0), ("Z", "c", "d", 1.0), ("W", "d", "e", 1.0)], kinds)
    got = {r["code"]: r["total"] for r in network.accumulate(network.split_factors(split), "own", "downstream_splits_dist").collect()}
    assert got == {"S": 2, "X": 2, "Y": 2, "Z": 3, "W": 6}
    cycle = spark.createDataFrame([("P", "a", "b", 1.0), ("Q", "b", "c", 1.0), ("R", "c", "b", 1.0), ("U", "c", "d", 1.0)], kinds)
    got = {r["code"]: (r["total"], r["unresolved"]) for r in network.accumulate(cycle).collect()}
    assert got == {"P": (1, False), "Q": (0, True), "R": (0, True), "U": (0, True)}


@pytest.mark.parametrize("up, down, circular, want", [
    ([0.0, 90.0], [10.0], False, ("u0", "d0")), ([0.0, 15.0], [10.0], False, (None, "d0")), ([-175.0, 150.0], [175.0], False, ("u1", "d0")), ([-175.0, 150.0], [175.0], True, ("u0", "d0")),
])
def test_selection_by_angle(spark, up, down, circular, want):
    row = (1, up, [f"u{i}" for i in range(len(up))], len(up), down, [f"d{i}" for i in range(len(down))], len(down))
    nodes = spark.createDataFrame([row], "node_id long, upstream_angles array<double>, upstream_edges array<string>, no_upstream_edges long, downstream_angles array<double>, downstream_edges array<string>, no_downstream_edges long")
    r = network.select_by_angle(nodes, 10.0, circular).first()
    assert (r["selected_upstream_edge"], r["selected_downstream_edge"]) == want


@pytest.mark.parametrize("q, want", [([4.0, 2.0], "e0"), ([3.0, 2.0], None), ([0.0, 0.0], "e0"), ([5.0], "e0")])
def test_selection_by_discharge(spark, q, want):
    nodes = spark.createDataFrame([(1, q, [f"e{i}" for i in range(len(q))], None, None)], "node_id long, upstream_discharges array<double>, upstream_edges array<string>, downstream_discharges array<double>, downstream_edges array<string>")
    assert network.select_by_discharge(nodes).first()["selected_upstream_edge"] == want


def test_vertices(spark):
    got = lines.line_to_vertices(spark.createDataFrame([("a", line((0, 0), (35, 0))), ("b", line((0, 1), (9, 1)))], LINES))
    d = {c: sorted(round(r["distance_from_start"], 4) for r in got.where(F.col("code") == c).collect()) for c in "ab"}
    assert d == {"a": [0, 11.6667, 23.3333, 35], "b": [0, 9]}


@pytest.mark.parametrize("lens, want", [((20.0, 15.0, 8.0, 6.0), 3), ((20.0, 16.0, 13.0, 11.9), 0), ((None, 16.0, 13.0, None), 1), ((None, None, 13.0, 9.7), 3)])
def test_best_line(spark, lens, want):
    df = spark.createDataFrame([lens], "a double, b double, c double, d double")
    assert df.select(culverts.best_line(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] == want


def test_scores(spark):
    kinds = "line_type string, WaterLineType string, crossings_peilgebied boolean, crossings_nwb boolean"
    rows = [("dangling_end", "hydroobject", False, False), ("other", "overige_watergang", False, False), ("dangling_end", "hydroobject", False, True), ("dangling_end", "hydroobject", True, False), ("dangling_end", "hydroobject", True, True), ("other", "overige_watergang", True, True), ("other", "hydroobject", None, None)]
    df = spark.createDataFrame(rows, kinds)
    assert [r[0] for r in df.select(culverts.score()).collect()] == [1, 4, 5, 13, None, 16, 2]
    assert [r[0] for r in df.select(culverts.score(strict=True)).collect()] == [1, 4, 5, 9, 13, 16, 2]
    assert df.select(culverts.score(legacy_null=True)).collect()[-1][0] is None


def test_suffixes(spark):
    df = spark.createDataFrame([(0, "A"), (1, "A"), (2, "B"), (3, "A"), (4, None)], "id int, code string")
    assert [r["code"] for r in windows.unique_codes(df, "code", "id").orderBy("id").collect()] == ["A", "A_1", "B", "A_2", ""]
    assert [r["code"] for r in windows.duplicate_suffix(df, "code", "id").orderBy("id").collect()][:4] == ["A-0", "A-1", "B", "A-2"]


def test_trace_with_border(spark):
    edges = spark.createDataFrame([("e1", 1, 0), ("e2", 2, 1), ("e3", 3, 2)], "code string, node_start long, node_end long")
    out = spark.createDataFrame([("o", "e1")], "outflow_id string, code string")
    assert {r["code"] for r in network.trace(edges, out).collect()} == {"e1", "e2", "e3"}
    assert {r["code"] for r in network.trace(edges, out, spark.createDataFrame([(2,)], "node_id long")).collect()} == {"e1", "e2"}
    assert {r["code"] for r in network.trace(edges, spark.createDataFrame([("o", "e3")], "outflow_id string, code string"), direction="downstream").collect()} == {"e1", "e2", "e3"}


def test_basins(spark):
    cells = spark.createDataFrame([(0, c, float(5 - c)) for c in range(5)], "r long, c long, v double")
    flow = raster.flow_d8(cells)
    for labels, want in (([(0, 4, 7)], [7] * 5), ([(0, 4, 7), (0, 2, 9)], [9, 9, 9, 7, 7])):
        got = raster.basins(flow, spark.createDataFrame(labels, "r long, c long, label long")).orderBy("c").collect()
        assert [r["label"] for r in got] == want


def test_fill(spark):
    v = [[5, 5, 5, 5], [5, 1, 2, 5], [5, 5, 4, 5]]
    cells = spark.createDataFrame([(r, c, float(v[r][c])) for r in range(3) for c in range(4)], "r long, c long, v double")
    got = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(cells).collect()}
    assert got[1, 1] == got[1, 2] == 4 and got[2, 2] == 4
    shallow = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(cells, max_depth=2.0).collect()}
    assert shallow[1, 1] == 1 and shallow[1, 2] == 4


def test_polygonize_parts(spark):
    cells = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (5, 5, 1), (1, 0, 2)], "r long, c long, label long")
    got = {r["label"]: (r["n_cells"], r["n_parts"], r["sides"], r["area"]) for r in raster.polygonize(cells).collect()}
    assert got == {1: (3, 2, 10, 12.0), 2: (1, 1, 4, 4.0)}


def test_split_at_points(spark):
    l = spark.createDataFrame([("A", line((0, 0), (10, 0)), "unchanged"), ("B", line((5, 5), (5, 0)), "unchanged")], LINES + ", status string")
    ends = lines.endpoints(l).select("x", "y")
    got = {r["code"]: ([(p["x"], p["y"]) for p in r["coords"]], r["status"]) for r in lines.split_at_points(l, ends).collect()}
    assert got == {"A-0": ([(0, 0), (5, 0)], "split"), "A-1": ([(5, 0), (10, 0)], "split"), "B": ([(5, 5), (5, 0)], "unchanged")}


def test_snap(spark):
    l = spark.createDataFrame([(1, "A", line((0, 0), (10, 0)), "unchanged"), (2, "B", line((5, 5), (5, 0.03)), "unchanged"), (3, "C", line((20, 0), (10.04, 0)), "unchanged")], "id int, " + LINES + ", status string")
    got = {r["code"]: ([(p["x"], p["y"]) for p in r["coords"]][-1], r["status"]) for r in lines.snap(l, 0.05).collect()}
    assert got["B"] == ((5, 0), "snapped")
    assert got["C"] == ((10, 0), "snapped") or got["A"] == ((10.04, 0), "snapped")


def test_holes_and_angles(spark):
    square = lambda a, o=0: line((o, o), (o + a, o), (o + a, o + a), (o, o + a), (o, o))
    df = spark.createDataFrame([([square(100), square(5, 10), square(10, 30)], line((0, 0), (0, 1), (1, 1)))], "rings array<array<struct<x:double,y:double>>>, c array<struct<x:double,y:double>>")
    r = df.select(F.size(g.remove_holes(F.col("rings"), 50)).alias("n"), g.area(F.col("rings")).alias("a"), g.angle_compass(F.col("c"), "upstream").alias("u"), g.angle_compass(F.col("c"), "downstream").alias("d"), g.angle_start(F.col("c")).alias("s"), g.angle_reverse(F.col("c")).alias("v"), g.inside(F.lit(12.0), F.lit(12.0), F.col("rings")).alias("hole"), g.inside(F.lit(50.0), F.lit(5.0), F.col("rings")).alias("in_")).first()
    assert (r["n"], r["a"], r["u"], r["d"], r["s"], r["v"], r["hole"], r["in_"]) == (2, 10000 - 125, 0, 90, 90, 270, False, True)


def test_radius_join_against_brute_force(spark):
    import random

    rnd = random.Random(4)
    a = [(i, rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for i in range(80)] + [(100, 10.0, 0.0)]
    b = [(i, rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for i in range(80)] + [(100, 20.0, 0.0)]
    pts = "id long, x double, y double"
    got = {(r["l_id"], r["r_id"]) for r in spatial.radius_pairs(spark.createDataFrame(a, pts), spark.createDataFrame(b, pts), 10.0).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if ((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) ** 0.5 <= 10}
    near = {r["l_id"]: r["r_id"] for r in spatial.nearest(spark.createDataFrame(a, pts), spark.createDataFrame(b, pts)).collect()}
    assert near == {p[0]: min((((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) ** 0.5, q[0]) for q in b)[1] for p in a}


def test_shortest_and_redirect(spark):
    edges = spark.createDataFrame([("a", 0, 1, 1.0), ("b", 1, 2, 5.0), ("c", 0, 2, 2.0), ("d", 8, 9, 1.0)], "code string, node_start long, node_end long, length double")
    got = {r["node_id"]: r["dist"] for r in network.shortest(edges, spark.createDataFrame([(0,)], "node_id long")).collect()}
    assert got == {0: 0, 1: 1, 2: 2}
    turned = {r["code"]: (r["node_start"], r["node_end"]) for r in network.redirect(edges, network.shortest(edges, spark.createDataFrame([(0,)], "node_id long"))).collect()}
    assert turned == {"a": (1, 0), "b": (2, 1), "c": (2, 0)}


def test_every_query_is_registered():
    names = queries.queries()
    assert len(names) > 120 and len(queries.oracle_sql()) > 90
