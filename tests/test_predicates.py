"""Hand-computed crossings, projections, fills and flow directions."""

import time

from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import flood, raster, spatial

LINE = "id string, coords array<struct<x:double,y:double>>"


def lines(spark, **named):
    return spark.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in named.items()], LINE)


def test_lines_cross_at_vertices_but_not_at_ends(spark):
    mine = lines(spark, c=[(0, -5), (0, 5)])
    walls = lines(
        spark,
        proper=[(-3, 1), (3, 2)], vertex=[(-3, 1), (0, 1), (3, 1)], bend=[(-3, 3), (0, 2), (-3, 1)], ends_on=[(-3, 0), (0, 0)], meets_end=[(-3, 5), (3, 5)],
        both_ends=[(0, 5), (4, 9)], along=[(0, -2), (0, 2), (4, 2)], along_and_through=[(0, -2), (0, 0), (3, 1), (-3, 2)], apart=[(1, -5), (1, 5)], ring=[(0, 0), (2, -1), (2, 1), (0, 0)],
    )
    want = {"proper", "vertex", "bend", "ring"}
    for cell in (0.7, 3.0, 100.0):
        assert {r["r_id"] for r in spatial.crossing_pairs(mine, walls, cell).collect()} == want
    assert {r["l_id"] for r in spatial.crossing_pairs(walls, mine, 3.0).collect()} == want


def test_lines_cross_polygons_they_pass_through(spark):
    corners = [(0, 0), (40, 0), (40, 10), (10, 10), (10, 40), (0, 40), (0, 0)]
    hole = [(2, 2), (2, 8), (8, 8), (8, 2), (2, 2)]
    areas = spark.createDataFrame([("L", [[(float(x), float(y)) for x, y in r] for r in (corners, hole)])], "id string, rings array<array<struct<x:double,y:double>>>")
    mine = lines(
        spark,
        through=[(20, -5), (20, 15)], over_the_notch=[(30, 5), (5, 30)], enters=[(20, 5), (20, 15)], within=[(15, 5), (35, 5)], outside=[(20, 20), (30, 30)], along=[(0, 0), (40, 0)], on_edge_then_in=[(12, 10), (20, 10), (20, 5)],
        touches=[(-5, 5), (5, -5)], through_hole=[(1, 5), (9, 5)], in_hole=[(3, 3), (7, 7)], far=[(900, 900), (901, 901)], corner_to_out=[(40, 0), (45, -5)], point=[(5, 9), (5, 9)],
    )
    assert {r["l_id"] for r in spatial.polygon_crossings(mine, areas).collect()} == {"through", "over_the_notch", "enters", "through_hole"}


def test_projection_of_a_long_line(spark):
    """The first of equally near places, and time in proportion to the vertices."""
    made = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(20_000)), lambda i: g.point(i, i % 2)).alias("c"))
    began = time.time()
    got = made.select(g.project(F.col("c"), F.lit(15_000.25), F.lit(9.0)).alias("p")).first()["p"]
    assert time.time() - began < 10 and (got["x"], got["y"]) == (15_001.0, 1.0) and abs(got["along"] - 15_001 * 2**0.5) < 1e-6
    flat = lines(spark, a=[(0, 0), (4, 0), (4, 4), (0, 4)], b=[(1, 1), (1, 1)]).select("id", g.project(F.col("coords"), F.lit(2.0), F.lit(2.0)).alias("p")).collect()
    assert {r["id"]: tuple(r["p"]) for r in flat} == {"a": (2.0, 2.0, 2.0, 0.0), "b": (2**0.5, 0.0, 1.0, 1.0)}


def grid(spark, rows):
    return spark.createDataFrame([(r, c, float(v)) for r, row in enumerate(rows) for c, v in enumerate(row)], "r int, c int, v double")


def test_fill_goes_on_until_stable(spark):
    """A winding ditch of low cells whose only outlet is its far end: water sinks along all of it."""
    rows = [[9] * 9 for _ in range(9)]
    path = [(1, c) for c in range(1, 8)] + [(2, 7)] + [(3, c) for c in range(7, 0, -1)] + [(4, 1)] + [(5, c) for c in range(1, 8)] + [(6, 7), (7, 7), (8, 7)]
    for r, c in path:
        rows[r][c] = 2
    rows[1][1] = 0
    got = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(grid(spark, rows)).collect()}
    assert got == {(r, c): 2.0 if (r, c) in path else 9.0 for r in range(9) for c in range(9)}


def test_flow_in_sixteen_directions(spark):
    """A slope that falls to the right and a little downward; cells at the border and beside no data have no direction."""
    rows = [[100 - 4 * c - r for c in range(8)] for r in range(7)]
    rows[6][7] = -50
    got = {(x["r"], x["c"]): (x["angle"], x["sector"]) for x in raster.flow_sectors(grid(spark, rows)).collect()}
    assert got[0, 3] == got[3, 0] == got[5, 6] == got[6, 3] == (None, None)
    assert abs(got[2, 2][0] - 104.03624346792648) < 1e-9 and got[2, 2][1] == 8  # a quarter down: sector 8 is centred on 112.5
    flow = {(x["r"], x["c"]): (x["nr"], x["nc"]) for x in raster.flow_d16(grid(spark, rows), spark.createDataFrame([(3, 3, 1)], "r int, c int, sector int")).collect()}
    assert flow[2, 2] == (3, 4) and flow[3, 3] == (1, 1) and flow[0, 0] == (None, None)


def test_labels_stop_at_rings(spark):
    flow = spark.createDataFrame([(0, 0, 0, 1), (0, 1, 0, 0), (0, 2, 0, 1), (1, 0, 1, 1), (1, 1, 1, 2), (1, 2, None, None)], "r int, c int, nr int, nc int")
    labels = spark.createDataFrame([(1, 2, 7)], "r int, c int, label int")
    assert {tuple(x) for x in raster.basins(flow, labels).collect()} == {(1, 0, 7), (1, 1, 7), (1, 2, 7)}


def test_length_within_polygons(spark):
    from brookflow.operators import spatial

    corner = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    frame = [[(10.0, 0.0), (14.0, 0.0), (14.0, 4.0), (10.0, 4.0), (10.0, 0.0)], [(11.0, 1.0), (13.0, 1.0), (13.0, 3.0), (11.0, 3.0), (11.0, 1.0)]]
    shape = "id long, rings array<array<struct<x:double,y:double>>>"
    areas = spark.createDataFrame([(1, [corner]), (2, frame)], shape)
    lines = {
        1: [(-1.0, 2.0), (5.0, 2.0)],  # through one arm
        2: [(0.5, 3.0), (3.0, 0.5)],  # leaves one arm, enters the other: 1 - 0.5 on both sides
        3: [(0.0, -1.0), (0.0, 3.0)],  # along the left side
        4: [(9.0, 2.0), (15.0, 2.0)],  # through a frame and its hole
        5: [(2.0, 2.0), (3.0, 3.0)],  # in the notch
        6: [(0.5, 0.5), (0.5, 0.5), (0.5, 2.5)],  # inside, with a repeated vertex
    }
    df = spark.createDataFrame(list(lines.items()), "id long, coords array<struct<x:double,y:double>>")
    got = {(r["area_id"], r["line_id"]): r["overlap"] for r in spatial.overlaps(areas, df).collect()}
    told = {(1, 1): 1.0, (1, 2): 2**0.5, (1, 3): 3.0, (2, 4): 2.0, (1, 6): 2.0}
    assert got.keys() == told.keys() and all(abs(got[k] - v) < 1e-9 for k, v in told.items())
    best = {r["area_id"]: r["line_id"] for r in spatial.longest_overlap(areas, df).collect()}
    assert best == {1: 3, 2: 4} and spatial.longest_overlap(areas.limit(0), df).count() == 0
