"""Outlines of cells against a flood fill and hand-drawn shapes."""

import random

from brookflow.operators import outlines, raster

CELLS = "r long, c long, label long"


def _parts(grid):
    left, out = dict(grid), []
    while left:
        at, label = left.popitem()
        todo, part = [at], {at}
        while todo:
            r, c = todo.pop()
            for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if left.get(n) == label:
                    del left[n]
                    part.add(n)
                    todo.append(n)
        out.append((label, min(part), part))
    return out


def _inside(x, y, rings):
    """Even-odd rule over all rings."""
    hit = False
    for ring in rings:
        for a, b in zip(ring, ring[1:]):
            if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"]):
                hit = not hit
    return hit


def test_every_part_is_covered_by_its_polygon(spark):
    rng = random.Random(3)
    grid = {(r, c): rng.choice((1, 1, 2)) for r in range(9) for c in range(9) if rng.random() < 0.9}
    made = outlines.outlines(spark.createDataFrame([(r, c, v) for (r, c), v in grid.items()], CELLS), 1.0).collect()
    want = _parts(grid)
    assert sorted((m["label"], tuple(m["part"])) for m in made) == sorted((label, name) for label, name, _ in want)
    cells = {(label, name): part for label, name, part in want}
    for m in made:
        part = cells[m["label"], tuple(m["part"])]
        assert m["area"] == len(part)
        assert {(r, c) for r in range(9) for c in range(9) if _inside(c + 0.5, r + 0.5, m["rings"])} == part
        assert all(ring[0] == ring[-1] for ring in m["rings"])


def test_hole_and_corners(spark):
    """A square of 3 x 3 cells with a hole has two rings of four corners; cells that meet by a corner are two parts."""
    rows = [(r, c, 7) for r in range(3) for c in range(3) if (r, c) != (1, 1)] + [(5, 0, 8), (6, 1, 8), (9, 9, None)]
    made = {(m["label"], tuple(m["part"])): m for m in outlines.outlines(spark.createDataFrame(rows, CELLS), 2.0).collect()}
    assert set(made) == {(7, (0, 0)), (8, (5, 0)), (8, (6, 1))}
    outer, hole = made[7, (0, 0)]["rings"]
    assert len(outer) == len(hole) == 5 and {(p["x"], p["y"]) for p in outer} == {(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0)}
    assert {(p["x"], p["y"]) for p in hole} == {(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)}
    assert made[7, (0, 0)]["area"] == 32.0 and made[8, (5, 0)]["area"] == 4.0


def test_long_rings_take_few_rounds_and_no_cells_no_rows(spark):
    rounds = []
    line = spark.range(3000).selectExpr("0L AS r", "id AS c", "1L AS label")
    assert [len(m["rings"][0]) for m in outlines.outlines(line, 1.0, rounds).collect()] == [5]
    assert len(rounds) < 16
    assert outlines.outlines(raster.relabel(line, spark.createDataFrame([], "label long, target long")), 1.0).isEmpty()


def test_flow_driver_counts_its_steps(spark):
    """A slope to the left of one row: labels go as far as iterations allow; sixteen directions need all eight neighbours."""
    slope = spark.createDataFrame([(0, c, float(c)) for c in range(8)], "r long, c long, v double")
    wet = spark.createDataFrame([(0, 0, 5), (0, 7, 0)], CELLS)
    for iterations, reached in ((3, 4), (None, 8), (0, 1)):
        made, flow = raster.run_flow(slope, wet, iterations)
        assert sorted((m["c"], m["label"]) for m in made.collect()) == [(c, 5) for c in range(reached)]
    assert {(m["c"], m["nc"]) for m in flow.collect()} == {(0, None)} | {(c, c - 1) for c in range(1, 8)}
    made, flow = raster.run_flow(slope, wet, None, "d16")
    assert sorted(m["c"] for m in made.collect()) == [0, 1, 2] and flow.where("sector is not null").isEmpty()
    fills = spark.createDataFrame([(0, c, raster.D8_TO_D16[16]) for c in range(8)], "r long, c long, sector int")
    assert sorted(m["c"] for m in raster.run_flow(slope, wet, None, "d16", fills)[0].collect()) == list(range(8))


def test_tiles_give_the_same_polygons(spark, monkeypatch):
    """Tiles of three cells cut rings, holes and parts many times over; few sides are left to the rounds with larger ones."""
    rng = random.Random(5)
    grid = {(r, c): rng.choice((1, 1, 1, 2)) for r in range(-4, 13) for c in range(14) if rng.random() < 0.9}
    cells = spark.createDataFrame([(r, c, v) for (r, c), v in grid.items()], CELLS)
    made = [{(m["label"], tuple(m["part"]), m["area"], str(m["rings"])) for m in outlines.outlines(cells, 1.0, tile=tile).collect()} for tile in (3, 5, 256)]
    assert made[0] == made[1] == made[2]
    want = _parts(grid)
    assert sorted((label, part, area) for label, part, area, _ in made[0]) == sorted((label, name, len(part)) for label, name, part in want)
    for tile in (3, 256):
        got = {(p["r"], p["c"]): (p["label"], tuple(p["part"])) for p in raster.parts(cells, tile).collect()}
        assert got == {at: (label, name) for label, name, part in want for at in part}
    seen, plain = [], outlines.components
    monkeypatch.setattr(outlines, "components", lambda edges, *names: seen.append(edges.count()) or plain(edges, *names))
    outlines.outlines(cells, 1.0).collect()
    assert len(seen) == 1 and seen[0] < len(grid) / 4
