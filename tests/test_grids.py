"""Grids with an origin, a cell and a direction of their own."""

import math
import random

import pytest

from brookflow.operators.raster import Grid, reproject_match


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_matched_to_another_grid(spark, method):
    r = random.Random(1)
    source, target = Grid(100.0, 50.0, 3.0, down=True), Grid(97.0, 11.0, 2.0)
    cells = {(a, b): r.uniform(0, 9) for a in range(12) for b in range(10) if r.random() < 0.9}
    like = [(a, b, f"z{a % 3}") for a in range(24) for b in range(22)]
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [(30, 30, None)], "r long, c long, v double")
    made = reproject_match(df, source, spark.createDataFrame(like, "r long, c long, zone string"), target, method)
    got = {(x["r"], x["c"]): (x["zone"], x["v"]) for x in made.collect()}
    assert len(got) == len(like)
    for a, b, zone in like:
        x, y = 97 + (b + 0.5) * 2, 11 + (a + 0.5) * 2
        row, col = (50 - y) / 3 - 0.5, (x - 100) / 3 - 0.5
        if method == "nearest":
            want = cells.get((math.floor(row + 0.5), math.floor(col + 0.5)))
        else:
            near = [(cells[k], w) for i in (0, 1) for j in (0, 1) if (k := (math.floor(row) + i, math.floor(col) + j)) in cells and (w := (1 - abs(row - k[0])) * (1 - abs(col - k[1]))) > 0]
            want = sum(v * w for v, w in near) / sum(w for _, w in near) if near else None
        assert got[a, b][0] == zone and (got[a, b][1] is None) == (want is None) and (want is None or abs(got[a, b][1] - want) < 1e-9)


def test_no_such_method(spark):
    with pytest.raises(ValueError):
        reproject_match(spark.range(0), Grid(0, 0, 1), spark.range(0), Grid(0, 0, 1), "cubic")
