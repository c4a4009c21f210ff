"""Flow and basins solved by tiles, against the plain rules cell by cell."""

import random

import pytest
from pyspark.sql import functions as F

from brookflow.operators import raster

CELLS = "r long, c long, v double"


def plain_flow(v):
    out = {}
    for (r, c), h in v.items():
        best, to = 0.0, (None, None, None)
        for dr, dc, code in raster.D8:
            n = v.get((r + dr, c + dc))
            if h is not None and n is not None and (h - n) / (dr * dr + dc * dc) ** 0.5 > best:
                best, to = (h - n) / (dr * dr + dc * dc) ** 0.5, (code, r + dr, c + dc)
        out[r, c] = to
    return out


def plain_labels(flow, labels, most=None):
    out = {}
    for cell in flow:
        at, n, seen = cell, 0, set()
        while at in flow and at not in labels and at not in seen:
            seen.add(at)
            at, n = flow[at][-2:], n + 1
        if at in labels and at in flow and (most is None or n <= most):
            out[cell] = labels[at]
    return out


@pytest.mark.parametrize("seed", (1, 2))
def test_flow_and_basins_across_tiles(spark, seed):
    """Gaps, heights that are missing, negative indices and long ways over the tiles' sides."""
    rng = random.Random(seed)
    v = {(r, c): (None if rng.random() < 0.02 else float(rng.randrange(9) + r)) for r in range(-9, 14) for c in range(-7, 12) if rng.random() < 0.95}
    cells = spark.createDataFrame([(*k, h) for k, h in v.items()], CELLS)
    want = plain_flow(v)
    flow = raster.by_tile(cells, raster._steepest, raster._POINTED, 4)
    assert {(x["r"], x["c"]): (x["dir"], x["nr"], x["nc"]) for x in flow.collect()} == want
    assert {(x["r"], x["c"]): (x["dir"], x["nr"], x["nc"]) for x in raster.flow_d8(cells).collect()} == want
    big = 2**60 + 1
    labels = {k: big + i for i, k in enumerate(v) if i % 17 == 3}
    wet = spark.createDataFrame([(*k, n) for k, n in labels.items()], "r long, c long, label long")
    for most in (None, 3):
        got = {(x["r"], x["c"]): x["label"] for x in raster.basins(flow, wet, most, tile=4).collect()}
        assert got == plain_labels(want, labels, most)


def test_rings_and_ways_out_of_the_grid_have_no_basin(spark):
    flow = {(0, 0): (0, 5), (0, 5): (0, 0), (0, 1): (0, 2), (0, 2): (0, 1), (0, 3): (0, 9), (0, 4): (0, 6), (0, 6): (0, 7), (0, 7): (None, None)}
    rows = [(*k, *to) for k, to in flow.items()]
    out = raster.basins(spark.createDataFrame(rows, "r long, c long, nr long, nc long"), spark.createDataFrame([(0, 7, 70), (0, 9, 90)], "r long, c long, label long"), tile=4)
    assert {(x["c"], x["label"]) for x in out.collect()} == {(4, 70), (6, 70), (7, 70)}


def test_a_cell_is_shuffled_once_not_once_for_each_neighbour(spark):
    n = raster.by_tile(spark.range(64).select((F.col("id") / 8).cast("long").alias("r"), (F.col("id") % 8).alias("c")), lambda t, own: t[["r", "c"]].assign(n=len(t))[own], "r long, c long, n long", 8)
    assert n.count() == 64 and n.agg(F.max("n")).first()[0] == 64
