"""Snapping onto lines and cutting them, against plain looks at all pairs; neither may build all pairs or go through a line's parts for each part."""

import math
import random
import time

import pytest

from brookflow.operators import lines as ln
from brookflow.operators import spatial

LINE = "code string, coords array<struct<x:double,y:double>>, status string"


def layer(spark, rows):
    return spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in p], "unchanged") for c, p in rows], LINE)


def off(p, a, b):
    """(distance, share) of the place of the segment that is nearest to p."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    norm = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / norm)) if norm else 0.0
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy), t


@pytest.mark.parametrize("step", [1, 0])
def test_nearest_other_line_is_that_of_all_pairs(spark, monkeypatch, step):
    """Dense lines, some twice or three times; on a lattice many are equally near, and many points lie on a line. Few pairs may be made."""
    r = random.Random(step)
    at = (lambda: float(r.randrange(60))) if step else (lambda: r.uniform(0, 60))
    lines = [(f"L{i:03}", [(at(), at()), (at(), at())]) for i in range(300)]
    lines += [(f"M{i:03}", lines[r.randrange(100)][1]) for i in range(60)]
    points = [(f"{c}:{i}", c, *p[i]) for c, p in lines[:280:2] for i in (0, 1)] + [("far", "L000", 500.0, 500.0)]
    made = []
    near = spatial._near_segments

    def counted(*a):
        out = near(*a)
        made.append(out.count())
        return out

    monkeypatch.setattr(spatial, "_near_segments", counted)
    frame = spark.createDataFrame(points, "id string, code string, x double, y double")
    got = {x["l_id"]: (x["r_id"], round(x["dist"], 9)) for x in spatial.nearest_other_line(frame, layer(spark, lines).selectExpr("code as id", "coords"), 5.0).collect()}
    want = {}
    for k, own, x, y in points:
        best = min((round(off((x, y), *p)[0], 9), c) for c, p in lines if c != own)
        if best[0] <= 5:
            want[k] = best[::-1]
    assert got == want and len(want) > 270 and "far" not in got
    assert sum(made) < sum(off(q[2:], *p)[0] <= 5 for q in points for _, p in lines) / 2


def test_snap_makes_few_pairs(spark, monkeypatch):
    """Each loose end has hundreds of lines within the distance, of which the nearest is enough."""
    r = random.Random(5)
    rows = [(f"L{i:03}", [(r.uniform(0, 60), r.uniform(0, 60)), (r.uniform(0, 60), r.uniform(0, 60))]) for i in range(300)]
    made = []
    near = spatial._near_segments

    def counted(*a):
        out = near(*a)
        made.append(out.count())
        return out

    monkeypatch.setattr(spatial, "_near_segments", counted)
    assert ln.snap(layer(spark, rows), 20.0).count() == 300
    assert 0 < sum(made) < 600 * 300 / 10


def test_parts_are_those_of_a_plain_cut(spark):
    """Straight and bent lines, twins, a code that repeats, cuts side by side at one distance, points beside vertices."""
    r = random.Random(3)
    rows = [(f"A{i}", [(float(r.randrange(40)), float(r.randrange(40))) for _ in range(r.choice((2, 2, 3, 4)))]) for i in range(60)]
    rows = [x for x in rows if all(a != b for a, b in zip(x[1], x[1][1:]))]
    rows += [("T", rows[0][1]), ("level", [(100.0, 0.0), (110.0, 0.0)]), ("back", [(200.0, 0.0), (210.0, 0.0), (210.0, 0.5), (200.0, 0.5)])]
    points = [(float(x), float(y)) for x in range(40) for y in range(40)] + [(103.0, 0.2), (103.0, -0.2), (107.0, 0.0), (205.0, 0.2), (204.0, 0.3), (100.1, 0.0)]
    want = []
    for code, p in rows:
        at, cum = 0.0, [0.0]
        for a, b in zip(p, p[1:]):
            at += math.dist(a, b)
            cum.append(at)
        cuts = []
        for q in points:
            best = min((off(q, a, b)[0], i, off(q, a, b)[1]) for i, (a, b) in enumerate(zip(p, p[1:])))
            along = cum[best[1]] + best[2] * (cum[best[1] + 1] - cum[best[1]])
            if best[0] <= 0.3 and 0.3 < along < at - 0.3:
                cuts.append((along, 1, *q))
        every = sorted([(c, 0, *v) for c, v in zip(cum, p) if all(abs(k[0] - c) > 0.3 for k in cuts)] + cuts)
        bounds = [-1.0, *(k[0] for k in sorted(cuts)), math.inf]
        parts = [[v[2:] for v in every if lo <= v[0] <= hi] for lo, hi in zip(bounds, bounds[1:])]
        parts = [x for x in parts if any(a != b for a, b in zip(x, x[1:]))]
        want += [(f"{code}-{i}" if len(parts) > 1 else code, x, "split" if len(parts) > 1 else "unchanged") for i, x in enumerate(parts)]
    made = ln.split_at_points(layer(spark, rows), spark.createDataFrame(points, "x double, y double"), 0.3)
    assert sorted((x["code"], [tuple(p) for p in x["coords"]], x["status"]) for x in made.collect()) == sorted(want) and len(want) > 300
    twice = layer(spark, [("R", [(0, 0), (10, 0)]), ("R", [(0, 5), (10, 5)]), ("S", [(0, 9), (10, 9)])])
    got = ln.split_at_points(twice, spark.createDataFrame([(4.0, 0.0)], "x double, y double"))
    assert sorted(x["code"] for x in got.collect()) == ["R-0", "R-1", "R-2", "S"]


def test_a_line_of_many_cuts(spark):
    """12,000 parts; looking through all vertices for each of them takes minutes."""
    points = spark.range(1, 12000).selectExpr("cast(id as double) x", "0d y")
    began = time.time()
    out = ln.split_at_points(layer(spark, [("A", [(0, 0), (12000, 0)])]), points)
    got = out.selectExpr("count(*) n", "count(distinct code) codes", "min(size(coords)) a", "max(size(coords)) b", "sum(coords[1].x - coords[0].x) long").first()
    assert tuple(got) == (12000, 12000, 2, 2, 12000.0)
    assert time.time() - began < 20
