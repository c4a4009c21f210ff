"""Buffers against closed forms and the distance to the shape."""

import math
import random

import pytest

from brookflow.operators import buffers

LINE, SHAPE = "id long, coords array<struct<x:double,y:double>>", "id long, rings array<array<struct<x:double,y:double>>>"


def points(*p):
    return [{"x": float(x), "y": float(y)} for x, y in p]


def odd(x, y, rings):
    hit = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"]):
                hit = not hit
    return hit


def away(x, y, p):
    best = math.hypot(x - p[0]["x"], y - p[0]["y"])
    for a, b in zip(p, p[1:]):
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        t = max(0, min(1, ((x - a["x"]) * dx + (y - a["y"]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        best = min(best, math.hypot(x - a["x"] - t * dx, y - a["y"] - t * dy))
    return best


def test_closed_forms(spark):
    rows = [(1, points((0, 0), (10, 0))), (2, points((0, 0), (10, 0), (10, 10))), (3, points((5, 5))), (4, points((0, 0), (20, 0), (20, 20), (0, 20), (0, 0))), (5, points((0, 0), (0, 0), (7, 0), (0, 0))), (6, None)]
    made = {(r["id"], r["part"]): r for r in buffers.buffer(spark.createDataFrame(rows, LINE), 2.0).collect()}
    disc = math.pi * 4
    want = {1: 40 + disc, 2: 80 + disc - 4 + disc / 4, 3: disc, 4: 4 * 80 - 4 * 4 + disc, 5: 28 + disc}
    assert {k for k, _ in made} == set(want) and all(abs(made[k, 0]["area"] - v) < 0.001 * v for k, v in want.items())
    assert [len(made[k, 0]["rings"]) for k in (1, 2, 3, 4, 5)] == [1, 1, 1, 2, 1]
    flat = {r["id"]: r["area"] for r in buffers.buffer(spark.createDataFrame(rows[:3], LINE), 2.0, cap="flat").collect()}
    assert abs(flat[1] - 40) < 1e-6 and abs(flat[2] - (80 - 4 + disc / 4)) < 0.02 and 3 not in flat
    box = [(1, [points((0, 0), (30, 0), (30, 30), (0, 30), (0, 0)), points((10, 10), (20, 10), (20, 20), (10, 20), (10, 10)), points((2, 2), (5, 2), (5, 5), (2, 2))]), (2, None)]
    got = buffers.buffer(spark.createDataFrame(box, SHAPE), 2.0).collect()
    assert [(r["id"], len(r["rings"])) for r in got] == [(1, 2)] and abs(got[0]["area"] - (900 + 4 * 30 * 2 + disc - 36)) < 0.02


def test_membership_is_the_distance(spark):
    r = random.Random(7)
    rows = [(i, points(*((r.uniform(0, 40), r.uniform(0, 40)) for _ in range(r.randrange(2, 7))))) for i in range(5)]
    radius, made = 3.0, {}
    for x in buffers.buffer(spark.createDataFrame(rows, LINE), radius).collect():
        made.setdefault(x["id"], []).append(x["rings"])
    for i, p in rows:
        assert len(made[i]) == 1
        for _ in range(1200):
            x, y = r.uniform(-4, 44), r.uniform(-4, 44)
            d = away(x, y, p)
            if abs(d - radius) > 0.002:
                assert odd(x, y, made[i][0]) == (d < radius), (i, x, y, d)


def test_what_is_refused(spark):
    for bad in ({"cap": "square"}, {"radius": 0.0}):
        with pytest.raises(ValueError):
            buffers.buffer(spark.createDataFrame([], LINE), **{"radius": 1.0, **bad})


def test_equal_shapes_are_buffered_once(spark, monkeypatch):
    seen, plain = [], buffers.dissolve

    def counted(named, *a, **k):
        seen.append(named.select("key").distinct().count())
        return plain(named, *a, **k)

    monkeypatch.setattr(buffers, "dissolve", counted)
    rows = [(i, points((0, 0), (10, 0))) for i in range(6)] + [(6, points((0, 0), (10, 0))), (6, points((50, 0), (60, 0))), (7, points((50, 0), (60, 0)))]
    made = {}
    for r in buffers.buffer(spark.createDataFrame(rows, LINE), 2.0).collect():
        made.setdefault(r["id"], []).append(round(r["area"], 6))
    assert seen == [3]
    assert sorted(made) == list(range(8)) and made[6] == [made[0][0], made[7][0]] and {len(made[i]) for i in (0, 1, 2, 3, 4, 5, 7)} == {1}
