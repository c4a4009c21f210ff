"""Unions of polygons against the polygons themselves, point by point, and against unit squares."""

import random

import pytest

from brookflow.operators import dissolve

SHAPE = "id long, k string, rings array<array<struct<x:double,y:double>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in (*points, points[0])]


def box(x, y, w, h):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def odd(x, y, rings):
    hit = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"]):
                hit = not hit
    return hit


def made(spark, shapes, **how):
    return dissolve.dissolve(spark.createDataFrame([(i, k, r) for i, (k, r) in enumerate(shapes)], SHAPE), "k", **how).collect()


def test_boxes_that_overlap_touch_and_enclose(spark):
    shapes = [
        ("over", [box(0, 0, 10, 10)]), ("over", [box(5, 5, 10, 10)]),
        ("beside", [box(0, 0, 10, 10)]), ("beside", [box(10, 0, 10, 10)]), ("beside", [box(20, 4, 10, 2)]),
        ("corner", [box(0, 0, 10, 10)]), ("corner", [box(10, 10, 10, 10)]),
        ("inside", [box(0, 0, 10, 10)]), ("inside", [box(2, 2, 3, 3)]), ("inside", [box(0, 0, 10, 10)]),
        ("ring", [box(0, 0, 30, 10)]), ("ring", [box(0, 20, 30, 10)]), ("ring", [box(0, 0, 10, 30)]), ("ring", [box(20, 0, 10, 30)]), ("ring", [box(13, 13, 2, 2)]),
        ("hole", [box(0, 0, 20, 20), box(5, 5, 10, 10)]), ("hole", [box(5, 5, 10, 4)]), ("apart", [box(0, 0, 1, 1)]), ("apart", [box(3, 0, 1, 1)]),
        ("clockwise", [list(reversed(box(0, 0, 4, 4))), box(1, 1, 1, 1)]), ("none", None), ("flat", [ring((0, 0), (5, 5), (9, 9))]),
    ]
    got = {}
    for r in made(spark, shapes):
        got.setdefault(r["k"], []).append((r["part"], r["area"], [len(x) - 1 for x in r["rings"]]))
    got = {k: sorted(v) for k, v in got.items()}
    assert got == {
        "over": [(0, 175.0, [8])], "beside": [(0, 220.0, [8])], "corner": [(0, 100.0, [4]), (1, 100.0, [4])], "inside": [(0, 100.0, [4])],
        "ring": [(0, 800.0, [4, 4]), (1, 4.0, [4])], "hole": [(0, 340.0, [4, 4])], "apart": [(0, 1.0, [4]), (1, 1.0, [4])], "clockwise": [(0, 15.0, [4, 4])],
    }
    small = {r["k"]: r["area"] for r in made(spark, [s for s in shapes if s[0] in ("hole", "clockwise")], min_hole=1.0)}
    assert small == {"hole": 340.0, "clockwise": 16.0}


@pytest.mark.parametrize("whole", [True, False])
def test_triangles_in_a_heap(spark, whole):
    """Random triangles, with whole coordinates that make many sides meet in corners and run along each other, or with any."""
    r = random.Random(5)

    def at():
        return (r.randrange(0, 12), r.randrange(0, 12)) if whole else (r.uniform(0, 40), r.uniform(0, 40))

    shapes = []
    while len(shapes) < 36:
        a, b, c = at(), at(), at()
        b, c = ((a[0] + (p[0] - a[0]) / (1 if whole else 4), a[1] + (p[1] - a[1]) / (1 if whole else 4)) for p in (b, c))
        if abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) > 1:
            shapes.append((r.choice("ab" if whole else "a"), [ring(a, b, c)]))
    rows = made(spark, shapes[: 14 if whole else 36], precision=1e-6)
    shapes = shapes[: 14 if whole else 36]
    for key in {k for k, _ in shapes}:
        own, parts = [s for k, s in shapes if k == key], [x["rings"] for x in rows if x["k"] == key]
        for _ in range(1500):
            x, y = r.uniform(-1, 41 if not whole else 13), r.uniform(-1, 41 if not whole else 13)
            assert sum(odd(x, y, p) for p in parts) == any(odd(x, y, s) for s in own), (key, x, y)


def test_a_long_row_takes_few_rounds(spark):
    """Three thousand steps of a stair, each overlapping the next: one outline of thousands of corners."""
    n, rounds = 3000, []
    rows = made(spark, [("stair", [box(2 * i, 2 * i, 3, 3)]) for i in range(n)], rounds=rounds)
    assert [(r["part"], r["area"], len(r["rings"]), len(r["rings"][0]) - 1) for r in rows] == [(0, 8.0 * n + 1, 1, 4 * n)] and len(rounds) < 40
