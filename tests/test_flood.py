"""Tiled filling and ways over level cells against a flood of the whole grid."""

import heapq
import random

import pytest

from brookflow.operators import flood

CELLS = "r long, c long, v double"
AROUND = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]


def whole_flood(grid):
    border = [x for x in grid if sum((x[0] + a, x[1] + b) in grid for a, b in AROUND) < 8]
    level = {x: grid[x] for x in border}
    queue = [(v, x) for x, v in level.items()]
    heapq.heapify(queue)
    while queue:
        w, x = heapq.heappop(queue)
        for a, b in AROUND:
            y = x[0] + a, x[1] + b
            if y in grid and y not in level:
                level[y] = max(w, grid[y])
                heapq.heappush(queue, (level[y], y))
    return level


def whole_steps(level):
    steps = {x: 0 for x in level if sum((x[0] + a, x[1] + b) in level for a, b in AROUND) < 8 or any(level.get((x[0] + a, x[1] + b), 1e9) < level[x] for a, b in AROUND)}
    ring = list(steps)
    while ring:
        ring = list(dict.fromkeys(y for x in ring for a, b in AROUND if (y := (x[0] + a, x[1] + b)) in level and y not in steps and level[y] == level[x] and not steps.update({y: steps[x] + 1})))
    return steps


def frame(spark, grid):
    return spark.createDataFrame([(r, c, float(v)) for (r, c), v in grid.items()], CELLS)


@pytest.mark.parametrize(("seed", "tile", "top"), [(1, 4, 6), (2, 7, 1000), (3, 64, 3)])
def test_filling_equals_a_flood_of_the_whole_grid(spark, seed, tile, top):
    r = random.Random(seed)
    grid = {(a, b): r.randrange(top) for a in range(-5, 22) for b in range(30) if r.random() < 0.97}
    got = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(frame(spark, grid), tile=tile).collect()}
    level = whole_flood(grid)
    assert got == level
    steps = {(x["r"], x["c"]): x["k"] for x in flood.level_steps(frame(spark, level), tile=tile).collect()}
    assert steps == whole_steps(level)
    flow = {(x["r"], x["c"]): (x["nr"], x["nc"]) for x in flood.flow_filled(frame(spark, level), tile=tile).collect()}
    for x, to in flow.items():
        if to == (None, None):
            assert sum((x[0] + a, x[1] + b) in grid for a, b in AROUND) < 8
        else:
            assert (level[to], steps[to]) < (level[x], steps[x])


def test_a_long_winding_lake_takes_few_rounds(spark):
    """A ditch of depth zero winds to and fro between walls and leaves the grid at one end over a sill."""
    n, grid = 40, {}
    for a in range(n):
        for b in range(n):
            turn = b == (n - 2 if a // 2 % 2 else 1)
            grid[a, b] = 9 if a in (0, n - 1) or b in (0, n - 1) or (a % 2 == 0 and not turn) else 0
    grid[1, 0] = 3
    rounds = []
    got = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(frame(spark, grid), tile=8, rounds=rounds).collect()}
    assert got == whole_flood(grid) and sum(v == 3 for v in got.values()) > 600 and len(rounds) < 60
    taken_back = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(frame(spark, grid), 2.0, tile=8).collect()}
    assert taken_back == grid


def test_cells_without_height_are_missing(spark):
    grid = {(a, b): 5.0 for a in range(5) for b in range(5)} | {(2, 2): 1.0}
    cells = frame(spark, {x: v for x, v in grid.items() if x != (1, 1)}).unionByName(spark.createDataFrame([(1, 1, None)], CELLS))
    got = {(x["r"], x["c"]): x["v"] for x in flood.fill_depressions(cells, tile=2).collect()}
    assert got[2, 2] == 1.0 and len(got) == 24
    assert flood.fill_depressions(cells.where("false")).count() == 0
