"""Depressions filled tile by tile, and the ways across what is level.

The level to which a cell fills is the least, over its ways to the border, of the greatest height on the way. A tile of
cells is flooded by itself from its rim, lowest cells first; that gives each cell the level at which it reaches the rim
and the rim cell that it reaches (its basin), and the least heights at which neighbouring basins spill into each other.
Rim cells, their spills and the steps from tile to tile make a graph of a few cells in a hundred; the least greatest
height from each rim cell to the border is found on that by merging every part with the neighbour that it spills into
at the lowest height, which halves the parts each round. A cell's level is the greater of its own and its rim cell's.
So rounds grow with the logarithm of the rim cells, however long a level stretch is.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.operators.raster import _POINTED, D8, TILE, by_tile, neighbours, nullable, pointed, tile_grid
from brookflow.runtime import release, staged

_STEPS = [(dr, dc) for dr, dc, _ in D8]


def _id(r: Column, c: Column) -> Column:
    return F.shiftleft(r.cast("long"), 32) + c.cast("long")


def _tiled(cells: DataFrame, tile: int) -> DataFrame:
    return cells.withColumns({"tr": F.floor(F.col("r") / tile).cast("long"), "tc": F.floor(F.col("c") / tile).cast("long")})


_FLOODED = "kind string, r long, c long, v double, w double, rim long, other long, near long"


def _flood(cells: pd.DataFrame) -> pd.DataFrame:
    """One tile's cells with level and rim cell (kind cell, near: neighbours in the tile, of rim cells), and the spills between rim cells' basins (kind spill)."""
    v, at, wide = tile_grid(cells, cells["v"].to_numpy(float))
    names = np.zeros(len(v), np.int64)
    names[at] = (cells["r"].to_numpy() << 32) + cells["c"].to_numpy()
    around = [dr * wide + dc for dr, dc in _STEPS]
    there = ~np.isnan(v)
    near = sum(there[at + d] for d in around)
    rim = at[near < 8]
    basin, level = np.full(len(v), -1, np.int64), np.full(len(v), np.nan)
    basin[rim], level[rim] = rim, v[rim]
    heights, basins, levels = v.tolist(), basin.tolist(), level.tolist()
    queue = [(heights[i], i) for i in rim.tolist()]
    heapq.heapify(queue)
    spills: dict[tuple[int, int], float] = {}
    while queue:
        w, i = heapq.heappop(queue)
        own = basins[i]
        for d in around:
            j = i + d
            h = heights[j]
            if h != h:
                continue
            if basins[j] < 0:
                basins[j], levels[j] = own, h if h > w else w
                heapq.heappush(queue, (levels[j], j))
            elif basins[j] != own:
                pair = (own, basins[j]) if own < basins[j] else (basins[j], own)
                over = w if w > levels[j] else levels[j]
                if over < spills.get(pair, float("inf")):
                    spills[pair] = over
    out = pd.DataFrame({"kind": "cell", "r": cells["r"], "c": cells["c"], "v": cells["v"], "w": np.array(levels)[at], "rim": names[np.array(basins)[at]], "other": pd.array([None] * len(cells), "Int64"), "near": near})
    if not spills:
        return out
    a, b = np.array(list(spills)).T
    more = pd.DataFrame({"kind": "spill", "r": -1, "c": -1, "v": np.nan, "w": list(spills.values()), "rim": names[a], "other": pd.array(names[b], "Int64"), "near": 0})
    return pd.concat([out, more], ignore_index=True)


def spill_levels(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """(node, level): the least greatest height on a way from each node to the outside (null) over edges (a, b, w), b null or another node.

    Every part spills at its lowest edge, and is one with its neighbour from that height on; the pointers to those
    neighbours are doubled to find who becomes one. Parts without a way to the outside have no row.
    """
    both = edges.select("a", "b", "w").unionByName(edges.where("b is not null").select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    links = staged(both.where("a <> b or b is null").groupBy("a", "b").agg(F.min("w").alias("w")), "spills")
    parts = staged(links.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("part"), F.lit(float("-inf")).alias("level")), "parts")
    while not links.isEmpty():
        name = F.struct("w", F.coalesce(F.least("a", "b"), F.lit(-(2**63))).alias("lo"), F.greatest("a", "b").alias("hi"), "b")
        least = staged(links.groupBy("a").agg(F.min(F.when(F.col("b").isNull(), F.struct("w", F.lit(-(2**63)).alias("lo"), F.col("a").alias("hi"), "b")).otherwise(name)).alias("m")).select("a", F.col("m.b").alias("to"), F.col("m.w").alias("w")), "least")
        # two parts that spill into each other: the smaller name stays
        back = least.select(F.col("a").alias("to"), F.col("to").alias("back"))
        heads = least.join(back, "to", "left").select("a", F.when(F.col("to").isNull(), F.lit(None).cast("long")).when((F.col("back") == F.col("a")) & (F.col("a") < F.col("to")), F.col("a")).otherwise(F.col("to")).alias("to"))
        now = staged(heads.select("a", "to", (F.col("to").isNull() | (F.col("to") == F.col("a"))).alias("stands")), "heads")
        while not now.where("not stands").isEmpty():
            ahead = now.select(F.col("a").alias("to"), F.col("to").alias("further"), F.col("stands").alias("there"))
            moved = now.where("not stands").join(ahead, "to").select("a", F.when(F.col("there") & F.col("further").isNotNull(), F.col("to")).otherwise(F.col("further")).alias("to"), F.col("there").alias("stands"))
            new = staged(now.where("stands").unionByName(moved), "heads")
            release(now)
            now = new
            if rounds is not None:
                rounds.append("head")
        joined = now.select(F.col("a").alias("part"), F.col("to").alias("whole"), F.lit(True).alias("known"))
        raised = parts.join(least.select(F.col("a").alias("part"), "w"), "part", "left").join(joined, "part", "left")
        new_parts = staged(raised.select("node", F.when(F.col("known"), F.col("whole")).otherwise(F.col("part")).alias("part"), F.greatest("level", F.coalesce("w", F.lit(float("-inf")))).alias("level")), "parts")
        left = links.join(now.select("a", F.col("to").alias("na")), "a").where("na is not null")
        right = now.select(F.col("a").alias("b"), F.col("to").alias("nb"), F.lit(True).alias("_b"))
        moved = left.join(right, "b", "left").select(F.col("na").alias("a"), F.when(F.col("_b"), F.col("nb")).otherwise(F.col("b")).alias("b"), "w")
        new_links = staged(moved.where("a <> b or b is null").groupBy("a", "b").agg(F.min("w").alias("w")), "spills")
        for old in (links, parts, least, now):
            release(old)
        links, parts = new_links, new_parts
        if rounds is not None:
            rounds.append("part")
    return parts.where("part is null").select("node", "level")


def fill_depressions(cells: DataFrame, max_depth: float | None = None, *, tile: int = TILE, rounds: list | None = None) -> DataFrame:
    """(r, c, v) of cells(r, c, v) with pits raised to their spill level; border cells, those with a missing neighbour, stay. Cells without a height are missing; fills deeper than max_depth are taken back."""
    known = cells.where("v is not null and not isnan(v)").select("r", "c", F.col("v").cast("double").alias("v"))
    flooded = staged(_tiled(known.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "v"), tile).groupBy("tr", "tc").applyInPandas(lambda t: _flood(t), _FLOODED), "flooded")
    rims = flooded.where("kind = 'cell' and near < 8").select("r", "c", "v", "near")
    beside = staged(neighbours(rims.select("r", "c", "v")).where((F.floor(F.col("r") / tile) != F.floor(F.col("nr") / tile)) | (F.floor(F.col("c") / tile) != F.floor(F.col("nc") / tile))), "beside")
    across = beside.select(_id(F.col("r"), F.col("c")).alias("a"), _id(F.col("nr"), F.col("nc")).alias("b"), F.greatest("v", "nv").alias("w")).where("a < b")
    count = beside.groupBy("r", "c").agg(F.count(F.lit(1)).alias("out"))
    border = rims.join(count, ["r", "c"], "left").where(F.col("near") + F.coalesce("out", F.lit(0)) < 8).select(_id(F.col("r"), F.col("c")).alias("a"), F.lit(None).cast("long").alias("b"), F.col("v").alias("w"))
    spills = flooded.where("kind = 'spill'").select(F.col("rim").alias("a"), F.col("other").alias("b"), "w")
    levels = spill_levels(staged(spills.unionByName(across).unionByName(border), "graph"), rounds)
    raised = flooded.where("kind = 'cell'").join(levels.withColumnRenamed("node", "rim"), "rim").select("r", "c", "v", F.greatest("w", "level").alias("w"))
    keep = F.lit(True) if max_depth is None else (F.col("w") - F.col("v")) <= max_depth
    return raised.select("r", "c", F.when(keep, F.col("w")).otherwise(F.col("v")).alias("v"))


_STEPPED = "r long, c long, k long"


def _step(cells: pd.DataFrame, rows: tuple[int, int], tile: int) -> pd.DataFrame:
    """Steps over level cells of a tile, from what is known in it and around it."""
    w, at, wide = tile_grid(cells, cells["v"].to_numpy(float))
    far = 1 << 60  # a float too
    k = np.full(len(w), far)
    k[at] = cells["k"].fillna(far).to_numpy(np.int64)
    heights, steps = w.tolist(), k.tolist()
    around = [dr * wide + dc for dr, dc in _STEPS]
    queue = [(steps[i], i) for i in at.tolist() if steps[i] < far]
    heapq.heapify(queue)
    while queue:
        n, i = heapq.heappop(queue)
        if n > steps[i]:
            continue
        for d in around:
            if heights[i + d] == heights[i] and n + 1 < steps[i + d]:
                steps[i + d] = n + 1
                heapq.heappush(queue, (n + 1, i + d))
    own = ((cells["r"] // tile == rows[0]) & (cells["c"] // tile == rows[1])).to_numpy()
    got = np.array(steps)[at][own]
    mine = cells[own]
    better = got < mine["k"].fillna(far).to_numpy(np.int64)
    return pd.DataFrame({"r": mine["r"][better], "c": mine["c"][better], "k": got[better]})


def level_steps(cells: DataFrame, *, tile: int = TILE, rounds: list | None = None) -> DataFrame:
    """(r, c, v, k): the steps from each cell over cells of its height to one that has a lower neighbour or is at the border (0 there); null where there is none.

    A round takes every tile that has open or bettered cells beside it and solves it, so rounds grow with the tiles that a level stretch crosses.
    """
    def run(pdf: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        v, at, wide = tile_grid(pdf, pdf["v"].to_numpy(float))
        beside = [v[at + dr * wide + dc] for dr, dc in _STEPS]
        none = sum(~np.isnan(nv) for nv in beside) < 8
        low = none | np.logical_or.reduce([nv < v[at] for nv in beside])
        return pd.DataFrame({"r": pdf["r"], "c": pdf["c"], "v": pdf["v"], "k": nullable(np.zeros(len(at)), low)})[own]

    held = staged(by_tile(cells.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.col("v").cast("double").alias("v")), run, "r long, c long, v double, k long", tile), "level")
    fresh = None
    while True:
        # a tile sees its own cells and those one step around it
        sides = [F.struct(F.floor((F.col("r") + dr) / tile).alias("tr"), F.floor((F.col("c") + dc) / tile).alias("tc")) for dr, dc in [(0, 0), *_STEPS]]
        spread = held.withColumn("t", F.explode(F.array_distinct(F.array(*sides)))).select("r", "c", "v", "k", "t.tr", "t.tc")
        open_tiles = spread.where("k is null") if fresh is None else fresh.withColumn("t", F.explode(F.array_distinct(F.array(*sides)))).select("t.tr", "t.tc")
        todo = spread.join(open_tiles.select("tr", "tc").distinct(), ["tr", "tc"], "left_semi")
        better = staged(todo.groupBy("tr", "tc").applyInPandas(lambda key, t: _step(t, key, tile), _STEPPED), "better")
        if better.isEmpty():
            return held
        new = staged(held.join(better.withColumnRenamed("k", "nk"), ["r", "c"], "left").select("r", "c", "v", F.coalesce("nk", "k").alias("k")), "level")
        release(held)
        held, fresh = new, better
        if rounds is not None:
            rounds.append(1)


def flow_filled(cells: DataFrame, *, tile: int = TILE) -> DataFrame:
    """(r, c, dir, nr, nc) of filled cells(r, c, v): the steepest way down; over level cells the neighbour with fewer steps left; null at the border's pits. Ties to the smaller code."""
    def run(pdf: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        far = float(2**62)
        v, at, wide = tile_grid(pdf, pdf["v"].to_numpy(float))
        k, _, _ = tile_grid(pdf, pdf["k"].fillna(far).to_numpy(float))
        best, nearest, code = np.zeros(len(at)), k[at], np.zeros(len(at), np.int64)
        for dr, dc, d in D8:
            there = at + dr * wide + dc
            drop = (v[at] - v[there]) / np.sqrt(float(dr * dr + dc * dc))
            lower, level = drop > best, (best == 0) & (drop == 0) & (k[there] < nearest)
            best[lower], nearest[level], code[lower | level] = drop[lower], k[there][level], d
        return pointed(pdf, own, code)

    return by_tile(level_steps(cells, tile=tile).select("r", "c", "v", "k"), run, _POINTED, tile)
