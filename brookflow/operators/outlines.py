"""Outlines of labelled cells as polygons: sides between different labels, stitched into rings, grouped by part.

Which side follows a side is told by the cell's own neighbours, so each tile stitches its own sides. Rings that stay in a
tile are done there; the others come out as chains, which are few, and are put together across tiles by components and doubled
pointers, so the rounds grow with the logarithm of the tiles that the longest ring passes. Only the finished ring is gathered,
as the one value that it is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.operators.components import components
from brookflow.operators.raster import D8, TILE, by_tile, joined_cells, part_cell, part_names
from brookflow.runtime import release, staged

#: The four sides of a cell, counter-clockwise from the lower one (rows run upward here, as in rasterizing): direction codes of
#: the cell beyond the side, of the one ahead on the same side of the line and of the one ahead beyond it; their steps (row,
#: column); the corner (x, y) at which the side ends.
SIDES = (
    (64, 1, 128, (0, 1), (-1, 1), (1, 0)),
    (1, 4, 2, (1, 0), (1, 1), (1, 1)),
    (4, 16, 8, (0, -1), (1, -1), (0, 1)),
    (16, 64, 32, (-1, 0), (-1, -1), (0, 0)),
)


_STEP = {(dr, dc): k for dr, dc, k in D8} | {(0, 0): 0}
RING, CHAIN, LINK = 0, 1, 2


def _sides(r: np.ndarray, c: np.ndarray, own: np.ndarray, same: dict[int, np.ndarray], place: dict[int, np.ndarray]) -> dict[str, np.ndarray]:
    """The outline sides of a tile's own cells, by name: (i, name, next, to, x, y, turns); to: the next one's position, -1 in another tile.

    A side runs with its cell on the left. Where cells of a label meet by a corner alone, the line stays with its cell.
    """
    n = len(r)
    there, to_cell, to_side = np.zeros((n, 4), bool), np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)
    turns, x, y = np.zeros((n, 4), bool), np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)
    for k, (out, ahead, across, a, b, (dx, dy)) in enumerate(SIDES):
        left = ~same[ahead]
        straight = ~left & ~same[across]
        there[:, k], turns[:, k], x[:, k], y[:, k] = own & ~same[out], ~straight, c + dx, r + dy
        to_cell[:, k] = np.where(left, place[0], np.where(straight, place[_STEP[a]], place[_STEP[b]]))
        to_side[:, k] = np.where(left, (k + 1) % 4, np.where(straight, k, (k + 3) % 4))
    every = np.flatnonzero(there)
    at = np.full(4 * n, -1, np.int64)
    at[every] = np.arange(len(every))
    i, cell, side = every // 4, to_cell.ravel()[every], to_side.ravel()[every]
    return {
        "i": i, "name": (r[i] << 32) + c[i] * 4 + every % 4, "next": (r[cell] << 32) + c[cell] * 4 + side, "to": np.where(own[cell], at[cell * 4 + side], -1),
        "x": x.ravel()[every], "y": y.ravel()[every], "turns": turns.ravel()[every],
    }


def _stitched(cells: pd.DataFrame, own: np.ndarray, cell: float) -> pd.DataFrame:
    """A tile's rings, its chains from the first side in it to the side that follows elsewhere (a, b), and the links of its parts.

    Corners are in order. A ring begins behind its least side; a chain's corners up to its least side and those behind are kept apart.
    """
    cells, own, same, place, part, links = joined_cells(cells, own)
    r, c = cells["r"].to_numpy(), cells["c"].to_numpy()
    if (place[0] != np.arange(len(r))).any():
        raise ValueError("a cell is repeated")
    s = _sides(r, c, own, same, place)
    m = len(s["i"])
    me, leaves = np.arange(m), s["to"] < 0
    to = np.where(leaves, me, s["to"])
    least, end = me, to
    for _ in range(m.bit_length() + 1):
        least, end = np.minimum(least, least[end]), end[end]
    ring = ~leaves[end]
    key = np.where(ring, least, end)
    ahead = np.where(key == me, me, to)
    steps = (key != me).astype(np.int64)
    for _ in range(m.bit_length() + 1):
        steps, ahead = steps + steps[ahead], ahead[ahead]
    lowest = np.full(m, m)
    np.minimum.at(lowest, key, me)
    order = np.lexsort((-steps, key))
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    group = np.cumsum(np.diff(key[order], prepend=-1) != 0) - 1
    piece = 2 * group + (~ring & (steps < steps[lowest[key]]))[order]
    turns = s["turns"][order]
    cuts = np.cumsum(np.bincount(piece[turns], minlength=2 * len(first)))[:-1] if m else []
    xs, ys = (np.split(s[k][order][turns].astype(float) * cell, cuts) if m else [] for k in ("x", "y"))
    at, last = order[first], key[order[first]]
    label = cells["label"].reset_index(drop=True)
    made = pd.DataFrame({
        "kind": np.where(ring[at], RING, CHAIN), "part": part[s["i"][at]], "a": s["name"][at], "b": s["next"][last], "least": s["name"][lowest[last]],
        **{k: pd.Series(v, dtype=object) for k, v in (("xs", xs[::2]), ("ys", ys[::2]), ("xs2", xs[1::2]), ("ys2", ys[1::2]))},
    })
    made.insert(1, "label", label.iloc[s["i"][at]].to_numpy())
    none = [np.zeros(0)] * len(links)
    rest = pd.DataFrame({"kind": LINK, "label": label.iloc[np.zeros(len(links), int)].to_numpy(), "part": links["part"], "a": links["a"], "b": links["b"], "least": 0, "xs": none, "ys": none, "xs2": none, "ys2": none})
    return pd.concat([x for x in (made, rest) if len(x)] or [made])


def _to_heads(of: DataFrame, rounds: list | None) -> DataFrame:
    """(side, steps): how many sides lie between each side and its ring's head, of (side, next, ring) where the head is side = ring.

    Raises ValueError if a side doesn't lead to its ring's head.
    """
    head = F.col("side") == F.col("ring")
    now = staged(of.select("side", F.when(~head, F.col("next")).alias("at"), F.when(head, 0).otherwise(1).cast("long").alias("steps")), "steps")
    left = None
    while (open_now := now.where("at is not null").count()):
        if open_now == left:
            raise ValueError("sides that lead to no head: a cell is repeated or an outline is open")
        left = open_now
        ahead = now.select(F.col("side").alias("at"), F.col("at").alias("further"), F.col("steps").alias("more"))
        moved = now.where("at is not null").join(ahead, "at").select("side", F.col("further").alias("at"), (F.col("steps") + F.col("more")).alias("steps"))
        new = staged(now.where("at is null").unionByName(moved), "steps")
        release(now)
        now = new
        if rounds is not None:
            rounds.append(open_now)
    return now.select("side", "steps")


def numbered_parts(df: DataFrame, key: str, order: str) -> DataFrame:
    """part, from 0 in order within each key, in place of the order."""
    return df.withColumn("part", F.row_number().over(W.partitionBy(key).orderBy(order)).cast("long") - 1).select(key, "part", *(c for c in df.columns if c not in (key, order)))


def signed_area(ring: Column) -> Column:
    """Of a closed ring: positive if it runs counter-clockwise."""
    pairs = F.zip_with(ring, F.slice(ring, 2, F.greatest(F.size(ring), F.lit(1))), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))) / 2


def outlines(cells: DataFrame, cell: float = 2.0, rounds: list | None = None, tile: int = TILE) -> DataFrame:
    """(label, part, rings, area): a polygon per part of side-joined cells (r, c, label), its outer ring first and its holes behind.

    part is the part's least cell, as in `parts`; cell (r, c) spans [c, c + 1) x [r, r + 1) cells. Rings are closed and have
    corners only where they turn; outer ones run counter-clockwise. Holes that meet by a corner alone are one ring, which
    touches itself there. Cells without a label have no part. Repeated cells aren't allowed.
    """
    known = cells.where("label is not null").select("r", "c", "label")
    schema = f"kind int, label {known.schema['label'].dataType.simpleString()}, part long, a long, b long, least long, xs array<double>, ys array<double>, xs2 array<double>, ys2 array<double>"
    tiled = staged(by_tile(known, lambda pdf, own: _stitched(pdf, own, cell), schema, tile), "tiled")

    def points(x: str, y: str) -> Column:
        return F.zip_with(x, y, lambda p, q: F.struct(p.alias("x"), q.alias("y")))

    chains = staged(tiled.where(F.col("kind") == CHAIN).select(F.col("a").alias("side"), F.col("b").alias("next"), "least", "label", "part", points("xs", "ys").alias("upto"), points("xs2", "ys2").alias("behind")), "chains")
    within = staged(chains.select("side", "next", "least").join(components(chains, "side", "next").withColumnRenamed("node", "side"), "side"), "within")
    heads = within.groupBy("component").agg(F.min(F.struct("least", "side")).alias("m")).select("component", F.col("m.side").alias("ring"))
    ringed = staged(within.join(heads, "component").select("side", "next", "ring"), "ringed")
    ordered = chains.join(_to_heads(ringed, rounds), "side").join(ringed.select("side", "ring"), "side")

    def piece(place: Column, p: Column) -> Column:
        return F.struct(place.cast("long").alias("place"), p.alias("p"))

    # the head's corners behind the ring's least side come first, those up to it last
    pieces = F.when(F.col("steps") == 0, F.array(piece(F.lit(-(2**62)), F.col("behind")), piece(F.lit(0), F.col("upto")))).otherwise(F.array(piece(-F.col("steps"), F.concat("upto", "behind"))))
    put = ordered.select("ring", "label", "part", F.explode(pieces).alias("q")).groupBy("ring").agg(F.max(F.struct("label", "part")).alias("of"), F.array_sort(F.collect_list("q")).alias("l"))
    joined = put.select("of.label", "of.part", F.flatten(F.transform("l", lambda q: q["p"])).alias("p"))
    rings = tiled.where(F.col("kind") == RING).select("label", "part", points("xs", "ys").alias("p")).unionByName(joined)
    names = part_names(tiled.where(F.col("kind") == LINK).select("part", "a", "b")).withColumnRenamed("node", "part")
    named = rings.join(names, "part", "left").select("label", F.coalesce("component", "part").alias("part"), F.concat("p", F.slice("p", 1, 1)).alias("p"))
    placed = named.withColumn("a", signed_area(F.col("p")))
    whole = placed.groupBy("label", "part").agg(F.array_sort(F.collect_list(F.struct((-F.col("a")).alias("o"), "p"))).alias("l"), F.sum("a").alias("area"))
    return whole.select("label", part_cell(F.col("part")).alias("part"), F.transform("l", lambda s: s["p"]).alias("rings"), "area")
