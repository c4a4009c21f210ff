"""Rasters as cells(r, c, v): resampling, rasterizing, distances, flow directions, basins, zones and outlines.

A grid never sits in one task: neighbours meet by equi-joins on shifted cell
indices, and labels run downstream by pointer jumping in O(log n) rounds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators.components import components
from brookflow.runtime import release, staged

#: Direction codes of the eight neighbours, as (row step, column step, code); rows run downward.
D8 = ((0, 1, 1), (1, 1, 2), (1, 0, 4), (1, -1, 8), (0, -1, 16), (-1, -1, 32), (-1, 0, 64), (-1, 1, 128))
#: Sector of sixteen for each code of eight.
D8_TO_D16 = {1: 7, 2: 9, 4: 11, 8: 13, 16: 15, 32: 1, 64: 3, 128: 5}


def resolution(xs: list[float] | tuple[float, ...], decimals: int = 2) -> float:
    return round(abs(xs[1] - xs[0]), decimals)


def d8_to_d16(cells: DataFrame, column: str = "dir") -> DataFrame:
    table = F.create_map(*(F.lit(v) for kv in D8_TO_D16.items() for v in kv))
    return cells.withColumn(column, F.try_element_at(table, F.col(column)))


def neighbours(cells: DataFrame, value: str = "v") -> DataFrame:
    """(r, c, v, dr, dc, dir, nv): each cell with each of its neighbours that exist."""
    steps = F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(code).alias("dir")) for dr, dc, code in D8)))
    around = cells.withColumn("_s", steps).select("r", "c", F.col(value).alias("v"), "_s.dr", "_s.dc", "_s.dir", (F.col("r") + F.col("_s.dr")).alias("nr"), (F.col("c") + F.col("_s.dc")).alias("nc"))
    there = cells.select(F.col("r").alias("nr"), F.col("c").alias("nc"), F.col(value).alias("nv"))
    return around.join(there, ["nr", "nc"])


#: Cells along the side of a tile: what one task holds at a time.
TILE = 256


def tile_grid(cells: pd.DataFrame, values: np.ndarray) -> tuple[list[float], np.ndarray, int]:
    """Values in a flat grid with an empty frame (NaN), each cell's place in it, and the grid's width."""
    r, c = cells["r"].to_numpy(), cells["c"].to_numpy()
    wide = int(c.max() - c.min()) + 3
    at = (r - r.min() + 1) * wide + (c - c.min() + 1)
    flat = np.full((int(r.max() - r.min()) + 3) * wide, np.nan)
    flat[at] = values
    return flat, at, wide


def by_tile(cells: DataFrame, run: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str, tile: int = TILE) -> DataFrame:
    """run(cells, own) of each tile's cells and those one step around it, which aren't its own; schema has r and c (long), which get the cells' types.

    A cell is shuffled once, or once more for each tile that it borders, not once for each neighbour.
    """
    def at(v: str, step: int) -> Column:
        return F.floor((F.col(v) + step) / tile).cast("long")

    seen = F.array_distinct(F.array(*(F.struct(at("r", i).alias("tr"), at("c", j).alias("tc")) for i in (-1, 1) for j in (-1, 1))))
    spread = cells.withColumn("_t", F.explode(seen)).withColumns({"r": F.col("r").cast("long"), "c": F.col("c").cast("long")}).select("_t.tr", "_t.tc", *cells.columns)

    def each(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = ((pdf["r"] // tile == key[0]) & (pdf["c"] // tile == key[1])).to_numpy()
        return run(pdf, own)

    out = spread.groupBy("tr", "tc").applyInPandas(each, schema)
    types = {n: cells.schema[n[-1]].dataType for n in ("r", "c", "nr", "nc") if n in out.columns}
    return out.select(*(F.col(n).cast(types[n]).alias(n) if n in types else n for n in out.columns))


def nullable(values: np.ndarray, known: np.ndarray) -> pd.api.extensions.ExtensionArray:
    """Whole numbers, null where not known."""
    return pd.arrays.IntegerArray(values.astype(np.int64), ~known)


_POINTED = "r long, c long, dir int, nr long, nc long"


def pointed(cells: pd.DataFrame, own: np.ndarray, code: np.ndarray) -> pd.DataFrame:
    """The tile's own cells with direction codes (0: none) and the cells there."""
    step = np.zeros((256, 2), np.int64)
    for dr, dc, k in D8:
        step[k] = dr, dc
    r, c, k = cells["r"].to_numpy()[own], cells["c"].to_numpy()[own], code[own]
    return pd.DataFrame({"r": r, "c": c, "dir": nullable(k, k > 0), "nr": nullable(r + step[k, 0], k > 0), "nc": nullable(c + step[k, 1], k > 0)})


def _steepest(cells: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
    v, at, wide = tile_grid(cells, cells["v"].to_numpy(float))
    best, code = np.zeros(len(at)), np.zeros(len(at), np.int64)
    for dr, dc, k in D8:
        drop = (v[at] - v[at + dr * wide + dc]) / np.sqrt(float(dr * dr + dc * dc))
        better = drop > best
        best[better], code[better] = drop[better], k
    return pointed(cells, own, code)


def flow_d8(cells: DataFrame) -> DataFrame:
    """(r, c, dir, nr, nc): the steepest way down; null in pits. Ties to the smaller code. Cells whose height is null or NaN are no way down."""
    return by_tile(cells.select("r", "c", F.col("v").cast("double").alias("v")), _steepest, _POINTED)


_DRAINED = "r long, c long, nr long, nc long, label long, n long"


def _drain(cells: pd.DataFrame, tile: int) -> pd.DataFrame:
    """A tile's cells with the label that they reach in it, or the first cell outside it on their way, and the steps to there; both null where the way ends."""
    r, c = cells["r"].to_numpy(), cells["c"].to_numpy()
    labelled, flows, nr, nc = (cells[k].to_numpy() for k in ("labelled", "flows", "nr", "nc"))
    r0, c0 = r[0] // tile * tile, c[0] // tile * tile
    place = np.full(tile * tile, -1, np.int64)
    place[(r - r0) * tile + c - c0] = np.arange(len(r))
    within = flows & ~labelled & (nr >= r0) & (nr < r0 + tile) & (nc >= c0) & (nc < c0 + tile)
    to = np.arange(len(r))
    to[within] = place[(nr[within] - r0) * tile + nc[within] - c0]
    lost = to < 0  # towards a cell that isn't there
    to[lost] = np.flatnonzero(lost)
    within &= ~lost
    n = within.astype(np.int64)
    for _ in range(2 * tile.bit_length() + 1):
        n, to = n + n[to], to[to]
    end = ~within[to]  # else a ring
    label = cells["label"].to_numpy()[to]
    known = end & labelled[to]
    leaves = end & ~labelled[to] & flows[to] & ~lost[to]
    n = n + leaves
    return pd.DataFrame({"r": r, "c": c, "nr": nullable(nr[to], leaves), "nc": nullable(nc[to], leaves), "label": nullable(label, known), "n": np.where(known | leaves, n, 0)})


def basins(flow: DataFrame, labels: DataFrame, most_steps: int | None = None, tile: int = TILE) -> DataFrame:
    """(r, c, label): the first labelled cell downstream of each cell, itself included; cells that drain to none have no row.

    flow(r, c, nr, nc), labels(r, c, label > 0). With most_steps, cells that are more steps away have none either.
    Ways are followed within tiles first; only the cells at which they enter another tile are followed from there, by doubled
    pointers, and what is settled isn't written again.
    """
    kinds = {"r": flow.schema["r"].dataType, "c": flow.schema["c"].dataType, "label": labels.schema["label"].dataType}
    flows = (F.col("nr").isNotNull() & F.col("nc").isNotNull()).alias("flows")
    joined = flow.select("r", "c", "nr", "nc").join(labels.select("r", "c", "label"), ["r", "c"], "left")
    joined = joined.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.col("label").isNotNull().alias("labelled"), flows, *(F.coalesce(F.col(k).cast("long"), F.lit(0)).alias(k) for k in ("nr", "nc", "label")))
    tiled = joined.withColumns({"tr": F.floor(F.col("r") / tile), "tc": F.floor(F.col("c") / tile)})
    drained = staged(tiled.groupBy("tr", "tc").applyInPandas(lambda t: _drain(t, tile), _DRAINED), "drained")
    leaving = drained.where("nr is not null")
    entered = leaving.select(F.col("nr").alias("r"), F.col("nc").alias("c")).distinct()
    held = staged(drained.join(entered, ["r", "c"]), "entered")
    left = held.where("nr is not null").count()
    while left:
        far = held.select(F.col("r").alias("nr"), F.col("c").alias("nc"), F.col("nr").alias("fr"), F.col("nc").alias("fc"), F.col("label").alias("fl"), F.col("n").alias("fn"))
        moved = held.where("nr is not null").join(far, ["nr", "nc"], "left").select("r", "c", F.col("fr").alias("nr"), F.col("fc").alias("nc"), F.col("fl").alias("label"), (F.col("n") + F.col("fn")).alias("n"))
        new = staged(held.where("nr is null").unionByName(moved), "entered")
        release(held)
        held, before, left = new, left, new.where("nr is not null").count()
        if left == before:  # pointers double, so all that don't go round in a ring get somewhere each round
            break
    ends = held.where("label is not null").select(F.col("r").alias("nr"), F.col("c").alias("nc"), "label", F.col("n").alias("fn"))
    there = leaving.drop("label").join(ends, ["nr", "nc"]).select("r", "c", "label", (F.col("n") + F.col("fn")).alias("n"))
    whole = drained.where("label is not null").select("r", "c", "label", "n").unionByName(there)
    within = F.lit(True) if most_steps is None else F.col("n") <= most_steps
    return whole.where(within).select(*(F.col(k).cast(v).alias(k) for k, v in kinds.items()))


def rasterize_lines(lines: DataFrame, cell: float, width: float, priority: str = "id") -> DataFrame:
    """(r, c, id): cells whose centre lies within `width` of a line (id, coords); the greatest priority wins. Cell (r, c) spans [c, c + 1) x [r, r + 1) cells."""
    from brookflow.operators.spatial import line_segments

    def span(lo, hi):
        return F.sequence(F.floor((lo - width) / cell).cast("long"), F.floor((hi + width) / cell).cast("long"))

    segs = line_segments(lines).withColumn("c", F.explode(span(F.least("ax", "bx"), F.greatest("ax", "bx")))).withColumn("r", F.explode(span(F.least("ay", "by"), F.greatest("ay", "by"))))
    d = g.segment_distance((F.col("c") + 0.5) * cell, (F.col("r") + 0.5) * cell, *(F.col(k) for k in ("ax", "ay", "bx", "by")))
    return segs.where(d <= width).groupBy("r", "c").agg(F.max("id").alias("id"))


def rasterize_polygons(polygons: DataFrame, cell: float) -> DataFrame:
    """(r, c, id): cells whose centre is inside a polygon (id, rings); the greatest id wins."""
    b = g.bounds(F.get(F.col("rings"), F.lit(0)))
    boxed = polygons.withColumn("_b", b)
    def span(lo, hi):
        return F.sequence(F.floor(lo / cell).cast("long"), F.floor(hi / cell).cast("long"))

    spread = boxed.withColumn("c", F.explode(span(F.col("_b.x0"), F.col("_b.x1")))).withColumn("r", F.explode(span(F.col("_b.y0"), F.col("_b.y1"))))
    return spread.where(g.inside((F.col("c") + 0.5) * cell, (F.col("r") + 0.5) * cell, F.col("rings"))).groupBy("r", "c").agg(F.max("id").alias("id"))


def _edt_1d(f: np.ndarray) -> np.ndarray:
    """Lower envelope of parabolas: min over q of (p - q)^2 + f[q]."""
    n = len(f)
    v, z, out, k = np.zeros(n, int), np.full(n + 1, np.inf), np.full(n, np.inf), -1
    for q in range(n):
        if not np.isfinite(f[q]):
            continue
        while k >= 0:
            s = ((f[q] + q * q) - (f[v[k]] + v[k] ** 2)) / (2 * (q - v[k]))
            if s > z[k]:
                break
            k -= 1
        k += 1
        v[k], z[k] = q, -np.inf if k == 0 else s
        z[k + 1] = np.inf
    if k < 0:
        return out
    at = 0
    for p in range(n):
        while z[at + 1] < p:
            at += 1
        out[p] = (p - v[at]) ** 2 + f[v[at]]
    return out


def distance_transform(cells: DataFrame, sampling: float = 2.0) -> DataFrame:
    """(r, c, dist) to the nearest cell with v = true, by passes over columns, then rows; null if there is none. A task holds one column or row."""
    def run(key: str, along: str, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(along)
        lo = int(pdf[along].min())
        f = np.full(int(pdf[along].max()) - lo + 1, np.inf)
        f[pdf[along].to_numpy() - lo] = pdf["f"].to_numpy()
        return pdf.assign(f=_edt_1d(f)[pdf[along].to_numpy() - lo])[["r", "c", "f"]]

    first = cells.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.when(F.col("v"), F.lit(0.0)).otherwise(F.lit(float("inf"))).alias("f"))
    columns = first.groupBy("c").applyInPandas(lambda pdf: run("c", "r", pdf), "r long, c long, f double")
    rows = columns.groupBy("r").applyInPandas(lambda pdf: run("r", "c", pdf), "r long, c long, f double")
    return rows.select("r", "c", F.when(F.col("f") < float("inf"), F.sqrt("f") * sampling).alias("dist"))


def smooth_burn(cells: DataFrame, depth: float, half: float, burn: float) -> DataFrame:
    """v lowered by depth * 0.5 ** (dist / half) (under 0.001 as none), and by `burn` more on waterways (dist = 0)."""
    low = depth * F.pow(F.lit(0.5), F.col("dist") / half)
    smooth = F.when(F.col("dist").isNull() | (low < 0.001), F.lit(0.0)).otherwise(low)
    return cells.withColumn("v", F.col("v") - smooth - F.when(F.col("dist") == 0, F.lit(burn)).otherwise(F.lit(0.0)))


def resample(cells: DataFrame, old: float, new: float) -> DataFrame:
    """Bilinear values of the new cells whose centres lie in an old cell, from the four old centres around them, weights renewed where some are missing.

    Every old cell gives its share to the new centres less than a cell away, so neither grid is laid out.
    """
    def near(at: str) -> Column:
        """New indices whose centres are less than a cell from the old centre; the weight decides at the margin."""
        return F.sequence(F.ceil((F.col(at) - 0.5) * old / new - 0.5).cast("long"), F.floor((F.col(at) + 1.5) * old / new - 0.5).cast("long"))

    def away(at: str, of: str) -> Column:
        return F.abs((F.col(at) + 0.5) * new / old - 0.5 - F.col(of))

    given = cells.select(F.col("r").alias("orow"), F.col("c").alias("ocol"), F.col("v").alias("ov")).withColumn("r", F.explode(near("orow"))).withColumn("c", F.explode(near("ocol")))
    own = (F.floor((F.col("r") + 0.5) * new / old) == F.col("orow")) & (F.floor((F.col("c") + 0.5) * new / old) == F.col("ocol"))
    y, x = (F.col("r") + 0.5) * new / old - 0.5, (F.col("c") + 0.5) * new / old - 0.5
    corner = 2 * (F.col("orow") - F.floor(y)) + F.col("ocol") - F.floor(x)
    shares = given.where((away("r", "orow") < 1) & (away("c", "ocol") < 1)).select("r", "c", "ov", ((1 - away("r", "orow")) * (1 - away("c", "ocol"))).alias("w"), corner.alias("k"), own.alias("own"))
    each = [F.max(F.when(F.col("k") == k, v)).alias(f"{n}{k}") for n, v in (("v", F.col("ov") * F.col("w")), ("w", F.col("w"))) for k in range(4)]
    out = shares.groupBy("r", "c").agg(F.bool_or("own").alias("own"), *each).where("own")

    def total(n: str) -> Column:
        """Added row by row: in any order the last digits would change from run to run."""
        return sum((F.coalesce(f"{n}{k}", F.lit(0.0)) for k in range(1, 4)), F.coalesce(f"{n}0", F.lit(0.0)))

    return out.select("r", "c", F.when(F.coalesce(*(f"v{k}" for k in range(4))).isNotNull(), total("v") / total("w")).alias("v"))


@dataclass(frozen=True)
class Grid:
    """Where cells lie: the outer corner (x0, y0) of cell (0, 0), the cell's size, and whether rows run downward (y falls)."""

    x0: float
    y0: float
    cell: float
    down: bool = False

    def centre(self, r: Column, c: Column) -> tuple[Column, Column]:
        """(x, y) of a cell's middle."""
        return self.x0 + (c + 0.5) * self.cell, self.y0 + (r + 0.5) * (-self.cell if self.down else self.cell)

    def place(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(row, column) of a point, whole numbers at the middles of cells."""
        return (y - self.y0) / (-self.cell if self.down else self.cell) - 0.5, (x - self.x0) / self.cell - 0.5


def reproject_match(cells: DataFrame, source: Grid, like: DataFrame, target: Grid, method: str = "nearest") -> DataFrame:
    """like(r, c, ...) on the target grid with v: the value of cells(r, c, v) on the source grid at each cell's middle; null where there is none.

    "nearest": of the source cell that holds the point (on a line between two, the one of the higher number). "bilinear": of the
    four middles around it, weights renewed where some are missing or null.
    """
    if method not in ("nearest", "bilinear"):
        raise ValueError(f"no method {method}")
    row, column = source.place(*target.centre(F.col("r"), F.col("c")))
    there = cells.where("v is not null").select(F.col("r").cast("long").alias("_r"), F.col("c").cast("long").alias("_c"), F.col("v").alias("_v"))
    if method == "nearest":
        placed = like.withColumns({"_r": F.floor(row + 0.5).cast("long"), "_c": F.floor(column + 0.5).cast("long")})
        return placed.join(there, ["_r", "_c"], "left").select(*like.columns, F.col("_v").alias("v"))
    r0, c0 = F.floor(row), F.floor(column)
    corner = F.explode(F.array(*(F.struct((r0 + i).cast("long").alias("_r"), (c0 + j).cast("long").alias("_c"), ((1 - F.abs(row - r0 - i)) * (1 - F.abs(column - c0 - j))).alias("_w")) for i in (0, 1) for j in (0, 1))))
    around = like.select("r", "c").distinct().withColumn("_k", corner).select("r", "c", "_k.*").where("_w > 0").join(there, ["_r", "_c"])
    value = around.groupBy("r", "c").agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias("v"))
    return like.join(value, ["r", "c"], "left").select(*like.columns, "v")


def polygonize(cells: DataFrame, cell: float = 2.0) -> DataFrame:
    """(label, n_cells, area, n_parts, sides): per label its area, its parts (cells joined by sides) and outline sides.

    An outline side is a cell side whose other cell has another label. Parts are components of equal cells.
    """
    four = neighbours(cells.select("r", "c", "label"), "label").where("abs(dr) + abs(dc) = 1")
    same = four.where("v = nv").groupBy("r", "c").agg(F.count(F.lit(1)).alias("same"))
    sized = cells.join(same, ["r", "c"], "left").groupBy("label").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(4 - F.coalesce("same", F.lit(0))).alias("sides"))
    return sized.join(parts(cells).groupBy("label").agg(F.countDistinct("part").alias("n_parts")), "label").withColumn("area", F.col("n_cells") * cell * cell)


def joined_cells(cells: pd.DataFrame, own: np.ndarray) -> tuple[pd.DataFrame, np.ndarray, dict[int, np.ndarray], np.ndarray, np.ndarray, pd.DataFrame]:
    """A tile by row and column: (cells, own, same, place, part, links).

    same: by direction code, whether the cell there has its label; place: by direction code, that cell's position, -1 where there
    is none, 0 for the cell itself; part: the name of the least of the tile's own cells that it is joined to by sides; links: (part, a, b)
    of own cells a, with their parts, and cells b of other tiles that they are joined to.
    """
    order = np.lexsort((cells["c"].to_numpy(), cells["r"].to_numpy()))
    cells, own = cells.iloc[order], own[order]
    r, c = cells["r"].to_numpy(), cells["c"].to_numpy()
    codes = pd.factorize(cells["label"])[0].astype(float)
    codes[codes < 0] = np.nan
    v, at, wide = tile_grid(cells, codes)
    there = np.full(len(v), -1, np.int64)
    there[at] = np.arange(len(at))
    place = {k: there[at + dr * wide + dc] for dr, dc, k in ((0, 0, 0), *D8)}
    same = {k: v[at] == v[at + dr * wide + dc] for dr, dc, k in D8}
    name = (r << 32) + c
    inside = [np.flatnonzero(own & same[k] & own[place[k]]) for k in (1, 4)]
    a, b = np.concatenate(inside), np.concatenate([place[k][i] for k, i in zip((1, 4), inside)])
    least = place[0].copy()
    while True:
        x, y = least[a], least[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(least, further := least[least]):
            least = further
    part = name[least[place[0]]]
    out = [(i, place[k][i]) for k in (1, 4, 16, 64) for i in [np.flatnonzero(own & same[k] & ~own[place[k]])]]
    i, j = (np.concatenate(x) for x in zip(*out))
    return cells, own, same, place, part, pd.DataFrame({"part": part[i], "a": name[i], "b": name[j]})


def part_names(links: DataFrame) -> DataFrame:
    """(node, component): tiles' parts that continue in other tiles, and the whole part's name; links(part, a, b) as joined_cells has them."""
    there = links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("part").alias("other"))
    return components(links.join(there, ["a", "b"]).select("part", "other").distinct(), "part", "other")


def part_cell(part: Column) -> Column:
    """The struct (r, c) of a part's name."""
    return F.struct(F.shiftright(part, 32).alias("r"), (part - F.shiftleft(F.shiftright(part, 32), 32)).alias("c"))


def parts(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """(r, c, label, part): components of side-joined cells of one label, named by their least cell (r, c).

    Cells are joined within tiles; only the parts that continue in other tiles are joined by rounds.
    """
    def run(pdf: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        held, own, _, _, part, links = joined_cells(pdf, own)
        mine = held[["r", "c", "label"]].assign(part=part, a=0, b=0, link=False)[own]
        first = held[["r", "c", "label"]].iloc[np.zeros(len(links), int)].reset_index(drop=True)
        return pd.concat([mine, first.assign(part=links["part"], a=links["a"], b=links["b"], link=True)])

    known = cells.select("r", "c", "label")
    tiled = staged(by_tile(known, run, f"r long, c long, label {known.schema['label'].dataType.simpleString()}, part long, a long, b long, link boolean", tile), "parts")
    named = tiled.where("not link").join(part_names(tiled.where("link").select("part", "a", "b")).withColumnRenamed("node", "part"), "part", "left")
    return named.select("r", "c", "label", part_cell(F.coalesce("component", "part")).alias("part"))


def relabel(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Cells (r, c, label) dissolved by mapping(label, target): the areas of one target become one."""
    return cells.join(mapping, "label").select("r", "c", F.col("target").alias("label"))


def levels(units: DataFrame, edges: DataFrame) -> DataFrame:
    """units(label, area) of edges(label, code, downstream_edges, order_code, downstream_order_code) with their keys of levels 1 to 4: unit, downstream edge, order code, its first six characters. Units without an order code go."""
    code = F.coalesce("order_code", "downstream_order_code")
    out = units.join(edges, "label").withColumn("order_code", code).where(~F.col("order_code").eqNullSafe(F.lit("")))
    return out.select("label", "area", F.col("code").alias("level_1"), F.coalesce("downstream_edges", "code").alias("level_2"), F.col("order_code").alias("level_3"), F.substring("order_code", 1, 6).alias("level_4"))


#: The weights of the eight neighbours (row step, column step) in a cell's flow to the right and upward.
FLOW_WEIGHTS = tuple((dr, dc, -dc / (dr * dr + dc * dc) ** 0.5, dr / (dr * dr + dc * dc) ** 0.5) for dr, dc, _ in D8)


def sector_steps(sectors: int) -> list[tuple[int, int, int]]:
    """(sector, row step, column step): sectors go clockwise from the upper left; sixteen reach cells two away, eight their neighbours."""
    reach = sectors // 8
    ring = [(-reach, c) for c in range(-reach, reach)] + [(r, reach) for r in range(-reach, reach)] + [(reach, c) for c in range(reach, -reach, -1)] + [(r, -reach) for r in range(reach, -reach, -1)]
    return [(i + 1, r, c) for i, (r, c) in enumerate(ring)]


def flow_sectors(cells: DataFrame, sectors: int = 16, least: float = -10.0) -> DataFrame:
    """(r, c, angle, sector): the compass direction (degrees clockwise from up) in which the eight neighbours fall off, and its sector.

    Each neighbour pushes away from itself by its height, in both axes' shares. Sector 1 is centred on the upper left and spans
    360 / sectors degrees. Null where a neighbour is missing or lower than `least` (no data).
    """
    def run(pdf: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        v, at, wide = tile_grid(pdf, pdf["v"].to_numpy(float))
        x, y, n = np.zeros(len(at)), np.zeros(len(at)), np.zeros(len(at), np.int64)
        for dr, dc, wx, wy in FLOW_WEIGHTS:
            nv = v[at + dr * wide + dc]
            known = nv >= least
            x, y, n = x + np.where(known, nv * wx, 0.0), y + np.where(known, nv * wy, 0.0), n + known
        return pd.DataFrame({"r": pdf["r"], "c": pdf["c"], "x": x, "y": y, "n": n})[own]

    sums = by_tile(cells.select("r", "c", F.col("v").cast("double").alias("v")), run, "r long, c long, x double, y double, n long")
    angle = F.pmod(F.degrees(F.atan2("x", "y")), F.lit(360.0))
    wide = 360.0 / sectors
    sector = F.pmod(F.floor((F.col("angle") + 45.0 + wide / 2) / wide), F.lit(sectors)).cast("int") + 1
    return sums.select("r", "c", F.when(F.col("n") == 8, angle).alias("angle")).withColumn("sector", sector)


def flow_d16(cells: DataFrame, fills: DataFrame | None = None) -> DataFrame:
    """(r, c, sector, nr, nc): the cell two steps away in the cell's sector of sixteen, or in the sector of fills (r, c, sector) where there is one."""
    held = flow_sectors(cells).select("r", "c", "sector")
    if fills is not None:
        held = held.join(fills.select("r", "c", F.col("sector").alias("_fill")), ["r", "c"], "left").withColumn("sector", F.coalesce("_fill", "sector")).drop("_fill")
    steps = F.create_map(*(F.lit(v) for i, r, c in sector_steps(16) for v in (i, F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")))))
    step = F.try_element_at(steps, F.col("sector"))
    return held.select("r", "c", "sector", (F.col("r") + step["r"]).alias("nr"), (F.col("c") + step["c"]).alias("nc"))


def propagate_d16(cells: DataFrame, labels: DataFrame, fills: DataFrame | None = None, d8_steps: int = 2, most_steps: int | None = None) -> DataFrame:
    """(r, c, label): labels go d8_steps cells up along the steepest ways, then all the way (or most_steps) up the sixteen directions."""
    down, held = staged(flow_d8(cells).select("r", "c", "nr", "nc"), "down"), labels.select("r", "c", "label")
    for _ in range(d8_steps):
        below = held.select(F.col("r").alias("nr"), F.col("c").alias("nc"), F.col("label").alias("_below"))
        reached = down.join(below, ["nr", "nc"]).select("r", "c", F.col("_below").alias("label")).join(held.select("r", "c"), ["r", "c"], "left_anti")
        held = staged(held.unionByName(reached), "labels")
    return basins(flow_d16(cells, fills).select("r", "c", "nr", "nc"), held, most_steps)


def run_flow(dem: DataFrame, waterways: DataFrame, iterations: int | None = 2000, method: str = "d8", fills: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(cells (r, c, label), flow): labels (r, c, label > 0) of waterways spread over the terrain (r, c, v), against its flow.

    "d8": at most `iterations` cells up the steepest ways; flow is (r, c, dir, nr, nc). "d16": two cells up those, then at most
    `iterations` steps of two cells up the sixteen directions of the filled terrain, or of fills (r, c, sector) where there are
    any; flow is (r, c, sector, nr, nc). iterations=None: all the way.
    """
    from brookflow.operators.flood import fill_depressions

    if method not in ("d8", "d16"):
        raise ValueError(f"no flow method {method}")
    wet = waterways.where("label > 0").select("r", "c", "label")
    down = staged(flow_d8(dem), "flow")
    near = basins(down, wet, iterations if method == "d8" else 2)
    if method == "d8":
        return near, down
    held = staged(flow_d16(staged(fill_depressions(dem), "filled"), fills), "flow")
    return basins(held.select("r", "c", "nr", "nc"), staged(near, "labels"), iterations), held
