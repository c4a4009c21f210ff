"""Union of polygons by key: an arrangement of their sides, in joins by cells and doubled pointers.

Sides are cut where those of one key meet, so that any two pieces are equal, touch at ends or are apart. A piece bounds
the union where one side of it is covered and the other isn't: polygons that have it as a side cover what lies to its left
(rings run with the polygon there), others cover both sides or none, told by the piece's middle. Bounding pieces follow
each other at their ends, rings are components of that relation, and the order along them comes from list ranking
(`outlines`); nothing is put together in one task but a finished polygon.

Coordinates are whole multiples of `precision`: points are rounded to it, and a side passes through every corner that
is nearer than that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import outlines, spatial
from brookflow.operators.components import components
from brookflow.runtime import staged

_ENDS = ("ax", "ay", "bx", "by")


def _sides(areas: DataFrame, key: str, precision: float) -> DataFrame:
    """(key, id, ring, i, ax, ay, bx, by) in units of the precision, the polygon to the left."""
    def units(v: Column) -> Column:
        return F.round(v / precision).cast("double")

    rounded = F.transform("_ring", lambda p: F.struct(units(p["x"]).alias("x"), units(p["y"]).alias("y")))
    rings = areas.select(F.col(key).alias("key"), "id", F.posexplode("rings").alias("ring", "_ring")).withColumn("_ring", rounded)
    area = outlines.signed_area(F.col("_ring"))
    run = F.when((F.col("ring") == 0) == (area > 0), F.col("_ring")).otherwise(F.reverse("_ring"))
    each = rings.where(area != 0).select("key", "id", "ring", F.posexplode(g.segments(run)).alias("i", "s")).select("key", "id", "ring", "i", "s.*")
    return each.where("ax <> bx or ay <> by")


def _cut_points(s: Column, t: Column) -> Column:
    """Points (x, y) strictly within side s at which side t crosses it or has an end on it, nearer than a unit."""
    dx, dy, ex, ey = s["bx"] - s["ax"], s["by"] - s["ay"], t["bx"] - t["ax"], t["by"] - t["ay"]
    across, norm = dx * ey - dy * ex, dx * dx + dy * dy
    share = ((t["ax"] - s["ax"]) * ey - (t["ay"] - s["ay"]) * ex) / across
    beyond = ((t["ax"] - s["ax"]) * dy - (t["ay"] - s["ay"]) * dx) / across
    crossing = F.when((across != 0) & (share > 0) & (share < 1) & (beyond > 0) & (beyond < 1), F.struct(F.round(s["ax"] + share * dx).alias("x"), F.round(s["ay"] + share * dy).alias("y")))

    def end(x: Column, y: Column) -> Column:
        along = (x - s["ax"]) * dx + (y - s["ay"]) * dy
        near = F.abs((x - s["ax"]) * dy - (y - s["ay"]) * dx) < F.sqrt(norm)
        return F.when(near & (along > 0) & (along < norm), F.struct(x.alias("x"), y.alias("y")))

    return F.filter(F.array(crossing, end(t["ax"], t["ay"]), end(t["bx"], t["by"])), lambda p: p.isNotNull())


def _pieces(sides: DataFrame) -> DataFrame:
    """(key, id, ax, ay, bx, by) of sides cut where those of their key meet them."""
    size = max(spatial._mean_extent(sides), 4.0)
    spread = spatial._spread(sides.withColumn("s", F.struct(*_ENDS)), size, 1.0)
    name = F.struct("id", "ring", "i")
    left, right = spread.select("key", "_cx", "_cy", name.alias("l"), F.col("s").alias("ls")), spread.select("key", "_cx", "_cy", name.alias("r"), F.col("s").alias("rs"))
    l, r = F.col("ls"), F.col("rs")
    met = left.join(right, ["key", "_cx", "_cy"]).where("l <> r")
    for lo, hi in (("ax", "bx"), ("ay", "by")):
        met = met.where((F.greatest(l[lo], l[hi]) + 1 >= F.least(r[lo], r[hi])) & (F.greatest(r[lo], r[hi]) + 1 >= F.least(l[lo], l[hi])))
    cuts = met.select("key", "l", F.explode(_cut_points(l, r)).alias("p")).groupBy("key", F.col("l.id").alias("id"), F.col("l.ring").alias("ring"), F.col("l.i").alias("i")).agg(F.collect_set("p").alias("cuts"))
    along = F.transform(F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")), lambda p: F.struct(((p["x"] - F.col("ax")) * (F.col("bx") - F.col("ax")) + (p["y"] - F.col("ay")) * (F.col("by") - F.col("ay"))).alias("t"), p["x"].alias("x"), p["y"].alias("y")))
    inner = F.transform(F.array_sort(along), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    line = F.concat(F.array(g.point(F.col("ax"), F.col("ay"))), inner, F.array(g.point(F.col("bx"), F.col("by"))))
    return sides.join(cuts, ["key", "id", "ring", "i"], "left").select("key", "id", F.explode(g.segments(line)).alias("s")).select("key", "id", "s.*").where("ax <> bx or ay <> by")


def _covered(pieces: DataFrame, areas: DataFrame, key: str, precision: float) -> DataFrame:
    """(key, ax, ay, bx, by) of pieces (with ids, the polygons that have them as a side) whose middle lies in another polygon of their key."""
    boxes = areas.select(F.col(key).alias("key"), F.col("id").alias("r_id"), "rings", g.bounds(F.get("rings", F.lit(0))).alias("b")).select("key", "r_id", "rings", "b.*")
    size = spatial._extent_cell(boxes)
    x, y = (F.col("ax") + F.col("bx")) / 2 * precision, (F.col("ay") + F.col("by")) / 2 * precision
    placed = pieces.select("key", *_ENDS, "ids", x.alias("x"), y.alias("y")).withColumns({"_cx": spatial._cell(F.col("x"), size), "_cy": spatial._cell(F.col("y"), size)})
    near = placed.join(spatial._boxed(boxes, size), ["key", "_cx", "_cy"]).where("x > x0 and x < x1 and y > y0 and y < y1 and not array_contains(ids, r_id)")
    return near.where(g.inside(F.col("x"), F.col("y"), F.col("rings"))).select("key", *_ENDS).distinct()


def _bounds_of(areas: DataFrame, key: str, precision: float) -> DataFrame:
    """(side, key, ax, ay, bx, by): the pieces that bound the union, the union to the left."""
    pieces = _pieces(staged(_sides(areas, key, precision), "sides"))
    turned = F.struct("bx", "by") < F.struct("ax", "ay")
    level = pieces.select("key", "id", F.when(turned, -1).otherwise(1).alias("way"), *(F.when(turned, F.col(o)).otherwise(F.col(c)).alias(c) for c, o in zip(_ENDS, ("bx", "by", "ax", "ay"))))
    own = level.groupBy("key", *_ENDS, "id").agg(F.sum("way").alias("way"))
    each = staged(own.groupBy("key", *_ENDS).agg(F.bool_or(F.col("way") > 0).alias("left"), F.bool_or(F.col("way") < 0).alias("right"), F.collect_set("id").alias("ids")), "pieces")
    one = each.where("left <> right").join(_covered(each.where("left <> right"), areas, key, precision), ["key", *_ENDS], "left_anti")
    run = [F.when(F.col("left"), F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(_ENDS, ("bx", "by", "ax", "ay"))]
    return staged(one.select(F.monotonically_increasing_id().alias("side"), "key", *run), "bounds")


def _followed(bounds: DataFrame) -> DataFrame:
    """(side, next, turns): at a piece's end the next one clockwise from where it came, which has the same part of the union to its left."""
    back = F.atan2(F.col("ay") - F.col("by"), F.col("ax") - F.col("bx"))
    ends = bounds.select("side", "key", F.col("bx").alias("x"), F.col("by").alias("y"), back.alias("back"), (F.col("bx") - F.col("ax")).alias("dx"), (F.col("by") - F.col("ay")).alias("dy"))
    ex, ey = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    starts = bounds.select(F.col("side").alias("next"), "key", F.col("ax").alias("x"), F.col("ay").alias("y"), F.atan2(ey, ex).alias("to"), ex.alias("ex"), ey.alias("ey"))
    swept = F.pmod(F.col("back") - F.col("to"), F.lit(2 * math.pi))
    at = ends.join(starts, ["key", "x", "y"]).select("side", F.struct(F.when(swept <= 0, 2 * math.pi).otherwise(swept).alias("swept"), "next", (F.col("dx") * F.col("ey") != F.col("dy") * F.col("ex")).alias("turns")).alias("f"))
    return at.groupBy("side").agg(F.min("f").alias("f")).select("side", "f.next", "f.turns")


def dissolve(areas: DataFrame, key: str, *, precision: float = 1e-4, min_hole: float = 0.0, rounds: list | None = None) -> DataFrame:
    """(key, part, rings, area): the union of the polygons of areas(id, key, rings) by key, a row per part that hangs together by more than corners.

    Outer rings run counter-clockwise and come first; corners stand only where a ring turns. Holes of min_hole and less
    are left out. part numbers a key's parts from 0 by their least corner. Polygons with null rings or without area are ignored;
    their own rings mustn't cross. Raises ValueError if rounding to the precision leaves an outline open.
    """
    areas = staged(areas.where(F.col("rings").isNotNull()).groupBy(F.col(key).alias("key"), "rings").agg(F.min("id").alias("id")), "areas")  # copies add nothing to a union
    bounds = _bounds_of(areas, "key", precision)
    follows = staged(_followed(bounds), "follows")
    total, begun, met = bounds.count(), follows.count(), follows.select("next").distinct().count()
    if not total == begun == met:
        raise ValueError("an outline stays open: the sides don't fit each other at this precision")
    ringed = staged(follows.join(components(follows, "side", "next").select(F.col("node").alias("side"), F.col("component").alias("ring")), "side"), "ringed")
    ranked = ringed.join(outlines._to_heads(ringed.select("side", "next", "ring"), rounds), "side").join(bounds, "side")
    corner = F.struct((-F.col("steps")).alias("o"), (F.col("bx") * precision).alias("x"), (F.col("by") * precision).alias("y"))
    gathered = ranked.groupBy("key", "ring").agg(F.array_sort(F.collect_list(F.when(F.col("turns"), corner))).alias("l"))
    points = F.transform("l", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    closed = gathered.select("key", "ring", points.alias("p")).select("key", "ring", F.concat("p", F.slice("p", 1, 1)).alias("p"))
    rings = staged(closed.withColumn("a", outlines.signed_area(F.col("p"))), "rings")
    shells = rings.where("a > 0").select("key", F.col("ring").alias("shell"), F.col("p").alias("outer"), F.col("a").alias("outer_area"), F.array_min(F.col("p")).alias("least"), g.bounds(F.col("p")).alias("b")).select("*", "b.*").drop("b")
    # a hole lies in the smallest outline around the middle of one of its sides
    first, second = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    size = spatial._extent_cell(shells)
    holes = rings.where((F.col("a") < 0) & (F.col("a") < -min_hole)).select("key", "ring", "p", "a", ((first["x"] + second["x"]) / 2).alias("x"), ((first["y"] + second["y"]) / 2).alias("y"))
    placed = holes.withColumns({"_cx": spatial._cell(F.col("x"), size), "_cy": spatial._cell(F.col("y"), size)})
    around = placed.join(spatial._boxed(shells, size), ["key", "_cx", "_cy"]).where("x >= x0 and x <= x1 and y >= y0 and y <= y1").where(g.inside_ring(F.col("x"), F.col("y"), F.col("outer")))
    held = around.groupBy("key", "ring").agg(F.min(F.struct("outer_area", "shell")).alias("in"), F.first("p").alias("p"), F.first("a").alias("a"))
    inner = held.groupBy("key", F.col("in.shell").alias("shell")).agg(F.array_sort(F.collect_list(F.struct(F.col("a").alias("o"), "p"))).alias("l"), F.sum("a").alias("gone"))
    whole = shells.join(inner, ["key", "shell"], "left")
    nothing = F.array().cast("array<array<struct<x:double,y:double>>>")
    rings_of = F.concat(F.array("outer"), F.coalesce(F.transform("l", lambda h: h["p"]), nothing))
    made = whole.select("key", "least", rings_of.alias("rings"), (F.col("outer_area") + F.coalesce("gone", F.lit(0.0))).alias("area"))
    return outlines.numbered_parts(made, "key", "least").withColumnRenamed("key", key)
