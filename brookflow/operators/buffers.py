"""Buffers of lines, points and polygons as shapes: pieces that share their corners exactly, united by `dissolve`.

A segment gives the box of the radius on both sides of it, with the segment's ends as corners of the box's short sides;
a bend the slice of a disc between the two boxes' corners on its outer side; a round end half a disc. Neighbouring
pieces have whole sides in common, so nothing depends on where nearly equal curves meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import spatial
from brookflow.operators.dissolve import dissolve

_RINGS = "array<array<struct<x:double,y:double>>>"


def _beside(s: Column, at: str, side: int, radius: float) -> Column:
    """The box's corner at an end ("a" or "b") of a segment, to its left (1) or right (-1)."""
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
    long = F.sqrt(dx * dx + dy * dy)
    return g.point(s[f"{at}x"] - side * radius * dy / long, s[f"{at}y"] + side * radius * dx / long)


def _slice(x: Column, y: Column, begin: Column, end: Column, since: Column, turn: Column, radius: float, quarter: int) -> Column:
    """A ring: the centre, then the arc from the corner `begin` (at the angle `since`) through `turn` radians to the corner `end`, in even steps of at most a quarter / `quarter`."""
    n = F.greatest(F.ceil(F.abs(turn) / (math.pi / 2 / quarter) - 1e-9).cast("int"), F.lit(1))
    steps = F.filter(F.sequence(F.lit(1), n), lambda k: k < n)
    inner = F.transform(steps, lambda k: g.point(x + radius * F.cos(since + turn * k / n), y + radius * F.sin(since + turn * k / n)))
    return F.concat(F.array(g.point(x, y), begin), inner, F.array(end, g.point(x, y)))


def _pieces(c: Column, radius: float, cap: str, quarter: int) -> Column:
    """Rings that make up the buffer of a line."""
    segs = F.filter(g.segments(c), lambda s: (s["ax"] != s["bx"]) | (s["ay"] != s["by"]))

    def box(s: Column) -> Column:
        left, right = (lambda at: _beside(s, at, 1, radius)), (lambda at: _beside(s, at, -1, radius))
        return F.array(left("a"), g.point(s["ax"], s["ay"]), right("a"), right("b"), g.point(s["bx"], s["by"]), left("b"), left("a"))

    def angle(s: Column) -> Column:
        return F.atan2(s["by"] - s["ay"], s["bx"] - s["ax"])

    def bend(s: Column, t: Column) -> Column:
        turn = F.pmod(angle(t) - angle(s) + math.pi, F.lit(2 * math.pi)) - math.pi  # above 0 to the left, so the right side is the outer one
        right = _slice(s["bx"], s["by"], _beside(s, "b", -1, radius), _beside(t, "a", -1, radius), angle(s) - math.pi / 2, turn, radius, quarter)
        left = _slice(s["bx"], s["by"], _beside(s, "b", 1, radius), _beside(t, "a", 1, radius), angle(s) + math.pi / 2, turn, radius, quarter)
        return F.when(turn > 1e-9, right).when(turn < -1e-9, left)

    def cap_at(s: Column, at: str) -> Column:
        """Half a disc beyond an end."""
        since, begin, end = (angle(s) + math.pi / 2, 1, -1) if at == "a" else (angle(s) - math.pi / 2, -1, 1)
        return _slice(s[f"{at}x"], s[f"{at}y"], _beside(s, at, begin, radius), _beside(s, at, end, radius), since, F.lit(math.pi), radius, quarter)

    first, last = F.get(segs, F.lit(0)), F.get(segs, F.size(segs) - 1)
    n = F.size(segs)
    bends = F.zip_with(F.slice(segs, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(segs, F.lit(2), F.greatest(n - 1, F.lit(0))), bend)
    ends = F.when(g.is_closed(c), F.array(bend(last, first))).otherwise(F.array(cap_at(first, "a"), cap_at(last, "b")) if cap == "round" else F.array().cast(_RINGS))
    p = g.start_point(c)
    right = g.point(p["x"] + radius, p["y"])
    disc = F.array(F.slice(_slice(p["x"], p["y"], right, right, F.lit(0.0), F.lit(2 * math.pi), radius, quarter), 2, 4 * quarter + 1))
    nothing = F.array().cast(_RINGS)
    return F.when(n == 0, disc if cap == "round" else nothing).otherwise(F.filter(F.concat(F.transform(segs, box), bends, ends), lambda r: r.isNotNull()))


def buffer(shapes: DataFrame, radius: float, *, cap: str = "round", quarter: int = 32, precision: float = 1e-4) -> DataFrame:
    """(id, part, rings, area): the places within the radius of lines (id, coords) or polygons (id, rings), a row per part.

    Ends are round or flat (a point has only a round buffer); bends are round; an arc has `quarter` chords per quarter of a
    circle, their corners on it. Polygons keep what they hold. Null shapes have no row. Rows of one id are buffered as one, and
    equal shapes of several ids once.
    """
    if cap not in ("round", "flat") or radius <= 0:
        raise ValueError("ends are round or flat, and the radius is above 0")
    column = "rings" if "rings" in shapes.columns else "coords"
    whole = shapes.where(F.col(column).isNotNull()).groupBy("id").agg(F.array_sort(F.collect_set(column)).alias("all"))
    every = spatial._shapes(whole, "all")
    made = _buffers(spatial._each(every).select("id", F.explode("all").alias(column)), radius, cap, quarter, precision)
    return spatial._named(made.withColumnRenamed("id", "own_shape"), every, "own").select(F.col("own_id").alias("id"), "part", "rings", "area")


def _buffers(shapes: DataFrame, radius: float, cap: str, quarter: int, precision: float) -> DataFrame:
    """The same of shapes that all differ."""
    if "rings" in shapes.columns:
        known = shapes.where("rings is not null")
        around = F.flatten(F.transform("rings", lambda r: _pieces(r, radius, cap, quarter)))
        pieces = known.select(F.col("id").alias("key"), F.explode(F.concat(F.transform(around, lambda r: F.array(r)), F.array("rings"))).alias("rings"))
    else:
        pieces = shapes.where(F.size("coords") > 0).select(F.col("id").alias("key"), F.explode(_pieces(F.col("coords"), radius, cap, quarter)).alias("r")).select("key", F.array("r").alias("rings"))
    named = pieces.withColumn("id", F.xxhash64(F.to_json("rings"))).dropDuplicates(["key", "id"])
    return dissolve(named, "key", precision=precision).withColumnRenamed("key", "id")
