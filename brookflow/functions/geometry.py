"""Plane geometry as Column expressions.

A line is array<struct<x:double,y:double>>, a polygon an array of rings (the
first is the shell, the others are holes), in metres. All expressions stay in
the JVM. Null in, null out, unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def start_point(c: Column) -> Column:
    return F.get(c, F.lit(0))


def end_point(c: Column) -> Column:
    return F.get(c, F.size(c) - 1)


def is_closed(c: Column) -> Column:
    return start_point(c) == end_point(c)


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))


def segments(c: Column) -> Column:
    """array<struct<ax,ay,bx,by>> of consecutive vertices; empty for fewer than two."""
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, F.lit(2), n), lambda p, q: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by")))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def length(c: Column) -> Column:
    return _total(F.transform(segments(c), lambda s: distance(s["ax"], s["ay"], s["bx"], s["by"])))


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area of a closed ring."""
    return F.abs(_total(F.transform(segments(ring), lambda s: s["ax"] * s["by"] - s["bx"] * s["ay"]))) / 2


def area(rings: Column) -> Column:
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return ring_area(F.get(rings, F.lit(0))) - _total(F.transform(holes, ring_area))


def remove_holes(rings: Column, min_area: float) -> Column:
    """Drop holes whose area isn't above min_area."""
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return F.concat(F.slice(rings, F.lit(1), F.lit(1)), F.filter(holes, lambda r: ring_area(r) > min_area))


def remove_z(c: Column) -> Column:
    """Two-dimensional vertices of a line of x, y, z."""
    return F.transform(c, lambda p: point(p["x"], p["y"]))


def cumulative(c: Column) -> Column:
    """Distance along the line at each vertex, beginning with 0."""
    steps = F.transform(segments(c), lambda s: distance(s["ax"], s["ay"], s["bx"], s["by"]))
    return F.aggregate(steps, F.array(F.lit(0.0)), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))


def interpolate(c: Column, along: Column) -> Column:
    """The point at a distance along the line; clamped to its ends."""
    start = F.struct(F.lit(0.0).alias("left"), F.lit(None).cast("struct<x:double,y:double>").alias("p"))

    def step(acc: Column, s: Column) -> Column:
        d = distance(s["ax"], s["ay"], s["bx"], s["by"])
        t = F.when(d > 0, acc["left"] / d).otherwise(F.lit(0.0))
        here = acc["p"].isNull() & (acc["left"] <= d)
        return F.struct((acc["left"] - d).alias("left"), F.when(here, point(s["ax"] + t * (s["bx"] - s["ax"]), s["ay"] + t * (s["by"] - s["ay"]))).otherwise(acc["p"]).alias("p"))

    at = F.greatest(along, F.lit(0.0))
    begin = F.struct(at.alias("left"), start["p"].alias("p"))
    return F.coalesce(F.aggregate(segments(c), begin, step)["p"], end_point(c))


def project(c: Column, x: Column, y: Column) -> Column:
    """struct<dist, along, x, y>: the line's nearest place to a point; the first of equally near ones. One pass carries the length so far."""
    def near(s: Column) -> Column:
        dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
        norm = dx * dx + dy * dy
        t = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["ax"]) * dx + (y - s["ay"]) * dy) / norm))).otherwise(F.lit(0.0))
        return F.struct(s["ax"].alias("ax"), s["ay"].alias("ay"), dx.alias("dx"), dy.alias("dy"), F.sqrt(norm).alias("len"), t.alias("t"))

    def place(s: Column) -> Column:
        px, py = s["ax"] + s["t"] * s["dx"], s["ay"] + s["t"] * s["dy"]
        return F.struct(distance(x, y, px, py).alias("dist"), (s["t"] * s["len"]).alias("on"), s["len"].alias("len"), px.alias("x"), py.alias("y"))

    def step(acc: Column, s: Column) -> Column:
        here = F.struct(s["dist"].alias("dist"), (acc["at"] + s["on"]).alias("along"), s["x"].alias("x"), s["y"].alias("y"))
        closer = acc["best"].isNull() | (s["dist"] < acc["best"]["dist"])
        return F.struct((acc["at"] + s["len"]).alias("at"), F.when(closer, here).otherwise(acc["best"]).alias("best"))

    begin = F.struct(F.lit(0.0).alias("at"), F.lit(None).cast("struct<dist:double,along:double,x:double,y:double>").alias("best"))
    return F.aggregate(F.transform(F.transform(segments(c), near), place), begin, step)["best"]


def segment_distance(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    norm = dx * dx + dy * dy
    t = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - ax) * dx + (y - ay) * dy) / norm))).otherwise(F.lit(0.0))
    off_x, off_y = x - ax - t * dx, y - ay - t * dy  # from the start, whose coordinates may be large beside the distance
    return F.sqrt(off_x * off_x + off_y * off_y)


def shorten(c: Column, offset: float) -> Column:
    """The two-vertex line between `offset` from the start and `offset` from the end."""
    return F.array(interpolate(c, F.lit(float(offset))), interpolate(c, length(c) - offset))


def angle_compass(c: Column, side: str) -> Column:
    """Degrees from north, (-180, 180], of the first ("upstream") or last ("downstream") segment."""
    s = F.get(segments(c), F.lit(0) if side == "upstream" else F.size(c) - 2)
    return F.degrees(F.atan2(s["bx"] - s["ax"], s["by"] - s["ay"]))


def _angle_math(s: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(s["by"] - s["ay"], s["bx"] - s["ax"])), F.lit(360.0))


def angle_start(c: Column) -> Column:
    return _angle_math(F.get(segments(c), F.lit(0)))


def angle_end(c: Column) -> Column:
    return _angle_math(F.get(segments(c), F.size(c) - 2))


def angle_reverse(c: Column) -> Column:
    s = F.get(segments(c), F.lit(0))
    return F.pmod(F.degrees(F.atan2(s["ay"] - s["by"], s["ax"] - s["bx"])), F.lit(360.0))


def angle_difference(a: Column, b: Column) -> Column:
    """Smallest difference on the circle, 0 to 180."""
    d = F.abs(F.pmod(a, F.lit(360.0)) - F.pmod(b, F.lit(360.0)))
    return F.least(d, 360.0 - d)


def smallest_angle(reference: Column, angles: Column, codes: Column) -> Column:
    """struct<diff, code>: the edge whose angle is nearest to the reference; first of ties; null without a reference."""
    each = F.transform(F.arrays_zip(angles.alias("angle"), codes.alias("code")), lambda z, i: F.struct(angle_difference(z["angle"], reference).alias("diff"), i.alias("i"), z["code"].alias("code")))
    best = F.array_min(each)
    return F.when(reference.isNotNull(), F.struct(best["diff"].alias("diff"), best["code"].alias("code")))


def fictive_length(long: Column, angle: Column, factor: float = 2.0) -> Column:
    return long * (1 + (factor - 1) * F.abs(angle) / 90)


def combine(c: Column, culverts: Column) -> Column:
    """Prepend or append each culvert that touches the line's end exactly; the joint vertex is kept twice."""
    return F.aggregate(culverts, c, lambda line, v: F.when(end_point(v) == start_point(line), F.concat(v, line)).when(start_point(v) == end_point(line), F.concat(line, v)).otherwise(line))


def flip(c: Column, starts_on_end: Column, ends_on_start: Column) -> Column:
    """The line as it is if it runs from some line's end to some line's start, else reversed."""
    return F.when(starts_on_end & ends_on_start, c).otherwise(F.reverse(c))


def bounds(c: Column) -> Column:
    xs, ys = F.transform(c, lambda p: p["x"]), F.transform(c, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def centroid(c: Column) -> Column:
    """Mean of the vertices: a label point."""
    n = F.size(c)
    return point(_total(F.transform(c, lambda p: p["x"])) / n, _total(F.transform(c, lambda p: p["y"])) / n)


def _side(px: Column, py: Column, r: Column) -> Column:
    """Above 0 to the left of the segment r, below to its right, 0 on its line."""
    return (r["bx"] - r["ax"]) * (py - r["ay"]) - (r["by"] - r["ay"]) * (px - r["ax"])


def _on(px: Column, py: Column, r: Column) -> Column:
    """Whether a point lies on a segment, its ends included."""
    in_x = (px >= F.least(r["ax"], r["bx"])) & (px <= F.greatest(r["ax"], r["bx"]))
    return (_side(px, py, r) == 0) & in_x & (py >= F.least(r["ay"], r["by"])) & (py <= F.greatest(r["ay"], r["by"]))


def segments_cross(s: Column, t: Column) -> Column:
    """Whether two segments meet in the inside of both and aren't parallel."""
    return (_side(s["ax"], s["ay"], t) * _side(s["bx"], s["by"], t) < 0) & (_side(t["ax"], t["ay"], s) * _side(t["bx"], t["by"], s) < 0)


def boxes_meet(s: Column, t: Column) -> Column:
    """Whether the bounds of two segments have a point in common."""
    out = F.lit(True)
    for a, b in (("ax", "bx"), ("ay", "by")):
        out = out & (F.greatest(s[a], s[b]) >= F.least(t[a], t[b])) & (F.greatest(t[a], t[b]) >= F.least(s[a], s[b]))
    return out


def on_straight(px: Column, py: Column, r: Column) -> Column:
    """Whether a point lies on the straight line through a segment, however far from it."""
    return _side(px, py, r) == 0


def segments_overlap(s: Column, t: Column) -> Column:
    """Whether two segments share more than a point."""
    level = (_side(s["ax"], s["ay"], t) == 0) & (_side(s["bx"], s["by"], t) == 0) & ((t["ax"] != t["bx"]) | (t["ay"] != t["by"]))
    shared = F.lit(False)
    for a, b in (("ax", "bx"), ("ay", "by")):
        shared = shared | (F.greatest(F.least(s[a], s[b]), F.least(t[a], t[b])) < F.least(F.greatest(s[a], s[b]), F.greatest(t[a], t[b])))
    return level & shared


def segments_meet_inside(s: Column, t: Column, s_ends: Column, t_ends: Column) -> Column:
    """Whether two segments of two lines meet in a point that is an end of neither line; ends: array<struct<x,y>>, empty for a closed line."""
    out = segments_cross(s, t)
    for one, other in ((s, t), (t, s)):
        for a, b in (("ax", "ay"), ("bx", "by")):
            p = point(one[a], one[b])
            out = out | (_on(one[a], one[b], other) & ~F.array_contains(s_ends, p) & ~F.array_contains(t_ends, p))
    return out


def line_ends(c: Column) -> Column:
    """The boundary of a line: its two ends, or nothing if it is closed."""
    ends = F.array(start_point(c), end_point(c))
    return F.when(is_closed(c), F.slice(ends, 1, 0)).otherwise(ends)


def inside_point(rings: Column) -> Column:
    """A point inside a polygon: on the level half-way between the vertices around its middle height, the middle of the widest stretch."""
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    mid = (F.array_min(ys) + F.array_max(ys)) / 2
    level = (F.array_max(F.filter(ys, lambda v: v <= mid)) + F.array_min(F.filter(ys, lambda v: v > mid))) / 2
    crossed = F.filter(F.flatten(F.transform(rings, segments)), lambda s: (s["ay"] > level) != (s["by"] > level))
    xs = F.array_sort(F.transform(crossed, lambda s: s["ax"] + (level - s["ay"]) / (s["by"] - s["ay"]) * (s["bx"] - s["ax"])))
    stretches = F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(2)), lambda i: F.struct(
        (F.get(xs, i) - F.get(xs, i - 1)).alias("wide"), (-F.get(xs, i - 1)).alias("left"), ((F.get(xs, i) + F.get(xs, i - 1)) / 2).alias("x")))
    return point(F.array_max(stretches)["x"], level)


def _stretches(c: Column, edges: Column) -> Column:
    """array<struct<x,y,len>>: a line's stretches between two meetings with the edges (segments of rings), by their middles."""
    def cuts(s: Column) -> Column:
        def at(e: Column) -> Column:
            dx, dy, ex, ey = s["bx"] - s["ax"], s["by"] - s["ay"], e["bx"] - e["ax"], e["by"] - e["ay"]
            across, norm = dx * ey - dy * ex, dx * dx + dy * dy
            ends = F.array(*(F.when(_side(e[a], e[b], s) == 0, ((e[a] - s["ax"]) * dx + (e[b] - s["ay"]) * dy) / norm) for a, b in (("ax", "ay"), ("bx", "by"))))
            return F.when(across == 0, ends).otherwise(F.array(((e["ax"] - s["ax"]) * ey - (e["ay"] - s["ay"]) * ex) / across))

        found = F.filter(F.flatten(F.transform(edges, at)), lambda t: (t > 0) & (t < 1))
        return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), found)))

    def parts(s: Column) -> Column:
        t, long = cuts(s), distance(s["ax"], s["ay"], s["bx"], s["by"])
        each = F.zip_with(F.slice(t, 1, F.size(t) - 1), F.slice(t, F.lit(2), F.size(t) - 1), lambda a, b: F.struct(((a + b) / 2).alias("m"), (b - a).alias("share")))
        return F.transform(each, lambda e: F.struct((s["ax"] + e["m"] * (s["bx"] - s["ax"])).alias("x"), (s["ay"] + e["m"] * (s["by"] - s["ay"])).alias("y"), (e["share"] * long).alias("len")))

    long_ones = F.filter(segments(c), lambda s: (s["ax"] != s["bx"]) | (s["ay"] != s["by"]))
    return F.flatten(F.transform(long_ones, parts))


def _on_any(p: Column, edges: Column) -> Column:
    return F.exists(edges, lambda e: _on(p["x"], p["y"], e))


def crosses_polygon(c: Column, rings: Column) -> Column:
    """Whether a line has a part inside a polygon and a part outside of it: every stretch between two meetings with the rings is judged by its middle."""
    edges = F.flatten(F.transform(rings, segments))
    tested = F.filter(_stretches(c, edges), lambda p: ~_on_any(p, edges))
    return F.exists(tested, lambda p: inside(p["x"], p["y"], rings)) & F.exists(tested, lambda p: ~inside(p["x"], p["y"], rings))


def length_within(c: Column, rings: Column) -> Column:
    """Length of a line's part inside a polygon of any shape, what runs along its rings included."""
    edges = F.flatten(F.transform(rings, segments))
    held = F.filter(_stretches(c, edges), lambda p: inside(p["x"], p["y"], rings) | _on_any(p, edges))
    return _total(F.transform(held, lambda p: p["len"]))


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule by a ray to the right."""
    crossed = F.filter(segments(ring), lambda s: ((s["ay"] > y) != (s["by"] > y)) & (x < (s["bx"] - s["ax"]) * (y - s["ay"]) / (s["by"] - s["ay"]) + s["ax"]))
    return F.size(crossed) % 2 == 1


def inside(x: Column, y: Column, rings: Column) -> Column:
    return F.size(F.filter(rings, lambda r: inside_ring(x, y, r))) % 2 == 1


def clip_length(s: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Length of a segment inside an axis-parallel box (Liang-Barsky)."""
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
    lo, hi, ok = F.lit(0.0), F.lit(1.0), F.lit(True)
    for p, q in ((-dx, s["ax"] - x0), (dx, x1 - s["ax"]), (-dy, s["ay"] - y0), (dy, y1 - s["ay"])):
        r = F.when(p != 0, q / p)
        ok = ok & ~((p == 0) & (q < 0))
        lo = F.when(p < 0, F.greatest(lo, r)).otherwise(lo)
        hi = F.when(p > 0, F.least(hi, r)).otherwise(hi)
    return F.when(ok & (hi > lo), (hi - lo) * F.sqrt(dx * dx + dy * dy)).otherwise(F.lit(0.0))


def zfill(text: Column, width: int = 3) -> Column:
    """Zero-padded on the left, never cut."""
    t = text.cast("string")
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def log10_or_null(v: Column) -> Column:
    return F.when(v > 0, F.log10(v))


#: The published approximation of RD New (EPSG:28992) in WGS84 degrees, as (power of x, power of y, coefficient).
RD_ORIGIN = (155000.0, 463000.0, 52.15517440, 5.38720621)
RD_LATITUDE = ((0, 1, 3235.65389), (2, 0, -32.58297), (0, 2, -0.24750), (2, 1, -0.84978), (0, 3, -0.06550), (2, 2, -0.01709), (1, 0, -0.00738), (4, 0, 0.00530), (2, 3, -0.00039), (4, 1, 0.00033), (1, 1, -0.00012))
RD_LONGITUDE = ((1, 0, 5260.52916), (1, 1, 105.94684), (1, 2, 2.45656), (3, 0, -0.81885), (1, 3, 0.05594), (3, 1, -0.05607), (0, 1, 0.01199), (3, 2, -0.00256), (1, 4, 0.00128), (0, 2, 0.00022), (2, 0, -0.00022), (5, 0, 0.00026))


def rd_to_wgs84(x: Column, y: Column) -> Column:
    """struct<lon, lat> of planar metres; for maps only."""
    dx, dy = (x - RD_ORIGIN[0]) * 1e-5, (y - RD_ORIGIN[1]) * 1e-5

    def series(terms: tuple) -> Column:
        out = F.lit(0.0)
        for p, q, k in terms:
            term = F.lit(k)
            for _ in range(p):
                term = term * dx
            for _ in range(q):
                term = term * dy
            out = out + term
        return out / 3600

    return F.struct((F.lit(RD_ORIGIN[3]) + series(RD_LONGITUDE)).alias("lon"), (F.lit(RD_ORIGIN[2]) + series(RD_LATITUDE)).alias("lat"))
