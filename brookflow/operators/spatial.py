"""Spatial joins by grid cells: an equi-join on the cell, then the exact test.

A bare distance predicate would be planned as a nested loop over all pairs. Here
one side is placed in its cell and the other in the cells around it. Skewed cells
are equi-join keys, so Spark's skew join splits them.

Joins are by shuffle: Spark's estimate of a side doesn't count the rows that an
explode adds, so it would send such a side through the driver. Rows that lie on
top of each other are judged once, as one place or shape, and named again at the
end. An id names one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.runtime import staged


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join by shuffle."""
    return left.hint("merge").join(right, on, how)


def _named(pairs: DataFrame, shapes: DataFrame, side: str) -> DataFrame:
    """pairs(<side>_shape, ...) for every id that has the shape, as <side>_id.

    Few pairs may give many rows, so the number of partitions is fixed: Spark would put them together by what goes in.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = shapes.select(F.col("shape").alias(f"{side}_shape"), F.col("id").alias(f"{side}_id"))
    return _joined(pairs.repartition(n, f"{side}_shape"), ids.repartition(n, f"{side}_shape"), [f"{side}_shape"]).drop(f"{side}_shape")


def _shapes(df: DataFrame, *columns: str) -> DataFrame:
    """(id, shape, columns): shape is the least id with the same values in the columns."""
    return staged(df.select("id", *columns, F.min("id").over(W.partitionBy(*columns)).alias("shape")), "shapes")


def _each(shapes: DataFrame) -> DataFrame:
    """One row (id, columns) of each shape."""
    return shapes.where("id = shape").drop("shape")


#: Pairs of one cell that a task tests, about: cells with more are split, and partitions are as many as all pairs ask for.
PAIRS = 20_000_000


def _split_cells(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, int, list[str]]:
    """(left, right, partitions, keys) to join rows of the same cell (_cx, _cy): a cell of too many pairs has its left rows dealt out and its right ones repeated."""
    cell = ["_cx", "_cy"]
    counts = _joined(left.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("l")), right.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("r")), cell)
    pieces = counts.select(*cell, F.least(F.ceil(F.col("l") * F.col("r") / PAIRS), F.col("l")).cast("int").alias("_k"), (F.col("l") * F.col("r")).alias("n"))
    total, most = pieces.agg(F.sum("n"), F.max("_k")).first()
    n = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), int((total or 0) // PAIRS) + 1)
    if (most or 0) <= 1:
        return left, right, n, cell
    large = staged(pieces.where("_k > 1").select(*cell, "_k"), "large-cells")
    dealt = _joined(left, large, cell, "left").withColumn("_b", F.coalesce(F.pmod(F.xxhash64(*(c for c in ("l_id", "l_x", "l_y") if c in left.columns)), "_k"), F.lit(0)).cast("int"))
    repeated = _joined(right, large, cell, "left").withColumn("_b", F.explode(F.sequence(F.lit(0), F.coalesce("_k", F.lit(1)) - 1)))
    return dealt.drop("_k"), repeated.drop("_k"), n, [*cell, "_b"]


def radius_pairs(left: DataFrame, right: DataFrame, radius: float, how: str = "inner") -> DataFrame:
    """left(id, x, y, ...) and right(id, x, y, ...) within the radius, the bound included: columns l_*, r_* and dist."""
    a = left.select(*(F.col(c).alias(f"l_{c}") for c in left.columns))
    b = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    near = [F.lit(-1), F.lit(0), F.lit(1)]
    spread = a.withColumn("_cx", F.explode(F.array(*(_cell(F.col("l_x"), radius) + d for d in near)))).withColumn("_cy", F.explode(F.array(*(_cell(F.col("l_y"), radius) + d for d in near))))
    placed = b.withColumn("_cx", _cell(F.col("r_x"), radius)).withColumn("_cy", _cell(F.col("r_y"), radius))
    dist = g.distance(F.col("l_x"), F.col("l_y"), F.col("r_x"), F.col("r_y"))
    one, other, n, keys = _split_cells(spread, placed)
    pairs = _joined(one.repartition(n, *keys), other.repartition(n, *keys), keys).withColumn("dist", dist).where(F.col("dist") <= radius).drop(*keys)
    if how == "inner":
        return pairs
    return _joined(a, pairs.drop(*(c for c in a.columns if c != "l_id")), ["l_id"], "left")


def within_semi(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Rows of left with some row of right within the radius."""
    hit = radius_pairs(left.select("x", "y").distinct(), right.select("x", "y").distinct(), radius).select(F.col("l_x").alias("x"), F.col("l_y").alias("y")).distinct()
    return _joined(left, hit, ["x", "y"], "left_semi")


def nearest(left: DataFrame, right: DataFrame, radius: float | None = None, ties: bool = False) -> DataFrame:
    """(l_id, r_id, dist) of the nearest right point; ties to the smaller id, or all with ties=True.

    Without a radius, rings of cells of doubling size are searched for the points that are left, until all have one.
    """
    every, there = _shapes(left, "x", "y"), _shapes(right, "x", "y")
    a, b = _each(every), _each(there)

    def best(points: DataFrame, r: float) -> DataFrame:
        pairs = radius_pairs(points, b, r).select("l_id", "r_id", "dist")
        if ties:
            return pairs.withColumn("_n", F.rank().over(W.partitionBy("l_id").orderBy("dist"))).where("_n = 1").drop("_n")
        return pairs.groupBy("l_id").agg(F.min(F.struct("dist", "r_id")).alias("m")).select("l_id", "m.r_id", "m.dist")

    def all_of(found: DataFrame) -> DataFrame:
        out = found.withColumnRenamed("l_id", "l_shape")
        if ties:
            out = _named(out.withColumnRenamed("r_id", "r_shape"), there, "r")
        return _named(out, every, "l").select("l_id", "r_id", "dist")

    if radius is not None:
        return all_of(best(a, radius))
    box = b.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))).first()
    reach = a.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if not box[4] or reach[0] is None:
        return all_of(best(a, 1.0))
    spanx, spany = max(box[1], reach[1]) - min(box[0], reach[0]), max(box[3], reach[3]) - min(box[2], reach[2])
    whole = max((spanx**2 + spany**2) ** 0.5, 1e-9)
    r = max(whole / max(box[4] ** 0.5, 1.0), 1e-9)
    found, rest = None, a
    while True:
        here = staged(best(rest, min(r, whole * 1.01)), "nearest")
        found = here if found is None else found.unionByName(here)
        rest = staged(_joined(rest, here.select(F.col("l_id").alias("id")), ["id"], "left_anti"), "rest")
        if r >= whole or rest.isEmpty():
            return all_of(found)
        r *= 8


def line_segments(lines: DataFrame) -> DataFrame:
    """(id, i, ax, ay, bx, by) of lines(id, coords)."""
    return lines.select("id", F.posexplode(g.segments(F.col("coords"))).alias("i", "s")).select("id", "i", "s.ax", "s.ay", "s.bx", "s.by")


#: Cells that a mean segment may span: finer ones would cost more rows than they save tests.
SPAN = 48


def _reach(ax: Column, bx: Column) -> Column:
    return F.greatest(F.abs(bx - ax), F.lit(0.0))


def _mean_extent(segs: DataFrame) -> float:
    """The mean of the larger side of the segments' boxes."""
    return segs.agg(F.avg(F.greatest(_reach(F.col("ax"), F.col("bx")), _reach(F.col("ay"), F.col("by"))))).first()[0] or 0.0


def _point_cell(points: DataFrame, lines: DataFrame, radius: float) -> float:
    """Cells with about four points each, not smaller than twice the radius and not so small that a mean segment spans more than SPAN of them."""
    box = points.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y"), F.count(F.lit(1))).first()
    dense = 2 * ((box[0] or 0.0) * (box[1] or 0.0) / box[2]) ** 0.5 if box[2] else 0.0
    mean = _mean_extent(line_segments(lines))
    return max(2 * radius, min(dense, mean) if dense else mean, mean / SPAN, 1e-6)


def _rows_of(column: Column, s: Column, size: float, margin: float) -> Column:
    """The struct (lo, hi) of the cells that a segment (ax, ay, bx, by), widened by the margin, has in a column of cells."""
    m = margin + size * 1e-9
    dx = s["bx"] - s["ax"]

    def at(x: Column) -> Column:
        share = F.when(dx == 0, F.lit(0.0)).otherwise(F.least(F.greatest((x - s["ax"]) / dx, F.lit(0.0)), F.lit(1.0)))
        return s["ay"] + share * (s["by"] - s["ay"])

    y0 = F.when(dx == 0, s["ay"]).otherwise(at(column * size - m))
    y1 = F.when(dx == 0, s["by"]).otherwise(at((column + 1) * size + m))
    return F.struct(_cell(F.least(y0, y1) - m, size).alias("lo"), _cell(F.greatest(y0, y1) + m, size).alias("hi"))


def _columns_of(s: Column, size: float, margin: float) -> tuple[Column, Column]:
    m = margin + size * 1e-9
    return _cell(F.least(s["ax"], s["bx"]) - m, size), _cell(F.greatest(s["ax"], s["bx"]) + m, size)


def _spread(segs: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """Each segment in the cells that it passes, widened by the margin: column by column of cells, so that a long one has as many as it is long."""
    own = F.struct("ax", "ay", "bx", "by")
    out = segs.withColumn("_cx", F.explode(F.sequence(*_columns_of(own, size, margin))))
    rows = out.withColumn("_rows", _rows_of(F.col("_cx"), own, size, margin))
    return rows.withColumn("_cy", F.explode(F.sequence(F.col("_rows.lo"), F.col("_rows.hi")))).drop("_rows")


def crossing_pairs(left: DataFrame, right: DataFrame, cell: float | None = None) -> DataFrame:
    """Distinct (l_id, r_id) of lines(id, coords) that cross: their insides meet, vertices between the ends included, and in points alone.

    Lines that only touch at an end of one of them don't cross, nor do lines that share a stretch. Cells are about as large as
    the shorter lines' segments, so two segments share few of them; to find the first of those takes longer than to test
    them again in the others.
    """
    one, other = _shapes(left, "coords"), _shapes(right, "coords")
    return _named(_named(_crossing_shapes(_each(one), _each(other), cell), other, "r"), one, "l").select("l_id", "r_id")


def _crossing_shapes(left: DataFrame, right: DataFrame, cell: float | None) -> DataFrame:
    """(l_shape, r_shape): crossing_pairs of lines that all differ."""
    sides = (_mean_extent(line_segments(left)), _mean_extent(line_segments(right)))
    size = max(min(*sides, cell or sides[0]), max(sides) / SPAN, 1e-6)

    def named(df: DataFrame, p: str) -> DataFrame:
        ends = df.select("id", g.line_ends(F.col("coords")).alias("ends"), F.posexplode(g.segments(F.col("coords"))).alias("i", "s")).select("id", "ends", "i", "s.*")
        return _spread(ends, size).select(F.col("id").alias(f"{p}_shape"), F.struct("ax", "ay", "bx", "by").alias(f"{p}_s"), F.col("ends").alias(f"{p}_ends"), "_cx", "_cy")

    s, t = F.col("l_s"), F.col("r_s")

    def apart(lo: str, hi: str) -> Column:
        return (F.greatest(s[lo], s[hi]) < F.least(t[lo], t[hi])) | (F.greatest(t[lo], t[hi]) < F.least(s[lo], s[hi]))

    pairs = _joined(named(left, "l"), named(right, "r"), ["_cx", "_cy"]).where(~apart("ax", "bx") & ~apart("ay", "by"))
    met, shared = g.segments_meet_inside(s, t, F.col("l_ends"), F.col("r_ends")), g.segments_overlap(s, t)
    judged = pairs.select("l_shape", "r_shape", met.alias("met"), shared.alias("shared")).where("met or shared")
    return judged.groupBy("l_shape", "r_shape").agg(F.bool_or("met").alias("met"), F.bool_or("shared").alias("shared")).where("met and not shared").select("l_shape", "r_shape")


def barrier_crossings(culverts: DataFrame, barriers: DataFrame, cell: float | None = None) -> DataFrame:
    """(id, kind): the kinds of barriers(kind, code, coords) that culverts(id, coords, code, dangling_code) cross, their own two lines exempt; all kinds in one join."""
    named = barriers.select(F.struct("kind", "code").alias("id"), "coords")
    own = culverts.select(F.col("id").alias("l_id"), F.col("code").alias("_a"), F.col("dangling_code").alias("_b"))
    hits = crossing_pairs(culverts.select("id", "coords"), named, cell).join(own, "l_id")
    return hits.where((F.col("r_id.code") != F.col("_a")) & (F.col("r_id.code") != F.col("_b"))).select(F.col("l_id").alias("id"), F.col("r_id.kind").alias("kind")).distinct()


def first_crossing(culverts: DataFrame, barrier: DataFrame, cell: float | None = None, exempt: bool = True) -> DataFrame:
    """culverts(id, coords, code, dangling_code) with crossing_code: the least code of a crossed barrier(id, coords, code).

    With exempt, a culvert's own two lines don't count as crossed: as these are two at most, the three least codes
    of a shape, and of what a shape crosses, are enough.
    """
    one, other = _shapes(culverts, "coords"), _shapes(barrier, "coords", "code")
    walls = _shapes(_each(other), "coords")

    def least(df: DataFrame, shape: str) -> DataFrame:
        return df.distinct().withColumn("_n", F.row_number().over(W.partitionBy(shape).orderBy("barrier_code"))).where("_n <= 3").drop("_n")

    coded = _joined(walls.select(F.col("shape").alias("r_shape"), "id"), barrier.where("code is not null").select("id", F.col("code").alias("barrier_code")), ["id"])
    crossed = _joined(_crossing_shapes(_each(one), _each(walls), cell), least(coded.select("r_shape", "barrier_code"), "r_shape"), ["r_shape"])
    codes = least(crossed.select("l_shape", "barrier_code"), "l_shape")
    named = _joined(one.select("id", F.col("shape").alias("l_shape")), codes, ["l_shape"])
    if exempt:
        named = _joined(named, culverts.select("id", "code", "dangling_code"), ["id"]).where((F.col("barrier_code") != F.col("code")) & (F.col("barrier_code") != F.col("dangling_code")))
    first = named.groupBy("id").agg(F.min("barrier_code").alias("crossing_code"))
    return _joined(culverts, first, ["id"], "left")


def _extent_cell(*boxes: DataFrame) -> float:
    """A cell about as large as a mean box (x0, y0, x1, y1) of the frames."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    means = [b.agg(F.avg(side)).first()[0] or 0.0 for b in boxes]
    return max(*means, 1e-6)


def _boxed(df: DataFrame, size: float) -> DataFrame:
    """Each row in all cells of its box (x0, y0, x1, y1)."""
    out = df.withColumn("_cx", F.explode(F.sequence(_cell(F.col("x0"), size), _cell(F.col("x1"), size))))
    return out.withColumn("_cy", F.explode(F.sequence(_cell(F.col("y0"), size), _cell(F.col("y1"), size))))


def _box_pairs(lines: DataFrame, polygons: DataFrame) -> DataFrame:
    """(l_id, coords, r_id, rings), once each: lines(id, coords) and polygons(id, rings) whose bounds meet."""
    boxes = polygons.select(F.col("id").alias("r_id"), "rings", g.bounds(F.get(F.col("rings"), F.lit(0))).alias("b")).select("r_id", "rings", "b.*")
    lined = lines.select(F.col("id").alias("l_id"), "coords", g.bounds(F.col("coords")).alias("b")).select("l_id", "coords", "b.*")
    size = _extent_cell(boxes, lined)
    mine = _boxed(lined, size).select("l_id", "coords", F.struct("x0", "y0", "x1", "y1").alias("lb"), "_cx", "_cy")
    pairs = _joined(mine, _boxed(boxes, size), ["_cx", "_cy"])
    near = (F.col("lb.x0") <= F.col("x1")) & (F.col("lb.x1") >= F.col("x0")) & (F.col("lb.y0") <= F.col("y1")) & (F.col("lb.y1") >= F.col("y0"))
    first = (_cell(F.greatest(F.col("lb.x0"), F.col("x0")), size) == F.col("_cx")) & (_cell(F.greatest(F.col("lb.y0"), F.col("y0")), size) == F.col("_cy"))
    return pairs.where(near & first).select("l_id", "coords", "r_id", "rings")


def polygon_crossings(lines: DataFrame, polygons: DataFrame) -> DataFrame:
    """(l_id, r_id) of lines(id, coords) that lie partly inside and partly outside of polygons(id, rings)."""
    one, other = _shapes(lines, "coords"), _shapes(polygons, "rings")
    crossed = _box_pairs(_each(one), _each(other)).where(g.crosses_polygon(F.col("coords"), F.col("rings"))).select(F.col("l_id").alias("l_shape"), F.col("r_id").alias("r_shape"))
    return _named(_named(crossed, other, "r"), one, "l").select("l_id", "r_id")


def _near_segments(points: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """(l_shape, x, y, ..., r_shape, i, dist, ax, ay, bx, by): points(id, x, y, ...) within the radius of segments of lines(id, coords)."""
    size = _point_cell(points, lines, radius)
    spread = _spread(line_segments(lines), size, radius).withColumnRenamed("id", "r_shape")
    placed = points.withColumnRenamed("id", "l_shape").withColumns({"_cx": _cell(F.col("x"), size), "_cy": _cell(F.col("y"), size)})
    d = g.segment_distance(*(F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")))
    return _joined(placed, spread, ["_cx", "_cy"]).withColumn("dist", d).where(F.col("dist") <= radius).drop("_cx", "_cy")


#: Lines that a first circle around a point holds on the average.
FIRST_LINES = 8


def nearest_other_line(points: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """(l_id, r_id, dist): for points(id, code, x, y) the nearest of lines(id, coords) within the radius whose id isn't the point's code; ties to the smaller id.

    Circles of growing size are searched for the points that are left, so pairs don't grow with the square of the network. Of
    lines on top of each other the two least ids are enough, as one of them isn't the point's own.
    """
    every = _shapes(lines, "coords")
    each = _each(every)
    twins = every.where("id <> shape").groupBy(F.col("shape").alias("r_shape")).agg(F.min("id").alias("_second"))
    corner = F.explode("coords").alias("p")
    w, h = each.select(corner).agg(F.max("p.x") - F.min("p.x"), F.max("p.y") - F.min("p.y")).first()
    long = each.agg(F.sum(g.length(F.col("coords")))).first()[0]
    r = min(max(FIRST_LINES * w * h / (2 * long), radius / 1024), radius) if long and w * h > 0 else radius
    rest, found = points.select("id", "code", "x", "y"), None
    while True:
        close = _joined(_near_segments(rest, each, r), twins, ["r_shape"], "left").withColumn("r_id", F.when(F.col("r_shape") == F.col("code"), F.col("_second")).otherwise(F.col("r_shape")))
        best = close.where("r_id is not null").groupBy(F.col("l_shape").alias("l_id")).agg(F.min(F.struct("dist", "r_id")).alias("b"))
        here = staged(best.select("l_id", "b.r_id", "b.dist"), "nearest-lines")
        found = here if found is None else found.unionByName(here)
        if r >= radius:
            return found
        rest = staged(_joined(rest, here.select(F.col("l_id").alias("id")), ["id"], "left_anti"), "rest")
        if rest.isEmpty():
            return found
        r = min(r * 8, radius)


def points_on_lines(points: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """(l_id, r_id, dist): points(id, x, y) within the radius of lines(id, coords), least distance per pair."""
    one, other = _shapes(points, "x", "y"), _shapes(lines, "coords")
    near = _near_segments(_each(one), _each(other), radius).groupBy("l_shape", "r_shape").agg(F.min("dist").alias("dist"))
    return _named(_named(near, other, "r"), one, "l").select("l_id", "r_id", "dist")


def nearest_segments(points: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """(l_id, r_id, i, dist): the nearest segments of each point within the radius, all of equally near ones."""
    one, other = _shapes(points, "x", "y"), _shapes(lines, "coords")
    near = _near_segments(_each(one), _each(other), radius)
    best = near.withColumn("_n", F.rank().over(W.partitionBy("l_shape").orderBy("dist"))).where("_n = 1").drop("_n")
    return _named(_named(best, other, "r"), one, "l").select("l_id", "r_id", "i", "dist")


def overlaps(areas: DataFrame, lines: DataFrame) -> DataFrame:
    """(area_id, line_id, overlap) of areas(id, rings) or boxes(id, x0, y0, x1, y1) and lines(id, coords): lengths inside, above 0."""
    one, other = _shapes(areas, *(c for c in areas.columns if c != "id")), _shapes(lines, "coords")
    found = _overlaps(_each(one), _each(other)).select(F.col("area_id").alias("area_shape"), F.col("line_id").alias("line_shape"), "overlap")
    return _named(_named(found, other, "line"), one, "area").select("area_id", "line_id", "overlap")


def _overlaps(areas: DataFrame, lines: DataFrame) -> DataFrame:
    """The same of areas and lines that all differ."""
    if "rings" in areas.columns:
        inside = g.length_within(F.col("coords"), F.col("rings"))
        return _box_pairs(lines, areas).select(F.col("r_id").alias("area_id"), F.col("l_id").alias("line_id"), inside.alias("overlap")).where("overlap > 0")
    size = max(_extent_cell(areas), _mean_extent(line_segments(lines)) / 2, 1e-6)
    spread = _spread(line_segments(lines), size).withColumnRenamed("id", "line_id")
    one = _joined(spread, _boxed(areas, size).withColumnRenamed("id", "area_id"), ["_cx", "_cy"]).dropDuplicates(["area_id", "line_id", "i"])
    inside = g.clip_length(F.struct("ax", "ay", "bx", "by"), *(F.col(c) for c in ("x0", "y0", "x1", "y1")))
    return one.groupBy("area_id", "line_id").agg(F.sum(inside).alias("overlap")).where("overlap > 0")


def longest_overlap(areas: DataFrame, lines: DataFrame) -> DataFrame:
    """(area_id, line_id, overlap): per area the line with most length inside; ties (to a millionth) to the smaller id."""
    best = F.max(F.struct(F.round("overlap", 6).alias("at_most"), (-F.col("line_id")).alias("o"), "line_id", "overlap"))
    every = _shapes(areas, *(c for c in areas.columns if c != "id"))
    found = _overlaps(_each(every), _each(_shapes(lines, "coords"))).groupBy("area_id").agg(best.alias("b"))
    named = found.select(F.col("area_id").alias("area_shape"), F.col("b.line_id").alias("line_id"), F.col("b.overlap").alias("overlap"))
    return _named(named, every, "area").select("area_id", "line_id", "overlap")
