"""Registered queries of the raster operators, on the grid of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import flood, outlines, raster
from brookflow.plans.derive import duck, view
from brookflow.plans.queries import QUERIES, SQL, C, R, query, r4, t, walls
from brookflow.runtime import staged


def grid(spark, d):
    """The grid of orders, 100 columns wide."""
    return view(spark, d, "cells")


_G = f"{duck('cells')}, g AS (SELECT r, c, v, zone FROM cells)"
_STEP = "s AS (SELECT unnest([0, 1, 1, 1, 0, -1, -1, -1]) AS dr, unnest([1, 1, 0, -1, -1, -1, 0, 1]) AS dc, unnest([1, 2, 4, 8, 16, 32, 64, 128]) AS dir)"
_FLOW = f"{_G}, {_STEP}, n AS (SELECT a.r AS r, a.c AS c, s.dir AS dir, b.r AS nr, b.c AS nc, (a.v - b.v) / sqrt(CAST(dr * dr + dc * dc AS DOUBLE)) AS dd FROM g a CROSS JOIN s JOIN g b ON b.r = a.r + dr AND b.c = a.c + dc), k AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY dd DESC, dir) AS o FROM n WHERE dd > 0), f AS (SELECT g.r AS r, g.c AS c, k.dir AS dir, k.nr AS nr, k.nc AS nc FROM g LEFT JOIN k ON g.r = k.r AND g.c = k.c AND k.o = 1)"


@query("ras_flow_d8", f"{_FLOW} SELECT r, c, dir FROM f")
def _(spark, d):
    return raster.flow_d8(grid(spark, d)).select("r", "c", "dir")


@query("ras_basins", f"{_FLOW.replace('WITH ', 'WITH RECURSIVE ', 1)}, w AS (SELECT r, c, r AS br, c AS bc FROM f WHERE dir IS NULL UNION ALL SELECT f.r AS r, f.c AS c, w.br AS br, w.bc AS bc FROM w JOIN f ON f.nr = w.r AND f.nc = w.c) SELECT r, c, br * 100 + bc + 1 AS label FROM w")
def _(spark, d):
    f = raster.flow_d8(grid(spark, d))
    return raster.basins(f, f.where("dir is null").select("r", "c", (C("r") * 100 + C("c") + 1).alias("label")))


@query("ras_label_propagate", f"{_FLOW.replace('WITH ', 'WITH RECURSIVE ', 1)}, w AS (SELECT r, c, zone AS label FROM g WHERE zone % 5 = 0 UNION ALL SELECT f.r AS r, f.c AS c, w.label AS label FROM w JOIN f ON f.nr = w.r AND f.nc = w.c JOIN g ON g.r = f.r AND g.c = f.c WHERE g.zone % 5 <> 0) SELECT r, c, label FROM w")
def _(spark, d):
    """Labels of some zones go up the steepest ways until another labelled cell."""
    cells = grid(spark, d)
    return raster.basins(raster.flow_d8(cells), cells.where("zone % 5 = 0").select("r", "c", C("zone").alias("label")))


#: Shares of a neighbour's height in the flow to the right and upward: a push away from the neighbour, a diagonal one shared by both.
_PUSH = f"{_G}, {_STEP}, q AS (SELECT a.r AS r, a.c AS c, sum(b.v * -dc / sqrt(CAST(dr * dr + dc * dc AS DOUBLE))) AS x, sum(b.v * dr / sqrt(CAST(dr * dr + dc * dc AS DOUBLE))) AS y, count(*) AS n FROM g a CROSS JOIN s JOIN g b ON b.r = a.r + dr AND b.c = a.c + dc WHERE b.v >= -10 GROUP BY a.r, a.c)"
_ANGLE = "(degrees(atan2(x, y)) + 360) % 360"
_SECTORS = f"{_PUSH}, k AS (SELECT r, c, {_ANGLE} AS angle FROM q WHERE n = 8), a AS (SELECT r, c, angle, list_position(list_transform(range(16), lambda i: (angle >= 22.5 * (i - 2.5) AND angle < 22.5 * (i - 1.5)) OR (angle - 360 >= 22.5 * (i - 2.5) AND angle - 360 < 22.5 * (i - 1.5))), true) AS sector FROM k)"
#: Steps of two cells (columns, rows) in each of the sixteen sectors.
_TWO = "[-2, -1, 0, 1, 2, 2, 2, 2, 2, 1, 0, -1, -2, -2, -2, -2]"
_TWO_DOWN = "[-2, -2, -2, -2, -2, -1, 0, 1, 2, 2, 2, 2, 2, 1, 0, -1]"


@query("ras_label_propagate16", f"{_SECTORS.replace('WITH ', 'WITH RECURSIVE ', 1)}, n8 AS (SELECT a.r AS r, a.c AS c, s.dir AS dir, b.r AS nr, b.c AS nc, (a.v - b.v) / sqrt(CAST(dr * dr + dc * dc AS DOUBLE)) AS dd FROM g a CROSS JOIN s JOIN g b ON b.r = a.r + dr AND b.c = a.c + dc), "
       "k8 AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY dd DESC, dir) AS o FROM n8 WHERE dd > 0), f8 AS (SELECT r, c, nr, nc FROM k8 WHERE o = 1), l0 AS (SELECT r, c, zone AS label FROM g WHERE zone % 5 = 0), "
       "l1 AS (SELECT r, c, label FROM l0 UNION ALL SELECT f8.r, f8.c, label FROM f8 JOIN l0 ON f8.nr = l0.r AND f8.nc = l0.c WHERE (f8.r, f8.c) NOT IN (SELECT (r, c) FROM l0)), "
       "l2 AS (SELECT r, c, label FROM l1 UNION ALL SELECT f8.r, f8.c, label FROM f8 JOIN l1 ON f8.nr = l1.r AND f8.nc = l1.c WHERE (f8.r, f8.c) NOT IN (SELECT (r, c) FROM l1)), "
       f"f AS (SELECT r, c, r + {_TWO_DOWN}[sector] AS nr, c + {_TWO}[sector] AS nc FROM a WHERE (r, c) NOT IN (SELECT (r, c) FROM l2)), "
       "w AS (SELECT r, c, label FROM l2 UNION ALL SELECT f.r AS r, f.c AS c, w.label AS label FROM w JOIN f ON f.nr = w.r AND f.nc = w.c) SELECT r, c, label FROM w")
def _(spark, d):
    cells = grid(spark, d)
    return raster.propagate_d16(cells, cells.where("zone % 5 = 0").select("r", "c", C("zone").alias("label")))


#: Levels sink from the border inward until none gets lower; from those the steps over level cells, and the ways down.
_FILLED = (
    f"{_G.replace('WITH ', 'WITH RECURSIVE ', 1)}, {_STEP}, p AS (SELECT a.r AS r, a.c AS c, a.v AS v, s.dir AS dir, s.dr AS dr, s.dc AS dc, b.r AS nr, b.c AS nc, b.v AS nv FROM g a CROSS JOIN s JOIN g b ON b.r = a.r + dr AND b.c = a.c + dc), "
    "border AS (SELECT g.r AS r, g.c AS c, any_value(g.v) AS v FROM g LEFT JOIN p ON p.r = g.r AND p.c = g.c GROUP BY g.r, g.c HAVING count(p.dir) < 8), "
    "fl(r, c, w) USING KEY (r, c) AS (SELECT r, c, v AS w FROM border UNION SELECT m.r, m.c, m.w FROM (SELECT p.r AS r, p.c AS c, min(greatest(p.v, fl.w)) AS w FROM fl JOIN p ON p.nr = fl.r AND p.nc = fl.c GROUP BY p.r, p.c) m "
    "LEFT JOIN recurring.fl old ON old.r = m.r AND old.c = m.c WHERE old.w IS NULL OR m.w < old.w)"
)
_FILLED_FLOW = (
    f"{_FILLED}, q AS (SELECT p.r AS r, p.c AS c, a.w AS w, p.dir AS dir, (a.w - b.w) / sqrt(CAST(dr * dr + dc * dc AS DOUBLE)) AS dd, p.nr AS nr, p.nc AS nc FROM p JOIN fl a ON a.r = p.r AND a.c = p.c JOIN fl b ON b.r = p.nr AND b.c = p.nc), "
    "st(r, c, k) USING KEY (r, c) AS (SELECT r, c, 0 AS k FROM border UNION SELECT r, c, 0 FROM q WHERE dd > 0 UNION SELECT m.r, m.c, m.k FROM (SELECT q.r AS r, q.c AS c, min(st.k) + 1 AS k FROM st JOIN q ON q.nr = st.r AND q.nc = st.c AND q.dd = 0 GROUP BY q.r, q.c) m "
    "LEFT JOIN recurring.st old ON old.r = m.r AND old.c = m.c WHERE old.k IS NULL OR m.k < old.k), "
    "z AS (SELECT q.*, row_number() OVER (PARTITION BY q.r, q.c ORDER BY dd DESC, CASE WHEN dd > 0 THEN 0 ELSE b.k END, dir) AS o FROM q JOIN st a ON a.r = q.r AND a.c = q.c JOIN st b ON b.r = q.nr AND b.c = q.nc WHERE dd > 0 OR (dd = 0 AND b.k < a.k)), "
    "ff AS (SELECT g.r AS r, g.c AS c, z.dir AS dir, z.nr AS nr, z.nc AS nc FROM g LEFT JOIN z ON z.r = g.r AND z.c = g.c AND z.o = 1)"
)


@query("ras_fill_d8", f"{_FILLED} SELECT r, c, {R('w', 'v')} FROM fl")
def _(spark, d):
    return flood.fill_depressions(grid(spark, d)).select("r", "c", r4(C("v")).alias("v"))


@query("ras_flow_filled", f"{_FILLED_FLOW} SELECT r, c, dir FROM ff")
def _(spark, d):
    """The ways down the filled grid, what is level included."""
    return flood.flow_filled(staged(flood.fill_depressions(grid(spark, d)), "filled")).select("r", "c", "dir")


@query("ras_d8_to_d16", "SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 7 WHEN 1 THEN 9 WHEN 2 THEN 11 WHEN 3 THEN 13 WHEN 4 THEN 15 WHEN 5 THEN 1 WHEN 6 THEN 3 ELSE 5 END AS dir FROM orders")
def _(spark, d):
    return raster.d8_to_d16(t(spark, d, "orders").select(C("o_orderkey").alias("id"), F.pow(F.lit(2), C("o_orderkey") % 8).cast("int").alias("dir")))


@query("ras_flow16", f"{_SECTORS} SELECT g.r AS r, g.c AS c, {R('angle', 'angle')}, CAST(sector AS INTEGER) AS sector FROM g LEFT JOIN a ON g.r = a.r AND g.c = a.c")
def _(spark, d):
    return raster.flow_sectors(grid(spark, d)).select("r", "c", r4(C("angle")).alias("angle"), "sector")


@query("ras_resolution", f"{duck('cells')} SELECT 2.0::DOUBLE AS resolution, count(*) AS n FROM cells")
def _(spark, d):
    return view(spark, d, "cells").agg(F.lit(raster.resolution([0.0, 2.0])).alias("resolution"), F.count(F.lit(1)).alias("n"))


@query("ras_resample", f"{_G}, o AS (SELECT r * 2 + i AS r, c * 2 + j AS c FROM g, (SELECT unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j)), p AS (SELECT r, c, (r + 0.5) / 2 - 0.5 AS y, (c + 0.5) / 2 - 0.5 AS x FROM o), q AS (SELECT r, c, CAST(floor(y) AS BIGINT) + i AS gr, CAST(floor(x) AS BIGINT) + j AS gc, (1 - abs(y - floor(y) - i)) * (1 - abs(x - floor(x) - j)) AS w FROM p, (SELECT unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j)) SELECT q.r AS r, q.c AS c, {R('sum(v * w) / sum(w)', 'v')} FROM q JOIN g ON g.r = gr AND g.c = gc GROUP BY q.r, q.c")
def _(spark, d):
    return raster.resample(grid(spark, d), 4.0, 2.0).select("r", "c", r4(C("v")).alias("v"))


@query("ras_match_equal", f"{_G}, z AS (SELECT r, c, zone FROM cells) SELECT zone, count(*) AS n, {R('sum(v)', 'total')} FROM g JOIN z USING (r, c) GROUP BY zone".replace("SELECT zone, count", "SELECT z.zone AS zone, count").replace("GROUP BY zone", "GROUP BY z.zone"))
def _(spark, d):
    g, z = grid(spark, d).select("r", "c", "v"), view(spark, d, "cells").select("r", "c", "zone")
    return g.join(z, ["r", "c"]).groupBy("zone").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("v")).alias("total"))


#: Heights on cells of 4 whose rows run downward from (0, 0), zones on cells of 2.5 whose rows run upward from (-3, -380).
_PLACED = f"{_G}, t AS (SELECT r, c, zone, -(-380 + (r + 0.5::DOUBLE) * 2.5) / 4 - 0.5 AS fr, (-3 + (c + 0.5::DOUBLE) * 2.5) / 4 - 0.5 AS fc FROM cells)"


@query(
    "ras_reproject_match",
    f"{_PLACED}, n AS (SELECT t.zone AS zone, count(g.v) AS n, sum(g.v) AS total FROM t LEFT JOIN g ON g.r = floor(fr + 0.5) AND g.c = floor(fc + 0.5) GROUP BY t.zone), "
    "k AS (SELECT t.r AS r, t.c AS c, t.zone AS zone, sum(g.v * w) / sum(w) AS v FROM (SELECT *, (1 - abs(fr - floor(fr) - i)) * (1 - abs(fc - floor(fc) - j)) AS w FROM t, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)) t "
    "JOIN g ON g.r = floor(fr) + i AND g.c = floor(fc) + j WHERE w > 0 GROUP BY t.r, t.c, t.zone), b AS (SELECT zone, count(*) AS n, sum(v) AS total FROM k GROUP BY zone) "
    f"SELECT n.zone AS zone, n.n AS n_nearest, {R('n.total', 'nearest')}, b.n AS n_bilinear, {R('b.total', 'bilinear')} FROM n JOIN b ON b.zone = n.zone",
)
def _(spark, d):
    """Heights on the zones' grid, which has another origin, cell and direction."""
    heights, zones = grid(spark, d).select("r", "c", "v"), view(spark, d, "cells").select("r", "c", "zone")
    source, target = raster.Grid(0.0, 0.0, 4.0, down=True), raster.Grid(-3.0, -380.0, 2.5)
    both = [raster.reproject_match(heights, source, zones, target, how).groupBy("zone").agg(F.count("v").alias(f"n_{how}"), r4(F.sum("v")).alias(how)) for how in ("nearest", "bilinear")]
    return both[0].join(both[1], "zone")


@query("ras_rasterize", 'WITH w AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS ax, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS ay FROM supplier), k AS (SELECT unnest(range(-1, 12)) AS dc), l AS (SELECT unnest(range(-1, 9)) AS dr), e AS (SELECT id, ax, ay, CAST(floor(ax / 5) AS BIGINT) + dc AS c, CAST(floor(ay / 5) AS BIGINT) + dr AS r FROM w, k, l), p AS (SELECT *, (c + 0.5) * 5 AS x, (r + 0.5) * 5 AS y FROM e), q AS (SELECT *, greatest(0, least(1, ((x - ax) * 35 + (y - ay) * 21) / 1666.0::DOUBLE)) AS t FROM p) SELECT r, c, max(id) AS id FROM q WHERE sqrt(pow(x - ax - t * 35, 2) + pow(y - ay - t * 21, 2)) <= 3 GROUP BY r, c')
def _(spark, d):
    return raster.rasterize_lines(walls(spark, d), 5.0, 3.0)


@query("ras_edt", f"{duck('cells')}, g AS (SELECT r, c, v > 400000 AS w FROM cells), t AS (SELECT r, c FROM g WHERE w) SELECT g.r AS r, g.c AS c, {R('min(sqrt(CAST((g.r - t.r) * (g.r - t.r) + (g.c - t.c) * (g.c - t.c) AS DOUBLE))) * 2', 'dist')} FROM g CROSS JOIN t GROUP BY g.r, g.c")
def _(spark, d):
    return raster.distance_transform(grid(spark, d).select("r", "c", (C("v") > 400000).alias("v"))).select("r", "c", r4(C("dist")).alias("dist"))


@query("ras_smooth_burn", f"{_G}, x AS (SELECT r, c, v, CAST(zone AS DOUBLE) AS dist FROM g) SELECT r, c, {R('v - CASE WHEN 5 * pow(0.5, dist / 3) < 0.001 THEN 0 ELSE 5 * pow(0.5, dist / 3) END - CASE WHEN dist = 0 THEN 10 ELSE 0 END', 'v')} FROM x")
def _(spark, d):
    return raster.smooth_burn(grid(spark, d).withColumn("dist", C("zone").cast("double")), 5.0, 3.0, 10.0).select("r", "c", r4(C("v")).alias("v"))


#: Corners, and parts less holes, told from the four cells around each grid point.
_CORNERS = (
    "q AS (SELECT label, r + i AS vr, c + j AS vc, count(*) AS n, count(*) FILTER (WHERE i = j) AS d "
    "FROM l, (SELECT unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j) GROUP BY label, vr, vc), "
    "k AS (SELECT label, count(*) FILTER (WHERE n = 1) AS one, count(*) FILTER (WHERE n = 3) AS three, count(*) FILTER (WHERE n = 2 AND d <> 1) AS across FROM q GROUP BY label)"
)


@query(
    "ras_polygonize",
    f"{_G}, l AS (SELECT r, c, zone // 9 AS label FROM g), s AS (SELECT unnest([0, 0, 1, -1]) AS dr, unnest([1, -1, 0, 0]) AS dc), "
    "e AS (SELECT a.label AS label, count(*) AS same FROM l a CROSS JOIN s JOIN l b ON b.r = a.r + dr AND b.c = a.c + dc AND b.label = a.label GROUP BY a.label), "
    f"n AS (SELECT label, count(*) AS n_cells FROM l GROUP BY label), {_CORNERS} SELECT n.label AS label, n_cells, CAST(n_cells * 4 AS DOUBLE) AS area, 4 * n_cells - same AS sides, "
    "CAST(one + three + 2 * across AS BIGINT) AS corners, CAST((one - three + 2 * across) // 4 AS BIGINT) AS parts_less_holes FROM n JOIN e ON n.label = e.label JOIN k ON n.label = k.label",
)
def _(spark, d):
    """Everything but n_cells is measured on the polygons' rings."""
    cells = grid(spark, d).select("r", "c", F.expr("zone div 9").alias("label"))
    shapes = outlines.outlines(cells, 2.0).select("label", "area", "rings")
    measured = shapes.groupBy("label").agg(
        F.sum("area").alias("area"),
        F.sum(F.aggregate("rings", F.lit(0.0), lambda s, ring: s + g.length(ring))).alias("around"),
        F.sum(F.aggregate("rings", F.lit(0).cast("long"), lambda s, ring: s + F.size(ring) - 1)).alias("corners"),
        F.sum(F.lit(2).cast("long") - F.size("rings")).alias("parts_less_holes"),
    )
    counted = cells.groupBy("label").agg(F.count(F.lit(1)).alias("n_cells"))
    return counted.join(measured, "label").select("label", "n_cells", "area", (F.col("around") / 2).cast("long").alias("sides"), "corners", "parts_less_holes")


@query("ras_levels_1_2", f"{duck('net_edges')} SELECT downstream AS level_2, count(*) AS n, {R('sum(length)', 'area')} FROM (SELECT concat('P', node_end) AS downstream, length FROM net_edges WHERE code LIKE 'P%') GROUP BY downstream")
def _(spark, d):
    l = _levels(spark, d)
    return l.groupBy("level_2").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("area")).alias("area"))


def _levels(spark, d):
    e = view(spark, d, "net_edges").where("code like 'P%'")
    units = e.select(C("node_start").alias("label"), C("length").alias("area"))
    keys = e.select(C("node_start").alias("label"), "code", F.concat(F.lit("P"), "node_end").alias("downstream_edges"), F.concat(F.lit("VE."), (C("node_start") % 50).cast("string"), F.lit(".001")).alias("order_code"), F.lit("").alias("downstream_order_code"))
    return raster.levels(units, keys)


@query("ras_levels_3_4", f"{duck('net_edges')} SELECT substr(concat('VE.', node_start % 50, '.001'), 1, 6) AS level_4, count(*) AS n, {R('sum(length)', 'area')} FROM net_edges WHERE code LIKE 'P%' GROUP BY 1")
def _(spark, d):
    return _levels(spark, d).groupBy("level_4").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("area")).alias("area"))


_WET = (
    "ends AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS ax, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS ay FROM supplier), "
    "around AS (SELECT id, ax, ay, CAST(floor(ax / 5) AS BIGINT) + dc AS c, CAST(floor(ay / 5) AS BIGINT) + dr AS r FROM ends, (SELECT unnest(range(-1, 12)) AS dc), (SELECT unnest(range(-1, 9)) AS dr)), "
    "mids AS (SELECT *, (c + 0.5) * 5 AS x, (r + 0.5) * 5 AS y FROM around), shares AS (SELECT *, greatest(0, least(1, ((x - ax) * 35 + (y - ay) * 21) / 1666.0::DOUBLE)) AS t FROM mids), "
    "wet AS (SELECT r, c, max(id) + 1 AS label FROM shares WHERE sqrt(pow(x - ax - t * 35, 2) + pow(y - ay - t * 21, 2)) <= 2.5 GROUP BY r, c)"
)


@query(
    "ras_preprocess",
    f"{_G}, {_WET}, far AS (SELECT g.r AS r, g.c AS c, g.v AS v, min(sqrt(CAST((g.r - w.r) * (g.r - w.r) + (g.c - w.c) * (g.c - w.c) AS DOUBLE))) * 5 AS dist FROM g CROSS JOIN (SELECT wet.r AS r, wet.c AS c FROM wet JOIN g ON g.r = wet.r AND g.c = wet.c) w GROUP BY g.r, g.c, g.v), "
    f"low AS (SELECT *, 0.5::DOUBLE * pow(0.5::DOUBLE, dist / 100) AS d FROM far) SELECT r, c, {R('v - CASE WHEN d < 0.001 THEN 0 ELSE d END - CASE WHEN dist = 0 THEN 10 ELSE 0 END', 'v')} FROM low",
)
def _(spark, d):
    from brookflow.plans.workflows import preprocess_terrain

    return preprocess_terrain(grid(spark, d).select("r", "c", "v"), walls(spark, d), 5.0).select("r", "c", r4(C("v")).alias("v"))


@query(
    "ras_generate",
    f"{_FILLED_FLOW}, {_WET}, drains AS (SELECT wet.r AS r, wet.c AS c, label FROM wet JOIN g ON g.r = wet.r AND g.c = wet.c UNION ALL SELECT ff.r AS r, ff.c AS c, drains.label AS label FROM drains JOIN ff ON ff.nr = drains.r AND ff.nc = drains.c "
    "WHERE (ff.r, ff.c) NOT IN (SELECT (r, c) FROM wet)) SELECT r, c, label FROM drains",
)
def _(spark, d):
    from brookflow.plans.workflows import drainage_units

    return drainage_units(grid(spark, d).select("r", "c", "v"), walls(spark, d), 5.0)


@query(
    "ras_run",
    f"{_FLOW.replace('WITH ', 'WITH RECURSIVE ', 1)}, w AS (SELECT r, c, zone AS label, 0 AS n FROM g WHERE zone > 0 AND zone % 5 = 0 UNION ALL "
    "SELECT f.r AS r, f.c AS c, w.label AS label, w.n + 1 AS n FROM w JOIN f ON f.nr = w.r AND f.nc = w.c JOIN g ON g.r = f.r AND g.c = f.c WHERE g.zone % 5 <> 0 OR g.zone = 0) "
    "SELECT r, c, label FROM w WHERE n <= 3",
)
def _(spark, d):
    """At most three steps up the steepest ways."""
    cells = grid(spark, d)
    wet = cells.select("r", "c", F.when(C("zone") % 5 == 0, C("zone")).otherwise(0).alias("label"))
    return raster.run_flow(cells.select("r", "c", "v"), wet, iterations=3)[0]


@query("run_drainage")
def _(spark, d):
    from brookflow.plans.workflows import run_drainage
    from brookflow.runtime import new_dir

    ways = walls(spark, d).select("id", F.concat(F.lit("W"), "id").alias("code"), "coords", F.lit(None).cast("string").alias("downstream_edges"), F.concat(F.lit("VE."), "id").alias("order_code"), F.lit("").alias("downstream_order_code"))
    made = run_drainage(spark, {"topo": grid(spark, d).select("r", "c", "v"), "waterways": ways}, new_dir(spark, "drainage"), cell=5.0)
    return made["afvoergebied_levels"].select("level_1", "level_2", "level_3", "level_4", r4(C("area")).alias("area"))
