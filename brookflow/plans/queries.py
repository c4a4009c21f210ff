"""The registered queries of the water-network operators on the views of derive.py, with their DuckDB forms.

Sums of doubles are compared to four decimals (floor(x * 10000 + 0.5) / 10000 on
both sides), as addition order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import buffers, culverts, discharge, dissolve, lumping, network, orders, raster, spatial, windows
from brookflow.operators import lines as ln
from brookflow.plans.derive import duck, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def r4(c: Column) -> Column:
    return F.floor(c * 10000 + 0.5).cast("double") / 10000


def R(expr: str, name: str) -> str:
    return f"floor(({expr}) * 10000 + 0.5) / 10000 AS {name}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def C(name: str) -> Column:
    return F.col(name)


# ---- geometry on the lines of embeddings and the tracks of events ----

def on_lines(name: str, out: Column | Callable[[], Column], sql: str, where: str = "", base: str = "lines") -> None:
    """id and one rounded value per line."""
    SQL[name] = f"{duck(base)} SELECT id, {R(sql, 'v')} FROM {base} {where}"
    QUERIES[name] = lambda spark, d: (view(spark, d, base).where(where.removeprefix("WHERE ")) if where else view(spark, d, base)).select("id", r4(out() if callable(out) else out).alias("v"))


_SEG = "list_transform(range(1, len({c})), lambda i: sqrt(pow({c}[i + 1].x - {c}[i].x, 2) + pow({c}[i + 1].y - {c}[i].y, 2)))"
_LEN = f"list_sum({_SEG.format(c='coords')})"
on_lines("geo_length", lambda: g.length(C("coords")), _LEN)
on_lines("geo_start_point", lambda: g.start_point(C("coords"))["x"], "coords[1].x")
on_lines("geo_end_point", lambda: g.end_point(C("coords"))["y"], "coords[-1].y")
on_lines("geo_reverse", lambda: g.start_point(F.reverse("coords"))["x"], "coords[-1].x")
on_lines("geo_area", lambda: g.ring_area(F.concat("coords", F.slice("coords", 1, 1))), "abs(list_sum(list_transform(range(1, len(coords)), lambda i: coords[i].x * coords[i + 1].y - coords[i + 1].x * coords[i].y)) + coords[-1].x * coords[1].y - coords[1].x * coords[-1].y) / 2")
on_lines("geo_bounds_center", lambda: (g.bounds(C("coords"))["x0"] + g.bounds(C("coords"))["x1"]) / 2, "(list_min(list_transform(coords, lambda p: p.x)) + list_max(list_transform(coords, lambda p: p.x))) / 2")
on_lines("geo_angle_compass", lambda: g.angle_compass(C("coords"), "upstream"), "degrees(atan2(coords[2].x - coords[1].x, coords[2].y - coords[1].y))")
_AM = "CASE WHEN {a} < 0 THEN {a} + 360 ELSE {a} END"
_A1, _AE = "degrees(atan2(coords[2].y - coords[1].y, coords[2].x - coords[1].x))", "degrees(atan2(coords[-1].y - coords[-2].y, coords[-1].x - coords[-2].x))"
_S, _E = _AM.format(a=_A1), _AM.format(a=_AE)
on_lines("geo_angle_math", lambda: g.angle_start(C("coords")), _S)
on_lines("geo_angle_diff", lambda: g.angle_difference(g.angle_start(C("coords")), g.angle_end(C("coords"))), f"least(abs(({_S}) - ({_E})), 360 - abs(({_S}) - ({_E})))")
on_lines("fn_fictive_length", lambda: g.fictive_length(g.length(C("coords")), g.angle_difference(g.angle_start(C("coords")), g.angle_end(C("coords")))), f"{_LEN} * (1 + least(abs(({_S}) - ({_E})), 360 - abs(({_S}) - ({_E}))) / 90)")
on_lines("geo_remove_z", lambda: g.length(g.remove_z(F.transform("coords", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(1.0).alias("z"))))), _LEN)
on_lines("geo_remove_holes", lambda: g.area(g.remove_holes(F.array(F.concat("coords", F.slice("coords", 1, 1)), F.array(*(g.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)))), F.array(*(g.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (0.1, 0.0), (0.0, 0.1), (0.0, 0.0))))), 0.25)), "abs(list_sum(list_transform(range(1, len(coords)), lambda i: coords[i].x * coords[i + 1].y - coords[i + 1].x * coords[i].y)) + coords[-1].x * coords[1].y - coords[1].x * coords[-1].y) / 2 - 0.5")
_CUM = "list_transform(range(1, len(coords)), lambda i: {'i': i, 'd': sqrt(pow(coords[i + 1].x - coords[i].x, 2) + pow(coords[i + 1].y - coords[i].y, 2)), 'b': coalesce(list_sum(list_transform(range(1, i), lambda j: sqrt(pow(coords[j + 1].x - coords[j].x, 2) + pow(coords[j + 1].y - coords[j].y, 2)))), 0)})"


@query("geo_interpolate", f"{duck('lines')}, l AS (SELECT id, coords, {_LEN} AS len FROM lines), s AS (SELECT id, len, coords, unnest({_CUM}) AS s FROM l), "
       f"h AS (SELECT id, s.i AS i, s.d AS d, s.b AS b, coords, len / 2 AS a FROM s) SELECT id, {R('coords[i].x + (a - b) / d * (coords[i + 1].x - coords[i].x)', 'x')}, {R('coords[i].y + (a - b) / d * (coords[i + 1].y - coords[i].y)', 'y')} FROM h WHERE a > b AND a <= b + d")
def _(spark, d):
    p = g.interpolate(C("coords"), g.length(C("coords")) / 2)
    return view(spark, d, "lines").select("id", p.alias("p")).select("id", r4(C("p.x")).alias("x"), r4(C("p.y")).alias("y"))


_T = "greatest(0, least(1, ((0.1 - coords[i].x) * (coords[i + 1].x - coords[i].x) + (0.1 - coords[i].y) * (coords[i + 1].y - coords[i].y)) / (pow(coords[i + 1].x - coords[i].x, 2) + pow(coords[i + 1].y - coords[i].y, 2))))"
_ND = f"list_min(list_transform(range(1, len(coords)), lambda i: sqrt(pow(0.1 - coords[i].x - {_T} * (coords[i + 1].x - coords[i].x), 2) + pow(0.1 - coords[i].y - {_T} * (coords[i + 1].y - coords[i].y), 2))))"
on_lines("geo_nearest_on_line", lambda: g.project(C("coords"), F.lit(0.1), F.lit(0.1))["dist"], _ND)


@query("geo_project", f"{duck('lines')}, s AS (SELECT id, coords, unnest({_CUM}) AS s FROM lines), p AS (SELECT id, s.i AS i, s.b + s.d * {_T.replace('[i', '[s.i')} AS along, sqrt(pow(0.1 - coords[s.i].x - {_T.replace('[i', '[s.i')} * (coords[s.i + 1].x - coords[s.i].x), 2) + pow(0.1 - coords[s.i].y - {_T.replace('[i', '[s.i')} * (coords[s.i + 1].y - coords[s.i].y), 2)) AS dist FROM s), "
       f"n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, i) AS k FROM p) SELECT id, {R('along', 'v')} FROM n WHERE k = 1")
def _(spark, d):
    return view(spark, d, "lines").select("id", r4(g.project(C("coords"), F.lit(0.1), F.lit(0.1))["along"]).alias("v"))


@query("geo_shorten", f"{duck('lines')}, l AS (SELECT id, coords, {_LEN} AS len FROM lines), s AS (SELECT id, len, coords, unnest({_CUM}) AS s FROM l), "
       "h AS (SELECT id, coords, s.i AS i, s.d AS d, s.b AS b, unnest([0.5::DOUBLE, len - 0.5]) AS a, unnest([0, 1]) AS k FROM s), "
       "p AS (SELECT id, k, coords[i].x + (a - b) / d * (coords[i + 1].x - coords[i].x) AS x, coords[i].y + (a - b) / d * (coords[i + 1].y - coords[i].y) AS y FROM h WHERE a > b AND a <= b + d) "
       f"SELECT f.id AS id, 2 AS n, {R('sqrt(pow(t.x - f.x, 2) + pow(t.y - f.y, 2))', 'v')} FROM p f JOIN p t ON f.id = t.id AND f.k = 0 AND t.k = 1")
def _(spark, d):
    c = g.shorten(C("coords"), 0.5)
    return view(spark, d, "lines").select("id", c.alias("c")).select("id", F.size("c").alias("n"), r4(g.length(C("c"))).alias("v"))


@query("geo_line_to_vertices", f"{duck('tracks')}, l AS (SELECT id, {_LEN} AS len FROM tracks), n AS (SELECT id, len, CAST(floor(len / 1000) AS BIGINT) AS n FROM l) SELECT id, CASE WHEN n > 1 THEN n + 1 ELSE 2 END AS n_points, {R('len', 'len')} FROM n")
def _(spark, d):
    v = ln.line_to_vertices(view(spark, d, "tracks"), 1000.0, ("id",))
    return v.groupBy("id").agg(F.count(F.lit(1)).alias("n_points"), r4(F.max("distance_from_start")).alias("len"))


@query("geo_closed", f"{duck('lines')} SELECT id, coords[1] = coords[-1] AS closed FROM lines")
def _(spark, d):
    return view(spark, d, "lines").select("id", g.is_closed(C("coords")).alias("closed"))


@query("geo_combine", f"{duck('lines')} SELECT id, CAST(len(coords) + 2 AS BIGINT) AS n, {R(_LEN + ' + 5', 'v')} FROM lines")
def _(spark, d):
    e = g.end_point(C("coords"))
    tail = F.array(F.struct(e["x"].alias("x"), e["y"].alias("y")), F.struct((e["x"] + 3).alias("x"), (e["y"] + 4).alias("y")))
    return view(spark, d, "lines").select("id", g.combine(C("coords"), F.array(tail)).alias("c")).select("id", F.size("c").cast("long").alias("n"), r4(g.length(C("c"))).alias("v"))


@query("geo_flip", f"{duck('lines')} SELECT id, {R('CASE WHEN id % 2 = 0 THEN coords[1].x ELSE coords[-1].x END', 'v')} FROM lines")
def _(spark, d):
    return view(spark, d, "lines").select("id", r4(g.start_point(g.flip(C("coords"), C("id") % 2 == 0, F.lit(True)))["x"]).alias("v"))


@query("geo_linemerge_own", f"{duck('lines')} SELECT id, CAST(len(coords) AS BIGINT) AS n, {R(_LEN, 'v')} FROM lines")
def _(spark, d):
    segs = spatial.line_segments(view(spark, d, "lines"))
    merged = segs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "ax", "ay", "bx", "by"))).alias("s"))
    c = F.concat(F.transform("s", lambda s: F.struct(s["ax"].alias("x"), s["ay"].alias("y"))), F.array(F.struct(F.element_at("s", -1)["bx"].alias("x"), F.element_at("s", -1)["by"].alias("y"))))
    return merged.select("id", c.alias("c")).select("id", F.size("c").cast("long").alias("n"), r4(g.length(C("c"))).alias("v"))


#: Lines between neighbouring points of a row, every ninth left out and every fourth drawn backward, with side lines and, apart from them, rings of four.
_ROW = (
    "SELECT concat('L', p_partkey) AS code, p_partkey % 4 = 0 AS back, 10.0 * p_partkey AS ax, 1.0 * (p_partkey * p_partkey % 7) AS ay, 10.0 * p_partkey + 10 AS bx, 1.0 * ((p_partkey + 1) * (p_partkey + 1) % 7) AS bz FROM {part} WHERE p_partkey % 9 <> 0 "
    "UNION ALL SELECT concat('B', p_partkey), false, 10.0 * p_partkey, 1.0 * (p_partkey * p_partkey % 7), 10.0 * p_partkey, 1000.0 FROM {part} WHERE p_partkey % 25 = 0 AND p_partkey % 9 NOT IN (0, 1) "
    "UNION ALL SELECT concat('R', p_partkey, '-', k), k = 2, CASE WHEN k IN (1, 2) THEN 10.0 ELSE 0.0 END, 5000 + 100.0 * p_partkey + CASE WHEN k IN (2, 3) THEN 10 ELSE 0 END, CASE WHEN k IN (0, 1) THEN 10.0 ELSE 0.0 END, 5000 + 100.0 * p_partkey + CASE WHEN k IN (1, 2) THEN 10 ELSE 0 END FROM {part} CROSS JOIN {four} WHERE p_partkey % 50 = 7"
)
_LONG = "sqrt(100 + pow((p_partkey + 1) * (p_partkey + 1) % 7 - p_partkey * p_partkey % 7, 2))"


@query(
    "geo_linemerge",
    f"WITH l AS (SELECT p_partkey, 'L' || p_partkey AS code, {_LONG} AS len, CASE WHEN p_partkey % 9 = 1 OR p_partkey = 1 OR (p_partkey % 25 = 0 AND p_partkey % 9 NOT IN (0, 1)) THEN 1 ELSE 0 END AS begins FROM part WHERE p_partkey BETWEEN 1 AND (SELECT max(p_partkey) FROM part) AND p_partkey % 9 <> 0), "
    "k AS (SELECT *, sum(begins) OVER (ORDER BY p_partkey) AS chain FROM l) "
    f"SELECT min(code) AS code, count(*) AS n, FALSE AS closed, {R('sum(len)', 'len')} FROM k GROUP BY chain "
    "UNION ALL SELECT 'B' || p_partkey, 1, FALSE, 1000.0::DOUBLE - p_partkey * p_partkey % 7 FROM part WHERE p_partkey % 25 = 0 AND p_partkey % 9 NOT IN (0, 1) "
    "UNION ALL SELECT 'R' || p_partkey || '-0', 4, TRUE, 40.0::DOUBLE FROM part WHERE p_partkey % 50 = 7",
)
def _(spark, d):
    """Lines put together from side line to side line or gap, however they are drawn, and rings."""
    rows = spark.sql(_ROW.replace(".0 ", ".0D "), part=t(spark, d, "part"), four=spark.range(4).withColumnRenamed("id", "k"))
    ends = F.array(g.point(C("ax"), C("ay")), g.point(C("bx"), C("bz")))
    drawn = rows.select("code", F.when(C("back"), F.reverse(ends)).otherwise(ends).alias("coords"))
    return ln.merge_lines(drawn).select("code", F.size("codes").cast("long").alias("n"), "closed", r4(g.length(C("coords"))).alias("len"))


_BOX = "list_sum(list_transform(range(1, len(coords)), lambda i: {f}))"


_BOXED = "greatest(0, least(1, greatest((-0.1 - ax) / (bx - ax), (0.1 - ax) / (bx - ax)), greatest((-0.1 - ay) / (cy - ay), (0.1 - ay) / (cy - ay))) - greatest(0, least((-0.1 - ax) / (bx - ax), (0.1 - ax) / (bx - ax)), least((-0.1 - ay) / (cy - ay), (0.1 - ay) / (cy - ay))))"


@query("geo_intersection_length", f"{duck('lines')}, p AS (SELECT id, coords, unnest(range(1, len(coords))) AS i FROM lines), s AS (SELECT id, coords[i].x AS ax, coords[i].y AS ay, coords[i + 1].x AS bx, coords[i + 1].y AS cy FROM p) SELECT id, {R(f'sum({_BOXED} * sqrt(pow(bx - ax, 2) + pow(cy - ay, 2)))', 'v')} FROM s GROUP BY id")
def _(spark, d):
    segs = spatial.line_segments(view(spark, d, "lines"))
    return segs.groupBy("id").agg(r4(F.sum(g.clip_length(F.struct("ax", "ay", "bx", "by"), F.lit(-0.1), F.lit(-0.1), F.lit(0.1), F.lit(0.1)))).alias("v"))


@query("geo_smallest_angle", f"{duck('lines')}, p AS (SELECT id, {_S} AS a FROM lines), c AS (SELECT id, a, unnest([0, 90, 180, 270]) AS b, unnest(['E', 'N', 'W', 'S']) AS code, unnest([0, 1, 2, 3]) AS i FROM p), "
       "r AS (SELECT id, code, least(abs(a - b), 360 - abs(a - b)) AS diff, row_number() OVER (PARTITION BY id ORDER BY least(abs(a - b), 360 - abs(a - b)), i) AS k FROM c) SELECT id, code, floor(diff * 10000 + 0.5) / 10000 AS diff FROM r WHERE k = 1")
def _(spark, d):
    best = g.smallest_angle(g.angle_start(C("coords")), F.array(*(F.lit(float(a)) for a in (0, 90, 180, 270))), F.array(*(F.lit(c) for c in "ENWS")))
    return view(spark, d, "lines").select("id", best.alias("b")).select("id", "b.code", r4(C("b.diff")).alias("diff"))


def _degrees(origin: float, terms: tuple) -> str:
    return f"{origin} + (" + " + ".join(f"({k}::DOUBLE) * pow(dx, {p}) * pow(dy, {q})" for p, q, k in terms) + ") / 3600"


@query("geo_crs", f"{duck('pts_a')}, o AS (SELECT id, (x * 100 + 100000 - 155000) / 1e5 AS dx, (y * 100 + 400000 - 463000) / 1e5 AS dy FROM pts_a) "
       f"SELECT id, {R(_degrees(g.RD_ORIGIN[3], g.RD_LONGITUDE), 'lon')}, {R(_degrees(g.RD_ORIGIN[2], g.RD_LATITUDE), 'lat')} FROM o")
def _(spark, d):
    p = g.rd_to_wgs84(C("x") * 100 + 100000, C("y") * 100 + 400000)
    return view(spark, d, "pts_a").select("id", p.alias("p")).select("id", r4(C("p.lon")).alias("lon"), r4(C("p.lat")).alias("lat"))


@query("fn_strings", "SELECT p_partkey AS id, CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 3 THEN CAST(p_partkey AS VARCHAR) ELSE lpad(CAST(p_partkey AS VARCHAR), 3, '0') END AS z, split_part(concat(p_partkey, '-', p_size), '-', 1) AS base, substr(concat('VE.', p_partkey, '.001'), 1, 6) AS six FROM part")
def _(spark, d):
    p = t(spark, d, "part")
    return p.select(C("p_partkey").alias("id"), g.zfill(C("p_partkey")).alias("z"), F.substring_index(F.concat("p_partkey", F.lit("-"), "p_size"), "-", 1).alias("base"), F.substring(F.concat(F.lit("VE."), "p_partkey", F.lit(".001")), 1, 6).alias("six"))


@query("fn_math", f"SELECT p_partkey AS id, CASE WHEN p_size - 10 > 0 THEN {R('log10(p_size - 10)', 'x')[:-5]} END AS lg, {R('pow(0.5, p_size / 10.0::DOUBLE)', 'half')} FROM part")
def _(spark, d):
    return t(spark, d, "part").select(C("p_partkey").alias("id"), r4(g.log10_or_null(C("p_size") - 10)).alias("lg"), r4(F.pow(F.lit(0.5), C("p_size") / 10.0)).alias("half"))


@query("fn_nulls", "SELECT o_orderkey AS id, coalesce(CASE WHEN o_custkey % 3 = 0 THEN o_custkey END, -999) AS v FROM orders")
def _(spark, d):
    return t(spark, d, "orders").select(C("o_orderkey").alias("id"), F.when(C("o_custkey") % 3 == 0, C("o_custkey")).alias("v")).na.fill(-999, ["v"])


@query("fn_dates", "SELECT o_custkey AS id, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM orders GROUP BY o_custkey")
def _(spark, d):
    return t(spark, d, "orders").groupBy(C("o_custkey").alias("id")).agg(F.min(F.year("o_orderdate")).cast("long").alias("first_year"), F.max(F.year("o_orderdate")).cast("long").alias("last_year"))


@query("fn_binning", "SELECT o_orderkey AS id, CASE WHEN o_totalprice < 100000 THEN '<100000' WHEN o_totalprice < 200000 THEN '100000-200000' ELSE '>200000' END AS bin FROM orders")
def _(spark, d):
    from brookflow.sources.viz import categories

    return t(spark, d, "orders").select(C("o_orderkey").alias("id"), categories(C("o_totalprice"), [100000, 200000]).alias("bin"))


# ---- filters and projections ----

@query("flt_closed_dup", f"{duck('lines')}, u AS (SELECT id, coords FROM lines UNION ALL SELECT id + 100000, coords FROM lines), k AS (SELECT id, coords, row_number() OVER (PARTITION BY coords ORDER BY id) AS n FROM u WHERE coords[1] <> coords[-1]) SELECT id FROM k WHERE n = 1")
def _(spark, d):
    l = view(spark, d, "lines")
    return ln.drop_closed_and_equal(l.union(l.withColumn("id", C("id") + 100000))).select("id")


_NETLINES = "SELECT e.code, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS \"by\" FROM net_edges e JOIN net_nodes a ON e.node_start = a.node_id JOIN net_nodes b ON e.node_end = b.node_id"


def net_lines(spark: SparkSession, d: str) -> DataFrame:
    e, n = view(spark, d, "net_edges"), view(spark, d, "net_nodes")
    a = n.select(C("node_id").alias("node_start"), g.point(C("x"), C("y")).alias("p"))
    b = n.select(C("node_id").alias("node_end"), g.point(C("x"), C("y")).alias("q"))
    return e.hint("merge").join(a, "node_start").hint("merge").join(b, "node_end").select("code", "node_start", "node_end", "own", "length", F.array("p", "q").alias("coords"))


_NL = f"{duck('net_edges', 'net_nodes')}, nl AS ({_NETLINES})"
_ENDS = "ends AS (SELECT code, 'dangling_start' AS line_type, ax AS x, ay AS y FROM nl UNION ALL SELECT code, 'dangling_end', bx, \"by\" FROM nl)"


@query("flt_endpoints_dangling", f"{_NL}, {_ENDS}, n AS (SELECT *, count(*) OVER (PARTITION BY x, y) AS k FROM ends) SELECT code, line_type, x, y FROM n WHERE k = 1")
def _(spark, d):
    return ln.dangling(net_lines(spark, d))


@query("flt_crossings", "SELECT l_orderkey AS id, count(*) AS n FROM lineitem WHERE NOT (l_quantity > 40 OR l_discount > 0.08) GROUP BY l_orderkey")
def _(spark, d):
    x = t(spark, d, "lineitem").select(C("l_orderkey").alias("id"), (C("l_quantity") > 40).alias("crossings_kering"), (C("l_discount") > 0.08).alias("crossings_snelweg"), F.lit(None).cast("boolean").alias("crossings_spoorweg"))
    return culverts.keep_uncrossed(x).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


_SC = "SELECT p_partkey AS id, p_size % 2 AS o, p_size // 2 % 2 AS w, p_size // 4 % 2 AS n, p_size // 8 % 2 AS p FROM part"


def scored_parts(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part")
    bit = lambda k: F.expr(f"p_size div {k} % 2 = 1")
    return p.select(C("p_partkey").alias("id"), F.when(bit(1), "other").otherwise("dangling_end").alias("line_type"), F.when(bit(2), "overige_watergang").otherwise("hydroobject").alias("WaterLineType"), bit(4).alias("crossings_nwb"), bit(8).alias("crossings_peilgebied"))


@query("prj_score", f"WITH s AS ({_SC}) SELECT id, CASE WHEN o = 0 AND w = 0 AND p = 1 AND n = 1 THEN NULL WHEN o = 0 AND w = 0 AND p = 1 THEN 13 ELSE 1 + o + 2 * w + 4 * n + 8 * p END AS score FROM s")
def _(spark, d):
    return scored_parts(spark, d).select("id", culverts.score().alias("score"))


@query("prj_score_group", f"WITH s AS ({_SC}) SELECT id, CAST(ceil((1 + o + 2 * w + 4 * n + 8 * p) / 4.0) AS INTEGER) AS score_group FROM s")
def _(spark, d):
    return scored_parts(spark, d).select("id", culverts.score_group(culverts.score(strict=True)).alias("score_group"))


@query("flt_fictive_len", "SELECT p_partkey AS id FROM part WHERE p_size * (1 + 0.5) <= 40")
def _(spark, d):
    return t(spark, d, "part").where(g.fictive_length(C("p_size"), F.lit(45.0)) <= 40).select(C("p_partkey").alias("id"))


@query("flt_split_nodes", f"{duck('net_edges')} SELECT node_start AS node_id, count(*) AS n FROM net_edges WHERE node_start IN (SELECT node_end FROM net_edges) GROUP BY node_start HAVING count(*) > 1")
def _(spark, d):
    e = view(spark, d, "net_edges")
    n = network.edge_lists(view(spark, d, "net_nodes"), e)
    return n.where("no_downstream_edges > 1 and no_upstream_edges > 0").select("node_id", C("no_downstream_edges").alias("n"))


@query("flt_order_positive", "SELECT o_orderkey AS id FROM orders WHERE o_custkey % 7 - 1 > -1 AND o_custkey % 5 > 0")
def _(spark, d):
    return t(spark, d, "orders").where((C("o_custkey") % 7 - 1 > -1) & (C("o_custkey") % 5 > 0)).select(C("o_orderkey").alias("id"))


@query("flt_empty_code", "SELECT o_orderkey AS id, coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_custkey % 3 = 0 THEN '' END) AS order_code FROM orders WHERE NOT (coalesce(CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_custkey % 3 = 0 THEN '' END) IS NOT DISTINCT FROM '')")
def _(spark, d):
    c = F.coalesce(F.when(C("o_custkey") % 2 == 0, C("o_orderstatus")), F.when(C("o_custkey") % 3 == 0, F.lit("")))
    return t(spark, d, "orders").select(C("o_orderkey").alias("id"), c.alias("order_code")).where(~C("order_code").eqNullSafe(F.lit("")))


@query("prj_category", "SELECT o_orderkey AS id, CASE WHEN o_totalprice / 1000000 >= 0.075 THEN 1 WHEN o_totalprice / 1000000 >= 0.01 THEN 2 ELSE 3 END AS category FROM orders")
def _(spark, d):
    return t(spark, d, "orders").select(C("o_orderkey").alias("id"), discharge.category(C("o_totalprice") / 1000000).alias("category"))


@query("flt_q_valid", "SELECT event_id AS id, CASE WHEN value > 0.0001 AND value <= 50 THEN value END AS q FROM events")
def _(spark, d):
    return t(spark, d, "events").select(C("event_id").alias("id"), discharge.valid_measurement(C("value"), F.lit(50.0)).alias("q"))


# ---- joins ----

_PTS = duck("pts_a", "pts_b")
_DIST = "sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))"


@query("join_radius_vertices", f"{_PTS} SELECT a.id AS a_id, b.id AS b_id, {R(_DIST, 'dist')} FROM pts_a a JOIN pts_b b ON {_DIST} <= 40")
def _(spark, d):
    p = spatial.radius_pairs(view(spark, d, "pts_a"), view(spark, d, "pts_b"), 40.0)
    return p.select(C("l_id").alias("a_id"), C("r_id").alias("b_id"), r4(C("dist")).alias("dist"))


for _name, _radius in (("join_dwithin_structure", 15.0), ("join_rws_buffer", 50.0)):
    SQL[_name] = f"{_PTS} SELECT DISTINCT a.id AS id FROM pts_a a JOIN pts_b b ON {_DIST} <= {_radius}"
    QUERIES[_name] = lambda spark, d, r=_radius: spatial.within_semi(view(spark, d, "pts_a"), view(spark, d, "pts_b"), r).select("id")


@query("join_dwithin_split", f"{_PTS} SELECT a.id AS a_id, b.id AS b_id FROM pts_a a LEFT JOIN pts_b b ON {_DIST} <= 5")
def _(spark, d):
    return spatial.radius_pairs(view(spark, d, "pts_a"), view(spark, d, "pts_b"), 5.0, "left").select(C("l_id").alias("a_id"), C("r_id").alias("b_id"))


_NEAR = f"{_PTS}, n AS (SELECT a.id AS a_id, b.id AS b_id, {_DIST} AS dist, row_number() OVER (PARTITION BY a.id ORDER BY {_DIST}, b.id) AS k FROM pts_a a CROSS JOIN pts_b b)"
SQL["join_nearest_node"] = f"{_NEAR} SELECT a_id, b_id, {R('dist', 'dist')} FROM n WHERE k = 1"
QUERIES["join_nearest_node"] = lambda spark, d: spatial.nearest(view(spark, d, "pts_a"), view(spark, d, "pts_b")).select(C("l_id").alias("a_id"), C("r_id").alias("b_id"), r4(C("dist")).alias("dist"))
SQL["join_nearest_deadend"] = f"{_NEAR} SELECT a_id, b_id, {R('dist', 'dist')} FROM n WHERE k = 1 AND dist <= 50"
QUERIES["join_nearest_deadend"] = lambda spark, d: spatial.nearest(view(spark, d, "pts_a"), view(spark, d, "pts_b"), 50.0).select(C("l_id").alias("a_id"), C("r_id").alias("b_id"), r4(C("dist")).alias("dist"))
_NT = f"{_PTS}, n AS (SELECT a.id AS a_id, b.id AS b_id, {_DIST} AS dist, rank() OVER (PARTITION BY a.id ORDER BY {_DIST}) AS k FROM pts_a a CROSS JOIN pts_b b)"
SQL["join_nearest_measure"] = f"{_NT} SELECT a_id, b_id, {R('dist', 'dist')} FROM n WHERE k = 1"
QUERIES["join_nearest_measure"] = lambda spark, d: spatial.nearest(view(spark, d, "pts_a"), view(spark, d, "pts_b"), None, ties=True).select(C("l_id").alias("a_id"), C("r_id").alias("b_id"), r4(C("dist")).alias("dist"))

SQL["join_snap_endpoints"] = f"{duck('pts_a')} SELECT a.id AS a_id, b.id AS b_id FROM pts_a a JOIN pts_a b ON a.id <> b.id AND {_DIST} <= 4"
QUERIES["join_snap_endpoints"] = lambda spark, d: spatial.radius_pairs(view(spark, d, "pts_a"), view(spark, d, "pts_a"), 4.0).where("l_id <> r_id").select(C("l_id").alias("a_id"), C("r_id").alias("b_id"))

_WALLS = "walls AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS ax, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS ay, CAST((s_suppkey * 53) % 1000 + 35 AS DOUBLE) AS bx, CAST((s_suppkey * 71) % 1000 + 21 AS DOUBLE) AS \"by\" FROM supplier)"


def walls(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "pts_b")
    return p.select("id", F.array(g.point(C("x"), C("y")), g.point(C("x") + 35, C("y") + 21)).alias("coords"))


_SEGD = "sqrt(pow(p.x - w.ax - {t} * (w.bx - w.ax), 2) + pow(p.y - w.ay - {t} * (w.\"by\" - w.ay), 2))".format(t="greatest(0, least(1, ((p.x - w.ax) * 35 + (p.y - w.ay) * 21) / 1666.0::DOUBLE))")


@query("join_endpoint_on_line", f"{duck('pts_a')}, {_WALLS} SELECT p.id AS point, w.id AS line, {R(_SEGD, 'dist')} FROM pts_a p JOIN walls w ON {_SEGD} <= 3.5")
def _(spark, d):
    return spatial.points_on_lines(view(spark, d, "pts_a"), walls(spark, d), 3.5).select(C("l_id").alias("point"), C("r_id").alias("line"), r4(C("dist")).alias("dist"))


@query("join_point_nearest_segment", f"{duck('pts_a')}, {_WALLS}, n AS (SELECT p.id AS point, w.id AS line, {_SEGD} AS dist, rank() OVER (PARTITION BY p.id ORDER BY {_SEGD}) AS k FROM pts_a p JOIN walls w ON {_SEGD} <= 20.5) SELECT point, line, {R('dist', 'dist')} FROM n WHERE k = 1")
def _(spark, d):
    return spatial.nearest_segments(view(spark, d, "pts_a"), walls(spark, d), 20.5).select(C("l_id").alias("point"), C("r_id").alias("line"), r4(C("dist")).alias("dist"))


_CULV = "culv AS (SELECT c_custkey AS id, CAST((c_custkey * 17) % 1000 AS DOUBLE) AS ax, CAST((c_custkey * 29) % 1000 AS DOUBLE) AS ay, CAST((c_custkey * 17) % 1000 + 13 AS DOUBLE) AS bx, CAST((c_custkey * 29) % 1000 - 31 AS DOUBLE) AS \"by\" FROM customer)"


def short_lines(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "pts_a").select("id", F.array(g.point(C("x"), C("y")), g.point(C("x") + 13, C("y") - 31)).alias("coords"))


#: Bent walls: the second piece begins where the first one ends.
_BENT = (
    "bent AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS x, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS y FROM supplier), "
    "pieces AS (SELECT id, 0 AS k, x AS ax, y AS ay, x + 35 AS bx, y + 21 AS \"by\" FROM bent UNION ALL SELECT id, 1 AS k, x + 35 AS ax, y + 21 AS ay, x + 48 AS bx, y - 10 AS \"by\" FROM bent)"
)
#: Where the two straight lines through a culvert and a piece meet, as shares of each (Cramer's rule, in whole numbers).
_MEET = (
    "solved AS (SELECT c.id AS id, p.id AS wall, p.k AS k, (c.bx - c.ax) * (p.\"by\" - p.ay) - (c.\"by\" - c.ay) * (p.bx - p.ax) AS den, "
    "(p.ax - c.ax) * (p.\"by\" - p.ay) - (p.ay - c.ay) * (p.bx - p.ax) AS t, (p.ax - c.ax) * (c.\"by\" - c.ay) - (p.ay - c.ay) * (c.bx - c.ax) AS u, "
    "(p.ax - c.ax) * (c.bx - c.ax) + (p.ay - c.ay) * (c.\"by\" - c.ay) AS from_a, (p.bx - c.ax) * (c.bx - c.ax) + (p.\"by\" - c.ay) * (c.\"by\" - c.ay) AS from_b, 13 * 13 + 31 * 31 AS norm FROM culv c, pieces p), "
    "judged AS (SELECT id, wall, bool_or(den <> 0 AND t * sign(den) > 0 AND t * sign(den) < abs(den) AND u * sign(den) >= 0 AND u * sign(den) <= abs(den) AND NOT (k = 0 AND u = 0) AND NOT (k = 1 AND u = den)) AS met, "
    "bool_or(den = 0 AND u = 0 AND greatest(least(from_a, from_b), 0) < least(greatest(from_a, from_b), norm)) AS shared FROM solved GROUP BY id, wall), "
    "crossed AS (SELECT id, wall FROM judged WHERE met AND NOT shared)"
)


def bent_walls(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "pts_b")
    return p.select("id", F.concat(F.lit("W"), "id").alias("code"), F.array(g.point(C("x"), C("y")), g.point(C("x") + 35, C("y") + 21), g.point(C("x") + 48, C("y") - 10)).alias("coords"))


@query("join_crosses", f"WITH {_BENT}, {_CULV}, {_MEET} SELECT id, min(concat('W', wall)) AS crossing_code FROM crossed GROUP BY id")
def _(spark, d):
    cul = short_lines(spark, d).withColumns({"code": F.lit("-"), "dangling_code": F.lit("-")})
    return spatial.first_crossing(cul, bent_walls(spark, d), 50.0).where("crossing_code is not null").select("id", "crossing_code")


#: Two segments of 35 by 21 and 13 by -31 with radius 3: boxes, half discs of 64 chords each, a slice at the bend, less what the boxes share inside it.
_TURN = "(atan2(21, 35) - atan2(-31, 13))"
_SIDES = f"greatest(1, CAST(ceil({_TURN} / (pi() / 64) - 1e-9) AS INTEGER))"


@query("geo_buffer", f"SELECT s_suppkey AS id, 1::BIGINT AS n_parts, {R(f'6 * (sqrt(35 * 35 + 21 * 21) + sqrt(13 * 13 + 31 * 31)) + 64 * 9 * sin(pi() / 64) + 9 * {_SIDES} * sin({_TURN} / {_SIDES}) / 2 - 9 * tan({_TURN} / 2)', 'area')} FROM supplier")
def _(spark, d):
    whole = buffers.buffer(bent_walls(spark, d), 3.0, precision=1e-7)
    return whole.groupBy("id").agg(F.count(F.lit(1)).alias("n_parts"), r4(F.sum("area")).alias("area"))


@query("join_own_line_exempt", f"WITH {_BENT}, {_CULV}, {_MEET} SELECT id, min(concat('W', wall)) AS crossing_code FROM crossed WHERE wall <> id % 100 GROUP BY id")
def _(spark, d):
    cul = short_lines(spark, d).withColumns({"code": F.concat(F.lit("W"), C("id") % 100), "dangling_code": F.lit("-")})
    return spatial.first_crossing(cul, bent_walls(spark, d), 50.0).where("crossing_code is not null").select("id", "crossing_code")


def _within(box: str, s: str = "c") -> str:
    """The share of a segment without level or upright direction that lies in a box (x0, y0, x1, y1)."""
    x0, y0, x1, y1 = box.split(", ")
    dx, dy = f"({s}.bx - {s}.ax)", f'({s}."by" - {s}.ay)'
    begin = f"greatest(0, least(({x0} - {s}.ax) / {dx}, ({x1} - {s}.ax) / {dx}), least(({y0} - {s}.ay) / {dy}, ({y1} - {s}.ay) / {dy}))"
    end = f"least(1, greatest(({x0} - {s}.ax) / {dx}, ({x1} - {s}.ax) / {dx}), greatest(({y0} - {s}.ay) / {dy}, ({y1} - {s}.ay) / {dy}))"
    return f"greatest(0, {end} - {begin})"


def corner_areas(spark: SparkSession, d: str) -> DataFrame:
    """L-shaped areas, 40 wide and high, 10 thick."""
    corners = ((0, 0), (40, 0), (40, 10), (10, 10), (10, 40), (0, 40), (0, 0))
    return view(spark, d, "pts_b").select("id", F.array(F.array(*(g.point(C("x") + x, C("y") + y) for x, y in corners))).alias("rings"))


@query("join_crosses_polygon", f"WITH bent AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS x, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS y FROM supplier), {_CULV}, "
       f"shares AS (SELECT c.id AS l_id, a.id AS r_id, {_within('a.x, a.y, a.x + 40, a.y + 10')} + {_within('a.x, a.y, a.x + 10, a.y + 40')} - {_within('a.x, a.y, a.x + 10, a.y + 10')} AS part FROM culv c, bent a) "
       "SELECT l_id, r_id FROM shares WHERE part > 1e-9 AND part < 1 - 1e-9")
def _(spark, d):
    return spatial.polygon_crossings(short_lines(spark, d), corner_areas(spark, d))


@query("geo_representative_point", "SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 + 5 AS DOUBLE) AS x, CAST((s_suppkey * 71) % 1000 + 25 AS DOUBLE) AS y FROM supplier")
def _(spark, d):
    return corner_areas(spark, d).select("id", g.inside_point(C("rings")).alias("p")).select("id", "p.x", "p.y")


@query("join_intersection_len", f"WITH {_WALLS}, boxes AS (SELECT unnest(range(100)) AS area_id), o AS (SELECT area_id, w.id AS line_id, sqrt(35 * 35 + 21 * 21) * {_within('(area_id % 10) * 100, (area_id // 10) * 100, (area_id % 10) * 100 + 100, (area_id // 10) * 100 + 100', 'w')} AS overlap FROM boxes, walls w), "
       f"k AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY overlap DESC, line_id) AS n FROM o WHERE overlap > 0) SELECT area_id, line_id, {R('overlap', 'overlap')} FROM k WHERE n = 1")
def _(spark, d):
    boxes = spark.range(100).select("id", *(((C("id") % 10) * 100.0 + dx).alias(n) if n[0] == "x" else (F.floor(C("id") / 10) * 100.0 + dx).alias(n) for n, dx in (("x0", 0), ("y0", 0), ("x1", 100), ("y1", 100))))
    return spatial.longest_overlap(boxes, walls(spark, d)).select("area_id", "line_id", r4(C("overlap")).alias("overlap"))


#: Culverts' lengths within L-shaped areas: both arms less the corner they share.
_IN_CORNERS = (
    "bent AS (SELECT s_suppkey AS id, CAST((s_suppkey * 53) % 1000 AS DOUBLE) AS x, CAST((s_suppkey * 71) % 1000 AS DOUBLE) AS y FROM supplier), "
    f"{_CULV}, inl AS (SELECT a.id AS area_id, c.id AS line_id, sqrt(13 * 13 + 31 * 31) * ({_within('a.x, a.y, a.x + 40, a.y + 10')} + {_within('a.x, a.y, a.x + 10, a.y + 40')} - {_within('a.x, a.y, a.x + 10, a.y + 10')}) AS overlap FROM culv c, bent a), "
    "most AS (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY round(overlap, 6) DESC, line_id) AS n FROM inl WHERE overlap > 1e-9)"
)


@query("join_intersection_len_polygon", f"WITH {_IN_CORNERS} SELECT area_id, line_id, {R('overlap', 'overlap')} FROM most WHERE n = 1")
def _(spark, d):
    return spatial.longest_overlap(corner_areas(spark, d), short_lines(spark, d)).select("area_id", "line_id", r4(C("overlap")).alias("overlap"))


@query("join_score_group", f"WITH s AS ({_SC}), g AS (SELECT id, id % 50 AS dangling_id, CAST(ceil((1 + o + 2 * w + 4 * n + 8 * p) / 4.0) AS INTEGER) AS grp FROM s), m AS (SELECT *, min(grp) OVER (PARTITION BY dangling_id) AS lo FROM g) SELECT id, dangling_id FROM m WHERE grp = lo")
def _(spark, d):
    s = scored_parts(spark, d).select("id", (C("id") % 50).alias("dangling_id"), culverts.score_group(culverts.score(strict=True)).alias("grp"))
    return windows.group_minimum(s, "dangling_id", "grp").select("id", "dangling_id")


@query("join_point_on_node", f"{duck('net_nodes', 'pts_a')} SELECT a.id AS id, n.node_id AS node_id FROM pts_a a JOIN net_nodes n ON a.x = n.x AND a.y = n.y")
def _(spark, d):
    return view(spark, d, "pts_a").join(view(spark, d, "net_nodes"), ["x", "y"]).select("id", "node_id")


_JN = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "outer": "FULL JOIN"}
for _how, _j in _JN.items():
    SQL[f"join_equi_{_how}"] = f"WITH c AS (SELECT c_custkey AS k, c_nationkey AS v FROM customer WHERE c_custkey % 3 <> 0), o AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey % 2 = 0 GROUP BY o_custkey) SELECT coalesce(c.k, o.k) AS k, c.v AS v, o.n AS n FROM c {_j} o ON c.k = o.k"
    QUERIES[f"join_equi_{_how}"] = lambda spark, d, how=_how: t(spark, d, "customer").where("c_custkey % 3 <> 0").select(C("c_custkey").alias("k"), C("c_nationkey").alias("v")).join(t(spark, d, "orders").where("o_custkey % 2 = 0").groupBy(C("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n")), "k", how)
SQL["join_natural"] = "SELECT n_nationkey AS k, n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey"
QUERIES["join_natural"] = lambda spark, d: t(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey").join(F.broadcast(t(spark, d, "region")), "r_regionkey").select(C("n_nationkey").alias("k"), C("n_name").alias("name"), C("r_name").alias("region"))
SQL["join_semi"] = "SELECT c_custkey AS k FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)"
QUERIES["join_semi"] = lambda spark, d: t(spark, d, "customer").join(t(spark, d, "orders").where("o_totalprice > 200000"), C("c_custkey") == C("o_custkey"), "left_semi").select(C("c_custkey").alias("k"))
SQL["join_anti"] = "SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)"
QUERIES["join_anti"] = lambda spark, d: t(spark, d, "customer").join(t(spark, d, "orders").where("o_totalprice > 200000"), C("c_custkey") == C("o_custkey"), "left_anti").select(C("c_custkey").alias("k"))


# ---- aggregations ----

@query("agg_list_edges", f"{duck('net_edges', 'net_nodes')}, u AS (SELECT node_end AS k, string_agg(code, ',' ORDER BY code) AS l, count(*) AS n FROM net_edges GROUP BY node_end), s AS (SELECT node_start AS k, string_agg(code, ',' ORDER BY code) AS l, count(*) AS n FROM net_edges GROUP BY node_start) SELECT node_id, u.l AS upstream_edges, coalesce(u.n, 0) AS no_upstream_edges, s.l AS downstream_edges, coalesce(s.n, 0) AS no_downstream_edges FROM net_nodes LEFT JOIN u ON node_id = u.k LEFT JOIN s ON node_id = s.k")
def _(spark, d):
    n = network.edge_lists(view(spark, d, "net_nodes"), view(spark, d, "net_edges"))
    return n.select("node_id", F.array_join("upstream_edges", ",").alias("upstream_edges"), "no_upstream_edges", F.array_join("downstream_edges", ",").alias("downstream_edges"), "no_downstream_edges")


QUERIES["net_edge_lists"], SQL["net_edge_lists"] = QUERIES["agg_list_edges"], SQL["agg_list_edges"]


def annotated(spark: SparkSession, d: str) -> DataFrame:
    lines = net_lines(spark, d)
    nodes = network.edge_lists(view(spark, d, "net_nodes"), lines)
    return network.angle_lists(nodes, lines, g.angle_compass(C("coords"), "upstream"), g.angle_compass(C("coords"), "downstream"))


_ANG = "floor(degrees(atan2(bx - ax, \"by\" - ay)) * 10 + 0.5) / 10"


@query("agg_list_angles", f"{_NL}, e AS (SELECT n.code, node_start, node_end, {_ANG} AS a FROM nl n JOIN net_edges e ON n.code = e.code) SELECT node_end AS node_id, string_agg(CAST(CAST(a * 10 AS BIGINT) AS VARCHAR), ',' ORDER BY code) AS angles FROM e GROUP BY node_end")
def _(spark, d):
    lines = net_lines(spark, d)
    tenth = F.floor(g.angle_compass(C("coords"), "downstream") * 10 + 0.5)
    n = network.value_lists(view(spark, d, "net_nodes"), lines, tenth, tenth, "up", "down")
    return n.where("up is not null").select("node_id", F.array_join(F.transform("up", lambda v: v.cast("string")), ",").alias("angles"))


@query("agg_list_discharge", f"{duck('net_edges')} SELECT node_end AS node_id, string_agg(CAST(CAST(own AS BIGINT) AS VARCHAR), ',' ORDER BY code) AS discharges FROM net_edges GROUP BY node_end")
def _(spark, d):
    n = network.discharge_lists(view(spark, d, "net_nodes"), view(spark, d, "net_edges"), "own")
    return n.where("upstream_discharges is not null").select("node_id", F.array_join(F.transform("upstream_discharges", lambda v: v.cast("long").cast("string")), ",").alias("discharges"))


_RN = "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS rn FROM {tab}) WHERE rn = 1"


@query("agg_first_by_score", _RN.format(cols="o_custkey AS k, o_orderstatus AS s, o_orderkey AS id", k="o_custkey, o_orderstatus", o="o_totalprice, o_orderkey", tab="orders"))
def _(spark, d):
    return windows.keep_first(t(spark, d, "orders"), ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"]).select(C("o_custkey").alias("k"), C("o_orderstatus").alias("s"), C("o_orderkey").alias("id"))


_BL = "WITH p AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS DOUBLE) END AS a, CASE WHEN p_size % 4 > 0 THEN p_size * 0.8 END AS b, CASE WHEN p_size % 5 > 0 THEN CAST(60 - p_size AS DOUBLE) END AS c, CASE WHEN p_size % 7 > 0 THEN p_size * 0.5 END AS d FROM part), q AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN NULL WHEN a IS NULL THEN 1 WHEN b <= 0.75 * a THEN 1 ELSE 0 END AS s1 FROM p), r AS (SELECT *, CASE WHEN s1 IS NULL THEN CASE WHEN c IS NOT NULL THEN 2 END WHEN c <= 0.6 * CASE WHEN s1 = 0 THEN a ELSE b END THEN 2 ELSE s1 END AS s2 FROM q) SELECT id, CAST(CASE WHEN s2 = 2 AND d <= 0.75 * c THEN 3 WHEN s2 IN (0, 1) AND d <= 0.6 * CASE WHEN s2 = 0 THEN a ELSE b END AND (c IS NULL OR d <= 0.75 * c) THEN 3 WHEN s2 IS NULL AND d IS NOT NULL THEN 3 ELSE s2 END AS INTEGER) AS pick FROM r"


@query("agg_best_line", _BL)
def _(spark, d):
    s = C("p_size")
    p = t(spark, d, "part").select(C("p_partkey").alias("id"), F.when(s % 3 > 0, s.cast("double")).alias("a"), F.when(s % 4 > 0, s * 0.8).alias("b"), F.when(s % 5 > 0, (60 - s).cast("double")).alias("c"), F.when(s % 7 > 0, s * 0.5).alias("d"))
    return p.select("id", culverts.best_line(C("a"), C("b"), C("c"), C("d")).alias("pick"))


@query("agg_low_score_filter", "WITH s AS (SELECT p_partkey AS id, p_partkey % 200 AS dangling_id, p_size % 16 + 1 AS score FROM part), m AS (SELECT *, max(score) OVER (PARTITION BY dangling_id) AS hi FROM s) SELECT id FROM m WHERE hi < 9")
def _(spark, d):
    from pyspark.sql import Window as W

    s = t(spark, d, "part").select(C("p_partkey").alias("id"), (C("p_partkey") % 200).alias("dangling_id"), (C("p_size") % 16 + 1).alias("score"))
    return s.withColumn("hi", F.max("score").over(W.partitionBy("dangling_id"))).where("hi < 9").select("id")


@query("agg_pair_min", "SELECT a, b, id FROM (SELECT l_partkey AS a, l_suppkey AS b, l_orderkey * 10 + l_linenumber AS id, row_number() OVER (PARTITION BY least(l_partkey, l_suppkey), greatest(l_partkey, l_suppkey) ORDER BY l_quantity, l_orderkey * 10 + l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1")
def _(spark, d):
    l = t(spark, d, "lineitem").select(C("l_partkey").alias("a"), C("l_suppkey").alias("b"), F.struct("l_quantity", C("l_orderkey") * 10 + C("l_linenumber"), "l_partkey", "l_extendedprice").alias("q"), (C("l_orderkey") * 10 + C("l_linenumber")).alias("id"))
    return windows.pair_shortest(l, "a", "b", "q", "id").select("a", "b", "id")


@query("agg_dup_codes", f"{_NL}, {_ENDS} SELECT x, y, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM ends GROUP BY x, y HAVING count(DISTINCT code) > 1")
def _(spark, d):
    return culverts.touching_codes(net_lines(spark, d)).select("x", "y", F.array_join("codes", ",").alias("codes"))


@query("agg_list_geom_by_code", "SELECT n_regionkey AS k, string_agg(n_name, ',' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY n_regionkey")
def _(spark, d):
    return windows.ordered_list(t(spark, d, "nation"), "n_regionkey", "n_name", "n_nationkey", "names").select(C("n_regionkey").alias("k"), F.array_join("names", ",").alias("names"), C("n").cast("long").alias("n"))


@query("agg_endpoint_counts", f"{_NL}, {_ENDS} SELECT x, y, count(*) FILTER (WHERE line_type = 'dangling_start') AS n_start, count(*) FILTER (WHERE line_type = 'dangling_end') AS n_end, count(*) AS n FROM ends GROUP BY x, y")
def _(spark, d):
    return ln.endpoints(net_lines(spark, d)).select("x", "y", C("starting_line_count").alias("n_start"), C("ending_line_count").alias("n_end"), C("connected_line_count").alias("n"))


@query("agg_segments_regroup", "WITH e AS (SELECT user_id AS part, event_id AS o, event_type AS code, ts FROM events), f AS (SELECT *, CASE WHEN code <> lag(code) OVER (PARTITION BY part ORDER BY o) THEN 1 ELSE 0 END AS ch FROM e), r AS (SELECT *, sum(ch) OVER (PARTITION BY part ORDER BY o) AS run FROM f) SELECT part, CAST(run AS BIGINT) AS run, code, count(*) AS n FROM r GROUP BY part, run, code")
def _(spark, d):
    e = t(spark, d, "events").select(C("user_id").alias("part"), C("event_id").alias("o"), C("event_type").alias("code"))
    return windows.run_ids(e, "o", "code", "run").groupBy("part", "run", "code").agg(F.count(F.lit(1)).alias("n"))


QUERIES["win_run_id"] = lambda spark, d: windows.run_ids(t(spark, d, "events").select(C("user_id").alias("part"), C("event_id").alias("o"), C("event_type").alias("code")), "o", "code", "run").select("o", "run")
SQL["win_run_id"] = "WITH f AS (SELECT user_id, event_id AS o, CASE WHEN event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS ch FROM events) SELECT o, CAST(sum(ch) OVER (PARTITION BY user_id ORDER BY o) AS BIGINT) AS run FROM f"


@query("agg_tributaries", f"{duck('net_edges')} SELECT p.code AS code, count(*) AS n, min(q.code) AS first FROM net_edges p JOIN net_edges q ON q.node_end = p.node_start GROUP BY p.code")
def _(spark, d):
    e = view(spark, d, "net_edges")
    into = e.groupBy(C("node_end").alias("node_start")).agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("first"))
    return e.join(into, "node_start").select("code", "n", "first")


@query("agg_outflow_nodes", f"{duck('net_edges')} SELECT node_end AS node_id, string_agg(code, ',' ORDER BY code) AS codes, CAST(count(*) AS BIGINT) AS n FROM net_edges GROUP BY node_end")
def _(spark, d):
    return windows.ordered_list(view(spark, d, "net_edges"), "node_end", "code", "code", "codes").select(C("node_end").alias("node_id"), F.array_join("codes", ",").alias("codes"), C("n").cast("long").alias("n"))


@query("agg_first_downstream", _RN.format(cols="o_custkey AS k, o_orderkey AS id", k="o_custkey", o="o_orderstatus, o_orderpriority, o_orderkey", tab="orders"))
def _(spark, d):
    return windows.first_by(t(spark, d, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority", "o_orderkey"], ["o_orderkey"]).select(C("o_custkey").alias("k"), C("o_orderkey").alias("id"))


_ZON = f"{duck('cells')} SELECT zone, count(v) AS n, {R('avg(v)', 'mean')}, {R('sum(v)', 'total')} FROM cells GROUP BY zone"


def _zonal(spark, d):
    z = discharge.zonal(view(spark, d, "cells"))
    return z.select("zone", "n", r4(C("mean")).alias("mean"), r4(C("total")).alias("total"))


for _k in ("agg_zonal", "ras_zonal"):
    QUERIES[_k], SQL[_k] = _zonal, _ZON


@query("agg_dissolve_cells", f"{duck('cells')} SELECT zone // 5 AS target, count(*) AS n_cells, CAST(count(*) * 4 AS DOUBLE) AS area FROM cells GROUP BY zone // 5")
def _(spark, d):
    c = view(spark, d, "cells").select("r", "c", C("zone").alias("label"))
    m = spark.range(25).select(C("id").alias("label"), F.expr("id div 5").alias("target"))
    return raster.relabel(c, m).groupBy(C("label").alias("target")).agg(F.count(F.lit(1)).alias("n_cells"), (F.count(F.lit(1)) * 4.0).alias("area"))


#: The unit squares of L-shaped areas `owned` (k, id): of each key's union the area, the length of its outlines, and its parts as areas joined through equal squares or neighbours.
UNION_OF_CORNERS = (
    "squares AS (SELECT DISTINCT k, o.id AS id, (s_suppkey * 53) % 1000 + dx AS x, (s_suppkey * 71) % 1000 + dy AS y FROM owned o JOIN supplier ON s_suppkey = o.id, "
    "(SELECT unnest(range(40)) AS dx), (SELECT unnest(range(40)) AS dy) WHERE dx < 10 OR dy < 10), u AS (SELECT DISTINCT k, x, y FROM squares), "
    "shared AS (SELECT a.k AS k, count(*) AS n FROM u a JOIN u b ON a.k = b.k AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY a.k), "
    "sizes AS (SELECT k, count(*) AS n FROM u GROUP BY k), "
    "steps AS (SELECT 0 AS dx, 0 AS dy UNION ALL SELECT 1, 0 UNION ALL SELECT 0, 1), "
    "joined AS (SELECT DISTINCT a.k AS k, a.id AS a, b.id AS b FROM squares a, steps JOIN squares b ON a.k = b.k AND b.x = a.x + steps.dx AND b.y = a.y + steps.dy), "
    "both_ways AS (SELECT k, a, b FROM joined UNION SELECT k, b, a FROM joined), reach AS (SELECT k, a, b FROM both_ways UNION SELECT r.k, r.a, w.b FROM reach r JOIN both_ways w ON w.k = r.k AND w.a = r.b), "
    "parts AS (SELECT k, count(DISTINCT low) AS n FROM (SELECT k, a, min(b) AS low FROM reach GROUP BY k, a) GROUP BY k), "
    "unions AS (SELECT sizes.k AS k, parts.n AS n_parts, sizes.n::DOUBLE AS area, (4 * sizes.n - 2 * shared.n)::DOUBLE AS outline FROM sizes JOIN shared ON shared.k = sizes.k JOIN parts ON parts.k = sizes.k)"
)


def union_sizes(parts: DataFrame, key: str) -> DataFrame:
    """(key, n_parts, area, outline) of dissolved polygons."""
    long = F.aggregate(F.transform("rings", g.length), F.lit(0.0), lambda a, v: a + v)
    return parts.groupBy(key).agg(F.count(F.lit(1)).alias("n_parts"), r4(F.sum("area")).alias("area"), r4(F.sum(long)).alias("outline"))


@query("agg_dissolve", f"WITH RECURSIVE owned AS (SELECT s_suppkey % 5 AS k, s_suppkey AS id FROM supplier), {UNION_OF_CORNERS} SELECT k, n_parts, area, outline FROM unions")
def _(spark, d):
    return union_sizes(dissolve.dissolve(corner_areas(spark, d).withColumn("k", C("id") % 5), "k"), "k")


@query("agg_sum_edges_at_node", f"{duck('net_edges')} SELECT node_end AS node_id, sum(own) AS total FROM net_edges GROUP BY node_end")
def _(spark, d):
    return view(spark, d, "net_edges").groupBy(C("node_end").alias("node_id")).agg(F.sum("own").alias("total"))


@query("agg_duration_curve", "SELECT user_id AS station, floor((count(value) / 365.25) * 10000 + 0.5) / 10000 AS years, floor(quantile_cont(value, 0.9972621492128679) * 10000 + 0.5) / 10000 AS q_1, floor(quantile_cont(value, 0.9945242984257358) * 10000 + 0.5) / 10000 AS q_2, min(year(ts)) AS first_year FROM events GROUP BY user_id")
def _(spark, d):
    e = t(spark, d, "events").select(C("user_id").alias("station"), C("value").alias("q"), "ts")
    return discharge.duration_curve(e).select("station", r4(C("years")).alias("years"), r4(C("q_1")).alias("q_1"), r4(C("q_2")).alias("q_2"), C("first_year").cast("long").alias("first_year"))


@query("agg_len_by_category", f"{duck('net_edges')} SELECT CASE WHEN own / 500 >= 0.075 THEN 1 WHEN own / 500 >= 0.01 THEN 2 ELSE 3 END AS category, {R('sum(length)', 'len')} FROM net_edges GROUP BY 1")
def _(spark, d):
    return view(spark, d, "net_edges").groupBy(discharge.category(C("own") / 500).alias("category")).agg(r4(F.sum("length")).alias("len"))


@query("agg_value_counts", "SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def _(spark, d):
    return t(spark, d, "orders").groupBy(C("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("agg_distinct", "SELECT DISTINCT l_returnflag AS f, l_linestatus AS s FROM lineitem")
def _(spark, d):
    return t(spark, d, "lineitem").select(C("l_returnflag").alias("f"), C("l_linestatus").alias("s")).distinct()


# ---- windows, sorts, set operations ----

@query("win_unique_code_suffix", "SELECT o_orderkey AS id, CASE WHEN k > 0 THEN concat(o_orderpriority, '_', k) ELSE o_orderpriority END AS code FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS k FROM orders)")
def _(spark, d):
    return windows.unique_codes(t(spark, d, "orders").select(C("o_orderkey").alias("id"), C("o_orderpriority").alias("code")), "code", "id")


@query("win_dup_code_suffix", "SELECT o_orderkey AS id, CASE WHEN n > 1 THEN concat('c', o_custkey, '-', k) ELSE concat('c', o_custkey) END AS code FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)")
def _(spark, d):
    return windows.duplicate_suffix(t(spark, d, "orders").select(C("o_orderkey").alias("id"), F.concat(F.lit("c"), "o_custkey").alias("code")), "code", "id")


@query("win_split_suffix", "SELECT o_orderkey AS id, CASE WHEN n > 1 THEN concat('c', o_custkey, '-', k) ELSE concat('c', o_custkey) END AS code, CASE WHEN n > 1 THEN 'split' ELSE 'unchanged' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)")
def _(spark, d):
    return windows.duplicate_suffix(t(spark, d, "orders").select(C("o_orderkey").alias("id"), F.concat(F.lit("c"), "o_custkey").alias("code"), F.lit("unchanged").alias("status")), "code", "id", "status")


@query("win_shift_cumsum", "SELECT o_orderkey AS id, CAST(1 + coalesce(sum(o_orderkey % 4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS no FROM orders")
def _(spark, d):
    o = t(spark, d, "orders").withColumn("b", C("o_orderkey") % 4)
    return windows.shifted_sum(o, "o_custkey", "o_orderkey", "b", "no").select(C("o_orderkey").alias("id"), "no")


@query("win_tributary_rank", "SELECT o_orderkey AS id, o_orderkey % 3 + row_number() OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderkey) - 1 AS no FROM orders")
def _(spark, d):
    return windows.tributary_rank(t(spark, d, "orders").withColumn("no", C("o_orderkey") % 3), "o_custkey", "no", "o_orderkey").select(C("o_orderkey").alias("id"), "no")


@query("win_cumcount_other", "SELECT o_orderkey AS id, concat(o_orderstatus, '-X', CASE WHEN k < 1000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END) AS code FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders)")
def _(spark, d):
    n = windows.numbered(t(spark, d, "orders"), "o_orderstatus", "o_orderkey", "k")
    return n.select(C("o_orderkey").alias("id"), F.concat("o_orderstatus", F.lit("-X"), g.zfill(C("k"), 4)).alias("code"))


@query("win_outflow_number", "SELECT s_suppkey AS id, 100 * s_nationkey + row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS no FROM supplier")
def _(spark, d):
    ranges = spark.range(25).select(C("id").alias("authority"), (C("id") * 100).alias("order_code_min"), (C("id") * 100 + 39).alias("order_code_max"))
    pts = t(spark, d, "supplier").select(C("s_suppkey").alias("id"), C("s_nationkey").cast("string").alias("rws_code"), C("s_nationkey").cast("long").alias("authority"))
    return orders.outflow_numbers(pts, ranges).select("id", C("rws_code_no").alias("no"))


@query("win_keep_first_order", _RN.format(cols="l_partkey AS k, l_orderkey AS id", k="l_partkey", o="l_linenumber, l_orderkey", tab="lineitem"))
def _(spark, d):
    return windows.keep_first(t(spark, d, "lineitem"), ["l_partkey"], ["l_linenumber", "l_orderkey"]).select(C("l_partkey").alias("k"), C("l_orderkey").alias("id"))


@query("win_dedupe_hydro", "SELECT o_orderkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F') WHERE k = 1 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, d):
    o = t(spark, d, "orders")
    return windows.keep_first(o.where("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderpriority", "o_totalprice", "o_orderkey"]).unionByName(o.where("o_orderstatus <> 'F'")).select(C("o_orderkey").alias("id"))


@query("sort_topk", "SELECT p_partkey AS id, p_retailprice AS price FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def _(spark, d):
    return t(spark, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25).select(C("p_partkey").alias("id"), C("p_retailprice").alias("price"))


@query("set_union", "SELECT c_custkey AS id, c_acctbal AS bal, NULL AS extra FROM customer UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier")
def _(spark, d):
    return t(spark, d, "customer").select(C("c_custkey").alias("id"), C("c_acctbal").alias("bal")).unionByName(t(spark, d, "supplier").select(C("s_suppkey").alias("id"), C("s_acctbal").alias("bal"), C("s_name").alias("extra")), allowMissingColumns=True)


@query("set_dedupe", "SELECT id FROM (SELECT o_orderkey AS id, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n = 1")
def _(spark, d):
    return windows.keep_unique(t(spark, d, "orders"), ["o_custkey"]).select(C("o_orderkey").alias("id"))


@query("explode", f"{duck('lines')} SELECT id, CAST(count(*) AS BIGINT) AS n, {R('sum(v.x)', 'x')} FROM (SELECT id, unnest(coords) AS v FROM lines) GROUP BY id")
def _(spark, d):
    v = view(spark, d, "lines").select("id", F.explode("coords").alias("v"))
    return v.groupBy("id").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("v.x")).alias("x"))


def queries() -> dict[str, Query]:
    from brookflow.plans import network_queries, raster_queries, source_queries  # noqa: F401  they register themselves

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
