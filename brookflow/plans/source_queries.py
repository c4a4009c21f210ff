"""Registered queries of scans, sinks and map data: round trips through files in the shared folder."""

from __future__ import annotations

import os
import tempfile
from urllib.parse import urlparse

from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.plans.derive import duck, view
from brookflow.plans.queries import _LEN, QUERIES, SQL, C, R, net_lines, query, r4, t
from brookflow.runtime import new_dir
from brookflow.sources import gpkg, grid, layers, settings, viz

_LL = f"{duck('lines')} SELECT id, {R(_LEN, 'v')} FROM lines"


@query("sink_layers", _LL)
def _(spark, d):
    out = new_dir(spark, "case")
    layers.write_layers({"lines": view(spark, d, "lines"), "absent": None}, out)
    return layers.read_layers(spark, out, ["lines"])["lines"].select("id", r4(g.length(C("coords"))).alias("v"))


QUERIES["src_required"], SQL["src_required"] = QUERIES["sink_layers"], SQL["sink_layers"]


@query("src_vector", "SELECT s_suppkey AS id, 'N' || CAST(s_nationkey AS VARCHAR) AS code, 700.0::DOUBLE AS area FROM supplier")
def _(spark, d):
    """L-shaped areas as polygons of a GeoPackage, 40 wide and high, 10 thick, in the shared folder: one of files, as sqlite3 opens no other."""
    from brookflow.plans.queries import corner_areas

    areas = corner_areas(spark, d).join(t(spark, d, "supplier").select(C("s_suppkey").alias("id"), F.concat(F.lit("N"), "s_nationkey").alias("code")), "id")
    place = urlparse(new_dir(spark, "gpkg"))
    if place.scheme not in ("", "file"):
        raise ValueError(f"a GeoPackage can't be written to {place.scheme}")
    os.makedirs(place.path)
    path = place.path + "/areas.gpkg"
    gpkg.write(areas, path, "areas")
    return gpkg.read(spark, path, "areas").select("id", "code", g.area(C("rings")).alias("area"))


@query("src_raster", f"{duck('cells')} SELECT r, c, {R('v', 'v')} FROM cells")
def _(spark, d):
    out = new_dir(spark, "grid")
    cells = view(spark, d, "cells").select("r", "c", "v")
    grid.write_ascii(cells, out, 100, cells.agg(F.max("r")).first()[0] + 1, 2.0)
    return grid.read_ascii(spark, out)[0].select("r", "c", r4(C("v")).alias("v"))


for _k in ("src_topo", "src_discharge"):
    QUERIES[_k], SQL[_k] = QUERIES["src_raster"], SQL["src_raster"]


@query("src_csv", "SELECT n_name AS authority, n_nationkey * 40 AS order_code_min, n_nationkey * 40 + 39 AS order_code_max FROM nation")
def _(spark, d):
    out = new_dir(spark, "csv")
    t(spark, d, "nation").select(C("n_name").alias("authority"), (C("n_nationkey") * 40).alias("order_code_min"), (C("n_nationkey") * 40 + 39).alias("order_code_max")).write.csv(out, sep=";", header=True)
    return layers.read_order_ranges(spark, out)


@query("src_csv_ts", "SELECT CASE WHEN k = 1 THEN 'a' ELSE 'b' END AS station, count(*) AS n, count(CASE WHEN o_custkey % 5 > 0 OR k = 2 THEN 1 END) AS known FROM orders, (SELECT unnest([1, 2]) AS k) GROUP BY k")
def _(spark, d):
    out = new_dir(spark, "csv")
    o = t(spark, d, "orders")
    o.select(F.date_format("o_orderdate", "dd-MM-yyyy HH:mm").alias("tijd"), F.when(C("o_custkey") % 5 > 0, C("o_totalprice")).otherwise(-999.0).alias("a"), C("o_totalprice").alias("b")).write.csv(out, sep=";", header=True)
    return layers.read_measurements(spark, out, ["a", "b"]).where("ts is not null").groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.count("q").alias("known"))


@query("src_toml", "SELECT 'hydro' AS dataset, 'hydro.gpkg' AS file")
def _(spark, d):
    with tempfile.NamedTemporaryFile("w", suffix=".toml") as f:
        f.write('[case]\nname = "x"\n[networkdata]\nfile_name_hydro = "hydro.gpkg"\n[generator_basis]\nlimit = 1\n')
        f.flush()
        made = settings.load_settings(f.name, "generator_basis").datasets()
    return spark.createDataFrame(list(made.items()), "dataset string, file string")


@query("viz_classify", f"WITH s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part) SELECT p_partkey AS id, CAST(least(floor((p_retailprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS category FROM part, s")
def _(spark, d):
    return viz.equal_classes(t(spark, d, "part"), "p_retailprice").select(C("p_partkey").alias("id"), "category")


@query("viz_labels", f"{duck('net_edges', 'net_nodes')} SELECT code AS label, {R('(a.x + b.x) / 2', 'x')}, {R('(a.y + b.y) / 2', 'y')} FROM net_edges e JOIN net_nodes a ON e.node_start = a.node_id JOIN net_nodes b ON e.node_end = b.node_id")
def _(spark, d):
    return viz.labels(net_lines(spark, d), "code").select("label", r4(C("x")).alias("x"), r4(C("y")).alias("y"))


@query("viz_geojson")
def _(spark, d):
    return viz.geojson(net_lines(spark, d), ["code", "own"])


@query("src_case", "SELECT '0_basisdata' AS data, '1_resultaat' AS results")
def _(spark, d):
    from pathlib import Path

    with tempfile.TemporaryDirectory() as case:
        (Path(case) / "0_basisdata").mkdir()
        made = [p.name for p in settings.check_case(case)]
    return spark.createDataFrame([tuple(made)], "data string, results string")


@query("src_xlsx_tables", "SELECT n_name AS name, CAST(n_nationkey AS DOUBLE) AS k FROM nation")
def _(spark, d):
    from brookflow.sources import xlsx

    with tempfile.NamedTemporaryFile(suffix=".xlsx") as f:
        xlsx.write_tables(f.name, {"Nations": t(spark, d, "nation").select(C("n_name").alias("name"), C("n_nationkey").alias("k"))})
        return xlsx.read_table(spark, f.name, "Nations")


QUERIES["sink_xlsx_tables"], SQL["sink_xlsx_tables"] = QUERIES["src_xlsx_tables"], SQL["src_xlsx_tables"]


@query("src_xlsx_sheet", "SELECT n_name AS station, CASE WHEN n_nationkey % 3 > 0 THEN CAST(n_nationkey AS DOUBLE) END AS level FROM nation")
def _(spark, d):
    """A plain sheet of measurements, in which -999 stands for none."""
    from brookflow.sources import xlsx

    level = F.when(C("n_nationkey") % 3 > 0, C("n_nationkey")).otherwise(-999).cast("double")
    with tempfile.NamedTemporaryFile(suffix=".xlsx") as f:
        xlsx.write_tables(f.name, {"Stations": t(spark, d, "nation").select(C("n_name").alias("station"), level.alias("level"))})
        return xlsx.read_sheet(spark, f.name, "Stations").select("station", F.nullif("level", F.lit(-999.0)).alias("level"))
