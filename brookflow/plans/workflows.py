"""The five workflows, from input layers to named result layers. Layers are Parquet tables below a result folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import culverts, discharge, flood, lines, lumping, network, orders, outlines, raster, spatial, windows
from brookflow.runtime import staged
from brookflow.sources import layers

LAYER = "code string, coords array<struct<x:double,y:double>>"


def prepared(raw: DataFrame, snapping: float = 0.05) -> DataFrame:
    """Lines of a case made ready: ids, status, snapped and split, without rings and repeats, codes unique."""
    numbered = raw.select("code", "coords", F.lit("unchanged").alias("status"), F.xxhash64(F.to_json("coords"), "code").alias("id"))
    split, _ = lines.preprocess(numbered, snapping)
    split = split.withColumn("id", F.xxhash64(F.to_json("coords"), "code"))
    return windows.unique_codes(lines.drop_closed_and_equal(split), "code", "id")


def run_culverts(
    spark: SparkSession, data: dict[str, DataFrame], results: str, *, distance_vertices: float = 10.0, max_culvert_length: float = 40.0,
    factor_angle_on_length: float = 2.0, attach_rest: bool = True,
) -> dict[str, DataFrame]:
    """data: hydroobject and overige_watergang (code, coords); optionally kering, snelweg, spoorweg, nwb (code, coords) and peilgebied (code, rings).

    Writes potential_culverts_0, _2 to _5, hydroobject_processed_0, outflow_nodes_overig and overige_watergang_processed_0 to
    _3 (and _3_nodes): ditches cut where culverts end, joined with their culverts, cut again where those end, and
    turned towards the nearest culvert into a channel; ditches without a way there are left out of _3. With attach_rest,
    culverts that the check of directions has turned away from their ditch are turned back and joined after the second cut.
    """
    hydro, other = staged(prepared(data["hydroobject"]), "hydro"), staged(prepared(data["overige_watergang"]), "other")

    def vertices(df: DataFrame, kind: str) -> DataFrame:
        return lines.line_to_vertices(df, distance_vertices).withColumn("WaterLineType", F.lit(kind))

    points = vertices(hydro, "hydroobject").unionByName(vertices(other, "overige_watergang"))
    points = staged(points.withColumn("id", F.concat_ws(":", "WaterLineType", "code", "line_type", F.col("distance_from_start").cast("string"))), "points")
    loose = windows.keep_unique(points.where("WaterLineType = 'overige_watergang' and line_type <> 'other'"), ["x", "y"])
    named = F.concat_ws(">", "dangling_id", "unique_id")
    found = culverts.candidates(loose, points, max_culvert_length).withColumn("id", named)  # as many as all pairs: written once, never read
    kinds = ["hydroobject", "overige_watergang"] + [k for k in ("kering", "snelweg", "spoorweg", "nwb") if k in data]
    barriers = [(hydro if k == "hydroobject" else other if k == "overige_watergang" else data[k]).select(F.lit(k).alias("kind"), "code", "coords") for k in kinds]
    walled = culverts.walls_near(loose, reduce(DataFrame.unionByName, [b for k, b in zip(kinds, barriers) if k in culverts.BARRIERS]), max_culvert_length)
    left = staged(culverts.candidates(staged(walled, "walled"), points, max_culvert_length).withColumn("id", named), "left")
    hit = spatial.barrier_crossings(left.select("id", "coords", "code", "dangling_code"), reduce(DataFrame.unionByName, barriers), max_culvert_length)
    flags = hit.groupBy("id").agg(*(F.bool_or(F.col("kind") == k).alias(f"crossings_{k}") for k in kinds))
    tested = left.join(flags, "id", "left").na.fill(False, [f"crossings_{k}" for k in kinds])
    if "peilgebied" in data:
        hit = spatial.polygon_crossings(left.select("id", "coords"), data["peilgebied"].select(F.col("code").alias("id"), "rings")).select(F.col("l_id").alias("id"), F.lit(True).alias("crossings_peilgebied")).distinct()
        tested = tested.join(hit, "id", "left")
    for flag in ("crossings_nwb", "crossings_peilgebied"):
        if flag not in tested.columns:
            tested = tested.withColumn(flag, F.lit(False))
    open_ = staged(culverts.keep_uncrossed(tested).withColumn("score", culverts.score()).where("score is not null"), "open")
    measured = culverts.add_geometry(open_, other, factor_angle_on_length)
    chosen = staged(culverts.select_best(measured, max_culvert_length), "chosen")
    both = hydro.select("code", "coords").unionByName(other.select("code", "coords"))
    kept = staged(culverts.post_process(chosen, culverts.touching_pairs(chosen, both)), "kept")

    def ends(kind: str) -> DataFrame:
        last = kept.where((F.col("line_type") == "other") & (F.col("WaterLineType") == kind)).select(g.end_point(F.col("coords")).alias("p"))
        return last.select("p.x", "p.y")

    hydro_0 = staged(lines.split_at_points(hydro.select("code", "status", "coords"), ends("hydroobject")), "hydro-cut")
    other_0 = staged(lines.split_at_points(other.select("code", F.col("code").alias("base_code"), "status", "coords"), ends("overige_watergang")), "other-cut")
    outflows = kept.where("WaterLineType = 'hydroobject'").select(g.end_point(F.col("coords")).alias("p"), "unique_id", "dangling_code").select("p.x", "p.y", "unique_id", "dangling_code")
    turned = staged(culverts.oriented(kept, hydro_0.select("code", "coords").unionByName(other_0.select("code", "coords"))), "turned")
    other_1 = staged(culverts.combine_with_lines(other_0, turned), "combined")
    other_2 = lines.split_at_points(other_1, lines.endpoints(other_1).select("x", "y"))
    if attach_rest:
        rest = culverts.left_out(other_0, turned).withColumn("coords", F.reverse("coords"))
        other_2 = culverts.combine_with_lines(staged(other_2, "cut-again"), rest)
    other_2 = staged(other_2, "joined")
    made = {
        "potential_culverts_0": found, "potential_culverts_2": open_, "potential_culverts_3": chosen, "potential_culverts_4": kept, "potential_culverts_5": turned,
        "hydroobject_processed_0": hydro_0, "overige_watergang_processed_0": other_0, "overige_watergang_processed_1": other_1, "overige_watergang_processed_2": other_2, "outflow_nodes_overig": outflows,
    }
    if not other_2.isEmpty():
        nodes, edges = network.build(with_edge_ids(other_2))
        reached = staged(network.shortest(edges, nodes.join(outflows.select("x", "y").distinct(), ["x", "y"]).select("node_id"), "geometry_len"), "reached")
        named = reached.select("node_id", F.col("source").alias("outflow_nodes_hydro"), F.col("dist").alias("outflow_nodes_hydro_dist"))
        made["overige_watergang_processed_3_nodes"] = nodes.join(named, "node_id", "left").na.fill(-999, ["outflow_nodes_hydro"])
        made["overige_watergang_processed_3"] = network.redirect(edges, reached)
    layers.write_layers(made, results)
    return layers.read_layers(spark, results, list(made))


def annotated_network(hydro: DataFrame, discharge_column: str = "total_specifieke_afvoer") -> tuple[DataFrame, DataFrame]:
    """(nodes with lists and selected edges, edges) of hydro(code, edge_id, coords, ...): by discharge where the lines have it, else by angle."""
    nodes, edges = network.build(hydro)
    nodes = network.edge_lists(nodes, edges)
    nodes = network.angle_lists(nodes, edges, g.angle_compass(F.col("coords"), "upstream"), g.angle_compass(F.col("coords"), "downstream"))
    nodes = network.discharge_lists(nodes, edges, discharge_column)
    return staged(network.select_main(nodes), "nodes"), staged(edges, "edges")


def run_orders(spark: SparkSession, data: dict[str, DataFrame], results: str, *, max_order_no: int = 100, range_outflow: float = 50.0, order_for_each_edge: bool = False) -> dict[str, DataFrame]:
    """data: hydroobject (code, edge_id, coords), outflow_nodes (id, x, y, order_code, rws_code), optionally other (code, outflow x, y). Writes nodes_hydro, edges_hydro and edges_overig."""
    nodes, edges = annotated_network(data["hydroobject"])
    dead = network.dead_ends(edges).join(nodes.select("node_id", "x", "y"), "node_id").select(F.col("node_id").alias("id"), "x", "y")
    at = orders.outflows_near_dead_ends(dead, data["outflow_nodes"], range_outflow)
    outs = staged(windows.keep_first(at.join(edges.select("code", "node_end"), "node_end"), ["code"], ["distance", "id"]).select("code", "order_code", "rws_code"), "outflows")
    numbered = staged(orders.order_numbers(nodes, edges, outs, max_order_no), "numbered")
    coded = orders.order_codes(numbered, outs, order_for_each_edge)
    made = {"nodes_hydro": nodes, "edges_hydro": coded}
    if "other" in data:
        points = data["other"].join(nodes.select("x", "y", "node_id"), ["x", "y"]).select(F.col("code").alias("point_id"), "x", "y", "node_id")
        made["edges_overig"] = orders.other_waterlines(points, coded, data["other"].select("code", F.col("code").alias("outflow_node")))
    layers.write_layers(made, results)
    return layers.read_layers(spark, results, list(made))


def preprocess_terrain(cells: DataFrame, waterways: DataFrame, cell: float, *, width: float = 2.5, depth: float = 0.5, half: float = 100.0, burn: float = 10.0) -> DataFrame:
    """Terrain cells (r, c, v) lowered towards the waterways (id, coords) and burnt in on them."""
    wet = raster.rasterize_lines(waterways, cell, width).select("r", "c", F.lit(True).alias("wet"))
    marked = cells.join(wet, ["r", "c"], "left").select("r", "c", "v", F.coalesce("wet", F.lit(False)).alias("wet"))
    dist = raster.distance_transform(marked.select("r", "c", F.col("wet").alias("v")), cell)
    return raster.smooth_burn(marked.join(dist, ["r", "c"]), depth, half, burn).select("r", "c", "v")


def drainage_units(terrain: DataFrame, waterways: DataFrame, cell: float, *, width: float = 2.5, max_depth: float | None = None) -> DataFrame:
    """(r, c, label): the waterway (id) that each cell drains to, over filled terrain and what is level in it; labels are ids plus one, as 0 is no label."""
    filled = staged(flood.fill_depressions(terrain, max_depth), "filled")
    wet = raster.rasterize_lines(waterways, cell, width).select("r", "c", (F.col("id") + 1).alias("label"))
    return raster.basins(staged(flood.flow_filled(filled), "flow"), wet.join(terrain.select("r", "c"), ["r", "c"]))


def run_drainage(spark: SparkSession, data: dict[str, DataFrame], results: str, *, cell: float = 2.0, max_depth: float | None = None) -> dict[str, DataFrame]:
    """data: topo (r, c, v), waterways (id, code, coords, downstream_edges, order_code, downstream_order_code). Writes afvoergebied_0 (cells), afvoergebied_0_gdf (a polygon per part, with its unit's area and number of parts) and the units' levels."""
    ways = data["waterways"]
    terrain = staged(preprocess_terrain(data["topo"], ways.select("id", "coords"), cell), "terrain")
    cells = staged(drainage_units(terrain, ways.select("id", "coords"), cell, max_depth=max_depth), "units")
    units = staged(raster.polygonize(cells, cell), "areas")
    shapes = outlines.outlines(cells, cell).join(units.select("label", F.col("area").alias("drainage_unit_area"), "n_parts"), "label")
    keys = ways.select((F.col("id") + 1).alias("label"), "code", "downstream_edges", "order_code", "downstream_order_code")
    made = {"afvoergebied_0": cells, "afvoergebied_0_gdf": shapes.join(keys.select("label", "code"), "label", "left"), "afvoergebied_levels": raster.levels(units.select("label", "area"), keys)}
    layers.write_layers(made, results)
    return layers.read_layers(spark, results, list(made))


def run_discharge(spark: SparkSession, data: dict[str, DataFrame], results: str, *, cell: float = 2.0, uniform: float | None = None) -> dict[str, DataFrame]:
    """data: edges (code, node_start, node_end, length[, coords]), optionally zones (r, c, code) with rain (r, c, v), or areas (code, area) for a uniform discharge; user_splits and nodes; supply (id, x, y). Writes edges with their accumulated discharge."""
    edges = data["edges"]
    units = None
    if "zones" in data:
        summed = discharge.zonal(data["zones"].join(data["rain"], ["r", "c"]), "v", "code")
        units = summed.select("code", discharge.zone_discharge(F.col("total"), cell).alias("specifieke_afvoer"))
    elif uniform is not None:
        units = data["areas"].groupBy("code").agg(F.sum(discharge.homogeneous_discharge(F.col("area"), uniform)).alias("specifieke_afvoer"))
    flowing = discharge.edge_discharge(edges, units)
    overrides = None
    if "user_splits" in data:
        split = network.angle_lists(network.edge_lists(data["nodes"], edges), edges, g.angle_compass(F.col("coords"), "upstream"), g.angle_compass(F.col("coords"), "downstream"))
        overrides = discharge.split_overrides(split.where("no_downstream_edges > 1 and no_upstream_edges > 0"), data["user_splits"])
    flowing = network.split_factors(flowing, overrides)
    excluded = discharge.supply_edges(edges, data["supply"]) if "supply" in data else None
    made = {"edges": discharge.accumulate_discharge(flowing, excluded)}
    layers.write_layers(made, results)
    return layers.read_layers(spark, results, list(made))


def run_lumping(spark: SparkSession, data: dict[str, DataFrame], results: str, *, direction: str = "upstream") -> dict[str, DataFrame]:
    """data: points (id, x, y), nodes, edges, areas (code, area[, rings]). Writes the membership of edges in sub-basins, the split points that need a decision, each sub-basin's area and, of areas with rings, its polygons."""
    members, at = lumping.upstream_of_nodes(data["points"], data["nodes"], data["edges"], direction)
    members = staged(members.withColumnRenamed("node_id", "outflow_id"), "members")  # of nodes: points at one node have the same edges, areas and polygons

    def named(df: DataFrame) -> DataFrame:
        return lumping.by_outflow(df.withColumnRenamed("outflow_id", "node_id"), at)

    made = {"membership": named(members), "inflow_outflow_splits": network.split_points(data["edges"], members), "inflow_outflow_areas": named(lumping.areas_by_code(data["areas"], members))}
    if "rings" in data["areas"].columns:
        made["inflow_outflow_areas_dissolved"] = named(staged(lumping.dissolved_areas(data["areas"], members), "dissolved"))
    layers.write_layers(made, results)
    return layers.read_layers(spark, results, list(made))


def with_edge_ids(df: DataFrame) -> DataFrame:
    """Ordinals in order of code for lines that have none."""
    return network.dense_ids(df, "code", "edge_id")
