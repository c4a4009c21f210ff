"""Sub-basins upstream of given outflow points, with directions at splits, and their areas."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookflow.operators import dissolve, network, spatial
from brookflow.runtime import staged
from brookflow.sources import layers

log = logging.getLogger(__name__)
#: The layer of split points that wait for a decision, and its columns (an interface).
DETECTED = "inflow_outflow_splits_detected"
DETECTED_COLUMNS = ("node_id", "downstream_edges", "no_downstream_edges", "downstream_edge", "upstream_edges", "no_upstream_edges", "upstream_edge", "x", "y")


def outflow_edges(points: DataFrame, nodes: DataFrame, edges: DataFrame, direction: str = "upstream") -> DataFrame:
    """(outflow_id, code, node_id): the edges at the node nearest to each point (id, x, y)."""
    at = spatial.nearest(points, nodes.select(F.col("node_id").alias("id"), "x", "y")).select(F.col("l_id").alias("outflow_id"), F.col("r_id").alias("node_id"))
    side = "node_end" if direction == "upstream" else "node_start"
    return at.join(edges.select("code", F.col(side).alias("node_id")), "node_id").select("outflow_id", "code", "node_id")


def upstream_of_nodes(points: DataFrame, nodes: DataFrame, edges: DataFrame, direction: str = "upstream") -> tuple[DataFrame, DataFrame]:
    """((node_id, code), (outflow_id, node_id)): the edges up to the other points' nodes from each node that has points, and whose points these are. Points at one node have the same edges, which are traced once."""
    first = staged(outflow_edges(points, nodes, edges, direction), "outflow-edges")
    at = first.select("outflow_id", "node_id").distinct()
    starts = first.select(F.col("node_id").alias("outflow_id"), "code").distinct()
    traced = network.trace(edges, starts, starts.select(F.col("outflow_id").alias("node_id")).distinct(), direction)
    return traced.select(F.col("outflow_id").alias("node_id"), "code"), at


def by_outflow(by_node: DataFrame, at: DataFrame) -> DataFrame:
    """by_node(node_id, ...) for every outflow_id of at(outflow_id, node_id). A node's rows are dealt out over all tasks, as one may have most edges and many outflows."""
    n = int(by_node.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in by_node.columns if c != "node_id"]
    dealt = by_node.withColumn("_b", F.pmod(F.xxhash64(*others), F.lit(n)).cast("int")).repartition(n, "node_id", "_b")
    each = at.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).repartition(n, "node_id", "_b")
    return dealt.hint("merge").join(each, ["node_id", "_b"]).select("outflow_id", *others)


def upstream_of_points(points: DataFrame, nodes: DataFrame, edges: DataFrame, direction: str = "upstream") -> DataFrame:
    """(outflow_id, code): each point's edges up to the other points' nodes."""
    return by_outflow(*upstream_of_nodes(points, nodes, edges, direction))


def split_direction_by_angle(nodes: DataFrame) -> DataFrame:
    """Per node the downstream edge whose angle is nearest to the first upstream angle."""
    from brookflow.functions import geometry as g

    best = g.smallest_angle(F.get("upstream_angles", F.lit(0)), F.col("downstream_angles"), F.col("downstream_edges"))
    return nodes.withColumn("selected_downstream_edge", best["code"])


def export_split_points(splits: DataFrame | None, results: str) -> None:
    """Write the detected split points (nodes with their lists of edges) with fixed columns; downstream_edge and upstream_edge are empty where they aren't decided. None is logged."""
    if splits is None:
        log.info("no split points are detected yet")
        return
    for name in ("downstream_edge", "upstream_edge"):
        if name not in splits.columns:
            splits = splits.withColumn(name, F.lit(None).cast("string"))
    layers.write_layers({DETECTED: splits.select(*DETECTED_COLUMNS)}, results)


def areas_by_code(areas: DataFrame, membership: DataFrame) -> DataFrame:
    """(outflow_id, n_areas, area) of areas(code, area) by the outflow of their edge."""
    return areas.join(membership, "code").groupBy("outflow_id").agg(F.count(F.lit(1)).alias("n_areas"), F.sum("area").alias("area"))


def dissolved_areas(areas: DataFrame, membership: DataFrame, min_hole: float = 50.0) -> DataFrame:
    """(outflow_id, part, rings, area): the areas(code, rings) of each outflow's edges as polygons, a row per part, without holes of min_hole and less."""
    named = areas.join(membership, "code").select("outflow_id", F.col("code").alias("id"), "rings").dropDuplicates(["outflow_id", "id"])
    return dissolve.dissolve(named, "outflow_id", min_hole=min_hole)


def areas_by_overlap(areas: DataFrame, lines: DataFrame, membership: DataFrame) -> DataFrame:
    """(outflow_id, n_areas): areas (polygons or boxes) by the outflow of the line (id = membership's code) with most length in them."""
    best = spatial.longest_overlap(areas, lines)
    return best.hint("merge").join(membership, best["line_id"] == membership["code"]).groupBy("outflow_id").agg(F.count(F.lit(1)).alias("n_areas"))
