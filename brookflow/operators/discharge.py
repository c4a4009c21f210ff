"""Design discharge: zonal statistics, units, splits with user overrides, supply structures, and accumulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.functions import geometry as g
from brookflow.operators import network, spatial


def zonal(cells: DataFrame, value: str = "v", zone: str = "zone") -> DataFrame:
    """(zone, n, mean, total) of cells."""
    return cells.groupBy(zone).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.sum(value).alias("total"))


def zone_discharge(total_mm_per_day: Column, cell: float = 2.0) -> Column:
    """m3/s of a zone's summed daily millimetres of discharge; null counts as none."""
    return F.coalesce(total_mm_per_day * (cell * cell) / 1000 / 24 / 3600, F.lit(0.0))


def homogeneous_discharge(area: Column, q: float) -> Column:
    """An area's share of a uniform q, in the unit of the original workflow (a day's volume, though it was called m3/s)."""
    return area / 10000 * q / 1000 * 24 * 3600


def edge_discharge(edges: DataFrame, units: DataFrame | None) -> DataFrame:
    """edges with specifieke_afvoer from units(code, specifieke_afvoer), 0 where there is none; without units, length / 1000."""
    if units is None:
        return edges.withColumn("specifieke_afvoer", F.col("length") / 1000)
    return edges.join(units.select("code", "specifieke_afvoer"), "code", "left").na.fill(0.0, ["specifieke_afvoer"])


def split_overrides(splits: DataFrame, user: DataFrame, radius: float = 5.0) -> DataFrame:
    """(code, dist) of splits(node_id, x, y, downstream_edges, downstream_angles) that have a user split (id, x, y, angles, factors) within the radius.

    The user's list is taken as it is, or reversed if that fits the angles better or as well.
    """
    near = spatial.nearest(splits.select(F.col("node_id").alias("id"), "x", "y"), user.select("id", "x", "y"), radius)
    both = near.join(splits, F.col("l_id") == F.col("node_id")).join(user.select(F.col("id").alias("r_id"), "angles", "factors"), "r_id")

    def off(angles: Column) -> Column:
        return F.pmod(F.aggregate(F.zip_with("downstream_angles", angles, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + v), F.lit(360.0))

    factors = F.when(off(F.col("angles")) < off(F.reverse("angles")), F.col("factors")).otherwise(F.reverse("factors"))
    return both.select(F.explode(F.arrays_zip(F.col("downstream_edges").alias("code"), factors.alias("dist"))).alias("z")).select("z.code", "z.dist")


def supply_edges(edges: DataFrame, structures: DataFrame, radius: float = 1.0) -> DataFrame:
    """(code) of edges(code, coords) within the radius of a supply structure (id, x, y)."""
    places = structures.select("x", "y").distinct().withColumn("id", F.xxhash64("x", "y"))
    hit = spatial.points_on_lines(places, edges.select(F.col("code").alias("id"), "coords"), radius)
    return hit.select(F.col("r_id").alias("code")).distinct()


def accumulate_discharge(edges: DataFrame, excluded: DataFrame | None = None, factor: str | None = "downstream_splits_dist") -> DataFrame:
    """edges with total_specifieke_afvoer and its log10 (null if not above 0); excluded codes stay out of the sum and get 0."""
    inside = edges if excluded is None else edges.join(excluded, "code", "left_anti")
    out = network.accumulate(inside, "specifieke_afvoer", factor).withColumnRenamed("total", "total_specifieke_afvoer")
    if excluded is not None:
        out = out.unionByName(edges.join(excluded, "code", "left_semi").withColumns({"specifieke_afvoer": F.lit(0.0), "total_specifieke_afvoer": F.lit(0.0), "unresolved": F.lit(False)}))
    return out.withColumn("log10_total_specifieke_afvoer", g.log10_or_null(F.col("total_specifieke_afvoer")))


def category(q: Column) -> Column:
    return F.when(q >= 0.075, 1).when(q >= 0.010, 2).otherwise(3)


def valid_measurement(q: Column, cap: Column | None = None, least: float = 0.0001) -> Column:
    """q where it is above `least` (and at most a station's cap), else null."""
    return F.when((q > least) & (F.lit(True) if cap is None else F.coalesce(q <= cap, F.lit(True))), q)


def duration_curve(measured: DataFrame, station: str = "station", q: str = "q", ts: str = "ts") -> DataFrame:
    """Per station: years of data, the discharge exceeded on one and on two days a year, first and last year."""
    p = F.percentile(q, F.array(F.lit(1 - 1 / 365.25 * 1.0), F.lit(1 - 2 / 365.25 * 1.0)))
    return measured.where(F.col(q).isNotNull()).groupBy(station).agg((F.count(q) / 365.25).alias("years"), p.alias("_p"), F.min(F.year(ts)).alias("first_year"), F.max(F.year(ts)).alias("last_year")).select(station, "years", F.get("_p", F.lit(0)).alias("q_1"), F.get("_p", F.lit(1)).alias("q_2"), "first_year", "last_year")
