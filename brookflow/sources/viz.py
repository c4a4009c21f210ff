"""What maps need: classes with labels, label points, GeoJSON features in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookflow.functions import geometry as g


def categories(v: Column, thresholds: list[float], unit: str = "") -> Column:
    """Labels "<a", "a-b", ">b"; the lower bound belongs to a class."""
    tail = f" {unit}" if unit else ""
    out = F.lit(f">{thresholds[-1]}{tail}")
    for lo, hi in reversed(list(zip(thresholds, thresholds[1:], strict=False))):
        out = F.when(v < hi, f"{lo}-{hi}{tail}").otherwise(out)
    return F.when(v.isNotNull(), F.when(v < thresholds[0], f"<{thresholds[0]}{tail}").otherwise(out))


def equal_classes(df: DataFrame, column: str, classes: int = 20, out: str = "category") -> DataFrame:
    """Numbers 0 to classes - 1 of equal width between the column's least and greatest value (one row, broadcast)."""
    span = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    place = F.floor((F.col(column) - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / classes))
    return df.crossJoin(F.broadcast(span)).withColumn(out, F.when(F.col("_hi") > F.col("_lo"), F.least(place, F.lit(classes - 1))).otherwise(F.when(F.col(column).isNotNull(), F.lit(0))).cast("int")).drop("_lo", "_hi")


def labels(lines: DataFrame, text: str) -> DataFrame:
    """(x, y, label): the middle of each line and its text."""
    p = g.interpolate(F.col("coords"), g.length(F.col("coords")) / 2)
    return lines.select(p.alias("p"), F.col(text).cast("string").alias("label")).select("p.x", "p.y", "label")


def geojson(lines: DataFrame, properties: list[str]) -> DataFrame:
    """One feature per line as text (`value`); wrap them, comma-separated, in a FeatureCollection."""
    place = F.transform("coords", lambda p: F.array(g.rd_to_wgs84(p["x"], p["y"])["lon"], g.rd_to_wgs84(p["x"], p["y"])["lat"]))
    return lines.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("LineString").alias("type"), place.alias("coordinates")).alias("geometry"))).alias("value"))
