"""Layers of a case: named Parquet tables, written by one workflow and read by the next; and delimited text."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

log = logging.getLogger(__name__)


def write_layers(layers: dict[str, DataFrame | None], results: str) -> list[str]:
    """Overwrite each layer below the result folder; None is logged and skipped, other things raise ValueError."""
    done = []
    for name, df in layers.items():
        if df is None:
            log.info("layer %s isn't there", name)
        elif not isinstance(df, DataFrame):
            raise ValueError(f"layer {name} is a {type(df).__name__}")
        else:
            df.write.mode("overwrite").parquet(f"{results}/{name}")
            done.append(name)
    return done


def read_layers(spark: SparkSession, results: str, names: list[str]) -> dict[str, DataFrame]:
    """The layers that exist; missing ones are logged."""
    found = {}
    for name in names:
        try:
            found[name] = spark.read.parquet(f"{results}/{name}")
        except AnalysisException:
            log.info("layer %s isn't there", name)
    return found


def read_vector(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame | None:
    """A vector file by its suffix (.gpkg, else Parquet); None, logged, where there is none."""
    try:
        if path.endswith(".gpkg"):
            from brookflow.sources import gpkg

            return gpkg.read(spark, path, layer)
        return spark.read.parquet(path)
    except (AnalysisException, FileNotFoundError):
        log.info("%s isn't there", path)
        return None


def read_order_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon table of authorities and their ranges of outflow numbers."""
    return spark.read.csv(path, sep=";", header=True, schema="authority string, order_code_min int, order_code_max int")


def read_measurements(spark: SparkSession, path: str, stations: list[str], ts: str = "tijd", sep: str = ";", fmt: str = "dd-MM-yyyy HH:mm", missing: float = -999.0) -> DataFrame:
    """A wide table of stations as (station, ts, q), the missing mark as null."""
    schema = ", ".join([f"`{ts}` string", *(f"`{s}` double" for s in stations)])
    wide = spark.read.csv(path, sep=sep, header=True, schema=schema).withColumn(ts, F.to_timestamp(ts, fmt))
    return wide.unpivot([ts], stations, "station", "q").select("station", F.col(ts).alias("ts"), F.when(F.col("q") != missing, F.col("q")).alias("q"))
