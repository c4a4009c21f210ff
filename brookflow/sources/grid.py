"""ESRI ASCII grids as cells(r, c, v), read and written by Spark's text files; rows count from the top, as in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEADER = ("ncols", "nrows", "xllcorner", "yllcorner", "cellsize", "nodata_value")


def read_ascii(spark: SparkSession, path: str, band: int = 1) -> tuple[DataFrame, dict[str, float]]:
    """(cells without nodata, header) of a file, or of a folder of files in order of their names. The format has one band; another raises ValueError."""
    if band != 1:
        raise ValueError("an ASCII grid has one band")
    text = spark.read.text(path)
    head = {r[0].split()[0].lower(): float(r[0].split()[1]) for r in text.where("value rlike '^\\\\s*[A-Za-z]'").collect()}
    # rows are numbered within the block of a file that a task reads, and blocks by what lies before them
    block = ["_file", "_at"]
    rows = text.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at")).where("NOT value rlike '^\\\\s*[A-Za-z]' AND trim(value) <> ''")
    before = F.coalesce(F.sum("n").over(W.orderBy(*block).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per block
    counts = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n")).select(*block, before.alias("before"))
    own = rows.withColumn("_o", F.monotonically_increasing_id()).withColumn("nth", F.row_number().over(W.partitionBy(*block).orderBy("_o")) - 1)
    numbered = own.join(counts, block).withColumn("r", F.col("before") + F.col("nth"))
    cells = numbered.select(F.col("r").cast("long").alias("r"), F.posexplode(F.split(F.trim("value"), "\\s+")).alias("c", "v")).select("r", F.col("c").cast("long").alias("c"), F.col("v").cast("double").alias("v"))
    return cells.where(F.col("v") != head.get("nodata_value", -9999.0)), head


def write_ascii(cells: DataFrame, path: str, ncols: int, nrows: int, cell: float, x0: float = 0.0, y0: float = 0.0, nodata: float = -9999.0, files: int | None = None) -> None:
    """Text files, in order of their names the grid's rows (files = 1: one); missing cells get the nodata value."""
    spark = cells.sparkSession
    head = spark.createDataFrame([(-1, "\n".join(f"{k} {v}" for k, v in zip(HEADER, (ncols, nrows, x0, y0, cell, nodata), strict=True)))], "r long, value string")
    rows = cells.groupBy("r").agg(F.map_from_entries(F.collect_list(F.struct(F.col("c").cast("int"), "v"))).alias("m"))
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(ncols - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(nodata)).cast("string")), " ")
    everything = spark.range(nrows).withColumnRenamed("id", "r").join(rows, "r", "left").select("r", F.coalesce(line, F.lit(" ".join([str(nodata)] * ncols))).alias("value"))
    parts = files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    head.unionByName(everything).repartitionByRange(parts, "r").sortWithinPartitions("r").select("value").write.mode("overwrite").text(path)
