"""Session and the shared folder in which iterative operators cut their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "brookflow", master: str = "local[*]", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submitting side configures its own."""
    return (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where none is configured a local session gets a folder of its own; on a cluster, whose executors wouldn't see that, RuntimeError is raised."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="brookflow-"))
    return context.getCheckpointDir()


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/brookflow/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back, so that a lost executor costs no earlier round.

    Joins with it are by shuffle: Spark takes the compressed files' size for the rows' size, and would send many times as
    much through the driver, anew in every round.
    """
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")
    out._staged_at = path
    return out


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that new_dir named, through Spark's file systems."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(df: DataFrame) -> None:
    """Remove what `staged` wrote for df, of which nothing is read any more."""
    delete_dir(df.sparkSession, df._staged_at)
