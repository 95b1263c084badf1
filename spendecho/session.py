"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # No call-site capture per column: halves the driver time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "spendecho", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workers_import_package(spark: SparkSession) -> None:
    """Put this package on the path of workers that share the folder it lies in
    (elsewhere it is shipped with --py-files)."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, else the warehouse, which has to be shared as well:
    a folder of the driver's own machine will do only where all tasks run there."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    place = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return warehouse


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/spendecho/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def scratch_mark() -> int:
    """For `clear_scratch`: what is made from now on."""
    return len(_MADE)


def clear_scratch(spark: SparkSession, mark: int = 0) -> None:
    """Remove the scratch folders that this driver made after `mark`. Call it when
    nothing reads them any more."""
    for path in _MADE[mark:]:
        remove_scratch(spark, path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove one folder of `scratch_path`."""
    _MADE.remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many: cuts lineage, survives executor loss, and gives
    the planner real file sizes for its join choice."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
