"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where it is unset and the master is local.

    On a cluster without the setting a machine-local folder would lose rows, so that is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = getattr(spark, "_tidewheel_dir", None)
        if not found:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            found = "file://" + tempfile.mkdtemp(prefix="tidewheel-")
            spark._tidewheel_dir = found
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidewheel/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step", **options) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, lost executors only re-read files."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files behind materialized frames that no later plan reads."""
    for df in frames:
        for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
            delete(df.sparkSession, folder)
