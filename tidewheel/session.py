"""Session builder with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "tidewheel", cores: str = "4", shuffle_partitions: int = 4, checkpoint_dir: str | None = None, **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session that is there."""
    conf = SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | ({"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}) | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
