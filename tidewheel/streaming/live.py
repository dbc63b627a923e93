"""Live feed as a stream: landed station documents matched against the canonical mapping, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewheel import schemas
from tidewheel.operators.places import coverage, live_match


def landed_feed(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.readStream.schema(schemas.LIVE_INFORMATION).option("multiLine", True).json(folder)
    return docs.select(F.explode("data.stations").alias("st")).select("st.*")


def reconcile(feed: DataFrame, mapping: DataFrame, out: str, checkpoint: str, alert_below: float = 0.95, alert=None) -> StreamingQuery:
    """Match each micro-batch; write matches by batch id (a batch that runs again replaces its own); alert on low coverage."""

    def one(batch: DataFrame, batch_id: int) -> None:
        matched = live_match(batch.select("station_id", "name", "lat", "lon"), mapping)
        matched.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        n = {r.method: r.n for r in coverage(batch.sparkSession.read.parquet(f"{out}/batch={batch_id}")).collect()}
        total = sum(n.values())
        if alert and total and 1 - n.get("unmatched", 0) / total < alert_below:
            alert(batch_id, n)

    return feed.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_velocity(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Streaming arrivals and departures by station and hour."""
    w = events.withWatermark("ts", late).groupBy("station", F.window("ts", "1 hour"))
    return w.agg(F.count_if(F.col("direction") == "in").alias("inflow"), F.count_if(F.col("direction") == "out").alias("outflow")).select("station", F.col("window.start").alias("hour"), "inflow", "outflow")
