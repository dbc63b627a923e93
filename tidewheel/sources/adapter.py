"""Trips, stations and station events made from the star-schema tables, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips: customers' nation and segment to suppliers' nation and a segment; dates as epoch milliseconds."""
    t = lambda n: table(spark, sf_dir, n)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    segment = F.array(*map(F.lit, SEGMENTS))

    def side(rows: DataFrame, key: str, nation: str, number, prefix: str) -> DataFrame:
        s = rows.join(F.broadcast(places), F.col(nation) == F.col("n_nationkey"))  # nations: 25 rows at any scale
        return s.select(
            F.col(key),
            F.concat("n_name", F.lit(" / "), F.element_at(segment, (number + 1).cast("int"))).alias(f"{prefix}_station_name"),
            F.col("r_name").alias(f"{prefix}_station_district"),
            (F.lit(45.4) + F.col("n_nationkey") * 0.01 + number * 0.001).cast("double").alias(f"{prefix}_station_latitude"),
            (F.lit(-73.7) + F.col("n_nationkey") * 0.005 + number * 0.002).cast("double").alias(f"{prefix}_station_longitude"),
        )

    starts = side(t("customer"), "c_custkey", "c_nationkey", (F.array_position(segment, F.col("c_mktsegment")) - 1).cast("int"), "start")
    ends = side(t("supplier"), "s_suppkey", "s_nationkey", (F.col("s_suppkey") % 5).cast("int"), "end")
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    lines = t("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate").join(t("orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = lines.join(starts, F.col("o_custkey") == F.col("c_custkey")).join(ends, F.col("l_suppkey") == F.col("s_suppkey"))
    names = [f"{p}_station_{c}" for p in ("start", "end") for c in ("name", "district", "latitude", "longitude")]
    return rows.select(*names, ms("o_orderdate").alias("start_time_ms"), ms("l_shipdate").alias("end_time_ms"))


_SEGMENT_SQL = "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"
TRIPS_SQL = f"""places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
starts AS (SELECT c_custkey, n_name || ' / ' || c_mktsegment AS nm, r_name AS ds, 45.4::DOUBLE + n_nationkey * 0.01::DOUBLE + k * 0.001::DOUBLE AS la, -73.7::DOUBLE + n_nationkey * 0.005::DOUBLE + k * 0.002::DOUBLE AS lo
  FROM (SELECT *, list_position({_SEGMENT_SQL}, c_mktsegment) - 1 AS k FROM customer) JOIN places ON c_nationkey = n_nationkey),
ends AS (SELECT s_suppkey, n_name || ' / ' || {_SEGMENT_SQL}[k + 1] AS nm, r_name AS ds, 45.4::DOUBLE + n_nationkey * 0.01::DOUBLE + k * 0.001::DOUBLE AS la, -73.7::DOUBLE + n_nationkey * 0.005::DOUBLE + k * 0.002::DOUBLE AS lo
  FROM (SELECT *, s_suppkey % 5 AS k FROM supplier) JOIN places ON s_nationkey = n_nationkey),
trips AS (SELECT s.nm AS start_station_name, s.ds AS start_station_district, s.la AS start_station_latitude, s.lo AS start_station_longitude,
  e.nm AS end_station_name, e.ds AS end_station_district, e.la AS end_station_latitude, e.lo AS end_station_longitude,
  epoch_ms(o_orderdate) AS start_time_ms, epoch_ms(l_shipdate) AS end_time_ms
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN starts s ON o_custkey = c_custkey JOIN ends e ON l_suppkey = s_suppkey)"""


def station_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, ts, direction): clicks leave (out), views arrive (in)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    return e.select(F.col("user_id").alias("station"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.when(F.col("event_type") == "click", "out").otherwise("in").alias("direction"))


EVENTS_SQL = "ev AS (SELECT user_id AS station, ts, CASE event_type WHEN 'click' THEN 'out' ELSE 'in' END AS direction FROM events WHERE event_type IN ('click', 'view'))"


def station_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, metres) as a made-up distance to the next metro; null for every 31st station."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("station")).distinct()
    return ids.select("station", F.when(F.col("station") % 31 != 0, (F.col("station") * 37 % 700).cast("double")).alias("metres"))


TIERS_SQL = "tiers AS (SELECT DISTINCT user_id AS station, CASE WHEN user_id % 31 <> 0 THEN (user_id * 37 % 700)::DOUBLE END AS metres FROM events)"
