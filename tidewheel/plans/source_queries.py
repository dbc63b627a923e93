"""Registered queries of the readers and writers: each lands a table in the shared folder and reads it back; and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewheel import schemas
from tidewheel.plans.storage import materialize, shared_path
from tidewheel.sources import files
from tidewheel.sources.adapter import TRIPS_SQL, table, trips

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
RAW = {v: k for k, v in schemas.RENAME.items()}


def add(sql: str) -> Callable:
    """Register the function under its own name."""

    def of(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return of


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips under the raw files' column names."""
    return trips(spark, sf_dir).withColumnsRenamed(RAW).select(*schemas.RENAME)


def _land_json(df: DataFrame, name: str, document: str) -> str:
    """One JSON document in the shared folder; df has one row."""
    path = shared_path(df.sparkSession, name)
    df.select(F.to_json(F.expr(document)).alias("value")).coalesce(1).write.text(path)
    return path


def _by_region(spark: SparkSession, sf_dir: str) -> str:
    """Nations in a folder and a file a region, in the order of their keys."""
    path = shared_path(spark, "regions")
    n = table(spark, sf_dir, "nation").withColumn("region", F.col("n_regionkey"))
    files.write_parquet(n.repartition("region").sortWithinPartitions("region", "n_nationkey"), path, ["region"])
    return path


@add(f"WITH {TRIPS_SQL} SELECT start_station_district, count(*) AS n, sum(start_time_ms)::BIGINT AS started, round(max(start_station_latitude::FLOAT)::DOUBLE, 4) AS north FROM trips GROUP BY 1")
def csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips as CSV files beside a file with a bad row, which is skipped; renamed, with coordinates as float32."""
    path = shared_path(spark, "raw-trips")
    files.write_csv(_raw(spark, sf_dir), path)
    bad = spark.createDataFrame([(",".join(schemas.RENAME) + "\na,b,north,west,c,d,1.0,2.0,soon,later",)], "value string")
    bad.write.mode("append").text(path)
    t = schemas.to_bronze(files.read_csv(spark, path, skip_bad_rows=True))
    return t.groupBy("start_station_district").agg(F.count(F.lit(1)).alias("n"), F.sum("start_time_ms").alias("started"), F.round(F.max("start_station_latitude").cast("double"), 4).alias("north"))


@add("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def csv_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of one CSV file."""
    path, n = shared_path(spark, "nations"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    files.write_csv(n.orderBy("n_nationkey"), path, single=True)
    return files.read_csv_head(spark, path, 5, n.schema)


@add("SELECT n_regionkey, n_nationkey FROM nation QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) <= 2")
def quota_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two rows of each file of a recursive read."""
    return files.head_of_files(files.read_parquet(spark, _by_region(spark, sf_dir)), 2).select("n_regionkey", "n_nationkey")


@add("SELECT DISTINCT n_regionkey::BIGINT AS region, true AS has_bytes FROM nation")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a folder tree, by extension."""
    found = files.discover(spark, _by_region(spark, sf_dir), "*.parquet")
    return found.select(F.regexp_extract("path", "region=([0-9]+)", 1).cast("long").alias("region"), (F.col("bytes") > 0).alias("has_bytes"))


@add(f"WITH {TRIPS_SQL} SELECT month(make_timestamp(start_time_ms * 1000))::INTEGER AS month, count(*) AS n, sum(end_time_ms)::BIGINT AS ended FROM trips GROUP BY 1")
def parquet_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in Parquet folders by month, read recursively."""
    month, path = F.month(F.timestamp_millis("start_time_ms")), shared_path(spark, "months")
    files.write_parquet(trips(spark, sf_dir).withColumn("folder", month), path, ["folder"])
    return files.read_parquet(spark, path).groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("end_time_ms").alias("ended"))


@add("SELECT c_nationkey, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer GROUP BY 1")
def equal_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame from two CSV folders whose headers are equal."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    paths = [shared_path(spark, f"customers-{i}") for i in (0, 1)]
    for i, p in enumerate(paths):
        files.write_csv(c.where(F.col("c_custkey") % 2 == i), p)
    return files.read_equal_csvs(spark, paths, c.schema).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("long").alias("keys"))


@add("SELECT * FROM (VALUES ('absent', 'ENDTIMEMS'), " + ", ".join(f"('mapped', '{c}')" for c in schemas.RENAME if c != "ENDTIMEMS") + ", ('unmapped', 'BIKETYPE')) AS t(kind, name)")
def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns of a raw table the dictionary maps, doesn't know, or misses."""
    found = schemas.rename_report(_raw(spark, sf_dir).drop("ENDTIMEMS").withColumn("BIKETYPE", F.lit("x")).columns)
    return spark.createDataFrame([(kind, c) for kind, names in found.items() for c in names], "kind string, name string")


@add("SELECT ordinal_position::INTEGER - 1 AS position, column_name AS name FROM information_schema.columns WHERE table_name = 'orders'")
def schema_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and places of a table's columns, from its schema alone."""
    return files.schema_table(table(spark, sf_dir, "orders")).select("position", "name")


@add("SELECT n_name FROM nation")
def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a type."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return n.select(*schemas.columns_of_type(n, T.StringType))


@add(f"WITH {TRIPS_SQL} SELECT end_station_district AS district, count(*) AS n FROM trips GROUP BY 1")
def view_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a frame that was registered under a name."""
    files.register(trips(spark, sf_dir), "tidewheel_trips")
    return spark.sql("SELECT end_station_district AS district, count(*) AS n FROM tidewheel_trips GROUP BY 1")


@add(f"WITH {TRIPS_SQL} SELECT start_station_name, count(*) AS n FROM trips GROUP BY 1")
def materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result that is written once and read from then on."""
    return materialize(trips(spark, sf_dir).groupBy("start_station_name").agg(F.count(F.lit(1)).alias("n")), "by-station")


@add(f"WITH {TRIPS_SQL} SELECT 'missing.csv' AS file, -1::BIGINT AS rows, false AS converted, false AS smaller UNION ALL SELECT 'trips.csv', count(*), true, true FROM trips")
def conversion_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to Parquet file by file: one that fails is reported and stops nothing."""
    root = shared_path(spark, "convert")
    files.write_csv(_raw(spark, sf_dir), f"{root}/trips.csv")
    done = files.convert(spark, [f"{root}/missing.csv", f"{root}/trips.csv"], f"{root}/bronze")
    return done.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.coalesce("rows", F.lit(-1).cast("long")).alias("rows"), F.col("error").isNull().alias("converted"), F.coalesce(F.col("ratio") > 1, F.lit(False)).alias("smaller"))


@add(f"WITH {TRIPS_SQL} SELECT start_station_name AS station_name_standardized, min(start_station_latitude) AS latitude, min(start_station_longitude) AS longitude, 30.5::DOUBLE AS elevation_meters, length(start_station_name)::DOUBLE AS nearest_metro_dist_meters, 19.0::DOUBLE AS capacity FROM trips GROUP BY 1")
def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station dimension as a CSV file."""
    path = shared_path(spark, "dimension")
    d = trips(spark, sf_dir).groupBy(F.col("start_station_name").alias("station_name_standardized")).agg(F.min("start_station_latitude").alias("latitude"), F.min("start_station_longitude").alias("longitude"))
    d = d.select("*", F.lit(30.5).alias("elevation_meters"), F.length("station_name_standardized").cast("double").alias("nearest_metro_dist_meters"), F.lit(19.0).alias("capacity"))
    files.write_csv(d, path)
    return files.read_dimension(spark, path)


@add("SELECT n_nationkey::VARCHAR AS station_id, n_name AS name, 45 + n_nationkey / 100.0::DOUBLE AS lat, -73 - n_nationkey / 100.0::DOUBLE AS lon, (n_nationkey % 7)::INTEGER AS capacity FROM nation")
def feed_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations of one information document, flattened (25 nations at any scale)."""
    n = table(spark, sf_dir, "nation")
    st = n.agg(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("station_id"), F.col("n_name").alias("name"), (45 + F.col("n_nationkey") / 100).alias("lat"), (-73 - F.col("n_nationkey") / 100).alias("lon"), (F.col("n_nationkey") % 7).alias("capacity"))).alias("st"))
    return files.read_live_information(spark, _land_json(st, "information", "named_struct('data', named_struct('stations', st))"))


@add("SELECT n_nationkey::VARCHAR AS station_id, (n_nationkey % 5)::INTEGER AS num_bikes_available, (n_nationkey % 3)::INTEGER AS num_docks_available FROM nation")
def feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations of one status document, flattened."""
    n = table(spark, sf_dir, "nation")
    st = n.agg(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("station_id"), (F.col("n_nationkey") % 5).alias("num_bikes_available"), (F.col("n_nationkey") % 3).alias("num_docks_available"))).alias("st"))
    return files.read_live_status(spark, _land_json(st, "status", "named_struct('data', named_struct('stations', st))"))


@add("SELECT 45 + n_nationkey / 100.0::DOUBLE AS lat, -73 - n_nationkey / 100.0::DOUBLE AS lon FROM nation WHERE n_nationkey % 6 <> 0")
def metro_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of one map-service document; elements without coordinates are left out."""
    n = table(spark, sf_dir, "nation")
    at = lambda c: F.when(F.col("n_nationkey") % 6 != 0, c)
    st = n.agg(F.collect_list(F.struct(at(45 + F.col("n_nationkey") / 100).alias("lat"), at(-73 - F.col("n_nationkey") / 100).alias("lon"))).alias("st"))
    return files.read_metro(spark, _land_json(st, "metro", "named_struct('elements', st)"))
