"""File readers, writers, feeds and conversion jobs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidewheel import schemas


def discover(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(path, bytes) of files under root, sorted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("length").alias("bytes")).orderBy("path")


def read_csv(spark: SparkSession, path: str, schema=None, skip_bad_rows: bool = False, recursive: bool = True) -> DataFrame:
    """CSV with a header and a declared schema (raw trips by default); bad rows fail, or are skipped."""
    r = spark.read.schema(schema or schemas.RAW_TRIPS).option("header", True).option("recursiveFileLookup", recursive).option("mode", "DROPMALFORMED" if skip_bad_rows else "FAILFAST")
    df = r.csv(path)
    # The parser judges a row by the columns that a query reads; this reads all of them, so a row is bad for every query or for none.
    return df.where(F.xxhash64(*df.columns) != F.lit(-1)) if skip_bad_rows else df


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_csv_head(spark: SparkSession, path: str, n: int, schema=None) -> DataFrame:
    return read_csv(spark, path, schema).limit(n)


def headers_equal(spark: SparkSession, paths: list[str]) -> bool:
    return len({tuple(csv_header(spark, p)) for p in paths}) <= 1


def read_equal_csvs(spark: SparkSession, paths: list[str], schema=None) -> DataFrame:
    """One frame from files of one header; ValueError if their headers differ."""
    if not headers_equal(spark, paths):
        raise ValueError("headers differ")
    return spark.read.schema(schema or schemas.RAW_TRIPS).option("header", True).csv(paths)


def head_of_files(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of each file in file order (what a quota on chunked reads gives)."""
    rows = df.withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"), "__at": F.monotonically_increasing_id()})
    w = Window.partitionBy("__file").orderBy("__block", "__at")
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).select(*df.columns)


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows at random, the same for a seed and an input order."""
    return df.orderBy(F.rand(seed)).limit(n)


def read_parquet(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(root)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "snappy")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def read_artifact(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A Parquet artifact; fails if it isn't there (as Spark does) or lacks a column."""
    return schemas.require(spark.read.parquet(path), columns)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DIMENSION).option("header", True).csv(path)


def _stations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("data.stations").alias("st")).select("st.*")


def read_live_information(spark: SparkSession, path: str) -> DataFrame:
    """A landed station-information document, one row a station."""
    return schemas.require(_stations(spark, path, schemas.LIVE_INFORMATION), ["station_id", "name", "lat", "lon"])


def read_live_status(spark: SparkSession, path: str) -> DataFrame:
    return _stations(spark, path, schemas.LIVE_STATUS)


def read_metro(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRO).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.lat", "e.lon").where("lat IS NOT NULL AND lon IS NOT NULL")


def land_feed(spark: SparkSession, url: str, path: str, timeout: float = 10.0, params: dict[str, str] | None = None) -> str:
    """Fetch a JSON document once, on the driver, and land it as a file that executors read. Returns path."""
    import urllib.parse
    import urllib.request

    with urllib.request.urlopen(url + ("?" + urllib.parse.urlencode(params) if params else ""), timeout=timeout) as r:
        body = r.read().decode("utf-8")
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


# Addresses and the request of the public map and elevation services.
MAP_SERVICE = "http://overpass-api.de/api/interpreter"
METRO_REQUEST = '[out:json];area["name"="{city}"]->.searchArea;node["railway"="station"]["station"="subway"](area.searchArea);out center;'
ELEVATION_SERVICE = "https://api.opentopodata.org/v1/mapzen?locations={latitude},{longitude}"


def land_metro(spark: SparkSession, path: str, city: str = "Montréal", url: str = MAP_SERVICE, timeout: float = 60.0) -> DataFrame:
    """Metro stations of a city as (lat, lon), asked from the map service once and landed at path."""
    return read_metro(spark, land_feed(spark, url, path, timeout, {"data": METRO_REQUEST.replace("{city}", city)}))


def lookup_elevations(places: DataFrame, url: str = ELEVATION_SERVICE, timeout: float = 10.0) -> DataFrame:
    """(latitude, longitude, elevation_meters) of each distinct place, one request each, from the executors.

    A request that fails, times out or answers without an elevation gives null and stops nothing.
    Land the result before it is joined: a task that runs again asks again.
    """

    def ask(latitude: float, longitude: float) -> float | None:
        import json
        import urllib.request

        try:
            with urllib.request.urlopen(url.format(latitude=latitude, longitude=longitude), timeout=timeout) as r:
                found = json.load(r)["results"][0]["elevation"]
            return None if found is None else float(found)
        except Exception:  # noqa: BLE001  no elevation, whatever the reason
            return None

    def run(batches):
        for b in batches:
            x, y = b.column(0).to_pylist(), b.column(1).to_pylist()
            found = [None if i is None or j is None else ask(i, j) for i, j in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.float64())], names=["latitude", "longitude", "elevation_meters"])

    distinct = places.select(F.col("latitude").cast("double"), F.col("longitude").cast("double")).distinct()
    return distinct.mapInArrow(run, "latitude double, longitude double, elevation_meters double")


def register(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound values (:name) and frames ({name})."""
    return spark.sql(sql, args=args or {}, **frames)


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)], "position int, name string, type string, nullable boolean")


def sizes(df: DataFrame) -> DataFrame:
    """(path, bytes) of the files behind a file-based frame."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).distinct()


def convert(spark: SparkSession, csv_paths: list[str], out_root: str) -> DataFrame:
    """CSV to bronze Parquet, file by file; a file that fails doesn't stop the others. Status table: path, rows, csv_bytes, parquet_bytes, ratio, error."""
    status = []
    for p in csv_paths:
        try:
            out = f"{out_root}/{p.rstrip('/').rpartition('/')[2].removesuffix('.csv')}.parquet"
            raw = read_csv(spark, p)
            write_parquet(schemas.to_bronze(raw), out)
            back = spark.read.parquet(out)
            before, after = (sizes(x).agg(F.sum("bytes")).first()[0] for x in (raw, back))
            status.append((p, back.count(), before, after, before / after, None))
        except Exception as e:  # noqa: BLE001  reported in the table
            status.append((p, None, None, None, None, str(e)[:300]))
    return spark.createDataFrame(status, T.StructType.fromDDL("path string, rows long, csv_bytes long, parquet_bytes long, ratio double, error string"))
