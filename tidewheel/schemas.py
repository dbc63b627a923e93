"""Declared schemas, the column dictionary of raw trip files, and required-column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Raw column names and their bronze names.
RENAME = {
    "STARTSTATIONNAME": "start_station_name",
    "STARTSTATIONARRONDISSEMENT": "start_station_district",
    "STARTSTATIONLATITUDE": "start_station_latitude",
    "STARTSTATIONLONGITUDE": "start_station_longitude",
    "ENDSTATIONNAME": "end_station_name",
    "ENDSTATIONARRONDISSEMENT": "end_station_district",
    "ENDSTATIONLATITUDE": "end_station_latitude",
    "ENDSTATIONLONGITUDE": "end_station_longitude",
    "STARTTIMEMS": "start_time_ms",
    "ENDTIMEMS": "end_time_ms",
}
RAW_TRIPS = T.StructType([T.StructField(c, T.LongType() if c.endswith("MS") else T.DoubleType() if c.endswith("TUDE") else T.StringType()) for c in RENAME])
COORDINATES = [c for c in RENAME.values() if c.endswith("tude")]
DIMENSION = "station_name_standardized string, latitude double, longitude double, elevation_meters double, nearest_metro_dist_meters double, capacity double"
LIVE_INFORMATION = "data struct<stations:array<struct<station_id:string,name:string,lat:double,lon:double,capacity:int>>>"
LIVE_STATUS = "data struct<stations:array<struct<station_id:string,num_bikes_available:int,num_docks_available:int>>>"
METRO = "elements array<struct<lat:double,lon:double>>"
MAPPING_COLUMNS = ["canonical_station_id", "normalized_name", "coord_key", "canonical_lat", "canonical_lon"]


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, if it has all columns; ValueError names those that it lacks."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def to_bronze(raw: DataFrame) -> DataFrame:
    """Rename by the dictionary (unknown names stay) and keep coordinates as float32."""
    df = raw.withColumnsRenamed(RENAME)
    return df.withColumns({c: F.col(c).cast("float") for c in COORDINATES if c in df.columns})


def rename_report(columns: list[str]) -> dict[str, list[str]]:
    return {"mapped": sorted(set(columns) & RENAME.keys()), "unmapped": sorted(set(columns) - RENAME.keys()), "absent": sorted(RENAME.keys() - set(columns))}


def columns_of_type(df: DataFrame, kind: type[T.DataType] | tuple[type[T.DataType], ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]
