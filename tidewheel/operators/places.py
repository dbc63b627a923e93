"""Nearest and radius joins, live matching, the station dimension, utilization."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.functions import geo, text
from tidewheel.plans.storage import materialize
from tidewheel.schemas import MAPPING_COLUMNS, require

from .core import asc, desc, first_per_key, top
from .profile import median_fill


SMALL = 10_000  # targets up to which every point is held against all of them


def nearest_all(points: DataFrame, targets: DataFrame, small: int = SMALL) -> DataFrame:
    """points (id, lat, lon) with the distance to the nearest of the targets (lat, lon), in metres to 2 places.

    Up to ``small`` targets (counted first; metro stations, say) go to every task. Of more, points
    are searched in rings that double until each point has a target. Without targets there is no row.
    """
    t = targets.select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon")).where("__lat IS NOT NULL AND __lon IS NOT NULL")
    if t.limit(small + 1).count() <= small:
        d = points.crossJoin(F.broadcast(t)).withColumn("m", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")))
        return d.groupBy("id").agg(F.round(F.min("m"), 2).alias("metres"))
    t = t.select(F.struct("__lat", "__lon").alias("id"), F.col("__lat").alias("lat"), F.col("__lon").alias("lon")).distinct()
    left, found, km = materialize(points.select("id", "lat", "lon").distinct(), "points"), [], 1.0
    while not left.isEmpty() and km < 2 * HALF_ROUND_KM:
        near = materialize(within_radius(left, t, km).groupBy("id").agg(F.round(F.min("km") * 1000, 2).alias("metres")), "nearest")
        found.append(near)
        left, km = materialize(left.join(near, "id", "left_anti"), "points"), km * 2
    return reduce(DataFrame.unionByName, found).groupBy("id").agg(F.min("metres").alias("metres"))


HALF_ROUND_KM = 20_016.0  # no two places are further apart
KM_A_DEGREE = 111.0  # a little less than there are


def within_radius(points: DataFrame, targets: DataFrame, km: float) -> DataFrame:
    """(id, target_id, km) of all pairs within km, anywhere on the globe: an equi join on a grid.

    Bands of latitude are a little over km high. A band has as many cells around the globe as
    keep each of them km wide at its end nearest a pole; one at the poles. A target goes to the
    cells of its own and the neighbouring bands that its reach in longitude touches, around
    +-180 too; a point lies in one cell. Null coordinates match nothing.
    """
    height = km / KM_A_DEGREE
    band = F.floor(F.col("lat") / F.lit(height)).cast("long")

    def cells(b: Column) -> Column:
        pole = F.least(F.greatest(F.abs(b), F.abs(b + 1)) * F.lit(height), F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(pole)) * F.lit(360.0 / height)), F.lit(1)).cast("long")

    place = lambda lon, n: F.floor((lon + 180) * n / 360).cast("long")
    p = points.select("id", "lat", "lon", band.alias("band")).withColumn("cell", F.pmod(place(F.col("lon"), cells(F.col("band"))), cells(F.col("band"))))
    t = targets.select(F.col("id").alias("target_id"), F.col("lat").alias("tlat"), F.col("lon").alias("tlon"), F.explode(F.sequence(band - 1, band + 1)).alias("band"))
    arc = km / KM_A_DEGREE
    spread = F.lit(math.sin(math.radians(min(arc, 90.0)))) / F.cos(F.radians(F.col("tlat")))
    reach = F.when((F.abs("tlat") + arc >= 90) | (spread >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(spread, F.lit(1.0)))))
    n = cells(F.col("band"))
    first, last = place(F.col("tlon") - reach, n), place(F.col("tlon") + reach, n)
    around = F.when(last - first + 1 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, n)))
    t = t.where("tlat IS NOT NULL AND tlon IS NOT NULL").select("target_id", "tlat", "tlon", "band", F.explode(around).alias("cell"))
    return p.join(t, ["band", "cell"]).select("id", "target_id", geo.haversine_km(F.col("lat"), F.col("lon"), F.col("tlat"), F.col("tlon")).alias("km")).where(F.col("km") <= km)


def within_degrees(points: DataFrame, degrees: float) -> DataFrame:
    """(a, b, deg) of all pairs of points (id, lat, lon), a before b, less than ``degrees`` of plain distance apart: an equi join on a grid."""
    cell = lambda c: F.floor(F.col(c) / F.lit(degrees)).cast("long")
    p = points.select(F.col("id").alias("a"), F.col("lat").alias("alat"), F.col("lon").alias("alon"), cell("lat").alias("cy"), cell("lon").alias("cx"))
    near = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    q = points.select(F.col("id").alias("b"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), cell("lat").alias("y"), cell("lon").alias("x"), F.explode(near).alias("o"))
    q = q.select("b", "blat", "blon", (F.col("y") + F.col("o.i")).alias("cy"), (F.col("x") + F.col("o.j")).alias("cx"))
    d = geo.degree_distance(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon"))
    return p.join(q, ["cy", "cx"]).where("a < b").select("a", "b", d.alias("deg")).where(F.col("deg") < degrees)


def around_hub(points: DataFrame, hub_lat: Column, hub_lon: Column, metres: float = 400.0) -> DataFrame:
    """points within metres of one place; the place itself is the hub, others are spillover."""
    d = points.withColumn("metres", geo.haversine_m(hub_lat, hub_lon, F.col("lat"), F.col("lon")))
    return d.where(F.col("metres") <= metres).withColumn("role", F.when(F.col("metres") == 0, "hub").otherwise("spillover"))


def live_match(feed: DataFrame, mapping: DataFrame, name_km: float = 0.20, near_km: float = 0.05) -> DataFrame:
    """feed (station_id, name, lat, lon) with a canonical station each: by coordinate, else by name within name_km, else by nearness within near_km.

    Rows that repeat in all four columns count once; others are matched each by itself, whatever their station_id.
    """
    require(mapping, MAPPING_COLUMNS)
    f = feed.select("station_id", "name", text.normalize_name(F.col("name"), nbsp=True).alias("normalized_name"), "lat", "lon", geo.coord_key(F.col("lat"), F.col("lon")).alias("coord_key")).distinct()
    m = materialize(mapping.select(*MAPPING_COLUMNS).distinct(), "mapping")
    exact = m.groupBy("coord_key").agg(F.min("canonical_station_id").alias("a_id"))
    a = materialize(f.join(exact, "coord_key", "left").withColumn("row", F.struct(*f.columns)), "exact-matches")
    found = a.where("a_id IS NOT NULL").select(*f.columns, F.col("a_id").alias("canonical_station_id"), F.lit("coord_exact").alias("match_method"), F.lit(0.0).alias("match_distance_km"))
    left = a.where("a_id IS NULL").drop("a_id")
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("canonical_lat"), F.col("canonical_lon"))
    named = left.join(m.drop("coord_key").distinct(), "normalized_name").withColumn("km", km).where(F.col("km") <= name_km)
    b = materialize(first_per_key(named, ["row"], asc("km"), asc("canonical_station_id")), "name-matches")
    rest = left.join(b.select("row"), "row", "left_anti")
    centers = m.select(F.col("canonical_station_id").alias("id"), F.col("canonical_lat").alias("lat"), F.col("canonical_lon").alias("lon")).distinct()
    near = first_per_key(within_radius(rest.select(F.col("row").alias("id"), "lat", "lon"), centers, near_km), ["id"], asc("km"), asc("target_id"))
    c = rest.join(near, F.col("row") == F.col("id"), "left")
    c = c.select(*f.columns, F.col("target_id").alias("canonical_station_id"), F.when(F.col("target_id").isNotNull(), "nearest").alias("match_method"), F.col("km").alias("match_distance_km"))
    b = b.select(*f.columns, "canonical_station_id", F.lit("name_near").alias("match_method"), F.col("km").alias("match_distance_km"))
    return found.unionByName(b).unionByName(c).drop("coord_key")


def coverage(matched: DataFrame) -> DataFrame:
    return matched.groupBy(F.coalesce("match_method", F.lit("unmatched")).alias("method")).agg(F.count(F.lit(1)).alias("n"), F.avg("match_distance_km").alias("avg_km"))


def station_dimension(stations: DataFrame, elevation: DataFrame, metro: DataFrame, capacity: DataFrame, cleaner: str = "first") -> DataFrame:
    """(name, lat, lon) enriched by landed elevations, nearest metro and capacities; capacity falls back to the median."""
    clean = text.clean_first if cleaner == "first" else text.clean_all
    dim = stations.select(clean(F.col("name")).alias("station_name_standardized"), F.col("latitude"), F.col("longitude")).distinct()
    keyed = dim.withColumn("id", F.struct(*dim.columns))
    dist = nearest_all(keyed.select("id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")), metro).select("id.*", F.col("metres").alias("nearest_metro_dist_meters"))
    cap = first_per_key(capacity.select(text.clean_all(F.col("name")).alias("station_name_standardized"), F.col("capacity").cast("double").alias("capacity")), ["station_name_standardized"], asc("capacity"))
    out = dim.join(elevation, ["latitude", "longitude"], "left").join(dist, dim.columns, "left").join(cap, "station_name_standardized", "left")
    return median_fill(out, "capacity").select("station_name_standardized", "latitude", "longitude", "elevation_meters", "nearest_metro_dist_meters", "capacity")


def utilization(information: DataFrame, status: DataFrame) -> DataFrame:
    """Bikes over bikes and docks, and over capacity; null where a divisor is 0."""
    d = information.join(status, "station_id")
    bikes, docks = F.col("num_bikes_available").cast("double"), F.col("num_docks_available").cast("double")
    return d.withColumns({"utilization": F.try_divide(bikes, bikes + docks), "by_capacity": F.try_divide(bikes, F.col("capacity").cast("double"))})


def extremes(df: DataFrame, column: str, key: str, most: int = 20, least: int = 10) -> DataFrame:
    a = top(df.where(F.col(column).isNotNull()), most, desc(column), asc(key)).withColumn("end", F.lit("top"))
    return a.unionByName(top(df.where(F.col(column).isNotNull()), least, asc(column), asc(key)).withColumn("end", F.lit("bottom")))
