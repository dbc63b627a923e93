"""Questions on trips: time, districts, routes, durations, short and long trips, the depot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.functions import geo, timefn
from tidewheel.functions.timefn import instant
from tidewheel.plans import quantiles

from .core import asc, concat, desc, share_of_total, top

SHORT_MS, LONG_MS = 2 * 60_000, 12 * 3_600_000
START, END = ["start_station_name", "start_station_district"], ["end_station_name", "end_station_district"]
ROUTE = [*START, *END]


def duration() -> Column:
    return F.col("end_time_ms") - F.col("start_time_ms")


def count() -> Column:
    return F.count(F.lit(1)).alias("n")


def hour_by_weekday(trips: DataFrame) -> DataFrame:
    ts = instant(F.col("start_time_ms"))
    return trips.groupBy(timefn.hour(ts).alias("hour"), timefn.dow_sunday0(ts).alias("dow")).agg(count(), F.avg(duration()).alias("avg_ms"))


def top_stations(trips: DataFrame, side: str = "start", n: int = 30) -> DataFrame:
    keys = START if side == "start" else END
    return top(trips.groupBy(*keys).agg(count()), n, desc("n"), *map(asc, keys))


def intra_inter(trips: DataFrame) -> DataFrame:
    kind = F.when(F.col("start_station_district") == F.col("end_station_district"), "Intra-District").otherwise("Inter-District")
    return share_of_total(trips.groupBy(kind.alias("kind")).agg(count(), F.avg(duration()).alias("avg_ms")), "n")


def district_popularity(trips: DataFrame) -> DataFrame:
    return trips.groupBy("start_station_district").agg(count(), F.count_distinct("start_station_name").alias("n_start"), F.count_distinct("end_station_name").alias("n_end"))


def district_flows(trips: DataFrame, n: int = 30) -> DataFrame:
    keys = ["start_station_district", "end_station_district"]
    return top(trips.groupBy(*keys).agg(count()), n, desc("n"), *map(asc, keys))


def top_routes(trips: DataFrame, n: int = 100) -> DataFrame:
    keys = ["start_station_name", "end_station_name"]
    return top(trips.groupBy(*keys).agg(count(), F.avg(duration()).alias("avg_ms")), n, desc("n"), *map(asc, keys))


def name_variations(trips: DataFrame, pattern: str) -> DataFrame:
    keys = ["start_station_name", "start_station_latitude", "start_station_longitude"]
    return trips.where(F.col("start_station_name").like(pattern)).groupBy(*keys).agg(count())


def multi_name_locations(trips: DataFrame, n: int | None = None) -> DataFrame:
    """Coordinates with more than one name. All of them; n is for display."""
    keys = ["start_station_latitude", "start_station_longitude"]
    out = trips.groupBy(*keys).agg(F.min("start_station_name").alias("a_name"), F.count_distinct("start_station_name").alias("names"), count()).where("names > 1")
    return top(out, n, desc("names"), desc("n"), *map(asc, keys)) if n else out


def names_at_locations(trips: DataFrame, n: int = 5) -> DataFrame:
    """Names by year at the n busiest coordinates that have several names: one semi join, not a query a place."""
    places = multi_name_locations(trips, n).select("start_station_latitude", "start_station_longitude")
    rows = trips.join(F.broadcast(places), ["start_station_latitude", "start_station_longitude"], "left_semi")  # n rows
    return rows.groupBy("start_station_latitude", "start_station_longitude", "start_station_name", timefn.year(instant(F.col("start_time_ms"))).alias("year")).agg(count())


def hub_connectivity(trips: DataFrame, n: int = 30) -> DataFrame:
    out = trips.groupBy(*START).agg(F.count_distinct("end_station_name").alias("destinations"), count(), F.avg(duration()).alias("avg_ms"))
    return top(out, n, desc("destinations"), desc("n"), *map(asc, START))


def _ranked_durations(trips: DataFrame) -> DataFrame:
    return quantiles.ranked(trips.select(duration().alias("d")), "d")


def duration_stats(trips: DataFrame) -> DataFrame:
    return _ranked_durations(trips).agg(F.min("v").alias("min_ms"), F.max("v").alias("max_ms"), quantiles.mean().alias("avg_ms"), *(quantiles.quantile(k / 100).alias(f"p{k}") for k in (25, 50, 75, 95, 99)))


def iqr_outliers(trips: DataFrame) -> DataFrame:
    r = _ranked_durations(trips)
    q = r.agg(quantiles.quantile(0.25).alias("a"), quantiles.quantile(0.75).alias("z"))
    q = q.select((F.col("a") - 1.5 * (F.col("z") - F.col("a"))).alias("lower"), (F.col("z") + 1.5 * (F.col("z") - F.col("a"))).alias("upper"))
    out = r.crossJoin(F.broadcast(q)).groupBy("lower", "upper").agg(quantiles.rows_where(F.col("v") < F.col("lower")).alias("below"), quantiles.rows_where(F.col("v") > F.col("upper")).alias("above"), F.sum("n").alias("rows"))
    return out.select("lower", "upper", "below", "above", F.col("rows").alias("n"), ((F.col("below") + F.col("above")) * F.lit(100.0) / F.col("rows")).alias("percentage"))


def same_station() -> Column:
    same = (F.col("start_station_name") == F.col("end_station_name")) & (F.col("start_station_latitude") == F.col("end_station_latitude")) & (F.col("start_station_longitude") == F.col("end_station_longitude"))
    return F.when(same, "SAME_STATION").otherwise("DIFFERENT_STATION")


def _medians(trips: DataFrame, *keys: str) -> DataFrame:
    """(*keys, n, avg_ms, min_ms, max_ms, median_ms) of the column d; n counts nulls too. No task holds all values of a key."""
    r = quantiles.ranked(trips, "d", *keys, nulls=True)
    return r.groupBy(*keys).agg(F.sum("n").alias("n"), quantiles.mean().alias("avg_ms"), F.min("v").alias("min_ms"), F.max("v").alias("max_ms"), quantiles.quantile(0.5).alias("median_ms"))


def _by_route(trips: DataFrame, where: Column) -> DataFrame:
    keys = ["start_station_name", "end_station_name"]
    return _medians(trips.where(where).select(*keys, same_station().alias("kind"), duration().alias("d")), *keys, "kind")


def short_trips(trips: DataFrame, below_ms: int = SHORT_MS) -> DataFrame:
    return _by_route(trips, duration() < below_ms)


def long_trips(trips: DataFrame, above_ms: int = LONG_MS) -> DataFrame:
    return _by_route(trips, duration() > above_ms)


def by_kind(routes: DataFrame) -> DataFrame:
    return share_of_total(routes.groupBy("kind").agg(F.sum("n").alias("n"), count().alias("routes")), "n")


def duration_subset(trips: DataFrame, where: Column, unit_ms: float = 60_000.0) -> DataFrame:
    r = quantiles.ranked(trips.where(where).select((duration() / F.lit(unit_ms)).alias("d")), "d")
    q = (quantiles.quantile(p / 100).alias(f"p{p}") for p in (25, 75, 90, 95, 99))
    return r.agg(quantiles.rows().alias("n"), quantiles.mean().alias("mean"), quantiles.quantile(0.5).alias("median"), F.min("v").alias("lo"), F.max("v").alias("hi"), *q)


def validity(trips: DataFrame, depot: str = "cyclo", short_ms: int = SHORT_MS, long_ms: int = LONG_MS) -> DataFrame:
    """trips with the flags of the validity filters: short at one station, long, depot."""
    d = trips.withColumn("short_same", (duration() < short_ms) & (same_station() == "SAME_STATION"))
    return d.withColumn("long", duration() > long_ms).withColumn("depot", (F.col("start_station_name") == depot) | (F.col("end_station_name") == depot))


def validity_counts(trips: DataFrame, **how) -> DataFrame:
    v = validity(trips, **how)
    return v.groupBy("short_same", "long", "depot").agg(count())


def depot_counts(trips: DataFrame, depot: str) -> DataFrame:
    s, e = F.col("start_station_name") == depot, F.col("end_station_name") == depot
    return trips.agg(F.count_if(s).alias("from_depot"), F.count_if(e).alias("to_depot"), F.count_if(s & e).alias("within"), F.count_if(s | e).alias("any"), count())


def depot_routes(trips: DataFrame, depot: str, side: str = "start", n: int = 30) -> DataFrame:
    other = "end" if side == "start" else "start"
    keys = [f"{other}_station_name", f"{other}_station_latitude", f"{other}_station_longitude"]
    d = trips.where(F.col(f"{side}_station_name") == depot).withColumn("d", duration())
    return top(_medians(d, *keys).drop("min_ms", "max_ms"), n, desc("n"), *map(asc, keys))


def depot_durations(trips: DataFrame, depot: str) -> DataFrame:
    """Three labelled groups, of which a trip can be in more than one, in one scan."""
    s, e = F.col("start_station_name") == depot, F.col("end_station_name") == depot
    groups = F.array_compact(F.array(F.when(s, "FROM depot"), F.when(e, "TO depot"), F.when(s & e, "WITHIN depot")))
    d = trips.where(s | e).select(F.explode(groups).alias("category"), duration().alias("d"))
    return _medians(d, "category").drop("min_ms", "max_ms")


def depot_daily(trips: DataFrame, depot: str, n: int = 20) -> DataFrame:
    s, e = F.col("start_station_name") == depot, F.col("end_station_name") == depot
    day = F.to_date(instant(F.col("start_time_ms"))).alias("day")
    return top(trips.where(s | e).groupBy(day).agg(count(), F.count_if(s).alias("departures"), F.count_if(e).alias("arrivals")), n, desc("n"), asc("day"))


def depot_directions(trips: DataFrame, depot: str) -> DataFrame:
    s, e = F.col("start_station_name") == depot, F.col("end_station_name") == depot
    return trips.where(s | e).groupBy(F.when(s, "FROM").when(e, "TO").alias("direction")).agg(count())


def overview(trips: DataFrame) -> DataFrame:
    ts = instant(F.col("start_time_ms"))
    return trips.agg(count(), F.count_distinct("start_station_name").alias("start_stations"), F.count_distinct("end_station_name").alias("end_stations"), F.min(ts).cast("timestamp_ntz").alias("first"), F.max(ts).cast("timestamp_ntz").alias("last"))


def stations(trips: DataFrame) -> DataFrame:
    """Distinct (name, latitude, longitude) of starts and ends."""
    side = lambda p: trips.select(*(F.col(f"{p}_station_{c}").alias(c) for c in ("name", "latitude", "longitude"))).where("name IS NOT NULL AND latitude IS NOT NULL")
    return concat([side("start"), side("end")]).distinct()


def distance_by_district(trips: DataFrame) -> DataFrame:
    km = geo.haversine_km(*(F.col(f"{p}_station_{c}") for p in ("start", "end") for c in ("latitude", "longitude")))
    return trips.select("start_station_district", km.alias("km"), duration().alias("d")).groupBy("start_station_district").agg(count(), F.avg("km").alias("avg_km"), F.corr("km", "d").alias("corr_km_ms"))


def trimmed(trips: DataFrame, p: float = 0.99) -> DataFrame:
    """Count, mean and largest of the durations up to a percentile."""
    r = _ranked_durations(trips)
    cut = r.agg(quantiles.quantile(p).alias("cut"))
    return r.crossJoin(F.broadcast(cut)).where("v <= cut").agg(quantiles.rows().alias("n"), quantiles.mean().alias("mean"), F.max("v").alias("hi"))
