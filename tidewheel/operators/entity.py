"""Station resolution: profiles, similar names, groups, canonical stations, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewheel.functions import geo, similarity, text, timefn
from tidewheel.plans.graph import connected_components
from tidewheel.plans.ordering import positions
from tidewheel.plans.storage import materialize
from tidewheel.sources.files import write_parquet

from .core import asc, desc, first_per_key, metric_table

MIN_TRIPS, PAIR_KM = 50, 0.05


def observations(trips: DataFrame) -> DataFrame:
    """(raw_name, normalized_name, lat, lon, coord_key, trip_count, first_year_seen, last_year_seen) of start stations."""
    t = trips.where("start_station_name IS NOT NULL AND start_station_latitude IS NOT NULL AND start_station_longitude IS NOT NULL")
    lat, lon = F.col("start_station_latitude"), F.col("start_station_longitude")
    rows = t.select(F.col("start_station_name").alias("raw_name"), geo.coord(lat).alias("lat"), geo.coord(lon).alias("lon"), timefn.year(timefn.instant(F.col("start_time_ms"))).alias("y"))
    g = rows.groupBy("raw_name", "lat", "lon").agg(F.count(F.lit(1)).alias("trip_count"), F.min("y").alias("first_year_seen"), F.max("y").alias("last_year_seen"))
    return g.select("raw_name", text.normalize_name(F.col("raw_name")).alias("normalized_name"), "lat", "lon", geo.coord_key(F.col("lat"), F.col("lon")).alias("coord_key"), "trip_count", "first_year_seen", "last_year_seen")


def multi_name_report(obs: DataFrame) -> DataFrame:
    """Coordinates with more than one raw name, with their sorted names and years."""
    g = obs.groupBy("coord_key").agg(F.count_distinct("raw_name").alias("names"), F.array_join(F.sort_array(F.collect_set("raw_name")), "|").alias("name_list"), F.sum("trip_count").alias("trips"), F.min("first_year_seen").alias("first_year"), F.max("last_year_seen").alias("last_year"))
    return g.where("names > 1")


def normalization_impact(obs: DataFrame) -> DataFrame:
    """Coordinates by how many raw and normalized names they have, and how many normalization resolves."""
    g = obs.groupBy("coord_key").agg(F.count_distinct("raw_name").alias("raw"), F.count_distinct("normalized_name").alias("norm"))
    return g.agg(F.count(F.lit(1)).alias("coordinates"), F.count_if(F.col("raw") > 1).alias("multi_raw"), F.count_if(F.col("norm") > 1).alias("multi_normalized"), F.count_if((F.col("raw") > 1) & (F.col("norm") == 1)).alias("resolved"))


def name_profile(obs: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """(normalized_name, primary_lat, primary_lon, primary_coord_trips, total_name_trips, coord_count) of names with enough trips."""
    by = obs.groupBy("normalized_name", "lat", "lon").agg(F.sum("trip_count").alias("n"))
    w = Window.partitionBy("normalized_name")
    ranked = by.withColumns({"total_name_trips": F.sum("n").over(w), "coord_count": F.count(F.lit(1)).over(w), "rn": F.row_number().over(w.orderBy(desc("n"), asc("lat"), asc("lon")))})
    out = ranked.where(f"rn = 1 AND total_name_trips >= {int(min_trips)}")
    return out.select("normalized_name", F.col("lat").alias("primary_lat"), F.col("lon").alias("primary_lon"), F.col("n").alias("primary_coord_trips"), "total_name_trips", "coord_count")


def fuzzy_at_one_place(obs: DataFrame, ratio: float = 0.80, partial: float = 0.80, overlap: float = 0.85) -> DataFrame:
    """Pairs of normalized names of one coordinate that any of three scores calls alike."""
    names = obs.select("coord_key", "normalized_name").distinct()
    a, b = names.withColumnRenamed("normalized_name", "name_a"), names.withColumnRenamed("normalized_name", "name_b")
    pairs = a.join(b, "coord_key").where("name_a < name_b")
    return _scored(pairs, "name_a", "name_b", similarity.partial_ratio, ratio, partial, overlap)


def _scored(pairs: DataFrame, left: str, right: str, partial_udf, ratio: float, partial: float, overlap: float) -> DataFrame:
    s = pairs.withColumns({"ratio_score": similarity.ratio(left, right), "partial_ratio_score": partial_udf(left, right), "token_overlap_score": text.token_overlap(F.col(left), F.col(right))})
    s = s.where((F.col("ratio_score") >= ratio) | (F.col("partial_ratio_score") >= partial) | (F.col("token_overlap_score") >= overlap))
    scores = ["ratio_score", "partial_ratio_score", "token_overlap_score"]
    return s.withColumn("max_score", F.round(F.greatest(*scores), 4)).withColumns({c: F.round(c, 4) for c in scores})


def blocked_pairs(profile: DataFrame, tile: int = 1000) -> DataFrame:
    """Pairs (left_*, right_*) of different primary coordinates that share a blocking token; left has more trips.

    A pair comes from the least token that it shares, so none comes twice. Names of a token
    that more than ``tile`` names hold are dealt into tiles on the left side, and go to each of
    them on the right, so no task holds all pairs of a common token.
    """
    p = profile.withColumn("tokens", text.blocking_tokens(F.col("normalized_name"))).withColumn("token", F.explode("tokens"))
    tiles = p.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    p = p.join(tiles, "token")
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in (*profile.columns, "tokens")]
    a = p.select("token", F.pmod(F.xxhash64("normalized_name"), F.col("tiles")).cast("int").alias("tile"), *side("left"))
    b = p.select("token", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), *side("right"))
    before = (F.col("left_total_name_trips") > F.col("right_total_name_trips")) | ((F.col("left_total_name_trips") == F.col("right_total_name_trips")) & (F.col("left_normalized_name") < F.col("right_normalized_name")))
    apart = ~((F.col("left_primary_lat") == F.col("right_primary_lat")) & (F.col("left_primary_lon") == F.col("right_primary_lon")))
    once = F.col("token") == F.array_min(F.array_intersect("left_tokens", "right_tokens"))
    return a.join(b, ["token", "tile"]).where(before & apart & once).drop("token", "tile", "left_tokens", "right_tokens")


def similar_names(profile: DataFrame, ratio: float = 0.80, partial: float = 0.85, overlap: float = 0.80) -> DataFrame:
    """Blocked pairs that any of three scores calls alike, with their distance in km."""
    s = _scored(blocked_pairs(profile), "left_normalized_name", "right_normalized_name", similarity.partial_ratio_fast, ratio, partial, overlap)
    km = geo.haversine_km(F.col("left_primary_lat"), F.col("left_primary_lon"), F.col("right_primary_lat"), F.col("right_primary_lon"))
    return s.withColumn("distance_km", F.round(km, 4))


def distance_buckets(pairs: DataFrame) -> DataFrame:
    d = F.col("distance_km")
    return pairs.agg(F.count_if(d <= 0.2).alias("near"), F.count_if((d > 0.2) & (d <= 1.0)).alias("middle"), F.count_if(d > 1.0).alias("far"))


def station_groups(pairs: DataFrame, within_km: float = PAIR_KM) -> DataFrame:
    """(group_id, canonical_name, member_name, group_size): components of close pairs; ids by size, then name."""
    edges = pairs.where(F.col("distance_km") <= within_km).select(F.col("left_normalized_name").alias("src"), F.col("right_normalized_name").alias("dst"))
    comp = connected_components(edges)
    size = comp.groupBy("component").agg(F.count(F.lit(1)).alias("group_size"))
    ids = positions(size.withColumn("neg", -F.col("group_size")), "neg", "component").select("component", "group_size", F.format_string("station_group_%04d", F.col("pos") + 1).alias("group_id"))
    return comp.join(ids, "component").select("group_id", F.col("component").alias("canonical_name"), F.col("node").alias("member_name"), F.col("group_size").cast("int").alias("group_size"))


def canonical_mapping(obs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The mapping of every observation to a canonical station: group votes, anchors, ids by trips."""
    obs = materialize(obs, "observations")  # read in four places
    coords = obs.groupBy("coord_key", "lat", "lon").agg(F.sum("trip_count").alias("coord_total_trips"))
    if groups is None:
        grouped = coords.withColumn("group_id", F.lit(None).cast("string"))
    else:
        votes = obs.join(groups.select("group_id", F.col("member_name").alias("normalized_name")).distinct(), "normalized_name").groupBy("coord_key", "group_id").agg(F.sum("trip_count").alias("votes"))
        best = first_per_key(votes, ["coord_key"], desc("votes"), asc("group_id")).select("coord_key", "group_id")
        grouped = coords.join(best, "coord_key", "left")
    anchors = first_per_key(grouped.where("group_id IS NOT NULL"), ["group_id"], desc("coord_total_trips"), asc("coord_key")).select("group_id", F.col("coord_key").alias("anchor"))
    anchored = grouped.join(anchors, "group_id", "left").withColumn("canonical_coord_key", F.coalesce("anchor", "coord_key"))
    totals = anchored.groupBy("canonical_coord_key").agg(F.sum("coord_total_trips").alias("canonical_total_trips"))
    ids = positions(totals.withColumn("neg", -F.col("canonical_total_trips")), "neg", "canonical_coord_key")
    lat, lon = geo.split_key(F.col("canonical_coord_key"))
    ids = ids.select("canonical_coord_key", "canonical_total_trips", F.format_string("STN_%04d", F.col("pos") + 1).alias("canonical_station_id"), F.substring(F.sha2("canonical_coord_key", 256), 1, 12).alias("stable_id"), lat.alias("canonical_lat"), lon.alias("canonical_lon"))
    full = obs.join(anchored.select("coord_key", "group_id", "canonical_coord_key"), "coord_key").join(ids, "canonical_coord_key")
    return full.select("canonical_station_id", "stable_id", "canonical_coord_key", "canonical_lat", "canonical_lon", "group_id", *obs.columns, "canonical_total_trips")


def canonical_summary(mapping: DataFrame) -> DataFrame:
    g = mapping.groupBy("canonical_station_id", "canonical_coord_key", "canonical_lat", "canonical_lon", "canonical_total_trips")
    return g.agg(F.count_distinct("raw_name").alias("raw_name_variants"), F.count_distinct("normalized_name").alias("normalized_name_variants"), F.count_distinct("coord_key").alias("coord_variants"), F.min("first_year_seen").alias("first_year_seen"), F.max("last_year_seen").alias("last_year_seen"))


def name_conflicts(mapping: DataFrame) -> DataFrame:
    g = mapping.groupBy("normalized_name").agg(F.count_distinct("canonical_station_id").alias("canonical_id_count"), F.sum("trip_count").alias("total_trips"))
    return g.where("canonical_id_count > 1")


def map_trips(trips: DataFrame, mapping: DataFrame) -> DataFrame:
    """trips with start and end canonical ids, looked up by normalized name and coordinate."""
    look = mapping.select("normalized_name", "coord_key", "canonical_station_id").distinct()
    out = trips
    for p in ("start", "end"):
        side = look.select(F.col("normalized_name").alias(f"__{p}_name"), F.col("coord_key").alias(f"__{p}_key"), F.col("canonical_station_id").alias(f"{p}_canonical_id"))
        key = geo.coord_key(F.col(f"{p}_station_latitude"), F.col(f"{p}_station_longitude"))
        out = out.join(side, (text.normalize_name(F.col(f"{p}_station_name")) == F.col(f"__{p}_name")) & (key == F.col(f"__{p}_key")), "left").drop(f"__{p}_name", f"__{p}_key")
    return out


def mapping_validation(trips: DataFrame, mapping: DataFrame) -> DataFrame:
    """(metric, value): trips, self loops before and after, unmapped ends, coordinates with several ids."""
    m = map_trips(trips, mapping)
    raw = (F.col("start_station_name") == F.col("end_station_name")) & (F.col("start_station_latitude") == F.col("end_station_latitude")) & (F.col("start_station_longitude") == F.col("end_station_longitude"))
    s, e = F.col("start_canonical_id"), F.col("end_canonical_id")
    one = m.agg(F.count(F.lit(1)).alias("total_trips"), F.count_if(raw).alias("raw_self_loops"), F.count_if(s == e).alias("canonical_self_loops"), F.count_if(s.isNull() | e.isNull()).alias("unmapped_trips"))
    many = mapping.groupBy("coord_key").agg(F.count_distinct("canonical_station_id").alias("c")).agg(F.count_if(F.col("c") > 1).alias("coordinates_with_several_ids"))
    return metric_table(one.crossJoin(F.broadcast(many)))


def export(mapping: DataFrame, root: str) -> None:
    write_parquet(mapping, f"{root}/station_canonical_mapping")
    write_parquet(canonical_summary(mapping), f"{root}/station_canonical_summary")
    write_parquet(name_conflicts(mapping), f"{root}/station_name_conflicts")
