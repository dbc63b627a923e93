"""Registered queries over the driver tables, and the DuckDB SQL of each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewheel.functions import geo, similarity, text, timefn
from tidewheel.operators import core, entity, flow, layers, places, profile, trips as tr
from tidewheel.plans import source_queries
from tidewheel.plans.ordering import merge_by_position
from tidewheel.plans.storage import shared_path
from tidewheel.schemas import MAPPING_COLUMNS
from tidewheel.sources import files
from tidewheel.sources.adapter import EVENTS_SQL, TIERS_SQL, TRIPS_SQL, station_events, station_tiers, table, trips

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DAY = 86_400_000
DEPOT = "NATION_3 / BUILDING"


def add(name: str, f: Callable[[SparkSession, str], DataFrame], sql: str | None = None, over: str = "") -> None:
    """over: t for trips, e for events with tiers; it puts their definitions before the SQL."""
    QUERIES[name] = f
    if sql:
        head = {"": "", "t": TRIPS_SQL, "e": f"{EVENTS_SQL}, {TIERS_SQL}"}[over]
        for own in ("WITH RECURSIVE ", "WITH ", ""):
            if sql.startswith(own):
                ORACLE[name] = f"{own or 'WITH '}{head}{', ' if own else ' '}{sql[len(own) :]}" if head else sql
                break


def on_trips(name: str, f: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    add(name, lambda s, d: f(trips(s, d)), sql, "t")


def on_events(name: str, f: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    add(name, lambda s, d: f(station_events(s, d)), sql, "e")


D = "(end_time_ms - start_time_ms)"
SAME = "(start_station_name = end_station_name AND start_station_latitude = end_station_latitude AND start_station_longitude = end_station_longitude)"
TS = "make_timestamp(start_time_ms * 1000)"
DEP_S, DEP_E = f"start_station_name = '{DEPOT}'", f"end_station_name = '{DEPOT}'"

# --- time, districts, routes
on_trips("hour_by_weekday", tr.hour_by_weekday, f"SELECT hour({TS})::BIGINT AS hour, dayofweek({TS})::BIGINT AS dow, count(*) AS n, avg({D}) AS avg_ms FROM trips GROUP BY ALL")
on_events("temporal_hour_dow", lambda e: e.groupBy(timefn.hour(F.col("ts")).alias("hour"), timefn.dow_sunday0(F.col("ts")).alias("dow")).agg(tr.count()), "SELECT hour(ts) AS hour, dayofweek(ts) AS dow, count(*) AS n FROM ev GROUP BY ALL")


def _by_hour(e: DataFrame) -> DataFrame:
    return e.groupBy(timefn.hour(F.col("ts")).alias("hour"), timefn.dow_sunday0(F.col("ts")).alias("dow")).agg(tr.count())


on_events("hour_rollup", lambda e: _by_hour(e).groupBy("hour").agg(F.sum("n").alias("n")), "SELECT hour(ts) AS hour, count(*) AS n FROM ev GROUP BY ALL")
on_events("busiest_hours", lambda e: core.top(_by_hour(e), 5, core.desc("n"), core.asc("hour"), core.asc("dow")), "SELECT hour(ts) AS hour, dayofweek(ts) AS dow, count(*) AS n FROM ev GROUP BY ALL ORDER BY n DESC, hour, dow LIMIT 5")
on_events("slowest_hours", lambda e: core.top(_by_hour(e), 5, core.asc("n"), core.asc("hour"), core.asc("dow")), "SELECT hour(ts) AS hour, dayofweek(ts) AS dow, count(*) AS n FROM ev GROUP BY ALL ORDER BY n, hour, dow LIMIT 5")
on_events("last_hours", lambda e: core.tail(_by_hour(e), 5, "hour", "dow"), "SELECT hour(ts) AS hour, dayofweek(ts) AS dow, count(*) AS n FROM ev GROUP BY ALL ORDER BY hour DESC, dow DESC LIMIT 5")
on_events("pivot_dow_hour", lambda e: core.pivot_counts(_by_hour(e), "dow", "hour", list(range(24))), "SELECT dayofweek(ts) AS dow, " + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS c{h}" for h in range(24)) + " FROM ev GROUP BY ALL")
on_events("day_names", lambda e: e.groupBy(timefn.day_name(timefn.dow_sunday0(F.col("ts"))).alias("day"), timefn.dow_monday0(F.col("ts")).alias("monday0")).agg(tr.count()), "SELECT dayname(ts) AS day, (isodow(ts) - 1)::BIGINT AS monday0, count(*) AS n FROM ev GROUP BY ALL")
for _side in ("start", "end"):
    on_trips(f"top_{_side}_stations", lambda t, s=_side: tr.top_stations(t, s), f"SELECT {_side}_station_name, {_side}_station_district, count(*) AS n FROM trips GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT 30")
on_trips("intra_inter_district", tr.intra_inter, f"WITH g AS (SELECT CASE WHEN start_station_district = end_station_district THEN 'Intra-District' ELSE 'Inter-District' END AS kind, count(*) AS n, avg({D}) AS avg_ms FROM trips GROUP BY ALL) SELECT *, n * 100.0::DOUBLE / sum(n) OVER () AS percentage FROM g")
on_trips("district_popularity", tr.district_popularity, "SELECT start_station_district, count(*) AS n, count(DISTINCT start_station_name) AS n_start, count(DISTINCT end_station_name) AS n_end FROM trips GROUP BY ALL")
on_trips("district_flows", tr.district_flows, "SELECT start_station_district, end_station_district, count(*) AS n FROM trips GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT 30")
on_trips("top_routes", tr.top_routes, f"SELECT start_station_name, end_station_name, count(*) AS n, avg({D}) AS avg_ms FROM trips GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT 100")
on_trips("name_variations", lambda t: tr.name_variations(t, "%NATION_1 /%"), "SELECT start_station_name, start_station_latitude, start_station_longitude, count(*) AS n FROM trips WHERE start_station_name LIKE '%NATION_1 /%' GROUP BY ALL")


def _renamed(t: DataFrame) -> DataFrame:
    """Trips whose station names changed case with the year: several names a coordinate."""
    late = timefn.year(timefn.instant(F.col("start_time_ms"))) % 2 == 0
    return t.withColumn("start_station_name", F.when(late & (F.col("start_station_district") != "ASIA"), F.lower("start_station_name")).otherwise(F.col("start_station_name")))


RENAMED = f"WITH r AS (SELECT * REPLACE (CASE WHEN year({TS}) % 2 = 0 AND start_station_district <> 'ASIA' THEN lower(start_station_name) ELSE start_station_name END AS start_station_name) FROM trips), m AS (SELECT start_station_latitude, start_station_longitude, min(start_station_name) AS a_name, count(DISTINCT start_station_name) AS names, count(*) AS n FROM r GROUP BY 1, 2 HAVING names > 1)"
NAMES_AT = f"{RENAMED}, k AS (SELECT * FROM m ORDER BY names DESC, n DESC, 1, 2 LIMIT 5), q AS (SELECT start_station_latitude, start_station_longitude, start_station_name, year({TS}) AS year, count(*) AS n FROM r SEMI JOIN k USING (start_station_latitude, start_station_longitude) GROUP BY ALL)"
on_trips("multi_name_locations", lambda t: tr.multi_name_locations(_renamed(t)), f"{RENAMED} SELECT * FROM m")
on_trips("names_by_year", lambda t: tr.names_at_locations(_renamed(t)), f"{NAMES_AT} SELECT * FROM q")
_YEARS = range(1995, 2002)
on_trips("names_by_year_pivot", lambda t: core.pivot_counts(tr.names_at_locations(_renamed(t)), "start_station_name", "year", list(_YEARS), prefix="y").withColumn("total", sum((F.col(f"y{y}") for y in _YEARS), F.lit(0))), f"{NAMES_AT} SELECT start_station_name, " + ", ".join(f"coalesce(sum(n) FILTER (year = {y}), 0)::BIGINT AS y{y}" for y in _YEARS) + ", sum(n)::BIGINT AS total FROM q GROUP BY ALL")
on_trips("hub_connectivity", tr.hub_connectivity, f"SELECT start_station_name, start_station_district, count(DISTINCT end_station_name) AS destinations, count(*) AS n, avg({D}) AS avg_ms FROM trips GROUP BY ALL ORDER BY destinations DESC, n DESC, 1, 2 LIMIT 30")

# --- durations
_P = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99"))
on_trips("duration_stats", tr.duration_stats, f"SELECT min({D}) AS min_ms, max({D}) AS max_ms, avg({D}) AS avg_ms, " + ", ".join(f"quantile_cont({D}, {p}) AS {a}" for p, a in _P) + " FROM trips")
on_trips("iqr_outliers", tr.iqr_outliers, f"WITH q AS (SELECT quantile_cont({D}, 0.25) AS a, quantile_cont({D}, 0.75) AS b FROM trips), l AS (SELECT a - 1.5 * (b - a) AS lower, b + 1.5 * (b - a) AS upper FROM q) SELECT lower, upper, count(*) FILTER ({D} < lower) AS below, count(*) FILTER ({D} > upper) AS above, count({D}) AS n, (count(*) FILTER ({D} < lower) + count(*) FILTER ({D} > upper)) * 100.0::DOUBLE / count({D}) AS percentage FROM trips, l GROUP BY 1, 2")


def _routes_sql(where: str) -> str:
    return f"SELECT start_station_name, end_station_name, CASE WHEN {SAME} THEN 'SAME_STATION' ELSE 'DIFFERENT_STATION' END AS kind, count(*) AS n, avg({D}) AS avg_ms, min({D}) AS min_ms, max({D}) AS max_ms, median({D}) AS median_ms FROM trips WHERE {where} GROUP BY ALL"


_SHORT, _LONG = f"{D} < {100 * DAY}", f"{D} > {1200 * DAY}"
on_trips("short_trips", lambda t: tr.short_trips(t, 100 * DAY), _routes_sql(_SHORT))
on_trips("long_trips", lambda t: tr.long_trips(t, 1200 * DAY), _routes_sql(_LONG))
on_trips("short_trips_by_kind", lambda t: tr.by_kind(tr.short_trips(t, 100 * DAY)), f"WITH g AS ({_routes_sql(_SHORT)}), h AS (SELECT kind, sum(n)::BIGINT AS n, count(*) AS routes FROM g GROUP BY ALL) SELECT *, n * 100.0::DOUBLE / sum(n) OVER () AS percentage FROM h")
on_trips("long_trip_subset", lambda t: tr.duration_subset(t, tr.duration() > 1200 * DAY, DAY), f"WITH g AS (SELECT {D} / {float(DAY)}::DOUBLE AS d FROM trips WHERE {_LONG}) SELECT count(d) AS n, avg(d) AS mean, median(d) AS median, min(d) AS lo, max(d) AS hi, " + ", ".join(f"quantile_cont(d, {p / 100}) AS p{p}" for p in (25, 75, 90, 95, 99)) + " FROM g")
on_trips("validity_filters", lambda t: tr.validity_counts(t, depot=DEPOT, short_ms=100 * DAY, long_ms=1200 * DAY), f"SELECT ({_SHORT} AND {SAME}) AS short_same, {_LONG} AS long, ({DEP_S} OR {DEP_E}) AS depot, count(*) AS n FROM trips GROUP BY ALL")
_HIST = """WITH v AS (SELECT {d}::DOUBLE AS v FROM {f}), e AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {b}.0::DOUBLE AS w FROM v),
c AS (SELECT least({b} - 1, floor((v - lo) / w))::BIGINT AS bin, count(*) AS n FROM v, e GROUP BY ALL)
SELECT g.bin, lo + g.bin * w AS lo, coalesce(n, 0) AS n FROM (SELECT unnest(range({b})) AS bin) g CROSS JOIN e LEFT JOIN c USING (bin)"""
on_trips("duration_histogram", lambda t: profile.histogram(t.select(tr.duration().alias("d")), "d", 50), _HIST.format(d=D, f="trips", b=50))
on_trips("duration_box", lambda t: profile.box(t.select(tr.duration().alias("d")), "d"), f"WITH q AS (SELECT quantile_cont({D}, 0.25)::DOUBLE AS q1, median({D})::DOUBLE AS median, quantile_cont({D}, 0.75)::DOUBLE AS q3 FROM trips), v AS (SELECT {D}::DOUBLE AS v, q.*, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM trips, q) SELECT q1, median, q3, min(v) FILTER (ok) AS low, max(v) FILTER (ok) AS high, count(*) FILTER (NOT ok) AS outliers FROM v GROUP BY ALL")
on_trips("trimmed_durations", tr.trimmed, f"WITH q AS (SELECT quantile_cont({D}, 0.99) AS cut FROM trips) SELECT count(*) AS n, avg({D}) AS mean, max({D}) AS hi FROM trips, q WHERE {D} <= cut")

# --- depot
on_trips("depot_stats", lambda t: tr.depot_counts(t, DEPOT), f"SELECT count(*) FILTER ({DEP_S}) AS from_depot, count(*) FILTER ({DEP_E}) AS to_depot, count(*) FILTER ({DEP_S} AND {DEP_E}) AS within, count(*) FILTER ({DEP_S} OR {DEP_E}) AS any, count(*) AS n FROM trips")
for _side, _other, _where in (("start", "end", DEP_S), ("end", "start", DEP_E)):
    on_trips(f"depot_routes_{'from' if _side == 'start' else 'to'}", lambda t, s=_side: tr.depot_routes(t, DEPOT, s), f"SELECT {_other}_station_name, {_other}_station_latitude, {_other}_station_longitude, count(*) AS n, avg({D}) AS avg_ms, median({D}) AS median_ms FROM trips WHERE {_where} GROUP BY ALL ORDER BY n DESC, 1, 2, 3 LIMIT 30")
on_trips("depot_durations", lambda t: tr.depot_durations(t, DEPOT), " UNION ALL ".join(f"SELECT '{n} depot' AS category, count(*) AS n, avg({D}) AS avg_ms, median({D}) AS median_ms FROM trips WHERE {w} HAVING count(*) > 0" for n, w in (("FROM", DEP_S), ("TO", DEP_E), ("WITHIN", f"{DEP_S} AND {DEP_E}"))))
on_trips("depot_daily", lambda t: tr.depot_daily(t, DEPOT), f"SELECT {TS}::DATE AS day, count(*) AS n, count(*) FILTER ({DEP_S}) AS departures, count(*) FILTER ({DEP_E}) AS arrivals FROM trips WHERE {DEP_S} OR {DEP_E} GROUP BY ALL ORDER BY n DESC, day LIMIT 20")
on_trips("depot_directions", lambda t: tr.depot_directions(t, DEPOT), f"SELECT CASE WHEN {DEP_S} THEN 'FROM' ELSE 'TO' END AS direction, count(*) AS n FROM trips WHERE {DEP_S} OR {DEP_E} GROUP BY ALL")
on_trips("overview", tr.overview, f"SELECT count(*) AS n, count(DISTINCT start_station_name) AS start_stations, count(DISTINCT end_station_name) AS end_stations, min({TS}) AS first, max({TS}) AS last FROM trips")
UNION = "SELECT start_station_name AS name, start_station_latitude AS latitude, start_station_longitude AS longitude FROM trips UNION SELECT end_station_name, end_station_latitude, end_station_longitude FROM trips"
on_trips("union_distinct_stations", tr.stations, UNION)
KM = "2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"
_TRIP_KM = KM.format(a="start_station_latitude", b="start_station_longitude", c="end_station_latitude", d="end_station_longitude")
on_trips("distance_by_district", tr.distance_by_district, f"SELECT start_station_district, count(*) AS n, avg({_TRIP_KM}) AS avg_km, corr({_TRIP_KM}, {D}) AS corr_km_ms FROM trips GROUP BY ALL")
add("parameterized_sql", lambda s, d: s.sql("SELECT start_station_name, count(*) AS n FROM {t} GROUP BY ALL HAVING n >= :least", args={"least": 500}, t=trips(s, d)), "SELECT start_station_name, count(*) AS n FROM trips GROUP BY ALL HAVING n >= 500", "t")
on_trips("named_list_filter", lambda t: t.join(t.sparkSession.createDataFrame([("NATION_1 / BUILDING",), ("it's none",)], "start_station_name string"), "start_station_name", "left_semi").groupBy("start_station_name").agg(tr.count()), "SELECT start_station_name, count(*) AS n FROM trips WHERE start_station_name IN ('NATION_1 / BUILDING', 'it''s none') GROUP BY ALL")

# --- events: flows, behaviour, stockouts
on_events("activity", flow.activity, "SELECT station, count(*) FILTER (direction = 'out') AS departures, count(*) FILTER (direction = 'in') AS arrivals, count(*) AS total FROM ev GROUP BY ALL")
on_events("activity_top5", lambda e: flow.activity(e, 5), "SELECT station, count(*) FILTER (direction = 'out') AS departures, count(*) FILTER (direction = 'in') AS arrivals, count(*) AS total FROM ev GROUP BY ALL ORDER BY total DESC, station LIMIT 5")
on_events("activity_full_outer", flow.activity_joined, "WITH o AS (SELECT station, count(*) AS n FROM ev WHERE direction = 'out' GROUP BY ALL), i AS (SELECT station, count(*) AS n FROM ev WHERE direction = 'in' GROUP BY ALL) SELECT station, coalesce(o.n, 0) AS departures, coalesce(i.n, 0) AS arrivals FROM o FULL JOIN i USING (station)")
_TIER = "CASE WHEN metres <= 150 THEN 'Tier 1' WHEN metres <= 400 THEN 'Tier 2' ELSE 'Tier 3' END"
_NET = f"SELECT {_TIER} AS tier, hour(ts) AS hour, count(*) FILTER (direction = 'out') AS departures, count(*) FILTER (direction = 'in') AS arrivals, arrivals - departures AS net FROM ev JOIN tiers USING (station) GROUP BY 1, 2"
add("netflow_tier_hour", lambda s, d: flow.net_flow_by_tier(station_events(s, d), station_tiers(s, d)), _NET, "e")
add("peak_hours", lambda s, d: flow.peak_hours(flow.net_flow_by_tier(station_events(s, d), station_tiers(s, d))), f"WITH g AS ({_NET}), r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY net DESC, hour) AS a, row_number() OVER (PARTITION BY tier ORDER BY net, hour) AS b FROM g) SELECT x.tier, x.hour AS sink_hour, x.net AS sink_net, y.hour AS source_hour, y.net AS source_net FROM r x JOIN r y ON x.tier = y.tier AND x.a = 1 AND y.b = 1", "e")
add("melt_flows", lambda s, d: core.melt(flow.net_flow_by_tier(station_events(s, d), station_tiers(s, d)), ["tier", "hour"], ["departures", "arrivals"], "flow", "trips"), f"WITH g AS ({_NET}) SELECT tier, hour, 'departures' AS flow, departures AS trips FROM g UNION ALL SELECT tier, hour, 'arrivals', arrivals FROM g", "e")
add("dimension_fan_out", lambda s, d: station_events(s, d).join(station_tiers(s, d).unionByName(station_tiers(s, d).where("station < 20")), "station").groupBy("station").agg(tr.count()), "SELECT station, count(*) AS n FROM ev JOIN (SELECT * FROM tiers UNION ALL SELECT * FROM tiers WHERE station < 20) USING (station) GROUP BY ALL", "e")
_OUT = "SELECT station, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n FROM ev WHERE direction = 'out' GROUP BY ALL"
_DENSE = f"o AS ({_OUT}), s AS (SELECT station, min(hour) AS lo, max(hour) AS hi FROM o GROUP BY ALL), g AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM s), dense AS (SELECT station, hour, coalesce(n, 0)::BIGINT AS n FROM g LEFT JOIN o USING (station, hour))"
_EXPECT = f"{_DENSE}, x AS (SELECT *, avg(n) OVER (PARTITION BY station, isodow(hour), hour(hour)) AS expected FROM dense), so AS (SELECT station, hour, expected FROM x WHERE n = 0 AND expected > 0.3)"
on_events("hourly_outflow", flow.hourly_outflow, _OUT)
on_events("dense_hours", flow.dense_outflow, f"WITH {_DENSE} SELECT * FROM dense")
on_events("shadow_stockouts", lambda e: flow.shadow_stockouts(e, 0.3), f"WITH {_EXPECT} SELECT * FROM so")
on_events("stockout_slice", lambda e: flow.around_middle(flow.dense_outflow(e), flow.shadow_stockouts(e, 0.3)), f"WITH {_EXPECT}, m AS (SELECT station, hour AS mid FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY hour) AS rn, count(*) OVER (PARTITION BY station) AS c FROM so) WHERE rn = c // 2 + 1) SELECT station, hour, n FROM dense JOIN m USING (station) WHERE hour BETWEEN mid - INTERVAL 2 DAY AND mid + INTERVAL 2 DAY")
_WEEK = "w AS (SELECT station, count(*) FILTER (dayofweek(ts) NOT IN (0, 6)) AS weekday, count(*) FILTER (dayofweek(ts) IN (0, 6)) AS weekend, count(*) AS total FROM ev WHERE direction = 'out' GROUP BY ALL HAVING count(*) > 10)"
_ARCH = f"WITH {_WEEK} SELECT *, weekday * 100.0::DOUBLE / total AS weekday_pct, weekend * 100.0::DOUBLE / total AS weekend_pct, CASE WHEN weekday_pct >= 80 THEN 'Commuter' WHEN weekend_pct >= 35 THEN 'Leisure' ELSE 'Mixed' END AS archetype FROM w"
_SHIFT = f"WITH {_WEEK} SELECT station, weekday / 5.0::DOUBLE AS weekday_avg, weekend / 2.0::DOUBLE AS weekend_avg, weekend_avg - weekday_avg AS surge, CASE WHEN surge > 15 THEN 'Weekend Destination' WHEN surge < -15 THEN 'Weekday Hub' ELSE 'Neutral' END AS shift FROM w"
on_events("weekday_weekend_archetype", lambda e: flow.archetypes(e, 10), _ARCH)
on_events("archetype_counts", lambda e: flow.archetype_counts(flow.archetypes(e, 10)), f"{_ARCH.replace('WITH ', 'WITH ', 1)}".replace("SELECT *, weekday *", "SELECT archetype, count(*) AS n FROM (SELECT *, weekday *", 1) + ") GROUP BY archetype")
on_events("weekend_shift", lambda e: flow.weekend_shift(e, 10), _SHIFT)
on_events("largest_shift", lambda e: flow.largest_shift(flow.weekend_shift(e, 10)), f"{_SHIFT} ORDER BY abs(surge) DESC, station LIMIT 10")


def _pressure(s: SparkSession, d: str) -> DataFrame:
    capacity = table(s, d, "supplier").select(F.col("s_suppkey").alias("station"), (F.col("s_suppkey") % 23).alias("capacity"))
    return flow.outflow_pressure(flow.hourly_average(station_events(s, d), capacity.select("station")), capacity)


add("outflow_pressure", _pressure, "WITH cap AS (SELECT s_suppkey AS station, s_suppkey % 23 AS capacity FROM supplier), r AS (SELECT station, ts - INTERVAL 4 HOUR AS loc FROM ev SEMI JOIN cap USING (station) WHERE direction = 'out'), a AS (SELECT station, hour(loc) AS hour, count(*)::DOUBLE / max((SELECT count(DISTINCT loc::DATE) FROM r)) AS daily_avg FROM r GROUP BY ALL) SELECT station, hour, daily_avg, capacity, CASE WHEN capacity <> 0 THEN daily_avg / capacity * 100 END AS pressure FROM a JOIN cap USING (station)", "e")
on_events("velocity", flow.velocity, "SELECT station, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) FILTER (direction = 'in') AS inflow, count(*) FILTER (direction = 'out') AS outflow, inflow + outflow AS velocity, abs(inflow - outflow) AS imbalance FROM ev GROUP BY 1, 2")
for _p in ("day", "week", "month"):
    on_events(f"leaderboard_{_p}", lambda e, p=_p: flow.leaderboard(e, p), f"WITH g AS (SELECT date_trunc('{_p}', ts)::DATE AS period, station, count(*) AS n FROM ev GROUP BY ALL), r AS (SELECT *, rank() OVER (PARTITION BY period ORDER BY n DESC) AS rank FROM g), l AS (SELECT *, coalesce(lag(rank) OVER (PARTITION BY station ORDER BY period), 0) AS before FROM r) SELECT * FROM l WHERE rank <= 3")
on_events("moving_average_7d", flow.moving_average, "WITH g AS (SELECT station, ts::DATE AS day, count(*) AS n FROM ev GROUP BY ALL) SELECT *, avg(n) OVER (PARTITION BY station ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS mean FROM g")
on_events("moving_average_30d", lambda e: flow.moving_average(e, 30), "WITH g AS (SELECT station, ts::DATE AS day, count(*) AS n FROM ev GROUP BY ALL) SELECT *, avg(n) OVER (PARTITION BY station ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS mean FROM g")
_DEAD = f"{_DENSE}, y AS (SELECT *, avg(n) OVER (PARTITION BY station) AS mean, sum((n > 0)::INT) OVER (PARTITION BY station ORDER BY hour) AS island FROM dense), runs AS (SELECT station, min(hour) AS since, count(*) AS hours, max(mean) AS mean FROM y WHERE n = 0 GROUP BY station, island HAVING count(*) >= 3), dead AS (SELECT r.station, since, hours, hours * mean AS risk, CASE WHEN count(*) FILTER (e.direction = 'in') < count(*) FILTER (e.direction = 'out') THEN 'empty' ELSE 'full' END AS probably FROM runs r LEFT JOIN ev e ON e.station = r.station AND e.ts >= since - INTERVAL 24 HOUR AND e.ts < since GROUP BY r.station, since, hours, mean)"
on_events("dead_periods", flow.dead_periods, f"WITH {_DEAD} SELECT * FROM dead")
on_events("early_warnings", lambda e: flow.early_warnings(e, 2), f"WITH {_DEAD}, v AS (SELECT station, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS since, count(*) AS velocity FROM ev GROUP BY ALL HAVING count(*) >= 2) SELECT dead.*, velocity FROM dead JOIN v USING (station, since)")
on_events("month_by_hour", flow.month_by_hour, "SELECT date_trunc('month', ts)::DATE AS month, hour(ts) AS hour, count(*) FILTER (dayofweek(ts) NOT IN (0, 6)) AS weekday, count(*) FILTER (dayofweek(ts) IN (0, 6)) AS weekend FROM ev GROUP BY ALL")
on_events("naive_utc", lambda e: e.groupBy(timefn.hour(timefn.local(F.col("ts"))).alias("hour")).agg(tr.count()), "SELECT hour(ts - INTERVAL 4 HOUR) AS hour, count(*) AS n FROM ev GROUP BY ALL")
on_trips("epoch_naive", lambda t: t.groupBy(timefn.utc_naive(F.col("start_time_ms")).alias("at")).agg(tr.count()), f"SELECT {TS} AS at, count(*) AS n FROM trips GROUP BY ALL")

# --- text
_NORM = r"lower(trim(regexp_replace(regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '\s*/\s*', ' / ', 'g'), '\s*-\s*', '-', 'g'), ' '))"
add("normalize_names", lambda s, d: table(s, d, "documents").select("doc_id", F.sha2(text.normalize_name(F.col("text")), 256).alias("name")), f"SELECT doc_id, sha256({_NORM.format(x='text')}) AS name FROM documents")
add("first_match_clean", lambda s, d: table(s, d, "documents").select("doc_id", F.sha2(text.drop_first_outside(F.col("text")), 256).alias("name")), "SELECT doc_id, sha256(regexp_replace(text, '[^a-zA-Z0-9 -/]', '')) AS name FROM documents")
add("all_match_clean", lambda s, d: table(s, d, "documents").select("doc_id", F.sha2(text.clean_all(F.col("text")), 256).alias("name")), "SELECT doc_id, sha256(trim(upper(regexp_replace(text, '[^a-zA-Z0-9 -/]', '', 'g')))) AS name FROM documents")
_TOK = "list_distinct(regexp_extract_all(lower({x}), '[a-z0-9]+'))"
_STOP = "[" + ", ".join(f"'{t}'" for t in text.COMMON_TOKENS) + "]"
add("blocking_tokens", lambda s, d: table(s, d, "documents").select("doc_id", F.sha2(F.array_join(text.blocking_tokens(F.col("text")), ","), 256).alias("tokens")), f"SELECT doc_id, sha256(coalesce(array_to_string(list_sort(list_filter({_TOK.format(x='text')}, lambda t: length(t) >= 3 AND NOT list_contains({_STOP}, t))), ','), '')) AS tokens FROM documents")
_PARTS = "WITH p AS (SELECT DISTINCT p_name || ' ' || p_type AS a, p_name AS b FROM part)"
add("token_overlap", lambda s, d: (p := table(s, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("a"), F.col("p_type").alias("b")).distinct()).select("a", "b", text.token_overlap(F.col("a"), F.col("b")).alias("overlap")), f"SELECT DISTINCT p_name || ' ' || p_type AS a, p_type AS b, len(list_intersect({_TOK.format(x=chr(112) + '_name || chr(32) || p_type')}, {_TOK.format(x='p_type')}))::DOUBLE / least(len({_TOK.format(x='p_name || chr(32) || p_type')}), len({_TOK.format(x='p_type')})) AS overlap FROM part")
add("edit_distance", lambda s, d: (t := table(s, d, "part").select("p_name").distinct()).alias("l").join(t.alias("r"), (F.split("l.p_name", " ")[0] == F.split("r.p_name", " ")[0]) & (F.col("l.p_name") < F.col("r.p_name"))).select(F.col("l.p_name").alias("a"), F.col("r.p_name").alias("b"), F.levenshtein("l.p_name", "r.p_name").cast("long").alias("edits")), "WITH t AS (SELECT DISTINCT p_name FROM part) SELECT l.p_name AS a, r.p_name AS b, levenshtein(l.p_name, r.p_name) AS edits FROM t l JOIN t r ON split_part(l.p_name, ' ', 1) = split_part(r.p_name, ' ', 1) AND l.p_name < r.p_name")

# --- station resolution
OBS = f"o AS (SELECT start_station_name AS raw_name, round(start_station_latitude, 6) AS lat, round(start_station_longitude, 6) AS lon, count(*) AS trip_count, min(year({TS})) AS first_year_seen, max(year({TS})) AS last_year_seen FROM {{t}} WHERE start_station_name IS NOT NULL GROUP BY 1, 2, 3), obs AS (SELECT raw_name, {_NORM.format(x='raw_name')} AS normalized_name, lat, lon, printf('%.6f,%.6f', lat, lon) AS coord_key, trip_count, first_year_seen, last_year_seen FROM o)"
_R, _O = f"{RENAMED}, {OBS.format(t='r')}", f"WITH {OBS.format(t='trips')}"
on_trips("station_observations", lambda t: entity.observations(_renamed(t)), f"{_R} SELECT * FROM obs")
on_trips("multi_name_report", lambda t: entity.multi_name_report(entity.observations(_renamed(t))), f"{_R} SELECT coord_key, count(DISTINCT raw_name) AS names, string_agg(DISTINCT raw_name, '|' ORDER BY raw_name) AS name_list, sum(trip_count)::BIGINT AS trips, min(first_year_seen) AS first_year, max(last_year_seen) AS last_year FROM obs GROUP BY 1 HAVING names > 1")
on_trips("normalization_impact", lambda t: entity.normalization_impact(entity.observations(_renamed(t))), f"{_R}, g AS (SELECT coord_key, count(DISTINCT raw_name) AS raw, count(DISTINCT normalized_name) AS norm FROM obs GROUP BY 1) SELECT count(*) AS coordinates, count(*) FILTER (raw > 1) AS multi_raw, count(*) FILTER (norm > 1) AS multi_normalized, count(*) FILTER (raw > 1 AND norm = 1) AS resolved FROM g")
_PROFILE = "b AS (SELECT normalized_name, lat, lon, sum(trip_count)::BIGINT AS n FROM obs GROUP BY ALL), k AS (SELECT *, sum(n) OVER (PARTITION BY normalized_name)::BIGINT AS total_name_trips, count(*) OVER (PARTITION BY normalized_name) AS coord_count, row_number() OVER (PARTITION BY normalized_name ORDER BY n DESC, lat, lon) AS rn FROM b), prof AS (SELECT normalized_name, lat AS primary_lat, lon AS primary_lon, n AS primary_coord_trips, total_name_trips, coord_count FROM k WHERE rn = 1 AND total_name_trips >= 50)"
on_trips("name_profile", lambda t: entity.name_profile(entity.observations(t)), f"{_O}, {_PROFILE} SELECT * FROM prof")
_TOKENS = f"list_filter({_TOK.format(x='normalized_name')}, lambda t: length(t) >= 3 AND NOT list_contains({_STOP}, t))"
on_trips("blocking_pairs", lambda t: entity.blocked_pairs(entity.name_profile(entity.observations(t))).select(F.col("left_normalized_name").alias("a"), F.col("right_normalized_name").alias("b")), f"{_O}, {_PROFILE}, x AS (SELECT *, unnest({_TOKENS}) AS token FROM prof) SELECT DISTINCT l.normalized_name AS a, r.normalized_name AS b FROM x l JOIN x r USING (token) WHERE (l.total_name_trips > r.total_name_trips OR l.total_name_trips = r.total_name_trips AND l.normalized_name < r.normalized_name) AND NOT (l.primary_lat = r.primary_lat AND l.primary_lon = r.primary_lon)")
on_trips("similarity_pairs", lambda t: entity.similar_names(entity.name_profile(entity.observations(t))))
on_trips("similarity_buckets", lambda t: entity.distance_buckets(entity.similar_names(entity.name_profile(entity.observations(t)))))
on_trips("fuzzy_at_one_place", lambda t: entity.fuzzy_at_one_place(entity.observations(t.withColumn("start_station_latitude", F.round("start_station_latitude", 1)).withColumn("start_station_longitude", F.lit(-73.5)))))
add("jaro_winkler", lambda s, d: (n := table(s, d, "part").select("p_name").distinct()).alias("l").join(n.alias("r"), (F.split("l.p_name", " ")[1] == F.split("r.p_name", " ")[1]) & (F.col("l.p_name") < F.col("r.p_name"))).select(F.col("l.p_name").alias("a"), F.col("r.p_name").alias("b"), similarity.jaro_winkler("l.p_name", "r.p_name").alias("score")), "WITH t AS (SELECT DISTINCT p_name FROM part) SELECT l.p_name AS a, r.p_name AS b, jaro_winkler_similarity(l.p_name, r.p_name) AS score FROM t l JOIN t r ON split_part(l.p_name, ' ', 2) = split_part(r.p_name, ' ', 2) AND l.p_name < r.p_name")


def _close(t: DataFrame) -> DataFrame:
    """Pairs of names whose primary coordinates are within 0.3 km, as edges for groups."""
    pairs = entity.blocked_pairs(entity.name_profile(entity.observations(t)))
    return pairs.withColumn("distance_km", geo.haversine_km(*(F.col(f"{p}_primary_{c}") for p in ("left", "right") for c in ("lat", "lon"))))


_EDGE = KM.format(a="l.primary_lat", b="l.primary_lon", c="r.primary_lat", d="r.primary_lon")
_GROUPS = f"{OBS.format(t='trips')}, {_PROFILE}, x AS (SELECT *, unnest({_TOKENS}) AS token FROM prof), e AS (SELECT DISTINCT l.normalized_name AS a, r.normalized_name AS b FROM x l JOIN x r USING (token) WHERE l.normalized_name <> r.normalized_name AND NOT (l.primary_lat = r.primary_lat AND l.primary_lon = r.primary_lon) AND {_EDGE} <= 0.3), reach AS (SELECT a AS node, b AS to_ FROM e UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.to_ = e.a), comp AS (SELECT node, least(node, min(to_)) AS c FROM reach GROUP BY node), sz AS (SELECT c, count(*) AS s FROM comp GROUP BY c), gid AS (SELECT c, s, printf('station_group_%04d', row_number() OVER (ORDER BY s DESC, c)) AS group_id FROM sz), grp AS (SELECT group_id, c AS canonical_name, node AS member_name, s::INT AS group_size FROM comp JOIN gid USING (c))"
on_trips("station_groups", lambda t: entity.station_groups(_close(t), 0.3), f"WITH RECURSIVE {_GROUPS} SELECT * FROM grp")
_CANON = f"{_GROUPS}, cs AS (SELECT coord_key, sum(trip_count)::BIGINT AS t FROM obs GROUP BY 1), votes AS (SELECT coord_key, group_id, sum(trip_count) AS v FROM obs JOIN grp ON normalized_name = member_name GROUP BY ALL), best AS (SELECT coord_key, group_id FROM votes QUALIFY row_number() OVER (PARTITION BY coord_key ORDER BY v DESC, group_id) = 1), cg AS (SELECT cs.*, group_id FROM cs LEFT JOIN best USING (coord_key)), anc AS (SELECT group_id, coord_key AS anchor FROM cg WHERE group_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY t DESC, coord_key) = 1), ca AS (SELECT cg.*, coalesce(anchor, coord_key) AS ck FROM cg LEFT JOIN anc USING (group_id)), tot AS (SELECT ck, sum(t)::BIGINT AS canonical_total_trips FROM ca GROUP BY ck), ids AS (SELECT *, printf('STN_%04d', row_number() OVER (ORDER BY canonical_total_trips DESC, ck)) AS canonical_station_id FROM tot), map AS (SELECT canonical_station_id, ck AS canonical_coord_key, group_id, obs.*, canonical_total_trips FROM obs JOIN ca USING (coord_key) JOIN ids USING (ck))"


def _mapping(t: DataFrame) -> DataFrame:
    return entity.canonical_mapping(entity.observations(t), entity.station_groups(_close(t), 0.3))


on_trips("canonical_ids", lambda t: _mapping(t).select("canonical_station_id", "canonical_coord_key", "group_id", "raw_name", "coord_key", "trip_count", "canonical_total_trips"), f"WITH RECURSIVE {_CANON} SELECT canonical_station_id, canonical_coord_key, group_id, raw_name, coord_key, trip_count, canonical_total_trips FROM map")

def _exported(t: DataFrame) -> DataFrame:
    """The mapping as its artifact, written with summary and conflicts, and read back."""
    root = shared_path(t.sparkSession, "artifacts")
    entity.export(_mapping(t), root)
    return files.read_artifact(t.sparkSession, f"{root}/station_canonical_mapping", MAPPING_COLUMNS).select("canonical_station_id", "normalized_name", "coord_key")


on_trips("exported_mapping", _exported, f"WITH RECURSIVE {_CANON} SELECT canonical_station_id, normalized_name, coord_key FROM map")
on_trips("canonical_summary", lambda t: entity.canonical_summary(_mapping(t)).drop("canonical_lat", "canonical_lon"), f"WITH RECURSIVE {_CANON} SELECT canonical_station_id, canonical_coord_key, canonical_total_trips, count(DISTINCT raw_name) AS raw_name_variants, count(DISTINCT normalized_name) AS normalized_name_variants, count(DISTINCT coord_key) AS coord_variants, min(first_year_seen) AS first_year_seen, max(last_year_seen) AS last_year_seen FROM map GROUP BY 1, 2, 3")
on_trips("name_conflicts", lambda t: entity.name_conflicts(_mapping(t)), f"WITH RECURSIVE {_CANON} SELECT normalized_name, count(DISTINCT canonical_station_id) AS canonical_id_count, sum(trip_count)::BIGINT AS total_trips FROM map GROUP BY 1 HAVING canonical_id_count > 1")
_MAPPED = f"{_CANON}, lk AS (SELECT DISTINCT normalized_name, coord_key, canonical_station_id FROM map), mt AS (SELECT t.*, a.canonical_station_id AS s, b.canonical_station_id AS e FROM trips t LEFT JOIN lk a ON a.normalized_name = {_NORM.format(x='start_station_name')} AND a.coord_key = printf('%.6f,%.6f', round(start_station_latitude, 6), round(start_station_longitude, 6)) LEFT JOIN lk b ON b.normalized_name = {_NORM.format(x='end_station_name')} AND b.coord_key = printf('%.6f,%.6f', round(end_station_latitude, 6), round(end_station_longitude, 6))), one AS (SELECT count(*)::DOUBLE AS total_trips, count(*) FILTER ({SAME})::DOUBLE AS raw_self_loops, count(*) FILTER (s = e)::DOUBLE AS canonical_self_loops, count(*) FILTER (s IS NULL OR e IS NULL)::DOUBLE AS unmapped_trips, (SELECT count(*) FROM (SELECT coord_key FROM map GROUP BY 1 HAVING count(DISTINCT canonical_station_id) > 1))::DOUBLE AS coordinates_with_several_ids FROM mt)"
on_trips("mapping_validation", lambda t: entity.mapping_validation(t, _mapping(t)), f"WITH RECURSIVE {_MAPPED} " + " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS value FROM one" for c in ("total_trips", "raw_self_loops", "canonical_self_loops", "unmapped_trips", "coordinates_with_several_ids")))

# --- layers
_BLANKED = "CASE WHEN start_station_name LIKE 'NATION_3 /%' THEN ' ' ELSE start_station_name END"
_FLAGS = {"missing_start_name": "trim(sn) = ''", "missing_start_place": "false", "missing_end_name": "false", "missing_end_place": "false", "invalid_times": "end_time_ms < start_time_ms"}
on_trips("flags_by_month", lambda t: layers.flags_by_month(layers.standardize(t.withColumn("start_station_name", F.expr(_BLANKED)))), f"WITH b AS (SELECT *, {_BLANKED} AS sn FROM trips) SELECT year({TS}) AS trip_year, month({TS}) AS trip_month, count(*) AS rows, count(*) FILTER ({' OR '.join(_FLAGS.values())}) AS flagged, " + ", ".join(f"count(*) FILTER ({w}) AS {k}" for k, w in _FLAGS.items()) + " FROM b GROUP BY 1, 2")
on_trips("canonical_routes", lambda t: layers.canonical_routes(entity.map_trips(t, _mapping(t))), f"WITH RECURSIVE {_MAPPED} SELECT s AS start_canonical_id, e AS end_canonical_id, count(*) AS trips, avg((end_time_ms - start_time_ms) / 60000.0) AS avg_minutes FROM mt GROUP BY ALL")
_LIMITS = {"total_trips": (1, None), "unmapped_trips": (None, 0), "canonical_self_loops": (None, 10), "kpi_not_reported": (0, 1)}
on_trips(
    "quality_gates", lambda t: layers.gates(entity.mapping_validation(t, _mapping(t)), _LIMITS),
    f"WITH RECURSIVE {_MAPPED}, g AS (" + " UNION ALL ".join(f"SELECT '{k}' AS metric, {'NULL::DOUBLE' if k.startswith('kpi') else k} AS value, {'NULL' if a is None else a}::DOUBLE AS least, {'NULL' if z is None else z}::DOUBLE AS most FROM one" for k, (a, z) in _LIMITS.items()) + ") SELECT *, value IS NOT NULL AND coalesce(value >= least, true) AND coalesce(value <= most, true) AS passed FROM g",
)
_DAYS = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
_EARLY, _LATE = "start_time_ms < 788918400000", "start_station_name NOT LIKE 'NATION_5 /%'"


def _history(t: DataFrame) -> DataFrame:
    """First ends of stations, as known from early trips and then from all, when one nation's stations are gone."""
    state = lambda rows: rows.groupBy(F.col("start_station_name").alias("station")).agg(F.min("end_station_name").alias("first_end"))
    early, late = state(t.where(_EARLY)), state(t.where(_LATE))
    h = layers.next_version(layers.next_version(layers.new_history(early), early, _DAYS[0], ["station"]), late, _DAYS[1], ["station"])
    return h.select("station", "first_end", *(F.col(c).cast("string").alias(c) for c in ("valid_from", "valid_to")))  # as text: null dates differ between client libraries


on_trips("mapping_history", _history, f"""WITH a AS (SELECT start_station_name AS station, min(end_station_name) AS first_end FROM trips WHERE {_EARLY} GROUP BY 1), b AS (SELECT start_station_name AS station, min(end_station_name) AS first_end FROM trips WHERE {_LATE} GROUP BY 1)
SELECT a.station, a.first_end, '{_DAYS[0]}' AS valid_from, CASE WHEN b.station IS NULL OR a.first_end <> b.first_end THEN '{_DAYS[1]}' END AS valid_to FROM a LEFT JOIN b USING (station)
UNION ALL SELECT b.station, b.first_end, '{_DAYS[1]}', NULL FROM b LEFT JOIN a USING (station) WHERE a.station IS NULL OR a.first_end <> b.first_end""")
_RULES = [("nation_3 / building", None, "STN_X1", _DAYS[0], None), ("nation_4 / automobile", None, "STN_X2", _DAYS[0], _DAYS[1]), ("nation_6 / machinery", None, "STN_X3", _DAYS[0], None), ("nation_6 / machinery", "45.464000,-73.662000", "STN_X4", _DAYS[0], None)]


def _overridden(t: DataFrame) -> DataFrame:
    rules = t.sparkSession.createDataFrame(_RULES, "normalized_name string, coord_key string, canonical_station_id string, valid_from date, valid_to date")
    return layers.override(_mapping(t), rules, _DAYS[1]).select("canonical_station_id", "normalized_name", "coord_key", "raw_name", "overridden")


on_trips("mapping_overrides", _overridden, f"WITH RECURSIVE {_CANON}, ruled AS (SELECT *, CASE WHEN normalized_name = 'nation_3 / building' THEN 'STN_X1' WHEN normalized_name = 'nation_6 / machinery' AND coord_key = '45.464000,-73.662000' THEN 'STN_X4' WHEN normalized_name = 'nation_6 / machinery' THEN 'STN_X3' END AS r FROM map) SELECT coalesce(r, canonical_station_id) AS canonical_station_id, normalized_name, coord_key, raw_name, r IS NOT NULL AS overridden FROM ruled")

# --- places
_PT = f"pts AS ({UNION})"
M = "2 * 6371000.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))"
_H = "pow(sin(radians(y.latitude - x.latitude) / 2), 2) + cos(radians(x.latitude)) * cos(radians(y.latitude)) * pow(sin(radians(y.longitude - x.longitude) / 2), 2)"


def _points(t: DataFrame) -> DataFrame:
    return tr.stations(t).select(F.col("name").alias("id"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


on_trips("nearest_neighbour", lambda t: places.nearest_all(_points(t), _points(t).where("id LIKE '%BUILDING'")), f"WITH {_PT}, z AS (SELECT x.name AS id, {_H} AS h FROM pts x, pts y WHERE y.name LIKE '%BUILDING') SELECT id, round(min({M}), 2) AS metres FROM z GROUP BY 1")
on_trips("radius_join", lambda t: places.within_radius(_points(t), _points(t).where("id LIKE '%BUILDING'"), 0.5), f"WITH {_PT}, z AS (SELECT x.name AS id, y.name AS target_id, {KM.format(a='x.latitude', b='x.longitude', c='y.latitude', d='y.longitude')} AS km FROM pts x, pts y WHERE y.name LIKE '%BUILDING') SELECT * FROM z WHERE km <= 0.5")
on_trips("hub_radius", lambda t: places.around_hub(_points(t), F.lit(45.4), F.lit(-73.7), 2000.0).select("id", "metres", "role"), f"WITH {_PT}, z AS (SELECT x.name AS id, {_H.replace('y.latitude', '45.4::DOUBLE').replace('y.longitude', '(-73.7)::DOUBLE')} AS h FROM pts x), w AS (SELECT id, {M} AS metres FROM z) SELECT id, metres, CASE WHEN metres = 0 THEN 'hub' ELSE 'spillover' END AS role FROM w WHERE metres <= 2000")
on_trips("degree_pairs", lambda t: places.within_degrees(_points(t), 0.003), f"WITH {_PT}, z AS (SELECT x.name AS a, y.name AS b, sqrt(pow(y.latitude - x.latitude, 2) + pow(y.longitude - x.longitude, 2)) AS deg FROM pts x JOIN pts y ON x.name < y.name) SELECT * FROM z WHERE deg < 0.003")
add("haversine_stats", lambda s, d: table(s, d, "embeddings").select("vec_id", (F.col("embedding")[0].cast("double") + 45).alias("a"), (F.col("embedding")[1].cast("double") - 73).alias("b")).select("vec_id", geo.haversine_km(F.col("a"), F.col("b"), F.lit(45.5), F.lit(-73.5)).alias("km"), geo.haversine_m(F.col("a"), F.col("b"), F.lit(45.5), F.lit(-73.5)).alias("metres"), geo.coord_key(F.col("a"), F.col("b")).alias("key")), f"WITH x AS (SELECT vec_id, embedding[1]::DOUBLE + 45 AS latitude, embedding[2]::DOUBLE - 73 AS longitude FROM embeddings), y AS (SELECT 45.5::DOUBLE AS latitude, -73.5::DOUBLE AS longitude), z AS (SELECT x.*, {_H} AS h FROM x, y) SELECT vec_id, 2 * 6371.0::DOUBLE * asin(sqrt(least(1, h))) AS km, {M} AS metres, printf('%.6f,%.6f', round(latitude, 6), round(longitude, 6)) AS key FROM z")
add("float_coordinates", lambda s, d: table(s, d, "embeddings").select(F.col("embedding")[0].cast("float").alias("x"), "label").groupBy((F.col("x") == F.col("x").cast("double").cast("float")).alias("same"), (F.col("x") > F.lit(0).cast("float")).alias("positive")).agg(tr.count()), "SELECT embedding[1] = embedding[1]::DOUBLE::FLOAT AS same, embedding[1] > 0::FLOAT AS positive, count(*) AS n FROM embeddings GROUP BY ALL")


def _live(s: SparkSession, d: str) -> DataFrame:
    t = trips(s, d)
    m = entity.canonical_mapping(entity.observations(t)).select("canonical_station_id", "normalized_name", "coord_key", "canonical_lat", "canonical_lon")
    k = F.length("id") % 4
    shift = F.when(k == 1, 0.001).when(k == 2, 0.0003).when(k == 3, 0.7).otherwise(0.0)
    feed = _points(t).select(F.col("id").alias("station_id"), F.when(k == 2, "elsewhere").otherwise(F.col("id")).alias("name"), (F.col("lat") + shift).alias("lat"), F.col("lon").alias("lon"))
    return places.live_match(feed, m)


_LIVE_KM = KM.format(a="w.lat", b="w.lon", c="m.clat", d="m.clon")
_LIVE = f"""{_O}, cs AS (SELECT coord_key, sum(trip_count)::BIGINT AS n FROM obs GROUP BY 1),
ids AS (SELECT coord_key, printf('STN_%04d', row_number() OVER (ORDER BY n DESC, coord_key)) AS cid, split_part(coord_key, ',', 1)::DOUBLE AS clat, split_part(coord_key, ',', 2)::DOUBLE AS clon FROM cs),
m AS (SELECT DISTINCT cid, normalized_name, coord_key, clat, clon FROM obs JOIN ids USING (coord_key)), {_PT},
fd AS (SELECT DISTINCT name AS station_id, CASE WHEN length(name) % 4 = 2 THEN 'elsewhere' ELSE name END AS name, latitude + CASE length(name) % 4 WHEN 1 THEN 0.001::DOUBLE WHEN 2 THEN 0.0003::DOUBLE WHEN 3 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS lat, longitude AS lon FROM pts),
f AS (SELECT *, {_NORM.format(x='name')} AS normalized_name, printf('%.6f,%.6f', round(lat, 6), round(lon, 6)) AS coord_key, row_number() OVER () AS r FROM fd),
ex AS (SELECT coord_key, min(cid) AS cid FROM m GROUP BY 1), w AS (SELECT * FROM f ANTI JOIN ex USING (coord_key)),
nm AS (SELECT w.r, m.cid, {_LIVE_KM} AS km FROM w JOIN (SELECT DISTINCT cid, normalized_name, clat, clon FROM m) m USING (normalized_name)),
nb AS (SELECT * FROM nm WHERE km <= 0.2 QUALIFY row_number() OVER (PARTITION BY r ORDER BY km, cid) = 1),
nr AS (SELECT w.r, m.cid, {_LIVE_KM} AS km FROM w, (SELECT DISTINCT cid, clat, clon FROM m) m WHERE w.r NOT IN (SELECT r FROM nb)),
nc AS (SELECT * FROM nr WHERE km <= 0.05 QUALIFY row_number() OVER (PARTITION BY r ORDER BY km, cid) = 1),
lm AS (SELECT station_id, name, normalized_name, lat, lon, coalesce(ex.cid, nb.cid, nc.cid) AS canonical_station_id, CASE WHEN ex.cid IS NOT NULL THEN 'coord_exact' WHEN nb.cid IS NOT NULL THEN 'name_near' WHEN nc.cid IS NOT NULL THEN 'nearest' END AS match_method,
  CASE WHEN ex.cid IS NOT NULL THEN 0.0::DOUBLE ELSE coalesce(nb.km, nc.km) END AS match_distance_km FROM f LEFT JOIN ex USING (coord_key) LEFT JOIN nb USING (r) LEFT JOIN nc USING (r))"""
add("live_match", _live, f"{_LIVE} SELECT * FROM lm", "t")
add("live_coverage", lambda s, d: places.coverage(_live(s, d)), f"{_LIVE} SELECT coalesce(match_method, 'unmatched') AS method, count(*) AS n, avg(match_distance_km) AS avg_km FROM lm GROUP BY 1", "t")
_INFO = "SELECT s_suppkey AS station_id, s_suppkey % 7 AS num_bikes_available, s_suppkey % 5 AS num_docks_available, s_suppkey % 12 AS capacity FROM supplier"


def _used(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "supplier").select(F.col("s_suppkey").alias("station_id"), (F.col("s_suppkey") % 7).alias("num_bikes_available"), (F.col("s_suppkey") % 5).alias("num_docks_available"), (F.col("s_suppkey") % 12).alias("capacity"))
    return places.utilization(p.select("station_id", "capacity"), p.drop("capacity"))


_USED = f"u AS (SELECT *, CASE WHEN num_bikes_available + num_docks_available <> 0 THEN num_bikes_available::DOUBLE / (num_bikes_available + num_docks_available) END AS utilization, CASE WHEN capacity <> 0 THEN num_bikes_available::DOUBLE / capacity END AS by_capacity FROM ({_INFO}))"
add("utilization", _used, f"WITH {_USED} SELECT * FROM u")
add("utilization_extremes", lambda s, d: places.extremes(_used(s, d), "utilization", "station_id"), f"WITH {_USED} (SELECT *, 'top' AS \"end\" FROM u WHERE utilization IS NOT NULL ORDER BY utilization DESC, station_id LIMIT 20) UNION ALL (SELECT *, 'bottom' FROM u WHERE utilization IS NOT NULL ORDER BY utilization, station_id LIMIT 10)")
add("utilization_histogram", lambda s, d: profile.histogram(_used(s, d), "utilization", 30), f"WITH {_USED}, " + _HIST.format(d="utilization", f="u WHERE utilization IS NOT NULL", b=30)[5:])


def _dimension(s: SparkSession, d: str) -> DataFrame:
    st = tr.stations(trips(s, d))
    elevation = st.where("name NOT LIKE '%BUILDING'").select("latitude", "longitude", F.round(F.col("latitude") * 10, 1).alias("elevation_meters")).distinct()
    capacity = st.where("name NOT LIKE '%MACHINERY'").select("name", (F.length("name") + 5).alias("capacity")).distinct()
    return places.station_dimension(st, elevation, _points(trips(s, d)).where("id LIKE '%FURNITURE'"), capacity)


add("station_dimension", _dimension, f"WITH {_PT}, el AS (SELECT DISTINCT latitude, longitude, round(latitude * 10, 1) AS elevation_meters FROM pts WHERE name NOT LIKE '%BUILDING'), cp AS (SELECT DISTINCT name, (length(name) + 5)::DOUBLE AS capacity FROM pts WHERE name NOT LIKE '%MACHINERY'), z AS (SELECT x.name, x.latitude, x.longitude, {_H} AS h FROM pts x, pts y WHERE y.name LIKE '%FURNITURE'), nd AS (SELECT name, latitude, longitude, round(min({M}), 2) AS nearest_metro_dist_meters FROM z GROUP BY ALL), dim AS (SELECT upper(regexp_replace(pts.name, '[^a-zA-Z0-9 -/]', '')) AS station_name_standardized, latitude, longitude, elevation_meters, nearest_metro_dist_meters, capacity FROM pts LEFT JOIN el USING (latitude, longitude) JOIN nd USING (name, latitude, longitude) LEFT JOIN cp USING (name)) SELECT * REPLACE (coalesce(capacity, (SELECT median(capacity) FROM dim)) AS capacity) FROM dim", "t")

# --- profiles
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _holes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))


add("null_report", lambda s, d: profile.null_report(_holes(s, d)), "WITH h AS (SELECT * REPLACE (CASE WHEN c_acctbal > 0 THEN c_acctbal END AS c_acctbal) FROM customer) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*) AS percentage FROM h" for c in CUST))
add("duplicate_report", lambda s, d: profile.duplicate_report(table(s, d, "lineitem").select("l_orderkey", "l_linenumber")), "WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT sum(n)::BIGINT AS row_count, sum(n - 1)::BIGINT AS extra_copies, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_with_copy FROM g")
add("numeric_describe", lambda s, d: profile.describe(table(s, d, "lineitem"), LINE), " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q1, median({c}) AS median, quantile_cont({c}, 0.75) AS q3, max({c}) AS max FROM lineitem" for c in LINE))
on_trips("range_checks", lambda t: profile.rule_counts(t, profile.trip_rules()), " UNION ALL ".join(f"SELECT '{k}' AS metric, count(*) FILTER ({w})::DOUBLE AS value FROM trips" for k, w in [("negative_duration", "end_time_ms < start_time_ms"), *[(f"{p}_{c}", f"{p}_station_{c} NOT BETWEEN {a} AND {b}") for p in ("start", "end") for c, a, b in (("latitude", 44, 46), ("longitude", -75, -72))]]))
add("median_fill", lambda s, d: profile.median_fill(_holes(s, d), "c_acctbal").select("c_custkey", "c_acctbal"), "WITH h AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer) SELECT c_custkey, coalesce(b, (SELECT median(b) FROM h)) AS c_acctbal FROM h")
add("metric_table", lambda s, d: core.metric_table(table(s, d, "orders").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.avg("o_totalprice").alias("mean_price"))), "SELECT 'orders' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey)::DOUBLE FROM orders UNION ALL SELECT 'mean_price', avg(o_totalprice) FROM orders")
add("distinct_rows", lambda s, d: profile.distinct_rows(table(s, d, "lineitem").select("l_partkey", "l_suppkey")), "SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
add("distinct_tuples", lambda s, d: profile.distinct_tuples(table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"]), "SELECT count(DISTINCT (l_returnflag, l_linestatus)) AS n FROM lineitem")
add("correlation", lambda s, d: table(s, d, "lineitem").agg(F.corr("l_quantity", "l_extendedprice").alias("r")), "SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem")
add("value_counts", lambda s, d: table(s, d, "lineitem").groupBy("l_returnflag").agg(tr.count()), "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL")
add("any_value_per_group", lambda s, d: table(s, d, "customer").groupBy("c_mktsegment").agg(F.min("c_name").alias("a_name"), F.array_join(F.sort_array(F.collect_set("c_nationkey")).cast("array<string>"), ",").alias("nations")), "SELECT c_mktsegment, min(c_name) AS a_name, array_to_string(list_sort(list_distinct(list(c_nationkey))), ',') AS nations FROM customer GROUP BY ALL")
add("first_row_per_key", lambda s, d: core.first_per_key(table(s, d, "orders"), ["o_custkey"], core.desc("o_totalprice"), core.asc("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice"), "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
add("partition_totals", lambda s, d: table(s, d, "orders").select("o_orderkey", F.sum("o_totalprice").over(w := Window.partitionBy("o_custkey")).alias("total"), F.count(F.lit(1)).over(w).alias("orders")), "SELECT o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey) AS total, count(*) OVER (PARTITION BY o_custkey) AS orders FROM orders")
add("anti_join", lambda s, d: table(s, d, "customer").join(table(s, d, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey"), "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
add("concat_frames", lambda s, d: core.concat([table(s, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation")), table(s, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))]).groupBy("kind", "nation").agg(tr.count()), "SELECT kind, nation, count(*) AS n FROM (SELECT 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_nationkey FROM supplier) GROUP BY ALL")
_TRIP_COLUMNS = [f"{p}_station_{c}" for p in ("start", "end") for c in ("name", "district", "latitude", "longitude")] + ["start_time_ms", "end_time_ms"]
on_trips("trip_null_report", profile.null_report, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*) AS percentage FROM trips" for c in _TRIP_COLUMNS))
_MOVED = "CASE WHEN start_station_district = 'ASIA' AND start_time_ms < 883612800000 THEN start_station_latitude + 0.01::DOUBLE ELSE start_station_latitude END"
on_trips(
    "moved_name_conflicts", lambda t: entity.name_conflicts(entity.canonical_mapping(entity.observations(t.withColumn("start_station_latitude", F.expr(_MOVED.replace("::DOUBLE", "D")))))),
    f"WITH mv AS (SELECT * REPLACE ({_MOVED} AS start_station_latitude) FROM trips), {OBS.format(t='mv')} SELECT normalized_name, count(DISTINCT coord_key) AS canonical_id_count, sum(trip_count)::BIGINT AS total_trips FROM obs GROUP BY 1 HAVING canonical_id_count > 1",
)
add("positional_merge", lambda s, d: merge_by_position(table(s, d, "customer").select("c_custkey"), table(s, d, "supplier").select("s_suppkey"), ["c_custkey"], ["s_suppkey"]).select("pos", "c_custkey", F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey")), "SELECT pos, c_custkey, coalesce(s_suppkey, -1) AS s_suppkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer) FULL JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS pos FROM supplier) USING (pos)")


def _flows(s: SparkSession, d: str) -> DataFrame:
    """Departures and arrivals by tier and hour, counted apart and joined on both keys."""
    e = station_events(s, d).join(station_tiers(s, d), "station").select(flow.tier(F.col("metres")).alias("tier"), timefn.hour(F.col("ts")).alias("hour"), "direction")
    of = lambda way, name: e.where(F.col("direction") == way).groupBy("tier", "hour").agg(F.count(F.lit(1)).alias(name))
    return core.full_outer(of("out", "departures").where("hour < 20"), of("in", "arrivals").where("hour > 3"), ["tier", "hour"])


add("two_key_full_outer", _flows, f"WITH f AS (SELECT {_TIER} AS tier, hour(ts) AS hour, direction FROM ev JOIN tiers USING (station)), o AS (SELECT tier, hour, count(*) AS departures FROM f WHERE direction = 'out' AND hour < 20 GROUP BY ALL), i AS (SELECT tier, hour, count(*) AS arrivals FROM f WHERE direction = 'in' AND hour > 3 GROUP BY ALL) SELECT tier, hour, coalesce(departures, 0) AS departures, coalesce(arrivals, 0) AS arrivals FROM o FULL JOIN i USING (tier, hour)", "e")

QUERIES |= source_queries.QUERIES
ORACLE |= source_queries.ORACLE
