"""Questions on station events (station, ts, direction): flows, behaviour, stockouts, pressure, leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewheel.functions import timefn

from .core import asc, densify_hours, desc, first_per_key, top

def leaves() -> Column:
    return F.col("direction") == "out"


def arrives() -> Column:
    return F.col("direction") == "in"


def tier(metres: Column) -> Column:
    return F.when(metres <= 150, "Tier 1").when(metres <= 400, "Tier 2").otherwise("Tier 3")


def activity(events: DataFrame, n: int | None = None) -> DataFrame:
    """Departures, arrivals and their sum by station, in one pass over both directions."""
    out = events.groupBy("station").agg(F.count_if(leaves()).alias("departures"), F.count_if(arrives()).alias("arrivals")).withColumn("total", F.col("departures") + F.col("arrivals"))
    return top(out, n, desc("total"), asc("station")) if n else out


def activity_joined(events: DataFrame) -> DataFrame:
    """The same from two aggregates and a full outer join: for inputs that come as two tables."""
    side = lambda c, name: events.where(c).groupBy("station").agg(F.count(F.lit(1)).alias(name))
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return side(leaves(), "departures").join(side(arrives(), "arrivals"), "station", "full").select("station", z("departures"), z("arrivals"))


def net_flow_by_tier(events: DataFrame, tiers: DataFrame) -> DataFrame:
    rows = events.join(tiers, "station").groupBy(tier(F.col("metres")).alias("tier"), timefn.hour(F.col("ts")).alias("hour"))
    return rows.agg(F.count_if(leaves()).alias("departures"), F.count_if(arrives()).alias("arrivals")).withColumn("net", F.col("arrivals") - F.col("departures"))


def peak_hours(net: DataFrame) -> DataFrame:
    """Of each tier the hour that gains most and the one that loses most."""
    sink = first_per_key(net, ["tier"], desc("net"), asc("hour")).select("tier", F.col("hour").alias("sink_hour"), F.col("net").alias("sink_net"))
    source = first_per_key(net, ["tier"], asc("net"), asc("hour")).select("tier", F.col("hour").alias("source_hour"), F.col("net").alias("source_net"))
    return sink.join(source, "tier")


def hourly_outflow(events: DataFrame) -> DataFrame:
    return events.where(leaves()).groupBy("station", timefn.hour_start(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def dense_outflow(events: DataFrame) -> DataFrame:
    return densify_hours(hourly_outflow(events), "station", "hour", "n")


def shadow_stockouts(events: DataFrame, above: float = 5.0) -> DataFrame:
    """Hours without departures where the station's weekday-hour mean says more than ``above``; for all stations."""
    d = dense_outflow(events).withColumns({"dow": timefn.dow_monday0(F.col("hour")), "h": timefn.hour(F.col("hour"))})
    d = d.withColumn("expected", F.avg("n").over(Window.partitionBy("station", "dow", "h")))
    return d.where((F.col("n") == 0) & (F.col("expected") > above)).select("station", "hour", "expected")


def around_middle(dense: DataFrame, stockouts: DataFrame, days: int = 2) -> DataFrame:
    """The hours of each station within ``days`` of its middle stockout."""
    w = Window.partitionBy("station")
    mid = stockouts.withColumns({"rn": F.row_number().over(w.orderBy("hour")), "c": F.count(F.lit(1)).over(w)}).where("rn = CAST(floor(c / 2) AS INT) + 1").select("station", F.col("hour").alias("mid"))
    span = F.expr(f"INTERVAL {days} DAYS")
    return dense.join(mid, "station").where((F.col("hour") >= F.col("mid") - span) & (F.col("hour") <= F.col("mid") + span)).select("station", "hour", "n")


def _week(events: DataFrame) -> DataFrame:
    weekend = timefn.dow_sunday0(F.col("ts")).isin(0, 6)
    return events.where(leaves()).groupBy("station").agg(F.count_if(~weekend).alias("weekday"), F.count_if(weekend).alias("weekend"), F.count(F.lit(1)).alias("total"))


def archetypes(events: DataFrame, more_than: int = 500) -> DataFrame:
    d = _week(events).where(F.col("total") > more_than)
    d = d.withColumns({"weekday_pct": F.col("weekday") * F.lit(100.0) / F.col("total"), "weekend_pct": F.col("weekend") * F.lit(100.0) / F.col("total")})
    kind = F.when(F.col("weekday_pct") >= 80, "Commuter").when(F.col("weekend_pct") >= 35, "Leisure").otherwise("Mixed")
    return d.withColumn("archetype", kind)


def archetype_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("archetype").agg(F.count(F.lit(1)).alias("n"))


def weekend_shift(events: DataFrame, more_than: int = 500) -> DataFrame:
    """Weekday total over 5 against weekend total over 2."""
    d = _week(events).where(F.col("total") > more_than)
    d = d.select("station", (F.col("weekday") / F.lit(5.0)).alias("weekday_avg"), (F.col("weekend") / F.lit(2.0)).alias("weekend_avg"))
    d = d.withColumn("surge", F.col("weekend_avg") - F.col("weekday_avg"))
    return d.withColumn("shift", F.when(F.col("surge") > 15, "Weekend Destination").when(F.col("surge") < -15, "Weekday Hub").otherwise("Neutral"))


def largest_shift(shifts: DataFrame, n: int = 10) -> DataFrame:
    return top(shifts, n, F.abs("surge").desc(), asc("station"))


def hourly_average(events: DataFrame, cluster: DataFrame, offset_hours: int = -4) -> DataFrame:
    """Departures an active day by station and local hour, over a cluster (station) of stations."""
    local = timefn.local(F.col("ts"), offset_hours=offset_hours)
    rows = events.where(leaves()).join(cluster, "station", "left_semi").select("station", local.alias("at"))
    days = rows.agg(F.count_distinct(F.to_date("at")).alias("days"))
    n = rows.groupBy("station", timefn.hour(F.col("at")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(F.broadcast(days)).select("station", "hour", (F.col("n") / F.col("days").cast("double")).alias("daily_avg"))


def outflow_pressure(average: DataFrame, capacity: DataFrame) -> DataFrame:
    """Daily departures as a percentage of capacity; null for a capacity of 0."""
    return average.join(capacity, "station").withColumn("pressure", F.try_divide(F.col("daily_avg"), F.col("capacity").cast("double")) * 100)


def velocity(events: DataFrame) -> DataFrame:
    d = events.groupBy("station", timefn.hour_start(F.col("ts")).alias("hour")).agg(F.count_if(arrives()).alias("inflow"), F.count_if(leaves()).alias("outflow"))
    return d.withColumns({"velocity": F.col("inflow") + F.col("outflow"), "imbalance": F.abs(F.col("inflow") - F.col("outflow"))})


def leaderboard(events: DataFrame, period: str = "day", n: int = 3) -> DataFrame:
    """Busiest n stations of each day, week or month, and their rank in the last period before that has them (0: none)."""
    d = events.groupBy(F.date_trunc(period, F.col("ts")).cast("date").alias("period"), "station").agg(F.count(F.lit(1)).alias("n"))
    d = d.withColumn("rank", F.rank().over(Window.partitionBy("period").orderBy(desc("n"))).cast("long"))
    d = d.withColumn("before", F.coalesce(F.lag("rank").over(Window.partitionBy("station").orderBy("period")), F.lit(0)))
    return d.where(F.col("rank") <= n)


def moving_average(events: DataFrame, days: int = 7) -> DataFrame:
    """Daily events by station with their mean over the last ``days`` calendar days that have events."""
    d = events.groupBy("station", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("station").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return d.withColumn("mean", F.avg("n").over(w))


def dead_periods(events: DataFrame, empty_after: int = 3) -> DataFrame:
    """Runs of at least ``empty_after`` hours in which nothing leaves a station between its first and last departure.

    Risk of a run is its length times the station's mean hourly departures; a run is probably
    empty if less arrived than left in the day before it, else probably full.
    """
    grid = dense_outflow(events).select("station", "hour", F.col("n").alias("left"), F.lit(0).cast("long").alias("came"), F.lit(1).alias("on_grid"))
    came = events.where(arrives()).groupBy("station", timefn.hour_start(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("came"))
    rows = grid.unionByName(came.select("station", "hour", F.lit(0).cast("long").alias("left"), "came", F.lit(0).alias("on_grid")))
    h = rows.groupBy("station", "hour").agg(F.sum("left").alias("n"), F.sum("came").alias("came"), F.max("on_grid").alias("on_grid"))
    number = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '1970-01-01 00:00:00', hour)")
    day = Window.partitionBy("station").orderBy(number).rangeBetween(-24, -1)
    h = h.withColumns({"came": F.coalesce(F.sum("came").over(day), F.lit(0)), "left": F.coalesce(F.sum("n").over(day), F.lit(0))}).where("on_grid = 1")
    by_hour = Window.partitionBy("station").orderBy("hour")
    h = h.withColumn("mean", F.avg("n").over(Window.partitionBy("station"))).withColumn("island", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(by_hour)).where("n = 0")
    runs = h.groupBy("station", "island").agg(F.min("hour").alias("since"), F.count(F.lit(1)).alias("hours"), F.max("mean").alias("mean"), F.min_by("came", "hour").alias("came"), F.min_by("left", "hour").alias("left")).where(F.col("hours") >= empty_after)
    return runs.select("station", "since", "hours", (F.col("hours") * F.col("mean")).alias("risk"), F.when(F.col("came") < F.col("left"), "empty").otherwise("full").alias("probably"))


def early_warnings(events: DataFrame, fast: int = 4, empty_after: int = 3) -> DataFrame:
    """Dead periods that begin within an hour of a station-hour of at least ``fast`` events."""
    v = velocity(events).where(F.col("velocity") >= fast).select("station", (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("since"), "velocity")
    return dead_periods(events, empty_after).join(v, ["station", "since"])


def month_by_hour(events: DataFrame) -> DataFrame:
    weekend = timefn.dow_sunday0(F.col("ts")).isin(0, 6)
    return events.groupBy(F.date_trunc("month", F.col("ts")).cast("date").alias("month"), timefn.hour(F.col("ts")).alias("hour")).agg(F.count_if(~weekend).alias("weekday"), F.count_if(weekend).alias("weekend"))
