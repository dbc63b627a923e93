"""Layered batches: raw rows with their origin, standard rows with quality flags, gates, versioned mappings with overrides, increments."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewheel.functions import geo, text, timefn

from .core import asc, desc, first_per_key

SIDES = ("start", "end")


def with_origin(raw: DataFrame, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Rows of a file-based frame as they are, with source_file, batch_id and ingested_at."""
    return raw.withColumns({"source_file": F.col("_metadata.file_path"), "batch_id": F.lit(batch_id), "ingested_at": F.lit(ingested_at)})


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, expected, found) of every column that is new, gone or of another type; empty if all is as declared."""
    want, have = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (expected, df.schema))
    rows = [(c, want.get(c), have.get(c)) for c in sorted(want.keys() | have.keys()) if want.get(c) != have.get(c)]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, found string")


def flag_rules() -> dict[str, Column]:
    """Quality flags of a trip; a rule that meets a null it isn't about doesn't hold."""
    rules = {}
    for p in SIDES:
        name = F.col(f"{p}_station_name")
        rules[f"missing_{p}_name"] = name.isNull() | (F.trim(name) == "")
        rules[f"missing_{p}_place"] = F.col(f"{p}_station_latitude").isNull() | F.col(f"{p}_station_longitude").isNull()
    start, end = F.col("start_time_ms"), F.col("end_time_ms")
    return rules | {"invalid_times": start.isNull() | end.isNull() | (end < start)}


def standardize(trips: DataFrame) -> DataFrame:
    """trips with normalized names, coordinate keys, trip_date, trip_year, trip_month and flags (an array of the rules that a row breaks). Every row stays."""
    out = {"flags": F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), k) for k, c in flag_rules().items())), lambda x: x.isNotNull())}
    for p in SIDES:
        out[f"{p}_name"] = text.normalize_name(F.col(f"{p}_station_name"))
        out[f"{p}_key"] = geo.coord_key(F.col(f"{p}_station_latitude"), F.col(f"{p}_station_longitude"))
    at = timefn.utc_naive(F.col("start_time_ms"))
    return trips.withColumns(out | {"trip_date": F.to_date(at), "trip_year": F.year(at), "trip_month": F.month(at)})


def flags_by_month(standard: DataFrame) -> DataFrame:
    """(trip_year, trip_month, rows, flagged, and a count for each flag)."""
    each = (F.count_if(F.array_contains("flags", k)).alias(k) for k in flag_rules())
    return standard.groupBy("trip_year", "trip_month").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("flags") > 0).alias("flagged"), *each)


def canonical_routes(mapped: DataFrame) -> DataFrame:
    """(start_canonical_id, end_canonical_id, trips, avg_minutes) of trips with canonical ids; unmapped ends count as null."""
    minutes = (F.col("end_time_ms") - F.col("start_time_ms")) / F.lit(60_000.0)
    return mapped.groupBy("start_canonical_id", "end_canonical_id").agg(F.count(F.lit(1)).alias("trips"), F.avg(minutes).alias("avg_minutes"))


def gates(metrics: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(metric, value, least, most, passed) for every limit; a metric that is missing or null doesn't pass."""
    rows = [(k, *(None if x is None else float(x) for x in v)) for k, v in limits.items()]
    want = metrics.sparkSession.createDataFrame(rows, "name string, least double, most double")
    found = want.join(metrics, F.col("name") == F.col("metric"), "left")
    v = F.col("value").cast("double")
    ok = v.isNotNull() & ((v >= F.col("least")) | F.col("least").isNull()) & ((v <= F.col("most")) | F.col("most").isNull())
    return found.select(F.col("name").alias("metric"), v.alias("value"), "least", "most", ok.alias("passed"))


def lineage(spark: SparkSession, run_id: str, mapping_version: str, layers: dict[str, DataFrame]) -> DataFrame:
    """(run_id, mapping_version, layer, position, row_count), one row a layer, counted by one job each."""
    rows = [(run_id, mapping_version, k, i, df.count()) for i, (k, df) in enumerate(layers.items())]
    return spark.createDataFrame(rows, "run_id string, mapping_version string, layer string, position int, row_count long")


def new_history(current: DataFrame) -> DataFrame:
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in current.schema.fields]).add("valid_from", T.DateType()).add("valid_to", T.DateType())
    return current.sparkSession.createDataFrame([], kind)


def next_version(history: DataFrame, current: DataFrame, day: date, keys: list[str]) -> DataFrame:
    """history with ``current`` as its state from ``day`` on: changed and gone rows end that day, new ones begin.

    valid_to is exclusive; open rows have null. Keys are unique in current and not null.
    Giving the same state again changes nothing; a second state of one day takes the place of the first.
    """
    names = current.columns
    values = [c for c in names if c not in keys]
    # Rows of earlier days only; what an earlier run for this day has ended is open again, what it began is gone.
    earlier = history.where(F.col("valid_from") < F.lit(day))
    before = earlier.where(F.col("valid_to") < F.lit(day))
    live = earlier.where(F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(day)))
    old = live.select(*(F.col(c).alias(f"old_{c}") for c in (*names, "valid_from")))
    j = current.join(old, [F.col(k) == F.col(f"old_{k}") for k in keys], "full")
    was, now = F.col("old_valid_from").isNotNull(), F.col(keys[0]).isNotNull()
    same = was & now
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    none, at = F.lit(None).cast("date"), F.lit(day)
    row = lambda p, since, until: F.struct(*(F.col(p + c).alias(c) for c in names), since.alias("valid_from"), until.alias("valid_to"))
    both = F.array(F.when(was, row("old_", F.col("old_valid_from"), F.when(same, none).otherwise(at))), F.when(now & ~same, row("", at, none)))
    return before.unionByName(j.select(F.explode(F.filter(both, lambda r: r.isNotNull())).alias("r")).select("r.*"))


def state_at(history: DataFrame, day: date) -> DataFrame:
    """The state that held on a day."""
    return history.where((F.col("valid_from") <= F.lit(day)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day)))).drop("valid_from", "valid_to")


def override(mapping: DataFrame, rules: DataFrame, day: date) -> DataFrame:
    """mapping with canonical ids from the rules (normalized_name, coord_key, canonical_station_id, valid_from, valid_to) that hold on a day, and ``overridden``.

    A rule without coord_key is for a name anywhere; one with it goes first, then the
    latest, then the smallest id.
    """
    keys = ["rule_name", "rule_key"]
    held = state_at(rules.withColumn("since", F.col("valid_from")), day)
    held = held.select(F.col("normalized_name").alias("rule_name"), F.col("coord_key").alias("rule_key"), F.col("canonical_station_id").alias("rule_id"), "since")
    held = first_per_key(held, keys, desc("since"), asc("rule_id")).drop("since")
    here = held.where(F.col("rule_key").isNotNull())
    anywhere = held.where(F.col("rule_key").isNull()).select(F.col("rule_name").alias("any_name"), F.col("rule_id").alias("any_id"))
    j = mapping.join(here, (F.col("normalized_name") == F.col("rule_name")) & (F.col("coord_key") == F.col("rule_key")), "left").join(anywhere, F.col("normalized_name") == F.col("any_name"), "left")
    by_rule = F.coalesce("rule_id", "any_id")
    own = [F.coalesce(by_rule, F.col(c)).alias(c) if c == "canonical_station_id" else F.col(c) for c in mapping.columns]
    return j.select(*own, by_rule.isNotNull().alias("overridden"))


def unseen_files(found: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of ``found`` (path, ...) that no earlier run's ``done`` (path) has."""
    return found.join(done.select("path").distinct(), "path", "left_anti")


def write_months(standard: DataFrame, path: str) -> None:
    """Write trips by year and month; months that the frame holds are replaced, others stay."""
    standard.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trip_year", "trip_month").parquet(path)
