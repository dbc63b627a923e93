"""Hand-made rows, one behaviour each."""

import datetime as dt
import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidewheel import schemas
from tidewheel.functions import geo, similarity, text, timefn
from tidewheel.operators import core, entity, flow, layers, places, profile, trips as tr
from tidewheel.plans.graph import connected_components
from tidewheel.plans.ordering import positions
from tidewheel.sources import files
from tidewheel.streaming import live

NAMES = ["start_station_name", "start_station_district", "start_station_latitude", "start_station_longitude", "end_station_name", "end_station_district", "end_station_latitude", "end_station_longitude", "start_time_ms", "end_time_ms"]
TYPES = "start_station_name string, start_station_district string, start_station_latitude double, start_station_longitude double, end_station_name string, end_station_district string, end_station_latitude double, end_station_longitude double, start_time_ms long, end_time_ms long"


def trip(a="A", b="B", start=0, end=60_000, da="X", db="X", at=(45.5, -73.6), to=(45.6, -73.6)):
    return (a, da, *at, b, db, *to, start, end)


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("raw, want", [("Duluth  / St-Denis", "duluth / st-denis"), ("A - B", "a-b"), ("A-B", "a-b"), ("Chemin MacDonald", "chemin macdonald"), (" x/y ", "x / y")])
def test_normalize(spark, raw, want):
    assert one(spark, raw, text.normalize_name) == want


def test_two_cleaners_differ(spark):
    raw = "Métro Mont-Royal (Utilités publiques / Rivard)"
    assert one(spark, raw, text.clean_first) == "MTRO MONT-ROYAL (UTILITÉS PUBLIQUES / RIVARD)"
    assert one(spark, raw, text.clean_all) == "MTRO MONT-ROYAL (UTILITS PUBLIQUES / RIVARD)"


def test_tokens(spark):
    assert one(spark, "métro du parc Jarry jarry", text.tokens) == ["m", "tro", "du", "parc", "jarry"]
    assert one(spark, "Rue de la Montagne / Parc Jarry", text.blocking_tokens) == ["jarry", "montagne"]
    df = spark.createDataFrame([("a b c", "b c d e", 2 / 3), ("", "a", 0.0)], "a string, b string, want double")
    assert all(r.got == pytest.approx(r.want) for r in df.withColumn("got", text.token_overlap(F.col("a"), F.col("b"))).collect())


def test_similarity_udfs(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("du parc-lafontaine / rachel", "du parc-la fontaine / rachel"), ("", "x"), (None, "x"), ("abc", "xxabcxx")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.ratio("a", "b").alias("r"), similarity.partial_ratio("a", "b").alias("p"), similarity.partial_ratio_fast("a", "b").alias("q")).collect()
    got = {(r.a, r.b): r for r in rows}
    assert got["tide", "diet"].r == 0.25 and got["diet", "tide"].r == 0.5
    assert got["abc", "xxabcxx"].p == got["abc", "xxabcxx"].q == 1.0 and got["", "x"].p == 0.0 and got[None, "x"].r is None
    a, b = pairs[2]
    assert got[a, b].p == max(SequenceMatcher(None, a, b[i : i + len(a)]).ratio() for i in range(len(b) - len(a) + 1))


def test_time(spark):
    ms = 1718830800000
    df = spark.createDataFrame([(ms,)], "ms long").select(timefn.hour(timefn.instant(F.col("ms"))).alias("h"), timefn.utc_naive(F.col("ms")).alias("n"), timefn.dow_sunday0(timefn.instant(F.col("ms"))).alias("s"), timefn.dow_monday0(timefn.instant(F.col("ms"))).alias("m"), timefn.hour(timefn.local(timefn.instant(F.col("ms")), "America/Toronto")).alias("l"))
    r = df.first()
    assert (r.h, r.n, r.s, r.m, r.l) == (21, dt.datetime(2024, 6, 19, 21), 3, 2, 17)
    winter = spark.createDataFrame([(1705320000000,)], "ms long").select(timefn.hour(timefn.local(timefn.instant(F.col("ms")))).alias("fixed"), timefn.hour(timefn.local(timefn.instant(F.col("ms")), "America/Toronto")).alias("true")).first()
    assert (winter.fixed, winter.true) == (8, 7)


def test_distances_agree(spark):
    r = spark.createDataFrame([(45.5, -73.6, 45.52, -73.58)], "a double, b double, c double, d double").select(geo.haversine_km(*map(F.col, "abcd")).alias("km"), geo.haversine_m(*map(F.col, "abcd")).alias("m")).first()
    assert r.km * 1000 == pytest.approx(r.m) and 2.5 < r.km < 3


def test_trip_rules(spark):
    rows = [trip("S", "S", 0, 119_999, at=(1.0, 1.0), to=(1.0, 1.0)), trip("S", "S", 0, 120_000), trip("S", "T", 0, 43_200_000), trip("S", "T", 0, 43_200_001), trip(da=None), trip(end=None)]
    t = spark.createDataFrame(rows, TYPES)
    assert [(r.kind, r.n) for r in tr.short_trips(t).where("start_station_name = 'S'").collect()] == [("SAME_STATION", 1)]
    assert tr.long_trips(t).agg(F.sum("n")).first()[0] == 1
    assert {r.kind: r.n for r in tr.intra_inter(t).collect()} == {"Intra-District": 5, "Inter-District": 1}
    assert tr.validity(t, depot="T").where("depot").count() == 2


def test_limits_of_classes(spark):
    df = spark.createDataFrame([(150.0,), (150.01,), (400.0,), (400.01,), (None,)], "m double").select(flow.tier(F.col("m")).alias("t"))
    assert [r.t[-1] for r in df.collect()] == ["1", "2", "2", "3", "3"]
    days = {"a": (80, 20), "b": (65, 35), "c": (70, 30)}
    ev = [(s, dt.datetime(2024, 1, 1 if k < n else 6, 5), "out") for s, (n, _) in days.items() for k in range(100)]
    e = spark.createDataFrame(ev, "station string, ts timestamp_ntz, direction string")
    assert {r.station: r.archetype for r in flow.archetypes(e, 99).collect()} == {"a": "Commuter", "b": "Leisure", "c": "Mixed"}
    assert flow.archetypes(e, 100).count() == 0


def test_hours_are_filled(spark):
    df = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, 0), 2), ("s", dt.datetime(2024, 1, 1, 3), 1)], "station string, hour timestamp_ntz, n long")
    assert [r.n for r in core.densify_hours(df, "station", "hour", "n").orderBy("hour").collect()] == [2, 0, 0, 1]


def test_pressure_without_capacity(spark):
    a = spark.createDataFrame([(1, 0, 3.0), (2, 0, 3.0)], "station long, hour long, daily_avg double")
    c = spark.createDataFrame([(1, 0), (2, 6)], "station long, capacity int")
    assert {r.station: r.pressure for r in flow.outflow_pressure(a, c).collect()} == {1: None, 2: 50.0}


def test_one_sided_flow(spark):
    e = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "in")], "station long, ts timestamp_ntz, direction string")
    assert [tuple(r) for r in flow.activity_joined(e).collect()] == [(1, 0, 1)]


def test_components_of_chains(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)] + [("x", "y"), ("z", "z"), (None, "q")]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {f"n{i:03}": "n000" for i in range(41)} | {"x": "x", "y": "x"}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_of_shuffled_chains(spark):
    order = list(range(4000))
    random.Random(7).shuffle(order)
    chains = [order[:3000], order[3000:]]
    edges = [(a, b) for c in chains for a, b in zip(c, c[1:], strict=False)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: min(c) for c in chains for x in c}


def test_positions(spark):
    rows = spark.createDataFrame([(k,) for k in [5, 3, None, 9, 3, -1]], "k long")
    assert [(r.k, r.pos) for r in positions(rows, "k").orderBy("pos").collect()] == [(None, 0), (-1, 1), (3, 2), (3, 3), (5, 4), (9, 5)]


def test_groups_and_mapping(spark):
    pairs = spark.createDataFrame([("a", "b", 0.05), ("b", "c", 0.01), ("d", "e", 0.05), ("e", "f", 0.0501)], "left_normalized_name string, right_normalized_name string, distance_km double")
    groups = entity.station_groups(pairs)
    assert sorted((r.group_id, r.canonical_name, r.member_name, r.group_size) for r in groups.collect()) == [("station_group_0001", "a", n, 3) for n in "abc"] + [("station_group_0002", "d", n, 2) for n in "de"]
    rows = [trip("A", at=(45.5, -73.6))] * 3 + [trip("B", at=(45.5001, -73.6))] * 2 + [trip("G", at=(45.9, -73.6))] * 4
    m = entity.canonical_mapping(entity.observations(spark.createDataFrame(rows, TYPES)), groups)
    assert {r.raw_name: (r.canonical_station_id, r.canonical_coord_key) for r in m.collect()} == {"A": ("STN_0001", "45.500000,-73.600000"), "B": ("STN_0001", "45.500000,-73.600000"), "G": ("STN_0002", "45.900000,-73.600000")}


def _canon(spark):
    return spark.createDataFrame([("STN_0001", "place a", "45.500000,-73.600000", 45.5, -73.6), ("STN_0002", "place b", "45.600000,-73.600000", 45.6, -73.6)], "canonical_station_id string, normalized_name string, coord_key string, canonical_lat double, canonical_lon double")


FEED = [("1", "Place A", 45.5, -73.6), ("2", "Place B", 45.6009, -73.6), ("3", "other", 45.60027, -73.6), ("4", "far", 46.0, -73.0)]


def test_live_stages(spark):
    feed = spark.createDataFrame(FEED, "station_id string, name string, lat double, lon double")
    out = places.live_match(feed, _canon(spark))
    assert {r.station_id: (r.canonical_station_id, r.match_method) for r in out.collect()} == {"1": ("STN_0001", "coord_exact"), "2": ("STN_0002", "name_near"), "3": ("STN_0002", "nearest"), "4": (None, None)}
    assert {r.method: r.n for r in places.coverage(out).collect()} == {"coord_exact": 1, "name_near": 1, "nearest": 1, "unmatched": 1}
    with pytest.raises(ValueError, match="missing"):
        places.live_match(feed, _canon(spark).drop("coord_key"))


def test_streamed_feed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    doc = {"data": {"stations": [dict(zip(("station_id", "name", "lat", "lon"), f, strict=True)) | {"capacity": 9} for f in FEED]}}
    (tmp_path / "in" / "a.json").write_text(json.dumps(doc))
    low = []
    q = live.reconcile(live.landed_feed(spark, f"{tmp_path}/in"), _canon(spark), f"{tmp_path}/out", f"{tmp_path}/ck", 0.9, lambda i, n: low.append((i, n["unmatched"])))
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4 and low == [(0, 1)]
    assert files.read_live_information(spark, f"{tmp_path}/in/a.json").count() == 4


def test_utilization_without_capacity(spark):
    i = spark.createDataFrame([("1", 0)], "station_id string, capacity int")
    s = spark.createDataFrame([("1", 0, 0)], "station_id string, num_bikes_available int, num_docks_available int")
    r = places.utilization(i, s).first()
    assert r.utilization is None and r.by_capacity is None


HEADER = ",".join(schemas.RENAME)
GOOD = "Métro X,D1,45.5,-73.6,B,D2,45.6,-73.5,1000,61000"


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{GOOD}\n{GOOD}\n")
    (tmp_path / "bad.csv").write_text(f"{HEADER}\n{GOOD}\nX,D,45.5,-73.6,B,D,45.6,-73.5,soon,1\n")
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    a, bad = f"{tmp_path}/a.csv", f"{tmp_path}/bad.csv"
    assert [r.path.rpartition("/")[2] for r in files.discover(spark, str(tmp_path)).collect()] == ["a.csv", "bad.csv", "other.csv"]
    assert files.read_csv(spark, bad, skip_bad_rows=True).count() == 1
    assert files.headers_equal(spark, [a, bad]) and not files.headers_equal(spark, [a, f"{tmp_path}/other.csv"])
    with pytest.raises(ValueError):
        files.read_equal_csvs(spark, [a, f"{tmp_path}/other.csv"])
    status = {r.path: r for r in files.convert(spark, [a, bad], f"{tmp_path}/bronze").collect()}
    assert status[a].rows == 2 and status[a].error is None and status[bad].error
    bronze = files.read_parquet(spark, f"{tmp_path}/bronze/a.parquet")
    assert bronze.columns == list(schemas.RENAME.values()) and dict(bronze.dtypes)["start_station_latitude"] == "float"
    assert schemas.rename_report(["STARTTIMEMS", "x"])["unmapped"] == ["x"]
    assert files.head_of_files(files.read_csv(spark, a), 1).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_artifact(spark, f"{tmp_path}/none", [])
    files.write_csv(bronze, f"{tmp_path}/csv", single=True)
    assert files.query(spark, "SELECT count(*) AS c FROM {t} WHERE start_time_ms > :m", {"m": 0}, t=bronze).first().c == 2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10)] + [(None,)], "v double")
    assert [r.n for r in profile.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 1]
    assert [r.n for r in profile.histogram(df.where("v = 1"), "v", 2).orderBy("bin").collect()] == [1, 0]
    assert profile.duplicate_report(df.unionAll(df.where("v = 1"))).first().asDict() == {"row_count": 6, "extra_copies": 1, "rows_with_copy": 2}


def test_fan_out_of_a_dimension_that_is_not_unique(spark):
    t = spark.createDataFrame([("x",)] * 3, "name string")
    dim = spark.createDataFrame([("x", 1.0), ("x", 2.0)], "name string, lat double")
    assert t.join(dim, "name").count() == 6
    assert t.join(core.first_per_key(dim, ["name"], core.asc("lat")), "name").count() == 3


def test_flags_and_drift(spark):
    rows = [trip(), trip(" "), trip(None, end=-1), trip(at=(None, -73.6)), trip(start=None)]
    df = layers.standardize(spark.createDataFrame(rows, TYPES))
    assert [r.flags for r in df.collect()] == [[], ["missing_start_name"], ["missing_start_name", "invalid_times"], ["missing_start_place"], ["invalid_times"]]
    assert df.first().trip_date == dt.date(1970, 1, 1)
    drift = layers.schema_drift(df.select("start_station_name", F.lit(1).alias("end_time_ms")), df.select("start_station_name", "end_time_ms", "flags").schema)
    assert sorted(tuple(r) for r in drift.collect()) == [("end_time_ms", "bigint", "int"), ("flags", "array<string>", None)]


def test_history_of_a_mapping(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    state = lambda *rows: spark.createDataFrame(rows, "k string, v string")
    h = layers.new_history(state())
    for day, s in zip(days, (state(("a", "1"), ("b", "1"), ("n", None)), state(("a", "2"), ("b", "1"), ("n", None)), state(("a", "2"), ("c", "1"), ("n", None))), strict=False):
        h = layers.next_version(h, s, day, ["k"])
    want = [("a", "1", days[0], days[1]), ("a", "2", days[1], None), ("b", "1", days[0], days[2]), ("c", "1", days[2], None), ("n", None, days[0], None)]
    got = lambda x: sorted((tuple(r) for r in x.collect()), key=str)
    assert got(h) == want
    assert got(layers.next_version(h, state(("a", "2"), ("c", "1"), ("n", None)), days[2], ["k"])) == want
    again = got(layers.next_version(h, state(("a", "2"), ("b", "1")), days[2], ["k"]))
    assert again == [("a", "1", days[0], days[1]), ("a", "2", days[1], None), ("b", "1", days[0], None), ("n", None, days[0], days[2])]
    assert got(layers.state_at(h, days[1])) == [("a", "2"), ("b", "1"), ("n", None)]


def test_increments(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{GOOD}\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n{GOOD}\n")
    found = files.discover(spark, str(tmp_path))
    left = layers.unseen_files(found, found.where("path LIKE '%a.csv'"))
    assert [r.path[-5:] for r in left.collect()] == ["b.csv"]
    raw = layers.with_origin(files.read_csv(spark, f"{tmp_path}/b.csv"), "b1", dt.datetime(2024, 1, 1)).collect()
    assert raw[0].source_file.endswith("b.csv") and raw[0].batch_id == "b1"
    out, month = f"{tmp_path}/silver", 32 * 86_400_000
    layers.write_months(layers.standardize(spark.createDataFrame([trip(), trip(start=month, end=month)], TYPES)), out)
    layers.write_months(layers.standardize(spark.createDataFrame([trip("B")], TYPES)), out)
    assert sorted((r.trip_month, r.start_name) for r in spark.read.parquet(out).collect()) == [(1, "b"), (2, "a")]
    audit = layers.lineage(spark, "r1", "v1", {"bronze": found, "silver": left})
    assert [(r.layer, r.row_count) for r in audit.collect()] == [("bronze", 2), ("silver", 1)]


def test_dealt_join_keeps_every_row_of_a_hot_key(spark):
    from tidewheel.plans.skew import dealt_join, hot_keys

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 30}") for i in range(900)] + [(1, None)], "i long, k string")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "key string, v long")
    counts = rows.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    assert [r[0] for r in hot_keys(counts, 4).collect()] == ["hot"]
    got = sorted(tuple(r) for r in dealt_join(rows, lookup, "k", "key").collect())
    assert got == sorted(tuple(r) for r in rows.join(lookup, rows.k == lookup.key).drop("key").collect()) and len(got) > 600
    assert dealt_join(rows, lookup, "k", "key", "left").count() == 901
    assert dealt_join(rows.limit(0), lookup, "k", "key").count() == 0


def test_components_of_structs_with_a_hub(spark):
    edges = [(i, 500) for i in range(1, 500)] + [(i, 501) for i in range(1000, 1400)] + [(500, 501), (2000, 2001)]
    df = spark.createDataFrame(edges, "a long, b long").select(F.struct(F.col("a").alias("id"), F.lit("x").alias("t")).alias("src"), F.struct(F.col("b").alias("id"), F.lit("x").alias("t")).alias("dst"))
    got = {r.node.id: r.component.id for r in connected_components(df).collect()}
    assert got == {n: 2000 if n >= 2000 else 1 for e in edges for n in e}


def test_no_temporary_folder_off_a_local_master():
    from types import SimpleNamespace

    from tidewheel.plans.storage import shared_dir

    nothing = SimpleNamespace(get=lambda *a: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
            shared_dir(SimpleNamespace(conf=nothing, sparkContext=SimpleNamespace(master=master, getConf=lambda: nothing)))


def _km(a, b):
    from math import asin, cos, radians, sin, sqrt

    p, q = radians(b[0] - a[0]) / 2, radians(b[1] - a[1]) / 2
    return 2 * 6371.0 * asin(min(1.0, sqrt(sin(p) ** 2 + cos(radians(a[0])) * cos(radians(b[0])) * sin(q) ** 2)))


def test_radius_anywhere_on_the_globe(spark):
    rnd = random.Random(2)
    spots = [(0.0, 179.9999), (0.0, -179.9999), (75.0, 10.0), (75.0, 10.02), (89.9999, 0.0), (89.9999, 180.0), (-89.9995, -90.0), (45.5, -73.5), (45.5003, -73.5), (-45.0, 180.0), (-45.0, -180.0)]
    spots += [(rnd.choice([0, 45, 60, 75, 89.9, -80]) + rnd.uniform(-0.02, 0.02), rnd.choice([0, 179.99, -179.99, 100]) + rnd.uniform(-0.02, 0.02)) for _ in range(150)]
    points = spark.createDataFrame([(i, *x) for i, x in enumerate(spots)] + [(999, None, 1.0)], "id long, lat double, lon double")
    for km in (0.05, 1.0, 700.0):
        got = {(r.id, r.target_id) for r in places.within_radius(points, points, km).collect()}
        want = {(i, j) for i, a in enumerate(spots) for j, b in enumerate(spots) if _km(a, b) <= km}
        assert got == want, km
        assert places.within_radius(points, points, km).count() == len(want)
    near = {r.id: r.metres for r in places.nearest_all(points.where("lat IS NOT NULL"), points.where("id > 20"), small=5).collect()}
    assert near == {i: pytest.approx(min(_km(a, b) for j, b in enumerate(spots) if j > 20) * 1000, abs=0.02) for i, a in enumerate(spots)}


def test_live_rows_of_one_station_are_matched_each(spark):
    mapping = spark.createDataFrame([("STN_1", "a", "45.000000,-73.000000", 45.0, -73.0), ("STN_2", "b", "45.100000,-73.000000", 45.1, -73.0)], "canonical_station_id string, normalized_name string, coord_key string, canonical_lat double, canonical_lon double")
    feed = spark.createDataFrame([("7", "A", 45.001, -73.0), ("7", "B", 45.101, -73.0), ("7", "A", 45.001, -73.0), ("8", "z", 45.1003, -73.0), ("9", None, 10.0, 10.0)], "station_id string, name string, lat double, lon double")
    got = sorted((r.station_id, r.canonical_station_id or "", r.match_method or "") for r in places.live_match(feed, mapping).collect())
    assert got == [("7", "STN_1", "name_near"), ("7", "STN_2", "name_near"), ("8", "STN_2", "nearest"), ("9", "", "")]


def test_quantiles(spark):
    from tidewheel.plans import quantiles

    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), float(rnd.randrange(50))) for _ in range(500)] + [("c", 3.0), ("d", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    ps = (0.0, 0.1, 0.25, 0.5, 0.95, 1.0)
    got = {r.k: r for r in quantiles.ranked(df, "x", "k").groupBy("k").agg(*(quantiles.quantile(p).alias(f"q{i}") for i, p in enumerate(ps)), quantiles.rows().alias("n"), quantiles.mean().alias("m")).collect()}
    for r in df.where("x IS NOT NULL").groupBy("k").agg(*(F.percentile("x", p).alias(f"q{i}") for i, p in enumerate(ps)), F.count("x").alias("n"), F.avg("x").alias("m")).collect():
        assert tuple(got.pop(r.k)) == pytest.approx(tuple(r))
    assert not got
    some = spark.createDataFrame([(None, 4.0), (None, 8.0), (None, None), ("a", None)], "k string, x double")
    held = quantiles.ranked(some, "x", "k", nulls=True).groupBy("k").agg(quantiles.quantile(0.5).alias("q"), quantiles.rows().alias("n"), quantiles.mean().alias("m"))
    assert sorted((tuple(r) for r in held.collect()), key=str) == [("a", None, 1, None), (None, 6.0, 3, 6.0)]
    assert [tuple(r) for r in quantiles.ranked(some, "x", "k").select("k", "v", "n", "before", "total").orderBy("v").collect()] == [(None, 4.0, 1, 0, 2), (None, 8.0, 1, 1, 2)]
    assert quantiles.ranked(df.limit(0), "x").agg(quantiles.quantile(0.5).alias("q"), quantiles.rows().alias("n")).first() == (None, 0)


def test_readers_of_small_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{GOOD}\n{GOOD}\n{GOOD}\n")
    assert files.read_csv_head(spark, f"{tmp_path}/a.csv", 2).count() == 2 and files.csv_header(spark, f"{tmp_path}/a.csv") == list(schemas.RENAME)
    (tmp_path / "dim.csv").write_text("station_name_standardized,latitude,longitude,elevation_meters,nearest_metro_dist_meters,capacity\nA,45.5,-73.5,30.5,120.25,19\n")
    assert tuple(files.read_dimension(spark, f"{tmp_path}/dim.csv").first()) == ("A", 45.5, -73.5, 30.5, 120.25, 19.0)
    (tmp_path / "status.json").write_text(json.dumps({"data": {"stations": [{"station_id": "1", "num_bikes_available": 3, "num_docks_available": 4}]}}))
    assert tuple(files.read_live_status(spark, f"{tmp_path}/status.json").first()) == ("1", 3, 4)
    (tmp_path / "metro.json").write_text(json.dumps({"elements": [{"lat": 45.5, "lon": -73.6}, {"id": 9}]}))
    assert [tuple(r) for r in files.read_metro(spark, f"{tmp_path}/metro.json").collect()] == [(45.5, -73.6)]


def test_frames_by_name_schema_and_sample(spark):
    df = spark.range(50).selectExpr("id", "id * 0.5D AS x", "cast(id AS string) AS s")
    files.register(df, "numbers")
    assert spark.sql("SELECT sum(id) AS t FROM numbers").first().t == 1225
    assert [tuple(r) for r in files.schema_table(df).collect()] == [(0, "id", "bigint", False), (1, "x", "double", False), (2, "s", "string", False)]
    from pyspark.sql import types as T

    assert schemas.columns_of_type(df, T.StringType) == ["s"] and schemas.columns_of_type(df, (T.LongType, T.DoubleType)) == ["id", "x"]
    a = sorted(r.id for r in files.sample_rows(df.coalesce(1), 7).collect())
    assert len(set(a)) == 7 and a == sorted(r.id for r in files.sample_rows(df.coalesce(1), 7).collect())


@pytest.fixture
def service():
    """A local stand-in for the public services."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from threading import Thread

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            lat = self.path.rpartition("=")[2].partition(",")[0]
            bodies = {"1.0": {"results": [{"elevation": 12.5}]}, "2.0": {"results": [{"elevation": None}]}, "3.0": {"error": "x"}}
            body = json.dumps(bodies.get(lat, {"elements": [{"lat": 45.0, "lon": -73.0}]})).encode()
            self.send_response(500 if lat == "4.0" else 200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_elevations_are_null_where_the_service_fails(spark, service, tmp_path):
    url, asked = service
    places_ = spark.createDataFrame([(x, 5.0) for x in (1.0, 1.0, 2.0, 3.0, 4.0, None)], "latitude double, longitude double")
    got = {r.latitude: r.elevation_meters for r in files.lookup_elevations(places_, url + "/v1?locations={latitude},{longitude}").collect()}
    assert got == {1.0: 12.5, 2.0: None, 3.0: None, 4.0: None, None: None} and len(asked) == 4
    assert files.lookup_elevations(places_.limit(1), "http://127.0.0.1:1/{latitude}{longitude}", 0.5).first().elevation_meters is None
    assert [tuple(r) for r in files.land_metro(spark, f"file://{tmp_path}/metro", "Québec", url).collect()] == [(45.0, -73.0)]
    assert "Qu%C3%A9bec" in asked[-1]


def test_first_in_input_order(spark, tmp_path):
    (tmp_path / "x.csv").write_text("k,v\nb,1\na,2\nb,3\na,4\n")
    df = spark.read.option("header", True).csv(f"{tmp_path}/x.csv")
    assert sorted(tuple(r) for r in core.first_in_input(df, ["k"]).collect()) == [("a", "2"), ("b", "1")]
    assert core.first_in_input(df, ["k", "v"]).count() == 4


def test_common_tokens_are_dealt(spark):
    obs = spark.createDataFrame([(f"main {'east' if i % 2 else 'west'} {i}", 45.0 + i, -73.0, i) for i in range(60)] + [("alone", 1.0, 1.0, 9)], "normalized_name string, primary_lat double, primary_lon double, total_name_trips long")
    got = {t: sorted((r.left_normalized_name, r.right_normalized_name) for r in entity.blocked_pairs(obs, t).collect()) for t in (1000, 7)}
    assert got[7] == got[1000] and len(got[7]) == len(set(got[7])) == 60 * 59 // 2


def test_artifacts_and_streamed_velocity(spark, tmp_path):
    mapping = _canon(spark).selectExpr("*", "1L AS canonical_total_trips", "'c' AS canonical_coord_key", "upper(normalized_name) AS raw_name", "5L AS trip_count", "2024 AS first_year_seen", "2025 AS last_year_seen")
    entity.export(mapping, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/station_canonical_mapping").count() == mapping.count()
    assert spark.read.parquet(f"{tmp_path}/out/station_canonical_summary").count() > 0
    rows = [("s", dt.datetime(2024, 5, 1, 10, m), "in" if m % 3 else "out") for m in range(30)] + [("s", dt.datetime(2024, 5, 1, 20, 0), "in")]
    spark.createDataFrame(rows, "station string, ts timestamp, direction string").write.parquet(f"{tmp_path}/ev")
    stream = spark.readStream.schema("station string, ts timestamp, direction string").parquet(f"{tmp_path}/ev")
    q = live.hourly_velocity(stream).writeStream.format("memory").queryName("speeds").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.inflow, r.outflow) for r in spark.table("speeds").collect()) == [(1, 0), (20, 10)]
