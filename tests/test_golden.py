"""Published figures of a small city, from its input files, and brute-force checks of order-dependent operators."""

import math
import random
import uuid

import pytest

from pyspark.sql import functions as F
from tallygrid.functions import geo
from tallygrid.functions import numerics as N
from tallygrid.functions import text as X
from tallygrid.functions.geo import Plane, polyline_centroid
from tallygrid.operators import city, crash, dedupe, governance, hotspot, network, ranks, rates, spatial, surfaces
from tallygrid.sources import readers, sinks

PLANE = Plane(33.9533, -117.3962)
COUNTS = {"s1": (3, 1500.0), "s2": (4, 800.0), "s3": (8, 250.0), "s4": (1, 1500.0), "s5": (0, 1500.0), "s6": (4, 800.0)}


def small_city(spark):
    """Six stretches apart from each other; counts and exposures as above; six of the eight at s3 are close passes."""
    lon = {s: -117.397 + i * 0.003 for i, s in enumerate(COUNTS)}
    coords = "coords array<struct<lat: double, lon: double>>"
    segs = spark.createDataFrame([(i, s, f"Main St ({s})", [(33.9533, x), (33.9533, x + 0.0016)]) for i, (s, x) in enumerate(lon.items())], f"pos long, segment_id string, name string, {coords}")
    rows = []
    for s, (n, _) in COUNTS.items():
        for i in range(n):
            hazard = "close_pass" if s == "s3" and i < 6 else "sightline"
            rows.append((f"{s}-{i}", f"2026-06-{i + 1:02d}T08:20:00-07:00", 33.95333, lon[s] + 0.0008, "cyclist", hazard, "minor", None, None, None))
    reps = spark.createDataFrame(rows, "report_id string, occurred_at string, lat double, lon double, mode string, hazard_type string, severity string, accuracy_m double, reporter_token string, address string")
    expo = spark.createDataFrame([(s, e) for s, (_, e) in COUNTS.items()], "segment_id string, estimate double")
    return segs, reps.withColumn("epoch", X.epoch(F.col("occurred_at"))), expo


def test_published_rates_of_a_small_city(spark):
    segs, reps, expo = small_city(spark)
    clean = city.run_pipeline(reps, segs, PLANE, "2026-01-01", "2026-12-31")
    stats = city.segment_statistics(clean, segs, expo, PLANE)
    got = {r.segment_id: r for r in stats.collect()}
    want = {
        "s1": (3, 2.0, 0.402, 5.8437, -0.4883), "s2": (4, 5.0, 1.3452, 12.8011, -0.2192), "s3": (8, 32.0, 13.7785, 63.0566, 2.2023),
        "s5": (0, 0.0, 0.0, 2.4454, -0.6677), "s6": (4, 5.0, 1.3452, 12.8011, -0.2192),
    }
    for s, (n, rate, low, high, z) in want.items():
        r = got[s]
        assert r.n == n and [round(x, 4) for x in (r.rate, r.rate_ci_low, r.rate_ci_high, r.z)] == [rate, low, high, z]
    assert not got["s4"].publishable and not any(r.significant for r in got.values())
    attached = rates.attach_exposure(segs.join(rates.segment_aggregate(clean), "segment_id", "left"), expo)
    assert round(rates.dispersion(attached).first().phi, 4) == 15.2193
    r = {(r.segment_id, r.hazard_type): r for r in rates.rates_by_type(clean, expo).collect()}["s3", "close_pass"]
    assert (r.n, r.rate, round(r.rate_ci_low, 4), round(r.rate_ci_high, 4)) == (6, 24.0, 8.7638, 52.2396)
    peak = surfaces.kde_peak(surfaces.kde_surface(reps, PLANE, 150.0, 20))
    cents = segs.withColumn("c", polyline_centroid(F.col("coords"))).select("segment_id", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"))
    assert surfaces.peak_segment(peak, cents).first().segment_id == "s3"
    assert network.maup_pairs(cents).select("unit").distinct().count() == 3


def haversine(a, b):
    p, q = map(math.radians, a), map(math.radians, b)
    (la, lo), (lb, lp) = tuple(p), tuple(q)
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371000.0 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("few", [100_000, 3])
def test_dedupe_is_greedy(spark, monkeypatch, few):
    monkeypatch.setattr(dedupe.removed_reports, "__defaults__", (200, few))
    draw = random.Random(8)
    rows = []
    for i in range(300):
        rows.append((f"r{i:03d}", 38.5 + draw.randint(0, 6) * 0.00008, -121.7, 1000 + draw.randint(0, 40) * 200, draw.choice([None, "", "t1", "t2"]), draw.choice("xy"), "m"))
    frame = spark.createDataFrame(rows, "report_id string, lat double, lon double, epoch long, reporter_token string, hazard_type string, mode string")
    kept = []
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        def same(k):
            if haversine(r[1:3], k[1:3]) > 15 or abs(r[3] - k[3]) > 600:
                return False
            return r[4] == k[4] if r[4] and k[4] else r[5] == k[5]

        if not any(same(k) for k in kept):
            kept.append(r)
    assert sorted(x.report_id for x in dedupe.dedupe(frame, Plane(38.5, -121.7)).collect()) == sorted(k[0] for k in kept)


def test_nothing_to_dedupe(spark):
    none = spark.createDataFrame([], "report_id string, lat double, lon double, epoch long, reporter_token string, hazard_type string, mode string")
    assert dedupe.dedupe(none, PLANE).collect() == []


def test_corridors(spark):
    p = lambda lon: (38.5, -121.7 + lon * 0.003)
    rows = [(f"seg-{i:02d}", f"5th St ({a}–{b})", [p(i), p(i + 1)], 6, 366.6666666666667 if i < 7 else 100.0, True, True) for i, (a, b) in enumerate(zip("ABCDEFGH", "BCDEFGHI")) if i in (4, 5, 6)]
    rows += [("seg-20", "Oak St (A–B)", [p(4), p(5)], 9, 50.0, True, True), ("seg-21", "5th St (Y–Z)", [p(20), p(21)], 9, 50.0, True, True), ("seg-22", "5th St (D–E)", [p(3), p(4)], 9, 50.0, False, True)]
    frame = spark.createDataFrame(rows, "segment_id string, name string, coords array<struct<lat: double, lon: double>>, n long, estimate double, significant boolean, publishable boolean")
    got = network.corridors(frame, Plane(38.5, -121.7)).collect()
    assert [(r.segment_ids, r.n, r.name) for r in got] == [(["seg-04", "seg-05", "seg-06"], 18, "5th St (E–H)")]
    assert abs(got[0].rate - 16.363636363636363) < 1e-9 and abs(got[0].rate_ci_low - 9.693079079709724) < 1e-9 and abs(got[0].rate_ci_high - 25.863132164308666) < 1e-9
    assert spark.range(1).select(X.corridor_id(F.array(F.lit("seg-07"), F.lit("seg-05"), F.lit("seg-06")))).first()[0] == "corridor-dd8fbf5922ba"


@pytest.mark.parametrize("few", [6, 100])
def test_reachability_is_dijkstra(spark, monkeypatch, few):
    monkeypatch.setattr(network, "FEW_HOPS", few)
    draw = random.Random(3)
    edges = {(a, b): draw.randint(1, 9) * 1.0 for a in range(30) for b in range(a + 1, 30) if draw.random() < 0.12}
    segs = spark.createDataFrame([(str(i),) for i in range(30)], "segment_id string")
    adj = spark.createDataFrame([(str(a), str(b), w) for (x, y), w in edges.items() for a, b in ((x, y), (y, x))], "u string, v string, w double")
    dist = {(a, b): 0.0 if a == b else math.inf for a in range(30) for b in range(30)}
    for (a, b), w in edges.items():
        dist[a, b] = dist[b, a] = w
    for k in range(30):
        for a in range(30):
            for b in range(30):
                dist[a, b] = min(dist[a, b], dist[a, k] + dist[k, b])
    got = {(int(r.a), int(r.b)): r.d for r in network.network_neighbors(segs, adj, 12.0).collect()}
    assert got == {k: d for k, d in dist.items() if d <= 12}


def test_planted_hot_spot(spark):
    out = {r.id: r for r in hotspot.unit_analyze(hotspot.planted_units(spark), Plane(0.0, 0.0), 300.0).collect()}
    assert all(out[f"hot-{i}"].significant for i in range(3)) and sum(r.significant for r in out.values()) == 3
    exact = spark.createDataFrame([(x / 16,) for x in range(-160, 480)], "z double").select("z", N.two_sided_p(F.col("z")).alias("p"))
    assert all(abs(r.p / math.erfc(abs(r.z) / math.sqrt(2)) - 1) < 1e-13 for r in exact.collect())


def test_rejections_of_ties_and_none(spark):
    p = [0.01, 0.01, 0.02, 0.04, 0.9, None]
    got = hotspot.benjamini_hochberg(spark.createDataFrame([(i, x) for i, x in enumerate(p)], "id int, p double"))
    assert {r.id for r in got.where("rejected").collect()} == {0, 1, 2, 3}
    assert hotspot.benjamini_hochberg(spark.createDataFrame([], "id int, p double")).collect() == []


def test_spearman_without_spread(spark):
    f = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert ranks.spearman(f, "x", "y").first().rho is None


def test_identity_and_rounding(spark):
    names = ["case:1", "case:é", ""]
    f = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in f.select(X.uuid5(uuid.NAMESPACE_URL, F.col("n"))).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]
    xs = [0.00005, 2.675, 1.00005, 0.12345, -0.5, None]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(N.even_round(F.col("x"), 4)).collect()
    assert [r[0] for r in got] == [None if x is None else round(x, 4) for x in xs]
    t = spark.createDataFrame([("2026-01-01T07:20:00-07:00",), ("2026-01-01T07:20:00Z",), ("2026-01-01T07:20:00",), ("junk",), (None,)], "t string")
    assert [tuple(r) for r in t.select(X.epoch(F.col("t")), X.local_hour(F.col("t"))).collect()] == [
        (1767277200, 7), (1767252000, 7), (1767252000, 7), (None, None), (None, None),
    ]


def test_crash_batch_fails_as_a_whole(spark):
    h = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "case_id long, declared long")
    good = spark.createDataFrame([(1, 1, True), (2, 1, False), (3, 1, True), (3, 2, False)], "case_id long, person long, fatal boolean")
    assert crash.reconciled(h, good, "case_id", "person", "declared", F.col("fatal")).count() == 4
    with pytest.raises(ValueError, match="fatal_mismatch 3"):
        crash.reconciled(h, good.where("not (case_id = 3 and person = 1)"), "case_id", "person", "declared", F.col("fatal"))


def test_noise_is_unbiased_and_guarded(spark):
    t = spark.range(4000).selectExpr("cast(id as string) as segment_id", "'midday' as part", "cast(100 as bigint) as true_count")
    key = bytes(range(16))
    out = surfaces.dp_release(t, 1.0, True, True, key)
    v = [r.published for r in out.collect()]
    assert "true_count" not in out.columns and abs(sum(v) / len(v) - 100) < 0.15 and abs(sum((x - 100) ** 2 for x in v) / len(v) - 2) < 0.4
    assert v == [r.published for r in out.repartition(3).orderBy(F.col("segment_id").cast("int")).collect()]
    assert key.hex() not in out._jdf.queryExecution().toString()
    fresh = [[r.published for r in surfaces.dp_release(t, 1.0, True, True).collect()] for _ in range(2)]
    assert fresh[0] != fresh[1] and v not in fresh
    assert surfaces.dp_release(t, 1.0, False, False).count() == 0
    with pytest.raises(PermissionError):
        surfaces.dp_release(t, 1.0, True, False, key)
    for epsilon, secret in ((0.0, key), (-1.0, key), (math.nan, key), (1.0, b"short")):
        with pytest.raises(ValueError):
            surfaces.dp_release(t, epsilon, True, True, secret)
    told = surfaces.dp_accounting(t, 0.5, key).first()
    assert told.cells == 4000 and told.noise_scale == 2.0 and told.composed_epsilon == 2000.0 and not told.theater and 1.9 < told.mean_absolute_noise < 2.1
    assert surfaces.dp_accounting(t.withColumn("true_count", F.lit(1)), 0.5, key).first().theater


def test_nothing_private_is_published(spark):
    good = spark.createDataFrame([("a", 5, True), ("b", 2, False), ("c", 0, True)], "segment_id string, n long, publishable boolean")
    assert {r.segment_id for r in governance.published_rows(good).collect()} == {"a", "c"}
    for key in ("reporter_token", "occurred_at", "note", "heading_deg", "lat", "lon", "accuracy_m", "mode", "severity", "true_count", "True_Count"):
        with pytest.raises(ValueError, match="private"):
            governance.published_rows(good.withColumn(key, F.lit(1)))
    with pytest.raises(ValueError, match="below 3"):
        governance.published_rows(good.withColumn("publishable", F.lit(True)))
    reports = spark.createDataFrame([(1, 38.123456, -121.5), (2, 38.2, -121.6)], "report_id long, lat double, lon double")
    leaks = lambda text: sorted((r.problem, r.what) for r in governance.metadata_leaks(text, reports).collect())
    assert leaks('{"at": [38.12346, -121.5], "other": 38.2}') == [("raw coordinate", "1")]
    assert leaks('{"note": 1, "true_count": 2}') == [("private key", "note"), ("private key", "true_count")] and leaks("{}") == []


def test_weather_codes(spark):
    from tallygrid.sources.readers import weather_condition

    want = {0: "clear", 2: "partly_cloudy", 4: "other", 44: "other", 45: "fog", 46: "other", 48: "fog", 50: "other", 51: "rain", 67: "rain", 70: "other",
            75: "snow", 81: "showers", 83: "other", 86: "snow_showers", 90: "other", 95: "thunderstorm", 100: "other", None: "other"}
    got = spark.createDataFrame([(c,) for c in want], "c int").select("c", weather_condition(F.col("c")).alias("w")).collect()
    assert {r.c: r.w for r in got} == want


def test_order_of_all_pairs(spark):
    draw = random.Random(6)
    rows = [(f"s{i}", draw.choice([None, *range(40)]), draw.randint(0, 30), draw.random() > 0.1) for i in range(300)]
    a = spark.createDataFrame([(i, None if x is None else float(x), p) for i, x, _, p in rows], "segment_id string, rate double, publishable boolean").repartition(3)
    b = spark.createDataFrame([(i, float(y)) for i, _, y, _ in rows[:250]], "segment_id string, rate double")
    both = [(i, x, y) for i, x, y, p in rows[:250] if x is not None and p]
    pa = {r[0]: k for k, r in enumerate(sorted(both, key=lambda r: (-r[1], r[0])))}
    pb = {r[0]: k for k, r in enumerate(sorted(both, key=lambda r: (-r[2], r[0])))}
    good = sum((pa[u[0]] < pa[v[0]]) == (pb[u[0]] < pb[v[0]]) for k, u in enumerate(both) for v in both[:k])
    n = len(both)
    for block in (7, 60, 50_000):
        assert tuple(ranks.kendall_concordance(a, b, block).first()) == (n * (n - 1) // 2, good)
    assert tuple(ranks.kendall_concordance(a.where("false"), b).first()) == (0, 0)
    none = a.where("false").select("segment_id", "rate")
    assert ranks.topk_overlap(none, none).first().overlap == 0.0


def test_numbers_in_order(spark):
    frame = spark.createDataFrame([(i * 7919 % 500,) for i in range(500)], "x int").repartition(5)
    got = ranks.numbered(frame, ["x"], "at").collect()
    assert all(r.x == r.at for r in got) and len(got) == 500


def test_pairs_of_segments_by_rings(spark):
    import pandas as pd

    draw = random.Random(11)
    for n in (0, 1, 2, 7, 90):
        at = {f"s{i:03d}": (38 + draw.random() * draw.choice((0.01, 0.3)), -121 - draw.random() * 0.05) for i in range(n)}
        free, want = dict(at), {}
        for s in sorted(at):
            if s in free:
                p = free.pop(s)
                want[s] = s
                if free:
                    o = min(free, key=lambda q: (geo.haversine_plain(*p, *free[q]), q))
                    free.pop(o)
                    want[o] = s
        rows = pd.DataFrame([(s, *p) for s, p in at.items()], columns=["segment_id", "lat", "lon"])
        assert dict(network._paired(rows)) == want
    cities = spark.createDataFrame([("a1", 0.0, 0.0, "a"), ("a2", 0.0, 9.0, "a"), ("b1", 0.0, 0.001, "b"), ("b2", 0.0, 9.001, "b")], "segment_id string, lat double, lon double, city string")
    assert {r.segment_id: r.unit for r in network.maup_pairs(cities, "city").collect()} == {"a1": "a1", "a2": "a1", "b1": "b1", "b2": "b1"}


def test_names_and_order_of_corridors(spark):
    p = lambda x, y=0.0: (38.5 + y * 0.003, -121.7 + x * 0.003)
    rows = [
        ("s2", "5th St (Z–Y)", [p(0), p(1)], 5, 10.0, "a", "d"), ("s1", "5th St (Y–A)", [p(1), p(2)], 5, 10.0, "a", "e"),
        ("t3", "Oak St (K–L)", [p(9, 1), p(8, 1)], 1, None, None, "d"), ("t1", "Oak St (L–M)", [p(8, 1), p(7, 1)], 1, 3.0, "b", "d"), ("t2", "Oak St (M-N)", [p(7, 1), p(6, 1)], 1, 3.0, "b", "d"),
        ("u1", "Elm St (A–B)", [p(0, 5), p(1, 5)], 1, 1.0, "a", "d"), ("u2", "Elm St (B–C)", [p(1, 5), p(2, 5)], 1, 1.0, "a", "d"), ("u3", "Elm St (B–D)", [p(1, 5), p(1, 6)], 1, 1.0, "a", "d"), ("u4", "Elm St (B–E)", [p(1, 5), p(1, 4)], 1, 1.0, "a", "d"),
        ("v1", "Ash St", [p(0, 9), p(1, 9)], 1, 1.0, "a", "d"), ("v2", "Ash St", [p(1, 9), p(2, 9)], 1, 1.0, "a", "d"),
    ]
    frame = spark.createDataFrame([(*r, True, True) for r in rows], "segment_id string, name string, coords array<struct<lat: double, lon: double>>, n long, estimate double, exposure_source string, exposure_date string, significant boolean, publishable boolean")
    got = {r.name: r for r in network.corridors(frame, Plane(38.5, -121.7)).collect()}
    assert set(got) == {"5th St (Z–A)", "Oak St (N–K)", "Elm St (merged: u1, u2, u3, u4)", "Ash St (merged: v1, v2)"}
    fifth, oak = got["5th St (Z–A)"], got["Oak St (N–K)"]
    assert fifth.segment_ids == ["s1", "s2"] and fifth.exposure_source == "a" and fifth.exposure_date == "mixed" and fifth.confidence_label == "certain" and fifth.rate == 500.0
    assert oak.segment_ids == ["t2", "t1", "t3"] and oak.rate is None and oak.exposure_source == "mixed" and oak.confidence_label == "uncertain"


def test_crosswalk_files(spark, tmp_path):
    from tallygrid.sources.readers import crosswalk_toml

    answers = "\n".join(f'{a} = "{"a long enough answer about this very axis "}{a}"' for a in governance.BIAS_AXES)
    rest = '[hazard_type]\ndefault = "other"\nrules = [{when = "Close pass", value = "close_pass"}]\n[severity]\nrules = [{contains = "hurt", value = "serious"}, {contains = "h", value = "minor"}]\n'
    path = tmp_path / "c.toml"
    path.write_text(f'[source]\nid = "x"\nname = "X"\nurl = "u"\nlicense = "l"\nbias_label = "b"\n[source.bias_profile]\n{answers}\n{rest}')
    said = crosswalk_toml(spark, str(path))
    rows = spark.createDataFrame([(1, "Close pass", "HURT badly"), (2, "close pass", "oh"), (3, None, None), (4, "Close pass!", "")], "id int, kind string, harm string")
    got = {r.id: (r.hazard_type, r.severity, r.bias_label) for r in governance.apply_crosswalk(rows, said, "kind", "harm").collect()}
    assert got == {1: ("close_pass", "serious", "b"), 2: ("other", "minor", "b"), 3: ("other", "near_miss", "b"), 4: ("other", "near_miss", "b")}
    said["source"]["bias_profile"]["language"] = "n/a"
    said["severity"]["default"] = "awful"
    assert governance.crosswalk_problems(said) == ["bias axis language is not answered", "severity: awful is not known"]


def test_exposure_from_counters(spark):
    segs = spark.createDataFrame([("a",), ("b",), ("c",)], "segment_id string")
    snapped = spark.createDataFrame([(1, "a", 4.0), (2, "a", 8.0), (3, "b", 1.0), (4, None, 50.0)], "counter_id int, segment_id string, count double")
    build = lambda **k: {r.segment_id: (r.estimate, r.source) for r in rates.build_exposure(snapped, segs, "s", "d", **k).collect()}
    assert build() == {"a": (12.0, "s"), "b": (1.0, "s")} and build(how="max")["a"][0] == 8.0
    assert build(how="mean", fallback=True)["c"] == (3.5, "modeled_flat_prior (s)") and build(fallback=True, prior=2.0)["c"][0] == 2.0 and "c" not in build(fallback=True, prior=0.0)


def test_files(spark, tmp_path):
    (tmp_path / "ride.csv").write_text("56#1\nkey,lat,lon,ts,incident,scary,desc\n0,52.5,13.4,1600000000000,1,1,x\n1,52.6,13.5,0,7,0,\n2,52.7,13.6,1600000000000,-5,0,\n=======\nlat,lon\n")
    assert [(r.key, r.occurred_at, r.incident) for r in readers.ride_file(spark, f"{tmp_path}/ride.csv").collect()] == [("0", "2020-09-13T12:26:40Z", "1"), ("1", None, "7")]
    (tmp_path / "w.json").write_text('{"daily": [{"date": "2026-01-01", "precip_mm": 0.5}, {"date": "2026-01-02", "wet": false, "precip_mm": 3}]}')
    w = readers.weather_json(spark, f"{tmp_path}/w.json").withColumn("is_wet", surfaces.is_wet(F.col("wet"), F.col("precip_mm")))
    assert {r.date: r.is_wet for r in w.collect()} == {"2026-01-01": True, "2026-01-02": False}
    (tmp_path / "e.json").write_text('[{"segment_id": "a", "estimate": 1.0}, {"segment_id": "a", "estimate": 2.0, "tier": "proxy"}]')
    assert [(r.segment_id, r.estimate, r.tier) for r in readers.exposure_json(spark, f"{tmp_path}/e.json").collect()] == [("a", 2.0, "proxy")]
    (tmp_path / "acc.csv").write_text("﻿state , ST_CASE,X\n1,10,q\n")
    assert [tuple(r) for r in readers.text_table(spark, f"{tmp_path}/acc.csv", ["STATE", "ST_CASE"]).collect()] == [("1", "10")]
    with pytest.raises(ValueError, match="missing"):
        readers.text_table(spark, f"{tmp_path}/acc.csv", ["YEAR"])
    segs = spark.createDataFrame([("b", [(1.0, 2.0), (1.5, 2.5)]), ("a", [(3.0, 4.0), (3.5, 4.5)])], "segment_id string, coords array<struct<lat: double, lon: double>>")
    sinks.write_geojson(segs, f"{tmp_path}/out.geojson")
    back = readers.streets_geojson(spark, f"{tmp_path}/out.geojson").collect()
    assert [(r.segment_id, r.coords[0].lat, r.coords[0].lon) for r in back] == [("a", 3.0, 4.0), ("b", 1.0, 2.0)]
    with pytest.raises(ValueError, match="duplicate"):
        readers.public_release(b'{"a": 1, "a": 2}')
    assert sinks.negotiate("de, es;q=0.5, en;q=0.2") == "es"
    (tmp_path / "k.kml").write_text('<kml xmlns="http://x"><Placemark><name>A</name><SimpleData name="STATE">06</SimpleData><coordinates>1,2,0 3,4,0</coordinates></Placemark></kml>')
    r = readers.boundaries_kml(spark, f"{tmp_path}/k.kml").first()
    assert (r["name"], r["data"]["STATE"], r["rings"]) == ("A", "06", [[[1.0, 2.0], [3.0, 4.0]]])


def test_stream_of_reports(spark, tmp_path):
    from tallygrid.streaming import intake

    rows = [(1, "2026-01-01 00:00:00"), (1, "2026-01-01 00:00:01"), (2, "2026-01-01 02:00:00")]
    spark.createDataFrame(rows, "report_id long, ts string").selectExpr("report_id", "timestamp(ts) as ts").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("report_id long, ts timestamp").parquet(f"{tmp_path}/in")
    q = intake.fresh_reports(stream).writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.report_id for r in spark.sql("select * from fresh").collect()) == [1, 2]


def test_more_files(spark, tmp_path):
    import zipfile

    (tmp_path / "points.geojson").write_text('{"features": [{"geometry": {"type": "Point", "coordinates": [-121.5, 38.5]}, "properties": {"count": 7, "pk": 3, "date": "2024-01-01T10:00:00"}},'
        ' {"geometry": {"type": "Point", "coordinates": [-120.5, 38.5]}, "properties": {"count": "0", "date": "2024-01-01T10:00:00Z"}}, {"geometry": {"type": "LineString", "coordinates": []}, "properties": {}}]}')
    assert [tuple(r) for r in readers.counts_geojson(spark, str(tmp_path / "points.geojson")).collect()] == [(38.5, -121.5, 7.0)]
    both = {r.pk: r.report_id for r in readers.point_reports(spark, str(tmp_path / "points.geojson"), "collision").collect()}
    assert both == {"3": str(uuid.uuid5(readers.POINTS, "collision:3")), None: str(uuid.uuid5(readers.POINTS, "collision:38.500000,-120.500000:2024-01-01T10:00:00Z"))}
    assert [r.pk for r in readers.point_reports(spark, str(tmp_path / "points.geojson"), "collision", box=(-121.6, 38, -121.5, 38.5)).collect()] == ["3"]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("National/accident.CSV", '\ufeffst_case, State,NAME\n1,6,"Davis, CA"\n2,,\n3\n'.encode())
    got = readers.zip_table(spark, str(tmp_path / "a.zip"), "ACCIDENT.csv", ["ST_CASE", "NAME"]).collect()
    assert [tuple(r) for r in got] == [("1", "Davis, CA"), ("2", ""), ("3", None)]
    with pytest.raises(Exception, match="members are named"):
        readers.zip_table(spark, str(tmp_path / "a.zip"), "person.csv", ["A"]).collect()


def test_evidence_files_and_registry(spark, tmp_path):
    (tmp_path / "e.csv").write_text('Report ID, Hazard-Type ,Note (free)\r\n1,dooring,"a, ""b""\nc"\r\n,,\r\n2, debris ,\r\n')
    got = readers.evidence_csv(spark, str(tmp_path / "e.csv"))
    assert got.columns == ["report_id", "hazard_type", "note_free"]
    assert sorted(tuple(r) for r in got.collect()) == [("1", "dooring", 'a, "b"\nc'), ("2", "debris", "")]
    (tmp_path / "bad.csv").write_text("a,A \n1,2\n")
    with pytest.raises(ValueError):
        readers.evidence_csv(spark, str(tmp_path / "bad.csv"))
    files = {"l.json": '[{"Hazard Type": "x", "n": 1}]', "r.json": '{"reports": [{"a-b": "y"}]}',
             "f.json": '{"features": [{"geometry": {"type": "Point", "coordinates": [1.5, 2]}, "properties": {"Kind": "k"}}, {"geometry": null, "properties": null}]}'}
    for n, t in files.items():
        (tmp_path / n).write_text(t)
    read = lambda n: [r.record for r in readers.evidence_json(spark, str(tmp_path / n)).collect()]
    assert read("l.json") == [{"hazard_type": "x", "n": "1"}] and read("r.json") == [{"a_b": "y"}]
    assert read("f.json") == [{"kind": "k", "longitude": "1.5", "latitude": "2.0"}, {"longitude": "", "latitude": ""}]
    good = 'version = 1\ncity = "C"\n[[sources]]\nid = "s"\nkind = "streets"\nname = "S"\nlicense = "l"\nupdated_at = "2024-01-01"\ngeography = "g"\n'
    (tmp_path / "r.toml").write_text(good)
    assert [tuple(r) for r in readers.source_registry(spark, str(tmp_path / "r.toml")).collect()] == [("s", "streets", "S", "l", "2024-01-01", "g", "open", 365, False)]
    (tmp_path / "w.toml").write_text(good.replace("version = 1", "version = 2") + '[[sources]]\nid = "s"\nkind = "magic"\naccess = "secret"\n')
    with pytest.raises(ValueError, match="version must be 1; id 's' is empty or repeated; s: name is missing; s: license is missing; s: updated_at is missing; s: geography is missing; s: kind 'magic' is not known; s: access 'secret' is not known"):
        readers.source_registry(spark, str(tmp_path / "w.toml"))


def test_joined_records_fail_as_a_whole(spark):
    from tallygrid.operators import lineage

    o = spark.createDataFrame([(1, 2020, 6), (2, 2020, 7)], "case_id long, year long, state long")
    s = spark.createDataFrame([(1, 3), (2, 4)], "case_id long, people long")
    j = spark.createDataFrame([(1, 6, "001"), (2, 7, "003")], "case_id long, state long, county string")
    assert {(r.case_id, r.outcome.state, r.summary.people, r.jurisdiction.county) for r in lineage.joined_records(o, s, j, "case_id", 2020).collect()} == {(1, 6, 3, "001"), (2, 7, 4, "003")}
    for bad, message in (((o, s.where("case_id = 1"), j, "case_id", 2020), "exactly once"), ((o, s.union(s), j, "case_id", 2020), "exactly once"), ((o, s, j, "case_id", 2021), "another year"), ((o, s, j.withColumn("state", F.lit(6)), "case_id", 2020), "two states")):
        with pytest.raises(ValueError, match=message):
            lineage.joined_records(*bad)


def test_submissions_as_one_chain(spark):
    schema = "report_id string, occurred_at string, lat double, lon double, mode string, hazard_type string, severity string, accuracy_m double, address string, note string"
    row = lambda i, note=None, lat=38.5: (i, "2024-01-01T10:00:00Z", lat, -121.5, "cyclist", "dooring", "minor", 5.0, None, note)
    queue = spark.createDataFrame([(*row("q"), "pending"), (*row("r", lat=38.7), "rejected")], schema + ", status string")
    gone = governance.record_tombstones(queue.where("false").select(F.lit("").alias("hash")), spark.createDataFrame([("old",)], "report_id string"))
    batch = spark.createDataFrame([row("a", "call 555-123-4567"), row("b", lat=38.6), row("c", lat=38.7)], schema)
    assert {r.report_id: (r.status, r.flags) for r in governance.submit(batch, queue, gone).collect()} == {"a": ("pending", ["possible_phone_in_note", "possible_duplicate"]), "b": ("pending", []), "c": ("pending", [])}
    for wrong, message in ((row("old"), "deleted"), (row("x", lat=91.0), "invalid")):
        with pytest.raises(ValueError, match=message):
            governance.submit(spark.createDataFrame([row("a"), wrong], schema), queue, gone)


def test_counties_add_up(spark):
    rows = [(1, "001", "a", 1), (1, "999", "a", 2), (1, "001", "b", 1), (2, "000", "a", 3), (1, "003", "a", 4), (1, "001", "a", 1)]
    cells = crash.county_cells(spark.createDataFrame(rows, "state long, county string, mode string, key long"), "state", "county", "mode", "key")
    assert {tuple(r) for r in cells.where("mode = 'a'").collect()} == {("county", 1, "001", "a", 1), ("county", 1, "003", "a", 1), ("sentinel", 1, "unknown", "a", 1), ("sentinel", 2, "not_applicable", "a", 1), ("total", 1, None, "a", 3), ("total", 2, None, "a", 1)}
    assert crash.unreconciled(cells).collect() == []
    assert [tuple(r) for r in crash.unreconciled(cells.where("cell is distinct from '003'")).collect()] == [(1, "a", 2, 3)]
    with pytest.raises(ValueError, match="without a crosswalk"):
        crash.project_counties(cells, spark.createDataFrame([(1, "001", "g")], "state long, cell string, geoid string"))


def test_pinned_files_and_ingestion(tmp_path):
    from tallygrid.operators import lineage

    path = str(tmp_path / "p.json")
    lineage.write_pinned(path, {"b": 1, "a": [2]})
    assert lineage.read_pinned(path) == {"a": [2], "b": 1}
    (tmp_path / "p.json").write_text("{}")
    with pytest.raises(ValueError):
        lineage.read_pinned(path)
    root, calls = str(tmp_path / "store"), []

    def normalize(raw):
        calls.append(raw)
        if raw == b"bad":
            raise ValueError
        return raw.upper()

    first = lineage.ingest_once(root, b"abc", normalize)
    assert lineage.ingest_once(root, b"abc", normalize) == first and calls == [b"abc"]
    with pytest.raises(ValueError):
        lineage.ingest_once(root, b"bad", normalize)
    assert lineage.replay(root, normalize) == [] and lineage.replay(root, lambda raw: raw) == [first["raw"]]
