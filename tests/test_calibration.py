"""Permutations place by place, hot spots of dealt-out counts, and band sums without pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.functions.geo import Plane
from tallygrid.operators import calibration, hotspot, spatial

PLANE = Plane(38.5, -121.7)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 57, 64, 65, 1000, 4097])
def test_each_shuffle_is_a_permutation(n):
    for s in range(5):
        out = calibration.permuted(np.arange(n), n, 7, s)
        assert sorted(out.tolist()) == list(range(n))
        assert calibration.permuted(np.array([n - 1]), n, 7, s)[0] == out[-1]
    if n > 50:
        assert any((calibration.permuted(np.arange(n), n, 7, 0) != calibration.permuted(np.arange(n), n, x, y)).any() for x, y in ((7, 1), (8, 0)))


def test_places_are_dealt_out_evenly():
    n, rounds = 10, 3000
    seen = np.zeros((n, n))
    for s in range(rounds):
        seen[np.arange(n), calibration.permuted(np.arange(n), n, 1, s)] += 1
    # Each place goes everywhere about equally often: chi squared of 81 degrees of freedom.
    assert ((seen - rounds / n) ** 2 / (rounds / n)).sum() < 140


def test_false_positives_of_a_grid(spark):
    rows = [(f"u{i:02d}", 38.5 + i // 6 * 0.001, -121.7 + i % 6 * 0.001, (i * 7) % 13, 50.0 if i else None) for i in range(36)]
    units = spark.createDataFrame(rows, "id string, lat double, lon double, n long, exposure double")
    near = spatial.band_neighbors(units.where("exposure > 0").select("id", "lat", "lon"), PLANE, 150.0)
    got = {r.shuffle: r.false_positives for r in calibration.null_calibration(units, near, 12, 5, alpha=0.4).collect()}
    known = [r for r in rows if r[4]]
    pairs = {(r.a, r.b) for r in near.collect()} | {(r[0], r[0]) for r in known}
    from math import erfc, sqrt

    for s in range(12):
        at = calibration.permuted(np.arange(len(known)), len(known), 5, s)
        value = {r[0]: known[at[i]][3] * 1000 / r[4] for i, r in enumerate(known)}
        mean, sd, n = np.mean([*value.values()]), np.std([*value.values()]), len(value)
        z = {}
        for a in value:
            mine = [value[b] for x, b in pairs if x == a]
            w = len(mine)
            z[a] = (sum(mine) - mean * w) / (sd * sqrt((n * w - w * w) / (n - 1)))
        p = sorted(erfc(abs(x) / sqrt(2)) for x in z.values())
        last = max((i + 1 for i, x in enumerate(p) if x <= (i + 1) / n * 0.4), default=0)
        assert got[s] == sum(erfc(abs(x) / sqrt(2)) <= (p[last - 1] if last else -1) and x > 0 for x in z.values())
    assert len(set(got.values())) > 1


def test_no_units(spark):
    units = spark.createDataFrame([("a", 1, None)], "id string, n long, exposure double")
    got = calibration.null_calibration(units, spark.createDataFrame([], "a string, b string"), 3).collect()
    assert [tuple(r) for r in got] == [(0, 0), (1, 0), (2, 0)]


@pytest.mark.parametrize("spread, n", [(0.004, 400), (0.02, 300), (0.00002, 300)])
def test_band_sums_equal_the_pairs(spark, spread, n):
    rows = spark.range(n).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"), (38.5 + (F.rand(3) - 0.5) * spread).alias("lat"), (-121.7 + (F.rand(4) - 0.5) * spread).alias("lon"),
        F.when(F.col("id") % 17 != 0, F.rand(5)).alias("value"),
    ).cache()
    known = rows.where("value is not null")
    pairs = spatial.band_neighbors(known.select("id", "lat", "lon"), PLANE, 200.0)
    want = {r.id: r for r in hotspot.getis_ord_star(rows.select("id", "value"), pairs).collect()}
    got = {r.id: r for r in hotspot.getis_ord_band(rows, PLANE, 200.0).collect()}
    assert got.keys() == want.keys()
    assert all(got[i].neighbors == want[i].neighbors and got[i].z == pytest.approx(want[i].z, abs=1e-6) for i in want)


def test_a_crowd_in_one_place_makes_no_pairs(spark):
    rows = spark.range(3000).select("id", (38.5 + F.col("id") * 1e-9).alias("lat"), F.lit(-121.7).alias("lon"), F.lit(1.0).alias("value"))
    sums = hotspot.band_sums(rows, PLANE, 300.0)
    assert {(r.w, r.wx) for r in sums.collect()} == {(3000, 3000.0)}


def test_units_of_one_place_are_not_paired(spark):
    # 20,000 units at each of four places: one by one the rim would need more than a thousand million tests.
    n = 80_000
    units = spark.range(n).select("id", (38.5 + F.col("id") % 2 * 0.0026).alias("lat"), (-121.7 + F.floor(F.col("id") / 2) % 2 * 0.003).alias("lon"), F.lit(1.0).alias("value"))
    got = hotspot.band_sums(units, PLANE, 300.0).groupBy("w", "wx").count().collect()
    assert [tuple(r) for r in got] == [(3 * n // 4, 3.0 * n / 4, n)]
