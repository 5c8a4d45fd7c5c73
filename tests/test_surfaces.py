"""Density from bins against the exact form."""

import pytest
from pyspark.sql import functions as F

from tallygrid.functions.geo import Plane
from tallygrid.operators import surfaces

PLANE = Plane(38.5, -121.7)


@pytest.mark.parametrize("bandwidth, grid, per", [(150.0, 24, 8), (150.0, 10, 3), (40.0, 7, 8), (900.0, 12, 16)])
def test_binned_density_lies_within_its_bound(spark, bandwidth, grid, per):
    points = spark.range(600).select((38.5 + (F.rand(1) - 0.5) * 0.02 * F.rand(2)).alias("lat"), (-121.7 + (F.rand(3) - 0.5) * 0.03 * F.rand(4)).alias("lon")).cache()
    want = {r.pos: r for r in surfaces.kde_surface(points, PLANE, bandwidth, grid).collect()}
    got = surfaces.kde_binned(points, PLANE, bandwidth, grid, per)
    rows = {r.pos: r for r in got.collect()}
    assert rows.keys() == want.keys() and len(rows) == grid * grid
    for i, r in rows.items():
        assert abs(r.intensity - want[i].intensity) <= r.bound + 1e-9
        assert (r.row, r.col) == (want[i].row, want[i].col) and r.lat == pytest.approx(want[i].lat) and r.lon == pytest.approx(want[i].lon)
    peak = max(want, key=lambda i: (want[i].intensity, -i))
    assert surfaces.kde_peak(got).first().pos == peak
    if per >= 8:
        # The error itself is far smaller than the bound: bins are small against the bandwidth.
        assert max(abs(rows[i].intensity - want[i].intensity) for i in rows) < 0.02 * want[peak].intensity


def test_one_place_and_none(spark):
    one = spark.createDataFrame([(38.5, -121.7)] * 5, "lat double, lon double")
    assert {round(r.intensity, 9) for r in surfaces.kde_binned(one, PLANE, 150.0, 4).collect()} == {5.0} == {round(r.intensity, 9) for r in surfaces.kde_surface(one, PLANE, 150.0, 4).collect()}
    assert surfaces.kde_binned(one.where("false"), PLANE).collect() == []
