"""The packed index against the cell table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.functions.geo import Plane
from tallygrid.operators import packed, spatial

PLANE = Plane(38.5, -121.7)


def test_curve_visits_neighbours():
    n = 16
    x, y = np.meshgrid(np.arange(n), np.arange(n))
    h = packed.hilbert(x.ravel(), y.ravel(), 4)
    assert sorted(h.tolist()) == list(range(n * n))
    order = np.argsort(h)
    steps = np.abs(np.diff(x.ravel()[order])) + np.abs(np.diff(y.ravel()[order]))
    assert (steps == 1).all()


def city(spark, n, size=0.02, long=0.003):
    point = lambda seed, side: F.struct((38.5 + (F.rand(seed) - 0.5) * side).alias("lat"), (-121.7 + (F.rand(seed + 1) - 0.5) * side).alias("lon"))
    base = spark.range(n).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("segment_id"), point(1, size).alias("p"), point(3, long).alias("q"), point(5, long).alias("r"))
    move = lambda c: F.struct((F.col("p.lat") + F.col(f"{c}.lat") - 38.5).alias("lat"), (F.col("p.lon") + F.col(f"{c}.lon") + 121.7).alias("lon"))
    return base.select("segment_id", F.when(F.rand(7) < 0.05, F.array("p", "p")).otherwise(F.array(F.col("p"), move("q"), move("r"))).alias("coords")).cache()


@pytest.mark.parametrize("n, per_page", [(1, 64), (300, 8), (300, 64)])
def test_equals_the_cell_table(spark, n, per_page):
    segments = city(spark, n)
    points = spark.range(400).select("id", (38.5 + (F.rand(11) - 0.5) * 0.05).alias("lat"), (-121.7 + (F.rand(12) - 0.5) * 0.05).alias("lon"), F.lit("k").alias("kind")).cache()
    want = {r.id: (r.segment_id, r.snapped_distance_m) for r in spatial.snap_nearest(points, segments, PLANE, 60.0).collect()}
    got = packed.snap_packed(points, segments, PLANE, 60.0, per_page)
    assert got.columns == ["id", "lat", "lon", "kind", "segment_id", "snapped_distance_m"]
    rows = {r.id: (r.segment_id, r.snapped_distance_m) for r in got.collect()}
    assert rows.keys() == want.keys()
    for i, (segment, d) in rows.items():
        assert segment == want[i][0] and d == (None if want[i][1] is None else pytest.approx(want[i][1], abs=1e-9))
    assert n == 1 or (any(s for s, _ in rows.values()) and any(s is None and d for s, d in rows.values()))


def test_pages_are_small_and_whole(spark):
    segments = city(spark, 500, long=0.02)
    pages = packed.packed_pages(segments, PLANE, 16).collect()
    assert max(len(p.edges) for p in pages) <= 16
    assert {e.segment_id for p in pages for e in p.edges} == {r.segment_id for r in segments.where("size(coords) > 1").collect()}
    # Neighbours on the curve lie near each other: boxes cover far less than the city each.
    assert np.median([(p.x1 - p.x0) * (p.y1 - p.y0) for p in pages]) < 0.1 * 2200 * 2200


def test_many_segments_go_through_pages(spark, monkeypatch):
    segments = city(spark, 40)
    points = spark.createDataFrame([(1, 38.5, -121.7), (2, None, None)], "id int, lat double, lon double")
    want = spatial.snap_nearest(points.where("id = 1"), segments, PLANE, 200.0).first()
    monkeypatch.setattr(spatial, "FEW_SEGMENTS", 10)
    got = {r.id: r for r in spatial.snap_nearest(points, segments, PLANE, 200.0).collect()}
    assert (got[1].segment_id, got[1].snapped_distance_m) == (want.segment_id, pytest.approx(want.snapped_distance_m)) and got[2].segment_id is None
    assert packed.snap_packed(points, segments.where("false"), PLANE).count() == 2
