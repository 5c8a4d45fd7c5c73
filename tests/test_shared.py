from pyspark.sql import functions as F

from tallygrid.functions.geo import Plane
from tallygrid.operators import shared, spatial


def test_bounds_of_rows_and_bytes(spark):
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert shared.is_small(rows, 100, 1 << 20) and not shared.is_small(rows, 99, 1 << 20) and not shared.is_small(rows, 100, 50_000)


def test_crowded_cell_is_not_broadcast(spark):
    """One cell of 5,000 segments: few rows, many bytes."""
    plane = Plane(38.5, -121.7)
    at = F.lit(38.5) + F.col("id") * 1e-8
    segments = spark.range(5000).select(
        F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("segment_id"),
        F.array(F.struct(at.alias("lat"), F.lit(-121.7).alias("lon")), F.struct(at.alias("lat"), F.lit(-121.6999).alias("lon"))).alias("coords"),
    )
    cells = shared.kept(spatial.segment_cells(segments, plane, 35.0, 100.0))
    assert cells.count() < 30 and not shared.is_small(cells, bytes_=4 << 20)
    points = spark.range(50).select("id", (F.lit(38.5) + F.col("id") * 1e-6).alias("lat"), F.lit(-121.69995).alias("lon"))
    found = spatial.snap_nearest(points, segments, plane, 25.0).orderBy("id").collect()
    assert [r.segment_id for r in found][:3] == ["s00000", "s00100", "s00200"]


def test_what_is_kept_has_no_lineage(spark):
    frame = shared.kept(spark.range(10).withColumn("x", F.col("id") + 1).groupBy("x").count())
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
