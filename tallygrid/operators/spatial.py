"""Joins by distance: bucketed equi-joins of cells, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .shared import bounded_broadcast, kept  # noqa: F401  others take them from here

#: Segments whose cells, each with all edges near it, are kept as a table; more are packed in pages.
FEW_SEGMENTS = 20_000


def _around(cx: Column, cy: Column, reach: int = 1) -> Column:
    steps = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]
    return F.array(*(F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i, j in steps))


def segment_cells(segments: DataFrame, plane: geo.Plane, size: float, step: float = 200.0) -> DataFrame:
    """Per cell, the segments within reach of a point in it: (cx, cy, near array<struct<segment_id, edges>>).

    Edges are in the plane: where they begin, how far they go, and the square of their length.
    """

    def edge(e: Column) -> Column:
        ax, ay = plane.x(e["a"]["lon"]), plane.y(e["a"]["lat"])
        dx, dy = plane.x(e["b"]["lon"]) - ax, plane.y(e["b"]["lat"]) - ay
        return F.struct(ax.alias("ax"), ay.alias("ay"), dx.alias("dx"), dy.alias("dy"), (dx * dx + dy * dy).alias("l2"))

    points = segments.select("segment_id", F.explode(geo.samples(F.col("coords"), step)).alias("p"))
    cells = points.select("segment_id", geo.cell(plane.x(F.col("p.lon")), size).alias("x"), geo.cell(plane.y(F.col("p.lat")), size).alias("y")).distinct()
    # Ids and cells only are spread and made different; the edges join last.
    spread = cells.select("segment_id", F.explode(_around(F.col("x"), F.col("y"))).alias("c")).select("segment_id", "c.cx", "c.cy").distinct()
    edges = segments.select("segment_id", F.transform(geo.edges(F.col("coords")), edge).alias("edges"))
    return spread.join(edges, "segment_id").groupBy("cx", "cy").agg(F.collect_list(F.struct("segment_id", "edges")).alias("near"))


def _far(s: Column) -> Column:
    """Distance in the plane from the point (__x, __y) to the nearest edge of a candidate."""

    def square(e: Column) -> Column:
        t = F.when(e["l2"] == 0, 0.0).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("__x") - e["ax"]) * e["dx"] + (F.col("__y") - e["ay"]) * e["dy"]) / e["l2"]))
        )
        x, y = F.col("__x") - (e["ax"] + t * e["dx"]), F.col("__y") - (e["ay"] + t * e["dy"])
        return x * x + y * y

    return F.sqrt(F.array_min(F.transform(s["edges"], square)))


def _look_up(points: DataFrame, segments: DataFrame, plane: geo.Plane, radius: float, step: float, pick, only: Column | None = None) -> DataFrame:
    """Points (with __x, __y) with `found`: what `pick` makes of the array<struct<d, segment_id>> of segments near them.

    A cell knows all segments within the radius of any of its points, so each point looks up the
    one cell that it lies in, and nothing is spread or shuffled. Points for which `only` is
    false look nothing up. The explosion of one element keeps what is found from being worked
    out again by each use.
    """
    size = radius + geo.margin(radius) + step / 2
    cells = bounded_broadcast(segment_cells(segments, plane, size, step))
    cx, cy = geo.cell(F.col("__x"), size), geo.cell(F.col("__y"), size)
    keyed = points.withColumns({"cx": cx if only is None else F.when(only, cx), "cy": cy})
    near = F.transform("near", lambda s: F.struct(_far(s).alias("d"), s["segment_id"].alias("segment_id")))
    joined = keyed.join(cells, ["cx", "cy"], "left")
    return joined.withColumn("found", F.explode(F.array(pick(near)))).drop("near", "cx", "cy")


def _placed(points: DataFrame, plane: geo.Plane) -> DataFrame:
    return points.withColumns({"__x": plane.x(F.col("lon")), "__y": plane.y(F.col("lat"))})


def snap_nearest(points: DataFrame, segments: DataFrame, plane: geo.Plane, snap_max: float = 25.0) -> DataFrame:
    """Points with segment_id of the nearest segment if within `snap_max`, and the distance either way.

    Looks within 4 snap_max first, where few segments are, and only for points that find none
    there within max(1000, 4 snap_max) metres; of equal distances the least id. More segments than `FEW_SEGMENTS` are
    looked up through a packed index instead, to the same result.
    """
    segments = kept(segments)
    if segments.limit(FEW_SEGMENTS + 1).count() > FEW_SEGMENTS:
        from .packed import snap_packed

        return snap_packed(points, segments, plane, snap_max)
    close, wide = 4 * snap_max, max(1000.0, 4 * snap_max)
    first = _look_up(_placed(points, plane), segments, plane, close, 100.0, F.array_min).withColumnRenamed("found", "__first")
    settled = F.coalesce(F.col("__first.d") <= close, F.lit(False))
    second = _look_up(first, segments, plane, wide, 200.0, F.array_min, ~settled)
    best = F.when(settled, F.col("__first")).otherwise(F.col("found"))
    return second.withColumns(
        {
            "segment_id": F.when(best["d"] <= snap_max, best["segment_id"]),
            "snapped_distance_m": F.when(best["d"] <= wide, best["d"]),
        }
    ).drop("found", "__first", "__x", "__y")


def snap_unambiguous(points: DataFrame, segments: DataFrame, plane: geo.Plane, snap_max: float = 25.0, gap: float = 5.0) -> DataFrame:
    """Three-valued snapping: snapped, ambiguous (another within `gap` of the nearest), unsnapped.

    Competitors are all segments within the gap of the nearest, in order of id.
    """
    radius, tolerance = max(1000.0, 4 * snap_max), 1e-6
    pick = lambda near: F.array_sort(F.filter(near, lambda s: s["d"] <= radius))
    found = _look_up(_placed(points, plane), segments, plane, radius, 200.0, pick).drop("__x", "__y")
    best = F.get("found", F.lit(0))
    close = F.array_sort(F.transform(F.filter("found", lambda s: s["d"] - F.get("found", F.lit(0))["d"] <= gap + tolerance), lambda s: s["segment_id"]))
    within = F.coalesce(best["d"] <= snap_max + tolerance, F.lit(False))
    return found.withColumns(
        {
            "status": F.when(~within, "unsnapped").when(F.size(close) > 1, "ambiguous").otherwise("snapped"),
            "segment_id": F.when(within & (F.size(close) == 1), best["segment_id"]),
            "competitors": F.when(within & (F.size(close) > 1), close),
            "snapped_distance_m": best["d"],
        }
    ).drop("found")


def pairs_within(left: DataFrame, right: DataFrame, plane: geo.Plane, radius: float) -> DataFrame:
    """(a, b, d) for all rows a of left and b of right (each id, lat, lon) within `radius` metres.

    The right side is spread over its neighbour cells; the left is not. One crowded cell is
    split by adaptive execution, as both sides are shuffled on the cell.
    """
    size = max(1.0, radius + geo.margin(radius))
    cell = {"cx": geo.cell(plane.x(F.col("lon")), size), "cy": geo.cell(plane.y(F.col("lat")), size)}
    a = left.select(F.col("id").alias("a"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), "lat", "lon").withColumns(cell)
    b = right.select(F.col("id").alias("b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "lat", "lon").withColumns(cell)
    b = b.select("b", "lat2", "lon2", F.explode(_around(F.col("cx"), F.col("cy"))).alias("c")).select("b", "lat2", "lon2", "c.*")
    d = geo.haversine(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return a.drop("lat", "lon").join(b, ["cx", "cy"]).withColumn("d", d).where(F.col("d") <= radius).select("a", "b", "d")


def band_neighbors(units: DataFrame, plane: geo.Plane, band: float) -> DataFrame:
    """(a, b): other units within the band of each unit (id, lat, lon)."""
    return pairs_within(units, units, plane, band).where("a <> b").select("a", "b")


def geocode(reports: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Places of reports that have an address and lie at (0, 0), from (key, lat, lon); others stay."""
    from ..functions.text import address_key

    places = gazetteer.select(F.col("key").alias("__key"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    lost = (F.col("lat") == 0) & (F.col("lon") == 0) & F.col("address").isNotNull()
    joined = reports.withColumn("__k", F.when(lost, address_key(F.col("address")))).join(
        bounded_broadcast(places), F.col("__k") == F.col("__key"), "left"
    )
    return joined.withColumns({"lat": F.coalesce("__lat", "lat"), "lon": F.coalesce("__lon", "lon")}).drop("__k", "__key", "__lat", "__lon")


def bbox(west: float, south: float, east: float, north: float) -> Column:
    return F.col("lon").between(west, east) & F.col("lat").between(south, north)
