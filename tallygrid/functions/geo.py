"""Plane and spherical geometry on columns. Positions are degrees, distances metres."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRES_PER_LON = 111_320.0
METRES_PER_LAT = 110_540.0
EARTH_M = 6_371_000.0
METRES_PER_DEGREE = EARTH_M * math.pi / 180
#: The longest edge that is cut into equal parts, in metres.
LONGEST_EDGE_M = 100_000.0


@dataclass(frozen=True)
class Plane:
    """Local equirectangular projection around a reference point."""

    lat0: float
    lon0: float

    @property
    def per_lon(self) -> float:
        return METRES_PER_LON * math.cos(math.radians(self.lat0))

    def x(self, lon: Column) -> Column:
        return (lon - self.lon0) * self.per_lon

    def y(self, lat: Column) -> Column:
        return (lat - self.lat0) * METRES_PER_LAT


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = F.sin(F.radians(lat2 - lat1) / 2)
    b = F.sin(F.radians(lon2 - lon1) / 2)
    h = a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def haversine_plain(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """The same of plain numbers, for steps within a group."""
    a, b = math.sin(math.radians(lat2 - lat1) / 2), math.sin(math.radians(lon2 - lon1) / 2)
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(a * a + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * b * b)))


def reference_point(points: DataFrame, lat0: float | None = None, lon0: float | None = None) -> Plane:
    """The plane about a given position, else about the mean of points (lat, lon); one row comes to the driver."""
    if lat0 is not None and lon0 is not None:
        return Plane(lat0, lon0)
    mean = points.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).first()
    if mean.lat is None or mean.lon is None:
        raise ValueError("no point to project about")
    return Plane(mean.lat, mean.lon)


def margin(radius: float) -> float:
    """What a projected search radius gains so that no true neighbour is missed."""
    return 0.10 * radius + 5.0


def cell(metres: Column, size: float) -> Column:
    return F.floor(metres / size)


def point_edge(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance from a point to a straight edge; to its one point if the edge has no length."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, 0.0).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length2))
    )
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def edges(coords: Column) -> Column:
    """Consecutive vertex pairs of an array<struct<lat, lon>>."""
    n = F.size(coords)
    at = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.element_at(coords, i).alias("a"), F.element_at(coords, i + 1).alias("b")))


def polyline_length(coords: Column) -> Column:
    return F.aggregate(
        edges(coords),
        F.lit(0.0),
        lambda s, e: s + haversine(e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"]),
    )


def polyline_centroid(coords: Column) -> Column:
    """Mean of edge midpoints weighted by length; the first vertex of a line without length."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))

    def add(s: Column, e: Column) -> Column:
        w = haversine(e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"])
        return F.struct(
            (s["w"] + w).alias("w"),
            (s["lat"] + w * (e["a"]["lat"] + e["b"]["lat"]) / 2).alias("lat"),
            (s["lon"] + w * (e["a"]["lon"] + e["b"]["lon"]) / 2).alias("lon"),
        )

    total = F.aggregate(edges(coords), zero, add)
    first = F.element_at(coords, 1)
    return F.struct(
        F.when(total["w"] > 0, total["lat"] / total["w"]).otherwise(first["lat"]).alias("lat"),
        F.when(total["w"] > 0, total["lon"] / total["w"]).otherwise(first["lon"]).alias("lon"),
    )


def point_polyline(px: Column, py: Column, coords: Column, plane: Plane) -> Column:
    """Distance in the plane from a point to the nearest edge of a line."""
    return F.array_min(
        F.transform(
            edges(coords),
            lambda e: point_edge(
                px, py, plane.x(e["a"]["lon"]), plane.y(e["a"]["lat"]), plane.x(e["b"]["lon"]), plane.y(e["b"]["lat"])
            ),
        )
    )


def samples(coords: Column, step: float, longest: float | None = None) -> Column:
    """Points along a line: both ends of every edge, and points between that cut it into equal parts of `step` metres at the most.

    An edge longer than `longest` fails, if that is given.
    """

    def along(e: Column) -> Column:
        d = haversine(e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"])
        n = F.greatest(F.lit(1), F.ceil(d / step).cast("int"))
        if longest is not None:
            n = F.when(d > longest, F.raise_error(F.lit(f"an edge is longer than {longest} m")).cast("int")).otherwise(n)
        return F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.struct(
                (e["a"]["lat"] + (e["b"]["lat"] - e["a"]["lat"]) * i / n).alias("lat"),
                (e["a"]["lon"] + (e["b"]["lon"] - e["a"]["lon"]) * i / n).alias("lon"),
            ),
        )

    return F.flatten(F.transform(edges(coords), along))


def densify(coords: Column, plane: Plane, step: float) -> Column:
    """Points (x, y) of a line in the plane: its vertices, and along each edge a point after each whole `step`."""
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def along(e: Column) -> Column:
        ax, ay, bx, by = plane.x(e["a"]["lon"]), plane.y(e["a"]["lat"]), plane.x(e["b"]["lon"]), plane.y(e["b"]["lat"])
        length = F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
        steps = F.floor(length / step).cast("int")
        between = F.when(steps > 0, F.transform(F.sequence(F.lit(1), steps), lambda k: point(ax + (bx - ax) * (k * step / length), ay + (by - ay) * (k * step / length))))
        return F.concat(F.coalesce(between, F.array().cast("array<struct<x:double,y:double>>")), F.array(point(bx, by)))

    first = F.element_at(coords, 1)
    return F.concat(F.array(point(plane.x(first["lon"]), plane.y(first["lat"]))), F.flatten(F.transform(edges(coords), along)))
