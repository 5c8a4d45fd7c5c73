"""Snapping by a packed spatial index: pages of edges in order of a Hilbert curve, joined by their boxes.

Edges are cut into short pieces, put in order of the curve's place of their middle, and dealt out in pages of a fixed number; so
a page's box is small and no row holds all edges of a neighbourhood. A point looks up the pages whose boxes reach its cell. The
farthest corner of any box bounds how far the nearest edge can be, so only pages that begin nearer than the least such
bound are opened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .ranks import numbered
from .shared import bounded_broadcast, kept

#: Pieces of edges on a page, metres of a piece at the most, and bits of the curve on each axis.
PAGE, PIECE_M, BITS = 64, 200.0, 16


def hilbert(x: np.ndarray, y: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of whole coordinates from 0 to 2^bits - 1."""
    x, y, out = x.astype(np.int64).copy(), y.astype(np.int64).copy(), np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        side = 1 << level
        right, up = (x & side) > 0, (y & side) > 0
        out += side * side * ((3 * right) ^ up)
        # Turn the quarter so that its curve begins and ends like the whole one.
        flip = ~up & right
        x[flip], y[flip] = side - 1 - (x[flip] & (side - 1)), side - 1 - (y[flip] & (side - 1))
        swap = ~up
        x[swap], y[swap] = y[swap].copy(), x[swap].copy()
        x, y = x & (side - 1), y & (side - 1)
    return out


def packed_pages(segments: DataFrame, plane: geo.Plane, per_page: int = PAGE) -> DataFrame:
    """page, x0, y0, x1, y1 (its box), edges array<struct<segment_id, ax, ay, dx, dy, l2>> of segments (segment_id, coords).

    One row of numbers, the box of all, comes to the driver. Edges without length count as points.
    """
    e = F.col("e")
    ends = segments.select("segment_id", F.explode(geo.edges(F.col("coords"))).alias("e")).select(
        "segment_id", plane.x(e["a"]["lon"]).alias("ax"), plane.y(e["a"]["lat"]).alias("ay"), plane.x(e["b"]["lon"]).alias("bx"), plane.y(e["b"]["lat"]).alias("b_y")
    )
    dx, dy = F.col("bx") - F.col("ax"), F.col("b_y") - F.col("ay")
    edges = ends.select("segment_id", "ax", "ay", dx.alias("dx"), dy.alias("dy"), (dx * dx + dy * dy).alias("l2"))
    parts = F.greatest(F.lit(1), F.ceil(F.sqrt("l2") / PIECE_M)).cast("int")
    pieces = edges.withColumn("m", parts).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    at = lambda a, d, k: F.col(a) + F.col(d) * (k / F.col("m"))
    k = F.col("k")
    x, y, u, v = at("ax", "dx", k), at("ay", "dy", k), at("ax", "dx", k + 1), at("ay", "dy", k + 1)
    pieces = kept(pieces.withColumns({"x0": F.least(x, u), "x1": F.greatest(x, u), "y0": F.least(y, v), "y1": F.greatest(y, v)}))
    low_x, low_y, high_x, high_y = pieces.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first()
    scale = ((1 << BITS) - 1) / max(1e-9, (high_x or 0) - (low_x or 0), (high_y or 0) - (low_y or 0))

    def placed(batches):
        for batch in batches:
            mid = lambda a, b, low: ((batch.column(a).to_numpy() + batch.column(b).to_numpy()) / 2 - low) * scale
            h = hilbert(mid("x0", "x1", low_x), mid("y0", "y1", low_y))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h)], names=[*batch.schema.names, "h"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", h long"
    ordered = numbered(pieces.mapInArrow(placed, schema), ["h", "segment_id", "ax", "ay", "k"], "place")
    box = {c: (F.min if c.endswith("0") else F.max)(c).alias(c) for c in ("x0", "y0", "x1", "y1")}
    rows = ordered.groupBy(F.floor(F.col("place") / per_page).alias("page")).agg(*box.values(), F.collect_set(F.struct("segment_id", "ax", "ay", "dx", "dy", "l2")).alias("edges"))
    return kept(rows)


def _square(x: Column, y: Column, e: Column) -> Column:
    t = F.when(e["l2"] == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["ax"]) * e["dx"] + (y - e["ay"]) * e["dy"]) / e["l2"])))
    u, v = x - (e["ax"] + t * e["dx"]), y - (e["ay"] + t * e["dy"])
    return u * u + v * v


def nearest_in_pages(points: DataFrame, pages: DataFrame, radius: float) -> DataFrame:
    """(pid, best struct<d, segment_id>) of points (pid, x, y) that have a segment within the radius; of equal distances the least id."""
    spread = lambda a, b: F.sequence(F.floor((F.col(a) - radius) / radius), F.floor((F.col(b) + radius) / radius))
    boxes = pages.select("page", "x0", "y0", "x1", "y1", F.explode(spread("x0", "x1")).alias("cx")).select("*", F.explode(spread("y0", "y1")).alias("cy"))
    keyed = points.select("pid", "x", "y", geo.cell(F.col("x"), radius).alias("cx"), geo.cell(F.col("y"), radius).alias("cy"))
    away = lambda p, a, b: F.greatest(F.lit(0.0), F.col(a) - F.col(p), F.col(p) - F.col(b))
    beyond = lambda p, a, b: F.greatest(F.abs(F.col(p) - F.col(a)), F.abs(F.col(p) - F.col(b)))
    both = lambda f: F.sqrt(f("x", "x0", "x1") * f("x", "x0", "x1") + f("y", "y0", "y1") * f("y", "y0", "y1"))
    met = keyed.join(bounded_broadcast(boxes), ["cx", "cy"]).select("pid", "x", "y", "page", both(away).alias("least"), both(beyond).alias("most")).where(F.col("least") <= radius)
    asked = met.groupBy("pid").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.min("most").alias("bound"), F.collect_list(F.struct("least", "page")).alias("p"))
    # A little more than the bound, as the box and the edge are worked out along different ways.
    opened = asked.select("pid", "x", "y", F.explode(F.filter("p", lambda p: p["least"] <= F.col("bound") + 1e-6)).alias("p")).select("pid", "x", "y", "p.page")
    found = opened.join(bounded_broadcast(pages.select("page", "edges")), "page")
    x, y = F.col("x"), F.col("y")
    best = F.array_min(F.transform("edges", lambda e: F.struct(F.sqrt(_square(x, y, e)).alias("d"), e["segment_id"].alias("segment_id"))))
    return found.select("pid", best.alias("best")).groupBy("pid").agg(F.min("best").alias("best")).where(F.col("best.d") <= radius)


def snap_packed(points: DataFrame, segments: DataFrame, plane: geo.Plane, snap_max: float = 25.0, per_page: int = PAGE) -> DataFrame:
    """Points with segment_id of the nearest segment if within `snap_max`, and snapped_distance_m, as `spatial.snap_nearest` gives them.

    Looks within 4 snap_max first, and further only for points that find none there. Rows keep all their columns; points without a
    place are not snapped.
    """
    close, wide = 4 * snap_max, max(1000.0, 4 * snap_max)
    pages = packed_pages(segments, plane, per_page)
    rows = kept(points.withColumn("__pid", F.monotonically_increasing_id()))
    at = rows.where("lat is not null and lon is not null").select(F.col("__pid").alias("pid"), plane.x(F.col("lon")).alias("x"), plane.y(F.col("lat")).alias("y"))
    first = kept(nearest_in_pages(at, pages, close))
    rest = nearest_in_pages(at.join(first, "pid", "left_anti"), pages, wide)
    found = first.unionByName(rest).select(F.col("pid").alias("__pid"), "best")
    best = F.col("best")
    return rows.join(found, "__pid", "left").withColumns({"segment_id": F.when(best["d"] <= snap_max, best["segment_id"]), "snapped_distance_m": best["d"]}).drop("best", "__pid")
