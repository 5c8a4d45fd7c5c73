"""Table functions for SQL: lines cut into points, and ways cut at the nodes that they share.

    register(spark)
    SELECT * FROM densify_lines(TABLE(streets), 50.0, 38.5, -121.7)
    SELECT * FROM split_ways(TABLE(SELECT way_id, i, lat, lon, shared FROM nodes))
    SELECT * FROM split_way_batches(TABLE(nodes) PARTITION BY pmod(xxhash64(way_id), 4096) ORDER BY (way_id, i))
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from ..functions.geo import METRES_PER_LAT, Plane

_POINT = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])


def _columns(table: AnalyzeArgument, *needed: str) -> StructType:
    if not table.isTable:
        raise ValueError("the first argument must be a table")
    names = [f.name for f in table.dataType.fields]
    if missing := [c for c in needed if c not in names]:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    return table.dataType


class DensifyLines:
    """Each row of a table with `coords` (array<struct<lat, lon>>) to the points of its line in the plane: its vertices, and along
    each edge a point after each whole step. Other columns come along; place counts from 0. Null or empty lines have no points."""

    @staticmethod
    def analyze(table: AnalyzeArgument, step: AnalyzeArgument, lat0: AnalyzeArgument, lon0: AnalyzeArgument) -> AnalyzeResult:
        own = _columns(table, "coords")
        if step.value is None or not float(step.value) > 0:
            raise ValueError("the step must be above 0")
        more = [StructField("place", IntegerType()), StructField("x", DoubleType()), StructField("y", DoubleType())]
        taken = {f.name for f in more}
        return AnalyzeResult(StructType([f for f in own.fields if f.name != "coords" and f.name not in taken] + more))

    def eval(self, row, step, lat0: float, lon0: float) -> Iterator[tuple]:
        plane, step = Plane(float(lat0), float(lon0)), float(step)
        said = row.asDict()
        kept = [v for k, v in said.items() if k not in ("coords", "place", "x", "y")]
        points = [((p["lon"] - plane.lon0) * plane.per_lon, (p["lat"] - plane.lat0) * METRES_PER_LAT) for p in said["coords"] or ()]
        place = 0
        for i, (x, y) in enumerate(points):
            if i:
                ax, ay = points[i - 1]
                length = math.sqrt((x - ax) * (x - ax) + (y - ay) * (y - ay))
                for k in range(1, int(math.floor(length / step)) + 1):
                    yield (*kept, place, ax + (x - ax) * (k * step / length), ay + (y - ay) * (k * step / length))
                    place += 1
            yield (*kept, place, x, y)
            place += 1


class SplitWays:
    """Nodes of ways (way_id, i, lat, lon, shared) to the pieces between shared nodes and ends: way_id, piece, coords. The function
    asks for the rows of a way together and in order, so the query need not say so; it holds one way's piece at a time."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        own = _columns(table, "way_id", "i", "lat", "lon", "shared")
        way = next(f for f in own.fields if f.name == "way_id")
        return AnalyzeResult(
            StructType([way, StructField("piece", IntegerType()), StructField("coords", ArrayType(_POINT))]), partitionBy=[PartitioningColumn("way_id")], orderBy=[OrderingColumn("i")]
        )

    def __init__(self):
        self._way, self._piece, self._held = None, 0, []

    def eval(self, row) -> Iterator[tuple]:
        self._way = row["way_id"]
        point = {"lat": row["lat"], "lon": row["lon"]}
        self._held.append(point)
        if row["shared"] and len(self._held) > 1:
            yield self._way, self._piece, self._held
            self._piece, self._held = self._piece + 1, [point]

    def terminate(self) -> Iterator[tuple]:
        if len(self._held) > 1:
            yield self._way, self._piece, self._held


class SplitWayBatches:
    """`split_ways` for ways of long ids, a batch of rows at a time. Such a function cannot ask for an order itself, so the query says it:
    all nodes of a way in one partition, of many ways, by way and in order. It holds on to the last unfinished piece only."""

    def __init__(self):
        #: Rows of the unfinished piece, and how many pieces its way has before it.
        self._held, self._piece = [], 0

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        if not batch.num_rows:
            return
        rows = pa.table({c: batch.column(c).cast(pa.float64()) if c in ("lat", "lon") else batch.column(c) for c in ("way_id", "lat", "lon", "shared")})
        if self._held and not rows.column("shared").to_numpy().astype(bool).any():
            ways = pa.chunked_array([self._held[0].column("way_id").chunk(0).slice(0, 1), *rows.column("way_id").chunks])
            if len(ways.unique()) == 1:
                self._held.append(rows)
                return
        yield from self._cut(False, rows)

    def terminate(self) -> Iterator[pa.Table]:
        if self._held:
            yield from self._cut(True)

    def _cut(self, end: bool, *more: pa.Table) -> Iterator[pa.Table]:
        rows = pa.concat_tables([*self._held, *more]).combine_chunks()
        n = rows.num_rows
        ways = rows.column("way_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.append(True, ways[1:] != ways[:-1])
        cut = first | np.append(first[1:], end) | rows.column("shared").fill_null(False).to_numpy()
        at = np.flatnonzero(cut)
        inside = ~first[at[1:]]
        a, b = at[:-1][inside], at[1:][inside]
        # Pieces before this one in its way; the first way goes on from what was held.
        started = np.maximum.accumulate(np.where(first, np.arange(n), 0))[a]
        piece = np.arange(len(a)) - np.searchsorted(started, started) + np.where(started == 0, self._piece, 0)
        lengths = b - a + 1
        offsets = np.append(0, np.cumsum(lengths))
        index = pa.array(np.repeat(a - offsets[:-1], lengths) + np.arange(offsets[-1]))
        told = None
        if len(a):
            points = pa.StructArray.from_arrays([rows.column(c).combine_chunks().take(index) for c in ("lat", "lon")], ["lat", "lon"])
            coords = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), points)
            told = pa.table({"way_id": rows.column("way_id").take(pa.array(a)), "piece": pa.array(piece, pa.int32()), "coords": coords})
        if not end:
            # The piece of the last way that may go on.
            self._piece = int(piece[-1]) + 1 if len(a) and ways[a[-1]] == ways[-1] else 0 if first[1:].any() else self._piece
            self._held = [rows.slice(at[-1])]
        if told is not None:
            yield told


def register(spark: SparkSession) -> None:
    """Make the functions known to a session's SQL."""
    from pyspark.sql.functions import arrow_udtf, udtf

    spark.udtf.register("densify_lines", udtf(DensifyLines))
    spark.udtf.register("split_ways", udtf(SplitWays))
    spark.udtf.register("split_way_batches", arrow_udtf(SplitWayBatches, returnType="way_id bigint, piece int, coords array<struct<lat: double, lon: double>>"))
