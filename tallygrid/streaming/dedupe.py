"""Deduplication of a stream of reports, with the outcome of the batch operator.

Reports go to the tile of the plane that they lie in, and as guests to tiles that they lie near. Each
tile holds its reports until the watermark has passed their second, then settles them in order of time and id against
those that stay of the last time window. So a late report is settled as if it had come in time, unless it
comes behind the watermark; Spark drops it then.
"""

from __future__ import annotations

import pickle
import sys
import zlib
from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import geo
from ..functions.geo import METRES_PER_LAT, haversine_plain, margin
from ..shipping import carry

Held = namedtuple("Held", "report_id epoch lat lon token kind home edge")
Seen = namedtuple("Seen", "report_id epoch lat lon token kind stays sure")
SETTLED = "report_id string, epoch long, stays boolean, sure boolean"
#: Where Spark keeps the state of such operators.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Reports that are cut into blocks by time at once, and bytes of blocks that go to the state at once.
CHUNK, SENT = 200_000, 8 << 20


def pack(rows: list[tuple]) -> bytes:
    return zlib.compress(pickle.dumps([list(c) for c in zip(*rows)], 4), 1)


def unpack(data: bytes, kind) -> list:
    return [kind(*r) for r in zip(*pickle.loads(zlib.decompress(bytes(data))))]


def settle(waiting: list, seen: list, distance_m: float, window_s: int, twins: bool = True) -> list[Seen]:
    """Settle reports in order of time and id: (report_id, epoch, lat, lon, token, kind, stays, sure) for each.

    `seen` are those settled before, of the last window. A report goes if it repeats one that stays. It is not sure where it
    lies within reach of the outer edge of what the tile sees, or repeats one that isn't sure and none that surely stays. Without `twins` rows of one id and second do not repeat each other.
    """
    size = max(1.0, distance_m + margin(distance_m)) / METRES_PER_LAT
    step = max(1, window_s)
    # Only those that stay or are not sure decide on later ones. They are found by reporter or kind, and by cell of latitude and time.
    near: dict[tuple, list] = {}

    def places(r, y: int, t: int):
        if r.token:
            yield ("token", r.token, y, t)
        if r.kind is not None:
            yield ("told" if r.token else "plain", r.kind, y, t)

    def put(r) -> None:
        for place in places(r, int(r.lat // size), int(r.epoch // step)):
            near.setdefault(place, []).append(r)

    def asked(r):
        y, t = int(r.lat // size), int(r.epoch // step)
        for j in (t - 1, t):
            for i in (y - 1, y, y + 1):
                # Two reports with a token count by it alone, others by kind.
                if r.token:
                    yield from near.get(("token", r.token, i, j), ())
                if r.kind is not None:
                    yield from near.get(("plain", r.kind, i, j), ())
                    if not r.token:
                        yield from near.get(("told", r.kind, i, j), ())

    for r in seen:
        if r.stays or not r.sure:
            put(r)
    out = []
    for r in sorted(waiting, key=lambda r: (r.epoch, r.report_id is not None, r.report_id)):
        gone = unsure = stays = False
        for s in asked(r):
            if not twins and s.epoch == r.epoch and s.report_id == r.report_id:
                continue
            if r.epoch - s.epoch <= window_s and haversine_plain(r.lat, r.lon, s.lat, s.lon) <= distance_m:
                gone, unsure, stays = gone or (s.stays and s.sure), unsure or not s.sure, stays or s.stays
        sure = gone or (r.edge > distance_m and not unsure)
        row = Seen(r.report_id, r.epoch, r.lat, r.lon, r.token, r.kind, not (gone or stays), sure)
        if row.stays or not row.sure:
            put(row)
        out.append(row)
    return out


class Tile(StatefulProcessor):
    """The reports of one tile that wait for the watermark, and those of the last window that later ones may repeat.

    Reports wait in packed blocks, each of a part of the time no longer than the window, and only those of one part are unpacked at once.
    """

    def __init__(self, distance_m: float, window_s: int):
        self._distance, self._window = distance_m, window_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "lo long, hi long, rows binary")
        self._seen = handle.getValueState("seen", "rows binary")

    def _blocks(self, rows: list[tuple]) -> Iterator[tuple]:
        parts: dict[int, list] = {}
        for r in rows:
            parts.setdefault(r[1] // max(1, self._window), []).append(r)
        for part in parts.values():
            yield min(r[1] for r in part), max(r[1] for r in part), pack(part)

    def _wait(self, blocks) -> None:
        held, size = [], 0
        for block in blocks:
            held.append(block)
            size += len(block[2])
            if size > SENT:
                self._waiting.appendList(held)
                held, size = [], 0
        if held:
            self._waiting.appendList(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came, first = [], None
        for frame in rows:
            if len(frame):
                came.extend(zip(*(frame[c].tolist() for c in Held._fields)))
                first = min(x for x in (first, int(frame["epoch"].min())) if x is not None)
            if len(came) >= CHUNK:
                self._wait(self._blocks(came))
                came = []
        self._wait(self._blocks(came))
        if first is not None:
            self._handle.registerTimer((first + 1) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A second is over once no report of it can come any more.
        over = timerValues.getCurrentWatermarkInMs() // 1000
        blocks = list(self._waiting.get())
        ripe: dict[int, list] = {}
        rest = []
        for block in blocks:
            if block[0] < over:
                ripe.setdefault(block[0] // max(1, self._window), []).append(block)
            else:
                rest.append(block)
        del blocks
        if not ripe:
            return
        seen = unpack(self._seen.get()[0], Seen) if self._seen.exists() else []
        for part in sorted(ripe):
            rows = [r for block in ripe.pop(part) for r in unpack(block[2], Held)]
            late = [tuple(r) for r in rows if r.epoch >= over]
            if late:
                rest.extend(self._blocks(late))
                rows = [r for r in rows if r.epoch < over]
            new = settle(rows, seen, self._distance, self._window)
            start = max(r.epoch for r in rows)
            seen = [r for r in (*seen, *new) if r.epoch >= start - self._window and (r.stays or not r.sure)]
            home = {r.report_id for r in rows if r.home}
            told = [(r.report_id, r.epoch, r.stays, r.sure) for r in new if r.report_id in home]
            if told:
                yield pd.DataFrame(told, columns=["report_id", "epoch", "stays", "sure"])
        recent = [tuple(r) for r in seen if r.epoch >= over - self._window]
        if recent:
            self._seen.update((pack(recent),))
        else:
            self._seen.clear()
        self._waiting.clear()
        self._wait(rest)
        if rest:
            self._handle.registerTimer((min(b[0] for b in rest) + 1) * 1000)

    def close(self) -> None:
        pass


def dedupe_stream(
    reports: DataFrame, plane: geo.Plane, distance_m: float = 15.0, window_s: int = 600, late: str = "10 minutes", tile_m: float = 2000.0, halo_m: float | None = None,
) -> DataFrame:
    """A stream of reports to (report_id, epoch, stays, sure), each settled once the watermark has passed its second.

    Rows need ts, report_id (any type; told as text, in whose order equal times are settled), lat, lon, epoch (the second of
    ts), reporter_token, hazard_type and mode, as `operators.dedupe` has them. `sure` is false where the outcome could hang on reports
    beyond the halo (16 distances without one given): only if reports repeat each other in a chain from a tile's border to there.
    Rows without ts, epoch or place have no duplicates and are left out; take them as they are.
    State is bounded: a tile holds the reports of the lateness and of one window, and nothing once they are over.
    """
    halo = 16 * distance_m if halo_m is None else halo_m
    if not distance_m < halo <= tile_m / 2:
        raise ValueError("the halo must be wider than the distance and no wider than half a tile")
    x, y = plane.x(F.col("lon")), plane.y(F.col("lat"))
    token, kind = F.nullif("reporter_token", F.lit("")), F.concat_ws("\x1f", "hazard_type", "mode")
    rows = reports.withWatermark("ts", late).where("ts is not null and epoch is not null and lat is not null and lon is not null")
    placed = rows.select(
        "ts", F.col("report_id").cast("string").alias("report_id"), F.col("epoch").cast("long").alias("epoch"), "lat", "lon", token.alias("token"),
        F.when(F.col("hazard_type").isNotNull() & F.col("mode").isNotNull(), kind).alias("kind"), x.alias("x"), y.alias("y"),
    )
    own = lambda c: F.floor(F.col(c) / tile_m)
    reached = lambda c: F.sequence(F.floor((F.col(c) - halo) / tile_m), F.floor((F.col(c) + halo) / tile_m))
    spread = placed.select("*", F.explode(reached("x")).alias("cx")).select("*", F.explode(reached("y")).alias("cy"))
    # How far a row lies inside the outer edge of what the tile sees.
    inside = lambda v, c: F.least(F.col(v) - F.col(c) * tile_m + halo, (F.col(c) + 1) * tile_m + halo - F.col(v))
    tiles = spread.withColumns({"home": (own("x") == F.col("cx")) & (own("y") == F.col("cy")), "edge": F.least(inside("x", "cx"), inside("y", "cy"))})
    reports.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    carry(sys.modules[__name__], geo)
    return tiles.groupBy("cx", "cy").transformWithStateInPandas(Tile(distance_m, window_s), SETTLED, "append", "eventTime")
