"""Python data sources that read large files by ranges of bytes: the features of GeoJSON collections, and ride files.

A collection can be one file of any size. Where a range begins inside it, nothing tells whether that is in a string or how
deep in brackets. So each range is first scanned by itself, for both cases: it tells whether it has an odd number of
quotes, and by how much brackets outside strings raise the depth. A running sum over these few numbers, one row a range,
gives the state at the start of each. Then each range reads the features that begin in it, the last one to its end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

#: Bytes of a range, and those that are looked at in one go.
RANGE, BLOCK = 32 << 20, 4 << 20
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_OPEN, _CLOSE = (ord("{"), ord("[")), (ord("}"), ord("]"))
FEATURE = "file string, offset long, lon double, lat double, feature string"
RIDE = "file string, line long, lon double, lat double, ts long, incident string, record map<string,string>"
Box = tuple[float, float, float, float]


# ---------------------------------------------------------------- files


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(uri, bytes) of the files that a path, pattern or folder names, by the file system that Spark has for it."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(context._jsc.hadoopConfiguration())
    found, out = system.globStatus(there), []
    for status in found or []:
        inner = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [(str(s.getPath().toString()), int(s.getLen())) for s in inner if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


def opened(uri: str):
    """A file that can be read at any place."""
    from pyarrow import fs

    uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def cut(size: int, most: int = RANGE) -> list[tuple[int, int]]:
    return [(a, min(a + most, size)) for a in range(0, size, most)]


# ---------------------------------------------------------------- structure of JSON


def quotes(data: np.ndarray, run: int) -> tuple[np.ndarray, int]:
    """Places of the quotes that no backslash escapes, and how many backslashes the block ends with; `run` stand before it."""
    other = np.flatnonzero(data != _BACKSLASH)
    found = np.flatnonzero(data == _QUOTE)
    before = np.searchsorted(other, found) - 1
    backslashes = found - 1 - np.where(before >= 0, other[np.maximum(before, 0)], -1 - run)
    tail = len(data) - 1 - int(other[-1]) if len(other) else run + len(data)
    return found[backslashes % 2 == 0], tail


def brackets(data: np.ndarray, unescaped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all brackets, +1 or -1 for each, and whether an odd number of quotes stands before it."""
    opens = (data == _OPEN[0]) | (data == _OPEN[1])
    at = np.flatnonzero(opens | (data == _CLOSE[0]) | (data == _CLOSE[1]))
    return at, np.where(opens[at], 1, -1), (np.searchsorted(unescaped, at) & 1).astype(bool)


@dataclass
class Shape:
    """Of a range: whether its quotes are odd in number, and for either state at its start how much deeper it ends and its least depth."""

    odd: bool = False
    even_sum: int = 0
    odd_sum: int = 0
    even_least: int = 0
    odd_least: int = 0


def _backslashes_before(file, start: int) -> int:
    n, step = 0, 64
    while start - n > 0:
        data = file.read_at(min(step, start - n), max(0, start - n - step))
        tail = len(data) - len(data.rstrip(b"\\"))
        n += tail
        if tail < len(data):
            break
        step *= 16
    return n


def shape_of(file, start: int, end: int) -> Shape:
    out, run = Shape(), _backslashes_before(file, start)
    for a in range(start, end, BLOCK):
        data = np.frombuffer(file.read_at(min(BLOCK, end - a), a), np.uint8)
        unescaped, run = quotes(data, run)
        _, sign, inside = brackets(data, unescaped)
        # What is inside a string if the range began outside one, and the other way round.
        for name, outside in (("even", inside == out.odd), ("odd", inside != out.odd)):
            steps = np.cumsum(sign[outside])
            base = getattr(out, f"{name}_sum")
            if len(steps):
                setattr(out, f"{name}_least", min(getattr(out, f"{name}_least"), base + int(steps.min())))
                setattr(out, f"{name}_sum", base + int(steps[-1]))
        out.odd ^= bool(len(unescaped) & 1)
    return out


class Walk:
    """Goes through a file from a place of known state: yields the brackets outside strings, with the depth behind each."""

    def __init__(self, file, start: int, inside: bool, depth: int):
        self._file, self.at, self._inside, self._depth = file, start, inside, depth
        self._run = _backslashes_before(file, start)

    def blocks(self, end: int, size: int) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, bytes, places, signs, depths) of blocks up to `end`, which is at most the size of the file."""
        while self.at < min(end, size):
            raw = self._file.read_at(min(BLOCK, min(end, size) - self.at), self.at)
            data = np.frombuffer(raw, np.uint8)
            unescaped, self._run = quotes(data, self._run)
            at, sign, odd = brackets(data, unescaped)
            outside = odd == self._inside
            at, sign = at[outside], sign[outside]
            depth = self._depth + np.cumsum(sign)
            start, self.at = self.at, self.at + len(raw)
            self._inside ^= bool(len(unescaped) & 1)
            self._depth = int(depth[-1]) if len(depth) else self._depth
            yield start, raw, at, sign, depth


def _key_before(file, at: int) -> str:
    """The name of the member whose value begins at this place."""
    step = 256
    while True:
        head = file.read_at(min(at, step), max(0, at - step)).rstrip()
        if head.endswith(b":"):
            name = head[:-1].rstrip()
            first = len(name) - 2
            while first > 0 and (name[first] != _QUOTE or (len(name[:first]) - len(name[:first].rstrip(b"\\"))) % 2):
                first -= 1
            if name[first : first + 1] == b'"' and (first or at <= step):
                return json.loads(name[first:])
        if at <= step:
            return ""
        step *= 16


def top_arrays(file, size: int, start: int, end: int, inside: bool, depth: int) -> list[tuple[str, str, int]]:
    """(open or close, name, place) of the arrays that are members of the outermost object, as far as they lie in the range."""
    out = []
    for first, raw, at, sign, deep in Walk(file, start, inside, depth).blocks(end, size):
        for i in np.flatnonzero(((sign == 1) & (deep == 2)) | ((sign == -1) & (deep == 1))).tolist():
            if raw[at[i]] in (ord("["), ord("]")):
                place = first + int(at[i])
                out.append(("open", _key_before(file, place), place) if sign[i] == 1 else ("close", "", place))
    return out


def elements(file, size: int, start: int, end: int, inside: bool, depth: int, low: int, high: int, level: int = 2) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the objects at a level that begin in [start, end) and between low and high."""
    walk, begun, held = Walk(file, start, inside, depth), None, []
    for first, raw, at, sign, deep in _until_closed(walk, end, size, lambda: begun is not None):
        last = 0
        for i in np.flatnonzero(((sign == 1) & (deep == level + 1)) | ((sign == -1) & (deep == level))).tolist():
            place = first + int(at[i])
            if sign[i] == 1:
                if begun is None and low < place < high and start <= place < end and raw[at[i]] == _OPEN[0]:
                    begun, held, last = place, [], int(at[i])
            elif begun is not None:
                held.append(raw[last : int(at[i]) + 1])
                yield begun, b"".join(held)
                begun, held = None, []
        if begun is not None:
            held.append(raw[last:])


def _until_closed(walk: Walk, end: int, size: int, open_) -> Iterator:
    yield from walk.blocks(end, size)
    while open_() and walk.at < size:
        yield from walk.blocks(walk.at + BLOCK, size)


# ---------------------------------------------------------------- data sources


@dataclass
class Range(InputPartition):
    """Bytes of a file, the state at their start, and the array that they lie in."""

    uri: str
    size: int
    start: int
    end: int
    inside: bool = False
    depth: int = 0
    low: int = 0
    high: int = 0
    level: int = 2


class BoxReader(DataSourceReader):
    """Takes lower and upper bounds of lon and lat, so that what lies outside them is dropped where it is read."""

    def __init__(self, options):
        self._options = options
        self.box: dict[str, list[float]] = {"lon": [-np.inf, np.inf], "lat": [-np.inf, np.inf]}
        self.pushed: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = getattr(f, "attribute", ("",))[0]
            if name in self.box and isinstance(f, (GreaterThanOrEqual, LessThanOrEqual)):
                low, high = self.box[name]
                value = float(f.value)
                self.box[name] = [max(low, value), high] if isinstance(f, GreaterThanOrEqual) else [low, min(high, value)]
                self.pushed.append(repr(f))
            else:
                yield f

    def fits(self, lon: float | None, lat: float | None) -> bool:
        if not self.pushed:
            return True
        return lon is not None and lat is not None and self.box["lon"][0] <= lon <= self.box["lon"][1] and self.box["lat"][0] <= lat <= self.box["lat"][1]


class FeatureReader(BoxReader):
    def partitions(self) -> list[Range]:
        return [Range(*r) for r in json.loads(self._options["ranges"])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names, kinds = ["file", "offset", "lon", "lat", "feature"], [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
        held, size = [], 0
        with opened(partition.uri) as file:
            for place, data in elements(file, partition.size, partition.start, partition.end, partition.inside, partition.depth, partition.low, partition.high, partition.level):
                geometry = json.loads(data).get("geometry") if b'"geometry"' in data else None
                point = geometry.get("coordinates") if isinstance(geometry, dict) and geometry.get("type") == "Point" else None
                lon, lat = (float(point[0]), float(point[1])) if point and len(point) >= 2 else (None, None)
                if self.fits(lon, lat):
                    held.append((partition.uri, place, lon, lat, data.decode()))
                    size += len(data)
                if size > BLOCK or len(held) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


class FeatureSource(DataSource):
    """Objects of lists: file, offset, lon and lat (of point features, else null), feature (the object's JSON). Option `ranges`: what `feature_ranges` finds."""

    @classmethod
    def name(cls) -> str:
        return "tallygrid_features"

    def schema(self) -> str:
        return FEATURE

    def reader(self, schema) -> FeatureReader:
        return FeatureReader(self.options)


class RideReader(BoxReader):
    """Each task reads a group of files; a file ends before its divider of five or more equals signs."""

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(group) for group in json.loads(self._options["groups"])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        names = ["file", "line", "lon", "lat", "ts", "incident", "record"]
        kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())]
        held = []
        for uri in partition.value:
            for row in _ride_rows(uri):
                if self.fits(row[2], row[3]):
                    held.append(row)
            if len(held) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _number(value: str | None, kind=float):
    try:
        return kind((value or "").strip())
    except ValueError:
        return None


def _ride_rows(uri: str) -> Iterator[tuple]:
    with opened(uri) as file:
        lines = file.read().decode("utf-8", "replace").replace("\r", "").split("\n")
    names: list[str] = []
    for i, line in enumerate(lines):
        if "=====" in line:
            if line.split("=====")[0].strip() and i > 1:
                yield _ride_row(uri, i, names, line.split("=====")[0])
            return
        if i == 1:
            names = line.split(",")
        elif i > 1 and line.strip():
            yield _ride_row(uri, i, names, line)


def _ride_row(uri: str, i: int, names: list[str], line: str) -> tuple:
    cells = line.split(",")
    record = {n: cells[j] if j < len(cells) else "" for j, n in enumerate(names)}
    return uri, i, _number(record.get("lon")), _number(record.get("lat")), _number(record.get("ts"), int), record.get("incident", ""), list(record.items())


class RideSource(DataSource):
    """Incidents of ride files: file, line, lon, lat, ts, incident, record (all cells). Option `groups`: the files of each task."""

    @classmethod
    def name(cls) -> str:
        return "tallygrid_rides"

    def schema(self) -> str:
        return RIDE

    def reader(self, schema) -> RideReader:
        return RideReader(self.options)


def _ready(spark: SparkSession) -> None:
    spark.dataSource.register(FeatureSource)
    spark.dataSource.register(RideSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def inside_box(frame: DataFrame, box: Box | None) -> DataFrame:
    """Rows within (west, south, east, north), its edges included, by bounds that the sources take over; all without a box."""
    if box is None:
        return frame
    west, south, east, north = box
    return frame.where((frame.lon >= west) & (frame.lon <= east) & (frame.lat >= south) & (frame.lat <= north))


def feature_ranges(spark: SparkSession, path: str, most: int = RANGE, member: str = "features") -> list[Range]:
    """The ranges of the lists of all files that a path names, each with the state at its start; one row a range comes to the driver.

    A file is an object with the list under `member`, or a list itself.
    """
    parts = [(uri, size, a, b) for uri, size in files_of(spark, path) for a, b in cut(size, most)]

    def each(schema, rows, tell):
        def run(batches):
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    with opened(row[0]) as file:
                        yield from tell(file, *row)

        frame = spark.createDataFrame(rows, "uri string, size long, start long, stop long, inside boolean, depth long").repartition(max(1, len(rows)))
        return frame.mapInArrow(run, schema).collect()

    def shapes(file, uri, size, a, b, *_):
        s = shape_of(file, a, b)
        yield pa.RecordBatch.from_pylist([{"uri": uri, "start": a, "odd": s.odd, "even_sum": s.even_sum, "odd_sum": s.odd_sum, "even_least": s.even_least, "odd_least": s.odd_least}])

    schema = "uri string, start long, odd boolean, even_sum long, odd_sum long, even_least long, odd_least long"
    seen = {(r.uri, r.start): r for r in each(schema, [(*p, False, 0) for p in parts], shapes)}
    states, shallow, now = [], [], (None, False, 0)
    for uri, size, a, b in parts:
        inside, depth = (now[1], now[2]) if now[0] == uri else (False, 0)
        s = seen[uri, a]
        states.append((uri, size, a, b, inside, depth))
        if depth + (s.odd_least if inside else s.even_least) <= 1 or depth <= 1:
            shallow.append(states[-1])
        now = (uri, inside ^ s.odd, depth + (s.odd_sum if inside else s.even_sum))

    def tops(file, uri, size, a, b, inside, depth):
        found = top_arrays(file, size, a, b, inside, depth)
        if a == 0 and (head := file.read_at(min(size, BLOCK), 0)).lstrip().startswith(b"["):
            found = [("list", "", len(head) - len(head.lstrip()))]
        yield pa.RecordBatch.from_pylist([{"uri": uri, "what": w, "name": n, "place": p} for w, n, p in found], schema=pa.schema([("uri", pa.string()), ("what", pa.string()), ("name", pa.string()), ("place", pa.int64())]))

    arrays: dict[str, tuple[int, int]] = {}
    lists: dict[str, int] = {}
    begun: dict[str, int] = {}
    for r in sorted(each("uri string, what string, name string, place long", shallow, tops), key=lambda r: (r.uri, r.place)):
        if r.what == "list":
            lists[r.uri] = r.place
        elif r.what == "open" and r.name == member:
            begun[r.uri] = r.place
        elif r.what == "close" and r.uri in begun:
            arrays[r.uri] = (begun.pop(r.uri), r.place)
    out = []
    for uri, size, a, b, inside, depth in states:
        low, high, level = (lists[uri], size, 1) if uri in lists else (*arrays.get(uri, (0, 0)), 2)
        if low < b and a < high:
            out.append(Range(uri, size, a, b, inside, depth, low, high, level))
    return out


def read_features(spark: SparkSession, path: str, most: int | None = None, member: str = "features") -> DataFrame:
    """(file, offset, lon, lat, feature) of GeoJSON collections, or of other lists of objects, one task for each range of bytes; they stand in order of offset."""
    _ready(spark)
    ranges = [[r.uri, r.size, r.start, r.end, r.inside, r.depth, r.low, r.high, r.level] for r in feature_ranges(spark, path, most or RANGE, member)]
    return spark.read.format(FeatureSource.name()).option("ranges", json.dumps(ranges)).load()


def read_rides(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Incidents of all ride files that a path names; a task reads files of about so many bytes."""
    _ready(spark)
    groups, size = [[]], 0
    for uri, n in files_of(spark, path):
        if groups[-1] and size + n > (most or RANGE):
            groups.append([])
            size = 0
        groups[-1].append(uri)
        size += n
    return spark.read.format(RideSource.name()).option("groups", json.dumps(groups)).load()
