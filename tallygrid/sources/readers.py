"""Readers of the file formats: GeoJSON, JSON lists, CSV and ZIP exports, ride files, boundaries."""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.ranks import numbered
from ..operators.spatial import bounded_broadcast
from . import ranges

_POINT = "array<double>"
_LINE = "struct<type: string, id: string, geometry: struct<type: string, coordinates: string>, properties: struct<segment_id: string, id: string, name: string>>"
_STREETS = f"features array<{_LINE}>"
_EXPOSURE = (
    "struct<segment_id: string, estimate: double, source: string, date: string, tier: string,"
    " sources: array<struct<estimate: double, source: string, date: string, tier: string>>>"
)
_REPORT = (
    "struct<schema_version: string, id: string, occurred_at: string,"
    " location: struct<lat: double, lon: double, accuracy_m: double>, mode: string, hazard_type: string,"
    " severity: string, heading_deg: double, note: string, reporter_token: string, address: string, language: string>"
)


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def _listed(spark: SparkSession, path: str, key: str, row: str) -> DataFrame:
    """Rows (file, offset, r) of JSON files that are a list or an object with the list under `key`; read by ranges of bytes."""
    return ranges.read_features(spark, path, member=key).select("file", "offset", F.from_json("feature", row).alias("r"))


def streets_geojson(spark: SparkSession, path: str) -> DataFrame:
    """pos, segment_id, name, coords of the LineStrings of a FeatureCollection; [lon, lat] is turned round.

    The collection is read by ranges of bytes. pos is the place among all its features. The id is properties.segment_id, else
    properties.id, else the feature's; a line of fewer than two vertices fails.
    """
    return _streets(numbered(ranges.read_features(spark, path), ["file", "offset"], "pos"))


def streets_bytes(spark: SparkSession, content: bytes, sha256: str | None = None) -> DataFrame:
    """The same of a collection that was read already, such as one whose digest was checked; raises if the digest is another one."""
    if not isinstance(content, bytes):
        raise TypeError("a street network is given as bytes")
    if sha256 is not None and hashlib.sha256(content).hexdigest() != sha256.lower():
        raise ValueError("the street network is not the one that was pinned")
    features = json.loads(content).get("features", [])
    rows = spark.createDataFrame([(i, json.dumps(f)) for i, f in enumerate(features)], "pos long, feature string")
    return _streets(rows)


def _streets(features: DataFrame) -> DataFrame:
    """Lines of features (pos, feature)."""
    lines = features.select("pos", F.from_json("feature", _LINE).alias("f")).where("f.geometry.type = 'LineString'")
    points = F.from_json("f.geometry.coordinates", f"array<{_POINT}>")
    coords = F.transform(points, lambda p: F.struct(p[1].alias("lat"), p[0].alias("lon")))
    checked = F.when(F.size(coords) >= 2, coords).otherwise(F.raise_error(F.lit("a line of fewer than two vertices")))
    identity = F.coalesce("f.properties.segment_id", "f.properties.id", "f.id")
    return lines.select(F.col("pos").cast("long"), identity.alias("segment_id"), F.coalesce("f.properties.name", identity).alias("name"), checked.alias("coords"))


def exposure_json(spark: SparkSession, path: str) -> DataFrame:
    """segment_id, estimate, source, date, tier, sources; the last of equal ids counts, a missing tier is 'unknown'."""
    rows = _listed(spark, path, "segments", _EXPOSURE)
    last = rows.groupBy("r.segment_id").agg(F.max_by("r", F.struct("file", "offset")).alias("r"))
    return last.select("segment_id", "r.estimate", "r.source", "r.date", F.coalesce("r.tier", F.lit("unknown")).alias("tier"), "r.sources")


def reports_json(spark: SparkSession, path: str) -> DataFrame:
    """Reports with lat and lon of 0 where there is no location."""
    rows = _listed(spark, path, "reports", _REPORT)
    return rows.select(
        F.col("r.id").alias("report_id"), "r.occurred_at", F.coalesce("r.location.lat", F.lit(0.0)).alias("lat"),
        F.coalesce("r.location.lon", F.lit(0.0)).alias("lon"), "r.location.accuracy_m", "r.mode", "r.hazard_type", "r.severity",
        "r.heading_deg", "r.note", "r.reporter_token", "r.address", F.coalesce("r.language", F.lit("en")).alias("language"),
        X.epoch(F.col("r.occurred_at")).alias("epoch"),
    )


def weather_json(spark: SparkSession, path: str) -> DataFrame:
    """date, wet, precip_mm of a list, or of an object with 'daily' or 'days'."""
    row = "struct<date: string, precip_mm: double, wet: boolean, condition: string>"
    raw = _whole(spark, path)
    both = F.from_json("value", f"struct<daily: array<{row}>, days: array<{row}>>")
    rows = F.coalesce(F.from_json(F.when(F.trim("value").startswith("["), F.col("value")), f"array<{row}>"), both["daily"], both["days"])
    return raw.select(F.explode(rows).alias("r")).select("r.date", "r.wet", "r.precip_mm", "r.condition")


def crosswalk_toml(spark: SparkSession, path: str) -> dict:
    """A crosswalk file: tables source (with bias_profile), hazard_type and severity; for `governance.apply_crosswalk`."""
    import tomllib

    return tomllib.loads(_whole(spark, path).first()["value"])


#: First and last weather code of each condition; codes between are other.
WEATHER_CODES = (
    ("clear", 0, 0),
    ("partly_cloudy", 1, 3),
    ("fog", 45, 45),
    ("fog", 48, 48),
    ("rain", 51, 67),
    ("snow", 71, 77),
    ("showers", 80, 82),
    ("snow_showers", 85, 86),
    ("thunderstorm", 95, 99),
)


def weather_condition(code) -> object:
    """The condition of a weather code; other outside all ranges and without a code."""
    out = F.when(code.isNull(), "other")
    for name, first, last in WEATHER_CODES:
        out = out.when(code.between(first, last), name)
    return out.otherwise("other")


def weather_archive(spark: SparkSession, path: str) -> DataFrame:
    """date, condition, wet from parallel arrays of an archive's daily block; wet from code 51 or any rain."""
    daily = "struct<daily: struct<time: array<string>, precipitation_sum: array<double>, weather_code: array<int>>>"
    rows = _whole(spark, path).select(F.from_json("value", daily)["daily"].alias("d")).select(F.explode(F.arrays_zip("d.time", "d.precipitation_sum", "d.weather_code")).alias("r"))
    return rows.select(
        F.col("r.time").alias("date"), weather_condition(F.col("r.weather_code")).alias("condition"), F.col("r.precipitation_sum").alias("precip_mm"),
        (F.coalesce(F.col("r.weather_code") >= 51, F.lit(False)) | F.coalesce(F.col("r.precipitation_sum") > 0, F.lit(False))).alias("wet"),
    )


def gazetteer_json(spark: SparkSession, path: str) -> DataFrame:
    """key, lat, lon by address in lower case with single blanks."""
    rows = _listed(spark, path, "addresses", "struct<address: string, lat: double, lon: double>")
    return rows.select(X.address_key(F.col("r.address")).alias("key"), "r.lat", "r.lon")


#: Addresses under which the ids of ride incidents and of point reports are made.
RIDES = uuid.uuid5(uuid.NAMESPACE_URL, "https://simra-project.github.io/")
POINTS = uuid.uuid5(uuid.NAMESPACE_URL, "https://bikemaps.org/")

Box = ranges.Box


def ride_file(spark: SparkSession, path: str, box: Box | None = None) -> DataFrame:
    """Incidents of ride files: the part before the divider, its second line naming the columns.

    Incidents without a kind or of kind -5 are left out, and those outside the box; the time is in milliseconds. report_id follows
    from the file's name, place and time. Files are read in groups, one task each, which also drops what lies outside the box.
    """
    rows = ranges.inside_box(ranges.read_rides(spark, path), box).where("incident not in ('', '-5')").select(
        "file", F.col("record")["ts"].alias("ts"), F.col("record")["key"].alias("key"), "lat", "lon",
        X.iso_from_epoch_ms(F.col("ts")).alias("occurred_at"), "incident", F.col("record")["scary"].alias("scary"),
    )
    name = F.format_string("simra:%s:%.6f,%.6f:%s", F.element_at(F.split("file", "/"), -1), F.col("lat"), F.col("lon"), F.col("ts"))
    return rows.withColumn("report_id", X.uuid5(RIDES, name)).drop("ts")


def point_reports(spark: SparkSession, path: str, kind: str, offset: str = "-08:00", box: Box | None = None) -> DataFrame:
    """Point features with pk, date, incident_with, injury, hazard_type, as far as they lie in the box.

    A time without offset gets one; report_id follows from kind and pk, without pk from place and time. source_term is the source's
    own word, trimmed: hazard_type of hazards, else incident_with; null if it is empty. The collection is read by ranges of
    bytes, which also drop what lies outside the box.
    """
    props = "struct<pk: string, date: string, incident_with: string, injury: string, hazard_type: string>"
    found = ranges.inside_box(ranges.read_features(spark, path), box).where("lon is not null")
    f = found.select("lat", "lon", F.from_json("feature", f"struct<properties: {props}>")["properties"].alias("p"))
    rows = f.select(F.lit(kind).alias("kind"), "p.pk", X.with_offset(F.col("p.date"), offset).alias("occurred_at"), "lat", "lon", "p.incident_with", "p.injury", "p.hazard_type")
    name = F.coalesce(F.concat(F.lit(f"{kind}:"), F.col("pk")), F.format_string(kind + ":%.6f,%.6f:%s", F.col("lat"), F.col("lon"), F.col("occurred_at")))
    term = F.nullif(F.trim("hazard_type" if kind == "hazard" else "incident_with"), F.lit(""))
    return rows.withColumns({"report_id": X.uuid5(POINTS, name), "source_term": term})


def osm_ways(spark: SparkSession, path: str) -> DataFrame:
    """way_id, name, nodes from map elements or from GeoJSON lines, whichever the file holds."""
    raw = _whole(spark, path)
    elements = "struct<elements: array<struct<type: string, id: string, geometry: array<struct<lat: double, lon: double>>, tags: map<string,string>>>>"
    a = raw.select(F.explode(F.from_json("value", elements)["elements"]).alias("e")).where("e.type = 'way' and size(e.geometry) >= 2").select(
        F.col("e.id").alias("way_id"), F.col("e.tags")["name"].alias("name"), F.col("e.geometry").alias("nodes")
    )
    b = raw.select(F.posexplode(F.from_json("value", f"struct<{_STREETS}>")["features"]).alias("pos", "f")).where("f.geometry.type = 'LineString'").select(
        F.coalesce("f.id", "f.properties.id", F.col("pos").cast("string")).alias("way_id"), "f.properties.name",
        F.transform(F.from_json("f.geometry.coordinates", f"array<{_POINT}>"), lambda p: F.struct(p[1].alias("lat"), p[0].alias("lon"))).alias("nodes"),
    )
    return a.unionByName(b)


def counts_csv(spark: SparkSession, path: str) -> DataFrame:
    """id, lat, lon, count with a positive count."""
    rows = spark.read.csv(path, header=True)
    number = {c: F.col(c).try_cast("double") for c in ("lat", "lon", "count")}
    return rows.withColumns(number).where("count > 0")


def counts_geojson(spark: SparkSession, path: str, field: str = "count") -> DataFrame:
    """lat, lon, count of Point features whose property `field` is a positive count; read by ranges of bytes."""
    found = ranges.read_features(spark, path).where("lon is not null")
    said = F.from_json("feature", "struct<properties: map<string,string>>")["properties"][field]
    return found.select("lat", "lon", said.try_cast("double").alias("count")).where("count > 0")


#: Encodings of a crash export.
ENCODINGS = ("utf-8-sig", "cp1252")


def zip_table(spark: SparkSession, path: str, member: str, columns: list[str], encoding: str = "utf-8-sig", row_cap: int | None = None) -> DataFrame:
    """The columns, as text, of the CSV that is a member of ZIP files; its name in any case, with or without folders before it.

    A file is one task, and its rows are passed on in parts. Names are trimmed and in upper case; a row with more values than
    names fails, and so do duplicate or missing names, another encoding than the two, and a file of more rows than `row_cap`, if one is given.
    """
    if encoding.lower() not in (*ENCODINGS, "utf-8"):
        raise ValueError(f"an export is in {' or '.join(ENCODINGS)}")
    wanted = [c.upper() for c in columns]

    def run(batches):
        import csv

        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    found = [m for m in z.namelist() if PurePosixPath(m).name.lower() == member.lower()]
                    if len(found) != 1:
                        raise ValueError(f"{len(found)} members are named {member}")
                    rows = csv.reader(io.TextIOWrapper(z.open(found[0]), encoding=encoding, newline=""))
                    names = [c.strip().lstrip("\ufeff").upper() for c in next(rows)]
                    if len(set(names)) != len(names) or not set(wanted) <= set(names):
                        raise ValueError("duplicate or missing columns")
                    at, held = [names.index(c) for c in wanted], []
                    for i, row in enumerate(rows):
                        if row_cap is not None and i >= row_cap:
                            raise ValueError(f"{member} has more than {row_cap} rows")
                        if len(row) > len(names):
                            raise ValueError("a row has more values than there are columns")
                        held.append([row[i] if i < len(row) else None for i in at])
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names=wanted)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names=wanted)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"`{c}` string" for c in wanted))


def evidence_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as trimmed text under plain names; a missing value is empty, rows without any value are left out.

    Quoted fields may hold commas, quotes and line breaks. Empty or equal names fail.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    names = [X.field_name(c) for c in raw.columns]
    if not all(names) or len(set(names)) != len(names):
        raise ValueError("headers must be non-empty and unique")
    rows = raw.toDF(*names).select(*(F.coalesce(F.trim(F.col(n)), F.lit("")).alias(n) for n in names))
    return rows.where(F.concat(*names) != "")


def evidence_json(spark: SparkSession, path: str) -> DataFrame:
    """record map<string,string> under plain names: of a list of objects, of `reports`, or of point features with longitude and latitude."""
    raw = _whole(spark, path)
    flat, point = "map<string,string>", f"struct<geometry: struct<type: string, coordinates: {_POINT}>, properties: map<string,string>>"
    listed = F.from_json(F.when(F.trim("value").startswith("["), F.col("value")), f"array<{flat}>")
    both = F.from_json("value", f"struct<reports: array<{flat}>, features: array<{point}>>")
    place = lambda f, i: F.when(f["geometry"]["type"] == "Point", F.get(f["geometry"]["coordinates"], F.lit(i)).cast("string")).otherwise("")
    own = lambda f: F.map_filter(F.coalesce(f["properties"], F.create_map().cast(flat)), lambda k, _: ~k.isin("longitude", "latitude"))
    features = F.transform(both["features"], lambda f: F.map_concat(own(f), F.create_map(F.lit("longitude"), place(f, 0), F.lit("latitude"), place(f, 1))))
    plain = lambda k, _: F.regexp_replace(F.regexp_replace(F.lower(F.trim(k)), r"[\s-]+", "_"), "[^a-z0-9_]", "")
    return raw.select(F.explode(F.coalesce(listed, both["reports"], features)).alias("r")).select(F.transform_keys("r", plain).alias("record"))


#: Kinds of sources, and how open they are.
SOURCE_KINDS = ("streets", "incidents", "exposure", "official_outcomes", "context", "interventions")
SOURCE_ACCESS = ("open", "partner", "licensed", "private")


def source_registry(spark: SparkSession, path: str) -> DataFrame:
    """(id, kind, name, license, updated_at, geography, access, stale_after_days, synthetic) of a registry file; raises with all that is wrong in it."""
    import tomllib

    said = tomllib.loads(_whole(spark, path).first()["value"])
    rows, floor = said.get("sources", []), said.get("measured_min_coverage", 0.8)
    ids = [str(r.get("id", "")) for r in rows]
    wrong = ["version must be 1"] * (said.get("version") != 1) + ["city is missing"] * (not str(said.get("city", "")).strip())
    wrong += ["measured_min_coverage must be above 0 and at most 1"] * (not (isinstance(floor, (int, float)) and 0 < floor <= 1))
    wrong += [f"id {i!r} is empty or repeated" for i in sorted({i for i in ids if not i or ids.count(i) > 1})]
    wrong += [f"{r.get('id')}: {k} is missing" for r in rows for k in ("name", "license", "updated_at", "geography") if not r.get(k)]
    wrong += [f"{r.get('id')}: kind {r.get('kind')!r} is not known" for r in rows if r.get("kind") not in SOURCE_KINDS]
    wrong += [f"{r.get('id')}: access {r.get('access')!r} is not known" for r in rows if r.get("access", "open") not in SOURCE_ACCESS]
    wrong += [f"{r.get('id')}: stale_after_days is below 0" for r in rows if int(r.get("stale_after_days", 365)) < 0]
    if wrong:
        raise ValueError("; ".join(wrong))
    told = [(*(str(r[k]) for k in ("id", "kind", "name", "license", "updated_at", "geography")), r.get("access", "open"), int(r.get("stale_after_days", 365)), bool(r.get("synthetic", False))) for r in rows]
    return spark.createDataFrame(told, "id string, kind string, name string, license string, updated_at string, geography string, access string, stale_after_days int, synthetic boolean")


def text_table(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """A CSV with all columns as text, names trimmed and in upper case; duplicate or missing names fail."""
    raw = spark.read.option("encoding", encoding).csv(path, header=True, mode="FAILFAST")
    names = [c.strip().lstrip("﻿").upper() for c in raw.columns]
    if len(set(names)) != len(names):
        raise ValueError("duplicate columns")
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return raw.toDF(*names).select(*columns)


def zip_members(content: bytes, most_ratio: float = 200.0) -> list[dict]:
    """Name, size, CRC-32 and SHA-256 of the members; unsafe paths and too strong compression fail."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for m in z.infolist():
            path = PurePosixPath(m.filename)
            if path.is_absolute() or ".." in path.parts:
                raise ValueError(f"unsafe member {m.filename}")
            if m.file_size > most_ratio * max(1, m.compress_size):
                raise ValueError(f"{m.filename} is compressed too strongly")
            out.append({"name": m.filename, "size": m.file_size, "crc32": m.CRC, "sha256": hashlib.sha256(z.read(m)).hexdigest()})
    return out


def pinned_archives(spark: SparkSession, path: str, pins: DataFrame) -> DataFrame:
    """Files whose size and SHA-256 are as pinned (name, size, sha256)."""
    files = spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")
    )
    return files.join(bounded_broadcast(pins), ["name", "size", "sha256"], "left_semi")


_RING = "struct<LinearRing: struct<coordinates: string>>"
_POLYGON = f"struct<outerBoundaryIs: {_RING}, innerBoundaryIs: array<{_RING}>>"
_DATA = "array<struct<_VALUE: string, _name: string>>"
_PLACEMARK = (
    f"name string, ExtendedData struct<SchemaData: struct<SimpleData: {_DATA}>>, SimpleData {_DATA}, Polygon array<{_POLYGON}>,"
    f" MultiGeometry struct<Polygon: array<{_POLYGON}>>, coordinates array<string>"
)


def boundaries_kml(spark: SparkSession, path: str) -> DataFrame:
    """Placemarks of KML files: name, data map, polygons (each its outer ring, then its inner ones; points [lon, lat] to 6 digits), rings (all of them).

    Spark's XML source reads the file placemark by placemark. Data and rings may also stand in a placemark itself; such a ring is a polygon.
    """
    marks = spark.read.format("xml").options(rowTag="Placemark", valueTag="_VALUE", attributePrefix="_", ignoreNamespace=True).schema(_PLACEMARK).load(path)
    half_up = lambda x: F.round(x.try_cast("double"), 6)
    point = lambda p: F.transform(F.slice(F.split(p, ","), 1, 2), half_up)
    listed = lambda text: F.transform(F.filter(F.split(F.trim(text), r"\s+"), lambda p: p != ""), point)
    ring = lambda r: listed(r["LinearRing"]["coordinates"])
    polygon = lambda p: F.concat(F.array(ring(p["outerBoundaryIs"])), F.coalesce(F.transform(p["innerBoundaryIs"], ring), F.array().cast("array<array<array<double>>>")))
    none = F.array().cast(f"array<{_POLYGON}>")
    bare = F.transform(F.coalesce("coordinates", F.array().cast("array<string>")), lambda c: F.array(listed(c)))
    polygons = F.concat(F.transform(F.concat(F.coalesce("Polygon", none), F.coalesce("MultiGeometry.Polygon", none)), polygon), bare)
    data = F.concat(F.coalesce("ExtendedData.SchemaData.SimpleData", F.array().cast(_DATA)), F.coalesce("SimpleData", F.array().cast(_DATA)))
    pairs = F.transform(data, lambda d: F.struct(d["_name"].alias("k"), F.coalesce(d["_VALUE"], F.lit("")).alias("v")))
    return marks.select("name", F.map_from_entries(pairs).alias("data"), polygons.alias("polygons")).withColumn("rings", F.flatten("polygons"))


#: Fields that each county's placemark has.
COUNTY_FIELDS = ("STATEFP", "COUNTYFP", "GEOID", "NAME", "NAMELSAD", "STUSPS", "STATE_NAME")
#: Least area of a ring, in square degrees, and states (with the capital's district) that there are.
LEAST_AREA, STATES = 1e-12, 51


def _ring_problem(ring) -> object:
    """What is wrong with a ring: not closed, a point outside the globe or without two numbers, or no area."""
    flat = F.forall(ring, lambda p: F.coalesce((F.size(p) == 2) & p[0].between(-180, 180) & p[1].between(-90, 90), F.lit(False)))
    steps = F.sequence(F.lit(0), F.size(ring) - 2)
    twice = F.aggregate(F.transform(steps, lambda i: F.get(ring, i)[0] * F.get(ring, i + 1)[1] - F.get(ring, i + 1)[0] * F.get(ring, i)[1]), F.lit(0.0), lambda a, x: a + x)
    return F.when(~flat, "a point is not valid").when((F.size(ring) < 4) | (F.element_at(ring, 1) != F.element_at(ring, -1)), "a ring is not closed").when(F.abs(twice) < LEAST_AREA, "a ring has no area")


def county_boundaries(spark: SparkSession, path: str, states: tuple[str, ...] | None = None) -> DataFrame:
    """geoid, state_fips, county_fips, name, kind (Polygon or MultiPolygon), polygons, points of the counties of KML files, or of some states only.

    A placemark without a field, with a geoid that is not its state's and county's, without a polygon, or with a bad ring fails.
    """
    marks = boundaries_kml(spark, path)
    f = lambda name: F.col("data")[name]
    if states is not None:
        marks = marks.where(f("STATEFP").isin(*states))
    missing = F.array_except(F.array(*map(F.lit, COUNTY_FIELDS)), F.map_keys("data"))
    rings = F.array_compact(F.transform("rings", _ring_problem))
    problem = (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")))
        .when(f("GEOID") != F.concat(f("STATEFP"), f("COUNTYFP")), "the geoid is not the state's and county's")
        .when(F.size("polygons") == 0, "no polygon")
        .otherwise(F.get(rings, F.lit(0)))
    )
    checked = marks.withColumn("problem", problem).withColumn("geoid", F.when(F.col("problem").isNull(), f("GEOID")).otherwise(F.raise_error(F.concat(F.coalesce("name", F.lit("placemark")), F.lit(": "), "problem"))))
    return checked.select(
        "geoid", f("STATEFP").alias("state_fips"), f("COUNTYFP").alias("county_fips"), f("NAME").alias("name"),
        F.when(F.size("polygons") == 1, "Polygon").otherwise("MultiPolygon").alias("kind"), "polygons", F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)).cast("long").alias("points"),
    )


def state_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """state_fips, abbreviation, name, polygons of the states; raises unless each of the 51 is there once. Territories are left out."""
    f = lambda name: F.col("data")[name]
    marks = boundaries_kml(spark, path).select(f("STATEFP").alias("state_fips"), f("STUSPS").alias("abbreviation"), f("NAME").alias("name"), "polygons")
    rows = marks.where((F.col("state_fips") <= "56") & (F.size("polygons") > 0))
    n, different = rows.agg(F.count("*"), F.count_distinct("state_fips")).first()
    if (n, different) != (STATES, STATES):
        raise ValueError(f"{n} boundaries of {different} states, not one each of {STATES}")
    return rows


def write_county_shards(counties: DataFrame, folder: str) -> DataFrame:
    """Write counties below `folder`, a part for each state, in order of geoid; returns what was read back of each state: state_fips,
    features, polygons, multipolygons, points. Raises if that is not what was to be written, or a geoid stands twice."""
    told = lambda rows: rows.groupBy("state_fips").agg(
        F.count("*").alias("features"), F.count_if(F.col("kind") == "Polygon").alias("polygons"), F.count_if(F.col("kind") == "MultiPolygon").alias("multipolygons"),
        F.sum("points").alias("points"), F.count_distinct("geoid").alias("different"),
    )
    counties.repartition("state_fips").sortWithinPartitions("state_fips", "geoid").write.partitionBy("state_fips").parquet(folder)
    back = told(counties.sparkSession.read.schema(counties.schema).parquet(folder))
    if not told(counties).exceptAll(back).isEmpty() or not back.where("different <> features").isEmpty():
        raise ValueError("the parts are not what was to be written")
    return back.drop("different")


def public_release(content: bytes, most: int = 16 << 20) -> dict:
    """A release's JSON: no duplicate keys, canonical bytes, bounded size."""
    from .sinks import canonical_json

    def once(pairs):
        keys = [k for k, _ in pairs]
        if len(set(keys)) != len(keys):
            raise ValueError("duplicate keys")
        return dict(pairs)

    if len(content) > most:
        raise ValueError("the release is too large")
    value = json.loads(content, object_pairs_hook=once)
    if canonical_json(value) != content:
        raise ValueError("the release is not in canonical form")
    return value


def geocode_by(transport, frame: DataFrame) -> DataFrame:
    """Adds lat and lon of `address` by an injected look-up; a failure gives null. Each address is asked once."""

    def run(batches):
        for pdf in batches:
            found = []
            for a in pdf["address"]:
                try:
                    found.append(transport(a) or (None, None))
                except Exception:  # noqa: BLE001  any failure of a look-up is an unknown place
                    found.append((None, None))
            pdf["lat"], pdf["lon"] = [x[0] for x in found], [x[1] for x in found]
            yield pdf

    schema = T.StructType().add("address", "string").add("lat", "double").add("lon", "double")
    return frame.select("address").distinct().mapInPandas(run, schema)
