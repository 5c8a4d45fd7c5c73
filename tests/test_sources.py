"""Readers, writers and streams that the golden city does not pass through."""

import hashlib
import json
import re
import zipfile

import pytest

from pyspark.sql import functions as F
from tallygrid.sources import readers, sinks
from tallygrid.streaming import intake


def test_reports_and_gazetteer(spark, tmp_path):
    rows = [{"id": "a", "occurred_at": "2026-01-02T03:04:05Z", "location": {"lat": 1.5, "lon": 2.5, "accuracy_m": 4}, "mode": "cyclist"}, {"id": "b", "address": "X"}]
    for name, value in (("o.json", {"reports": rows}), ("l.json", rows)):
        (tmp_path / name).write_text(json.dumps(value))
        got = {r.report_id: r for r in readers.reports_json(spark, str(tmp_path / name)).collect()}
        assert (got["a"].lat, got["a"].lon, got["a"].accuracy_m, got["a"].epoch, got["a"].language) == (1.5, 2.5, 4.0, 1767323045, "en")
        assert (got["b"].lat, got["b"].lon, got["b"].address, got["b"].epoch) == (0.0, 0.0, "X", None)
    (tmp_path / "g.json").write_text(json.dumps({"addresses": [{"address": " 1  Main ST ", "lat": 1, "lon": 2}]}))
    assert [tuple(r) for r in readers.gazetteer_json(spark, str(tmp_path / "g.json")).collect()] == [("1 main st", 1.0, 2.0)]


def test_injected_look_up(spark):
    def find(address):
        if address == "bad":
            raise OSError
        return {"x": (1.0, 2.0)}.get(address)

    frame = spark.createDataFrame([("x",), ("x",), ("bad",), ("none",)], "address string")
    assert sorted(map(str, map(tuple, readers.geocode_by(find, frame).collect()))) == ["('bad', None, None)", "('none', None, None)", "('x', 1.0, 2.0)"]


def test_ways_of_both_kinds(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"elements": [{"type": "way", "id": 5, "geometry": [{"lat": 1, "lon": 2}, {"lat": 3, "lon": 4}], "tags": {"name": "N"}}, {"type": "node", "id": 6}, {"type": "way", "id": 7, "geometry": [{"lat": 1, "lon": 2}]}]}))
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[2, 1], [4, 3]]}, "properties": {"name": "M"}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [2, 1]}, "properties": {}}]}))
    for file, want in (("e.json", ("5", "N")), ("g.json", ("0", "M"))):
        (r,) = readers.osm_ways(spark, str(tmp_path / file)).collect()
        assert (r.way_id, r.name) == want and [(p.lat, p.lon) for p in r.nodes] == [(1.0, 2.0), (3.0, 4.0)]


def test_archives(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"abd")
    pins = spark.createDataFrame([("a.bin", 3, hashlib.sha256(b"abc").hexdigest()), ("b.bin", 3, hashlib.sha256(b"abc").hexdigest())], "name string, size long, sha256 string")
    assert [r.name for r in readers.pinned_archives(spark, str(tmp_path), pins).collect()] == ["a.bin"]
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("in/x.csv", "a\n1\n")
    assert [(m["name"], m["size"], m["sha256"]) for m in readers.zip_members(path.read_bytes())] == [("in/x.csv", 4, hashlib.sha256(b"a\n1\n").hexdigest())]
    for name, content, message in (("../x", "a", "unsafe"), ("big", "0" * 10**6, "strongly")):
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(name, content)
        with pytest.raises(ValueError, match=message):
            readers.zip_members(path.read_bytes())


TOP = [(1, "s<1>", "A St", 9.5, 8.0, 11.0, True, True), (2, "s2", "B St", 5.0, 4.0, 6.0, False, True), (3, "s3", "C St", 4.0, 3.0, 5.0, True, True)]


def test_small_reports(spark, tmp_path):
    top = spark.createDataFrame(TOP, "place int, segment_id string, name string, rate double, rate_ci_low double, rate_ci_high double, significant boolean, publishable boolean")
    assert sinks.ranked_markdown(top).splitlines()[2:] == ["| 1 | s<1> | 9.50 | 8.00–11.00 |", "| 2 | s2 | 5.00 | 4.00–6.00 |", "| 3 | s3 | 4.00 | 3.00–5.00 |"]
    svg = sinks.bars_svg(top)
    assert svg.count("<rect") == svg.count("<line") == 3 and "s&lt;1&gt;" in svg and re.search(r'width="\d+\.\d" height="14"', svg)
    assert sinks.bars_svg(top.where("false")).count("<rect") == 0
    assert sinks.brief(top, "Town") == "# Where reports concentrate: Town\n\n- A St: 9.5 per 1000 (8.0 to 11.0)\n- C St: 4.0 per 1000 (3.0 to 5.0)\n"
    assert sinks.brief(top.where("false"), "Town", "es").endswith("Ningún tramo destaca.\n")
    one = spark.createDataFrame([("c", "A St (B–C)", ["x", "y"], 12, 3.25, 2.0, 4.5)], "corridor_id string, name string, segment_ids array<string>, n long, rate double, rate_ci_low double, rate_ci_high double")
    assert sinks.dossier(one, "c") == "# A St (B–C)\n\n12 reports over 2 segments; 3.25 per unit (2.00 to 4.50).\n"
    unknown = one.withColumns({c: F.lit(None).cast("double") for c in ("rate", "rate_ci_low", "rate_ci_high")})
    assert sinks.dossier(unknown, "c").endswith("12 reports over 2 segments; exposure unknown, so no rate.\n")
    with pytest.raises(KeyError):
        sinks.dossier(one, "d")
    said = sinks.manifest({"b": b"2", "a": b"1"}, {"k": 3}, {"n": 4})
    assert list(said["inputs"]) == ["a", "b"] and said["inputs"]["a"] == hashlib.sha256(b"1").hexdigest() and said["counts"] == {"n": 4}
    digest = sinks.write_metadata(one.select("n", "rate"), str(tmp_path / "m.json"))
    assert (tmp_path / "m.json").read_text() == '{\n  "n": 12,\n  "rate": 3.25\n}\n' and digest == hashlib.sha256((tmp_path / "m.json").read_bytes()).hexdigest()


def test_streams_of_windows_and_accepted_reports(spark, tmp_path):
    schema = "report_id long, ts timestamp, mode string, hazard_type string, severity string, lat double, lon double, address string, accuracy_m double"
    rows = [(i, f"2026-01-01 {10 + i // 4:02d}:{i % 4 * 10:02d}:00", "cyclist" if i != 5 else "car", "dooring", "minor", 1.0, 2.0, None, 3.0) for i in range(12)]
    frame = spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("ts", F.to_timestamp("ts"))
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    q = intake.window_counts(stream, "hazard_type").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.start.hour, r.n) for r in spark.sql("select * from windows").collect()) == [(10, 4), (11, 4), (12, 4)]
    for _ in range(2):
        intake.write_accepted(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.report_id for r in kept.collect()) == [i for i in range(12) if i != 5]


def test_streets_from_bytes(spark, tmp_path):
    said = {"type": "FeatureCollection", "features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}}, {"id": "x", "geometry": {"type": "LineString", "coordinates": [[2, 1], [4, 3.5]]}, "properties": {"name": "N"}}]}
    content = json.dumps(said).encode()
    (tmp_path / "s.geojson").write_bytes(content)
    rows = lambda f: [(r.pos, r.segment_id, r.name, [tuple(p) for p in r.coords]) for r in f.collect()]
    got = rows(readers.streets_bytes(spark, content, hashlib.sha256(content).hexdigest().upper()))
    assert got == rows(readers.streets_geojson(spark, str(tmp_path / "s.geojson"))) == [(1, "x", "N", [(1.0, 2.0), (3.5, 4.0)])]
    with pytest.raises(ValueError, match="pinned"):
        readers.streets_bytes(spark, content, "00")
    with pytest.raises(TypeError):
        readers.streets_bytes(spark, "text")


def test_export_encodings_and_row_cap(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("accident.csv", "ST_CASE,NAME\n1,Ca\u00f1on\n2,b\n".encode("cp1252"))
    read = lambda **how: [tuple(r) for r in readers.zip_table(spark, str(tmp_path / "a.zip"), "accident.csv", ["ST_CASE", "NAME"], **how).collect()]
    assert read(encoding="cp1252") == read(encoding="cp1252", row_cap=2) == [("1", "Ca\u00f1on"), ("2", "b")]
    for how, message in (({"encoding": "cp1252", "row_cap": 1}, "more than 1 rows"), ({}, "decode"), ({"encoding": "latin-1"}, "is in")):
        with pytest.raises(Exception, match=message):
            read(**how)


def test_rounding_is_that_of_the_exact_value(spark):
    import random

    from tallygrid.functions.numerics import even_round

    draw = random.Random(8)
    values = [0.00005, 0.000005, 2.675, 1.005, 0.5, 1.5, 2.5, -2.5, -0.4, 0.0, -0.0, 1e300, -1e22, 2.0**52 + 1, float("inf"), 5e-324, 0.125, 0.375, 1234567.125, 4503599627370495.5, None]
    values += [draw.uniform(-1, 1) * 10 ** draw.randint(-6, 9) for _ in range(3000)] + [(draw.randint(-10**6, 10**6) + 0.5) / 10 ** draw.randint(0, 5) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    for places in (0, 1, 2, 4, 6):
        got = [r[0] for r in frame.select(even_round(F.col("v"), places)).collect()]
        for v, g in zip(values, got):
            want = None if v is None else v if v == float("inf") else round(v, places)
            assert g == want and (g is None or str(g) == str(want)), (v, places)
