"""Files read by ranges of bytes: the same rows for any size of range."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallygrid.sources import ranges, readers


def collection(n, seed=1):
    draw = random.Random(seed)
    hard = ['a "quoted" {[', "\\", "\\\\\"", "}]", "é🎉", '{"type":"Feature"}', "\n\t", '\\"', ""]
    features = [
        {
            "type": "Feature", "id": f"f{i}", "properties": {"segment_id": f"s{i}", "name": draw.choice(hard) * draw.randint(0, 5), "list": [{"a": [1, {"b": "]"}]}], draw.choice(hard) + "k": None},
            "geometry": draw.choice([{"type": "Point", "coordinates": [i / 10, -i / 20]}, {"type": "LineString", "coordinates": [[i, 1], [i + 1, 2.5]]}, None]),
        }
        for i in range(n)
    ]
    return {"type": "FeatureCollection", "list": [{"x": "features"}], "meta\\\"": {"features": [{"no": 1}], "s": '"features":['}, "features": features, "after": [{"type": "Feature"}, "["]}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("most", [7, 64, 1000, 1 << 20])
def test_features_are_the_same_for_any_range(spark, tmp_path, monkeypatch, indent, most):
    monkeypatch.setattr(ranges, "BLOCK", 50)
    said = collection(12)
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps(said, indent=indent, ensure_ascii=False), encoding="utf-8")
    size, uri = path.stat().st_size, f"file://{path}"
    # In one process, without Spark: the running state and the features of each range.
    found, inside, depth, arrays = [], False, 0, []
    with ranges.opened(uri) as file:
        states = []
        for a, b in ranges.cut(size, most):
            states.append((a, b, inside, depth))
            s = ranges.shape_of(file, a, b)
            arrays += ranges.top_arrays(file, size, a, b, inside, depth)
            depth += s.odd_sum if inside else s.even_sum
            inside ^= s.odd
        assert (inside, depth) == (False, 0)
        (low,) = [p for w, n, p in arrays if w == "open" and n == "features"]
        high = min(p for w, _, p in arrays if w == "close" and p > low)
        for a, b, inside, depth in states:
            found += ranges.elements(file, size, a, b, inside, depth, low, high)
    assert [json.loads(data) for _, data in found] == said["features"] and [p for p, _ in found] == sorted({p for p, _ in found})


def test_source_reads_a_range_a_task_with_the_box_pushed(spark, tmp_path):
    said = collection(300)
    for name in ("a.geojson", "b.geojson"):
        (tmp_path / name).write_text(json.dumps(said))
    whole = ranges.read_features(spark, f"{tmp_path}/*.geojson", 10_000)
    size = (tmp_path / "a.geojson").stat().st_size
    assert whole.rdd.getNumPartitions() >= 2 * (size // 10_000) and whole.count() == 600
    got = [json.loads(r.feature) for r in whole.where(F.col("file").endswith("a.geojson")).orderBy("offset").collect()]
    assert got == said["features"]
    box = ranges.inside_box(whole, (1.0, -1.0, 2.0, -0.5))
    want = [f for f in said["features"] if f["geometry"] and f["geometry"]["type"] == "Point" and 1 <= f["geometry"]["coordinates"][0] <= 2 and -1 <= f["geometry"]["coordinates"][1] <= -0.5]
    assert box.count() == 2 * len(want) > 0
    # Spark leaves no filter of its own behind: the source has taken the bounds over.
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and not any(line.strip(" +-:*()0123456789").startswith("Filter ") and ">=" in line for line in plan.splitlines())


def test_collections_without_features(spark, tmp_path):
    for i, text in enumerate(('{"type":"FeatureCollection","features":[]}', '{"features":{}}', "{}", '{"features":[1,[2],{"geometry":null}]}')):
        (tmp_path / f"{i}.geojson").write_text(text)
    got = ranges.read_features(spark, f"{tmp_path}/*.geojson", 5).collect()
    assert [json.loads(r.feature) for r in got] == [{"geometry": None}]
    with pytest.raises(FileNotFoundError):
        ranges.read_features(spark, f"{tmp_path}/none.json")


def test_readers_give_what_whole_files_gave(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE", 333)
    said = collection(40)
    (tmp_path / "c.geojson").write_text(json.dumps(said))
    lines = [(i, f) for i, f in enumerate(said["features"]) if f["geometry"] and f["geometry"]["type"] == "LineString"]
    got = readers.streets_geojson(spark, str(tmp_path / "c.geojson")).orderBy("pos").collect()
    assert [(r.pos, r.segment_id, r.name, [(p.lon, p.lat) for p in r.coords]) for r in got] == [
        (i, f["properties"]["segment_id"], f["properties"]["name"], [tuple(map(float, p)) for p in f["geometry"]["coordinates"]]) for i, f in lines
    ]
    points = [f for f in said["features"] if f["geometry"] and f["geometry"]["type"] == "Point"]
    assert readers.point_reports(spark, str(tmp_path / "c.geojson"), "collision").count() == len(points)


def test_rides(spark, tmp_path):
    head = "i4#1\nkey,lat,lon,ts,incident,scary\n"
    for i in range(5):
        rows = "".join(f"{j},{38 + j / 10},{-121 - i / 10},{1_700_000_000_000 + j},{j % 3},0\n" for j in range(4))
        (tmp_path / f"r{i}").write_text(head + rows + "5,,x,,1\n=========================\nX\n1,2,3,4,5,6\n")
    rides = ranges.read_rides(spark, str(tmp_path), 300)
    assert rides.count() == 25 and 1 < rides.rdd.getNumPartitions() <= 5
    box = ranges.inside_box(rides, (-121.25, 38.05, -121.05, 38.25))
    assert sorted((r.lon, r.lat) for r in box.collect()) == [(-121.2, 38.1), (-121.2, 38.2), (-121.1, 38.1), (-121.1, 38.2)]
    assert readers.ride_file(spark, str(tmp_path), (-121.25, 38.05, -121.05, 38.25)).count() == 4


@pytest.mark.parametrize("wrap", [lambda rows: {"about": ["x", {"reports": []}], "reports": rows, "segments": rows}, lambda rows: rows])
@pytest.mark.parametrize("size", [11, 100, 1 << 20])
def test_lists_of_reports_by_ranges(spark, tmp_path, monkeypatch, wrap, size):
    monkeypatch.setattr(ranges, "RANGE", size)
    rows = [{"id": f"r{i}", "note": 'a "[{' * (i % 3), "segment_id": f"s{i % 4}", "estimate": i, "occurred_at": "2026-01-02T03:04:05Z", "location": {"lat": i, "lon": -i}} for i in range(15 if size > 11 else 4)]
    (tmp_path / "r.json").write_text("  " + json.dumps(wrap(rows), indent=1))
    got = readers.reports_json(spark, str(tmp_path / "r.json")).collect()
    assert sorted((r.report_id, r.note, r.lat, r.lon) for r in got) == sorted((r["id"], r["note"], r["location"]["lat"], r["location"]["lon"]) for r in rows)
    last = {r["segment_id"]: float(r["estimate"]) for r in rows}
    assert {r.segment_id: r.estimate for r in readers.exposure_json(spark, str(tmp_path / "r.json")).collect()} == last
