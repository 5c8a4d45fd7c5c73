"""Table functions from SQL against the column functions, and look-ups that ask once."""

import json

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import geo
from tallygrid.operators import network
from tallygrid.sources import lookups
from tallygrid.sql import tables

PLANE = geo.Plane(38.5, -121.7)


def test_points_along_lines(spark):
    tables.register(spark)
    rows = [(1, "a", [(38.5, -121.7), (38.501, -121.7), (38.501, -121.7), (38.5005, -121.6987)]), (2, "b", [(38.5, -121.7)]), (3, "c", None), (4, "d", [])]
    lines = spark.createDataFrame(rows, "id int, x string, coords array<struct<lat: double, lon: double>>")
    lines.createOrReplaceTempView("lines")
    got = spark.sql("SELECT * FROM densify_lines(TABLE(lines), 30.0, 38.5, -121.7)")
    assert got.columns == ["id", "place", "x", "y"]
    want = lines.where("size(coords) > 0").select("id", F.posexplode(geo.densify(F.col("coords"), PLANE, 30.0)).alias("place", "p")).select("id", "place", "p.x", "p.y").orderBy("id", "place").collect()
    assert [tuple(r) for r in got.orderBy("id", "place").collect()] == [tuple(r) for r in want] and len(want) > 8
    for bad, message in (("TABLE(lines), 0.0", "above 0"), ("TABLE(SELECT 1 AS a), 1.0", "no column coords"), ("1, 1.0", "must be a table")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT * FROM densify_lines({bad}, 38.5, -121.7)")


def test_ways_from_sql_are_those_of_the_function(spark):
    tables.register(spark)
    at = {n: (float(n), n / 10) for n in range(12)}
    ways = spark.createDataFrame([(1, [at[i] for i in (0, 1, 2, 3)]), (2, [at[i] for i in (4, 2, 5)]), (3, [at[6]]), (4, [at[7], at[8], at[7]]), (5, [at[3], at[9]])], "way_id int, nodes array<struct<lat: double, lon: double>>")
    nodes = ways.select("way_id", F.posexplode("nodes").alias("i", "p")).select("way_id", "i", "p.lat", "p.lon")
    shared = nodes.groupBy("lat", "lon").agg((F.count_distinct("way_id") >= 2).alias("shared"))
    nodes.join(shared, ["lat", "lon"]).repartition(3, "i").createOrReplaceTempView("nodes")
    got = spark.sql("SELECT * FROM split_ways(TABLE(nodes))").orderBy("way_id", "piece").collect()
    want = network.split_ways(ways).orderBy("way_id", "piece").collect()
    assert [(r.way_id, r.piece, [tuple(p) for p in r.coords]) for r in got] == [(r.way_id, r.piece, [tuple(p) for p in r.coords]) for r in want]


def service(log, fails=()):
    """A transport that writes down what it was asked, in a file that all tasks share."""

    def ask(url, headers):
        import urllib.parse

        address = urllib.parse.parse_qs(urllib.parse.urlparse(url).query)["q"][0]
        with open(log, "a") as f:
            f.write(address + "\n")
        if address in fails:
            raise ConnectionError("down")
        if address == "strange":
            return "{}"
        return json.dumps([{"lat": "1.5", "lon": "2.5"}] if address.lower().startswith("main") else [])

    return ask


def test_second_run_asks_nothing_and_failures_are_told(spark, tmp_path):
    log, table = tmp_path / "log", str(tmp_path / "answers")
    rows = spark.createDataFrame([("Main St 1",), ("main  st 1 ",), ("nowhere",), ("broken",), ("strange",), (None,), (" ",)], "address string")
    ask = lambda **how: {r.key: (r.lat, r.lon, r.status, r.problem) for r in lookups.look_up(rows, table, service(str(log), **how), per_second=1000.0, tasks=2, attempts=2).collect()}
    first = ask(fails=("broken",))
    assert first["main st 1"][:3] == (1.5, 2.5, "found") and first["nowhere"] == (None, None, "unknown", None) and len(first) == 4
    assert first["broken"] == (None, None, "failed", "ConnectionError: down") and first["strange"][2:] == ("failed", "ValueError: the answer is no list")
    asked = log.read_text().split("\n")
    assert asked.count("broken") == asked.count("strange") == 2 and asked.count("nowhere") == 1 and sum(a.lower().startswith("main") for a in asked) == 1
    log.write_text("")
    second = ask()
    assert second["broken"] == (None, None, "unknown", None) and sorted(set(log.read_text().split())) == ["broken", "strange"]
    log.write_text("")
    some = rows.where("address <> 'strange'")
    assert lookups.look_up(some, table, service(str(log))).count() == 3 and log.read_text() == ""
    reports = spark.createDataFrame([(1, "MAIN st 1", 0.0, 0.0), (2, "nowhere", 0.0, 0.0), (3, "main st 1", 5.0, 6.0)], "id int, address string, lat double, lon double")
    got = lookups.placed(reports, lookups.look_up(some, table, service(str(log))))
    assert sorted((r.id, r.lat, r.lon) for r in got.collect()) == [(1, 1.5, 2.5), (2, 0.0, 0.0), (3, 5.0, 6.0)]


def test_the_rate_is_kept(spark, tmp_path):
    import time

    rows = spark.createDataFrame([(f"x{i}",) for i in range(6)], "address string")
    began = time.time()
    assert lookups.look_up(rows, str(tmp_path / "a"), service(str(tmp_path / "log")), per_second=5.0).count() == 6
    assert time.time() - began > 1.0


def test_ways_are_cut_alike_in_any_batches():
    """A group of ways in one batch, in batches of a few rows, and row by row, against each node in turn."""
    import random

    import pyarrow as pa

    draw, rows = random.Random(4), []
    for way in [None, *range(60)]:
        some = draw.choice([0.0, 0.2, 0.7])
        rows += [(way, float(len(rows) + i), None if draw.random() < 0.1 else -float(i), draw.choice([True, True, None]) if draw.random() < some else False) for i in range(draw.choice([1, 1, 2, 3, 9, 40]))]
    want, held = [], {}
    for k, (way, lat, lon, shared) in enumerate(rows):
        piece, points = held.get(way, (0, []))
        points = [*points, (lat, lon)]
        last = k + 1 == len(rows) or rows[k + 1][0] != way
        if len(points) > 1 and (shared or last):
            want.append((way, piece, points))
            piece, points = piece + 1, [(lat, lon)]
        held[way] = piece, points
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.float64(), pa.float64(), pa.bool_()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["way_id", "lat", "lon", "shared"])
    for step in (1, 2, 7, 64, len(rows)):
        cutter = tables.SplitWayBatches()
        out = [t for i in range(0, len(rows), step) for t in cutter.eval(batch.slice(i, step))] + list(cutter.terminate())
        got = [(r["way_id"], r["piece"], [(p["lat"], p["lon"]) for p in r["coords"]]) for t in out for r in t.to_pylist()]
        assert got == want and len(want) > 100
