"""Stateful streams against the batch operators, with late rows and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from tallygrid.functions import text as X
from tallygrid.operators import dedupe, governance
from tallygrid.plans import mapping as M
from tallygrid.streaming import dedupe as D
from tallygrid.streaming import intake, rights

REPORT = "report_id string, ts timestamp, epoch long, lat double, lon double, reporter_token string, hazard_type string, mode string"


def reports(n, seed, spread=0.0008):
    draw = random.Random(seed)
    rows, t = [], 1_767_225_600
    for i in range(n):
        t += draw.choice([0, 5, 60, 200, 700])
        # Two places either side of the border between tiles, and one far off.
        x, y = draw.choice([(-121.7, 38.5), (-121.7, 38.5), (-121.6, 38.55)])
        rows.append((f"r{i:05d}", t, y + draw.uniform(-spread, spread), x + draw.uniform(-spread, spread), draw.choice([None, "", "a", "b"]), draw.choice(["dooring", "debris", None]), draw.choice(["cyclist", "other"])))
    return rows


def frame(spark, rows):
    told = spark.createDataFrame([(r[0], *r[1:]) for r in rows], "report_id string, epoch long, lat double, lon double, reporter_token string, hazard_type string, mode string")
    return told.select("report_id", F.timestamp_seconds("epoch").alias("ts"), "epoch", "lat", "lon", "reporter_token", "hazard_type", "mode")


def write(spark, rows, folder, name):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


END = ("end", 2_000_000_000, 0.0, 0.0, None, None, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_replayed_stream_settles_as_the_batch(spark, tmp_path, seed):
    rows = reports(400, seed, 0.0003)
    draw = random.Random(seed)
    # Rows come up to eight minutes late, in seven files; the stream is stopped and started again for each.
    order = sorted(rows, key=lambda r: r[1] + draw.uniform(0, 480))
    parts = [order[i * 60 : (i + 1) * 60] for i in range(7)] + [[END]]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i, part in enumerate(parts):
        write(spark, part, source, f"p{i}")
        stream = spark.readStream.schema(REPORT).option("recursiveFileLookup", "true").parquet(source)
        settled = intake.replay(D.dedupe_stream(stream, M.PLANE), out, state)
    got = {r.report_id: (r.stays, r.sure) for r in settled.collect()}
    kept = {r.report_id for r in dedupe.dedupe(frame(spark, rows), M.PLANE).select("report_id").collect()}
    assert settled.count() == len(got) == len(rows) and all(sure for _, sure in got.values())
    assert {i for i, (stays, _) in got.items() if stays} == kept and 0 < len(kept) < len(rows)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    first = [("a", 1000, 38.5, -121.7, "t", "debris", "other"), ("b", 9000, 38.5, -121.7, "t", "debris", "other")]
    late = [("c", 1001, 38.5, -121.7, "t", "debris", "other"), ("d", 8500, 38.5, -121.7, "t", "debris", "other"), END]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i, part in enumerate((first, late)):
        write(spark, part, source, f"p{i}")
        stream = spark.readStream.schema(REPORT).option("recursiveFileLookup", "true").parquet(source)
        got = intake.replay(D.dedupe_stream(stream, M.PLANE), out, state)
    # d comes late but in time, so b repeats it.
    assert {r.report_id: r.stays for r in got.collect()} == {"a": True, "d": True, "b": False}


def test_chains_beyond_the_halo_are_told_as_unsure(spark, tmp_path):
    # A report every minute, each 14 m further east, over more than the halo, towards and across a border of tiles.
    lon = lambda m: -121.7 + m / M.PLANE.per_lon
    rows = [(f"r{i:03d}", 1000 + 60 * i, 38.51, lon(1500 + 14 * i), "t", None, None) for i in range(60)]
    write(spark, [*rows, END], str(tmp_path / "in"), "p")
    stream = spark.readStream.schema(REPORT).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = intake.replay(D.dedupe_stream(stream, M.PLANE, halo_m=30.0), str(tmp_path / "out"), str(tmp_path / "state")).collect()
    kept = {r.report_id for r in dedupe.dedupe(frame(spark, rows), M.PLANE).select("report_id").collect()}
    assert len(got) == 60 and not all(r.sure for r in got)
    assert all((r.report_id in kept) == r.stays for r in got if r.sure)
    with pytest.raises(ValueError, match="halo"):
        D.dedupe_stream(stream, M.PLANE, halo_m=10.0)


def test_settled_state_is_dropped(spark, tmp_path):
    for i in range(6):
        write(spark, [(f"r{i}{j}", 10_000 * (i + 1) + j, 38.5, -121.7, None, "debris", "other") for j in range(50)], str(tmp_path / "in"), f"p{i}")
    write(spark, [END], str(tmp_path / "in"), "p9")
    stream = spark.readStream.schema(REPORT).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = D.dedupe_stream(stream, M.PLANE).writeStream.format("memory").queryName("settled").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert spark.sql("select count_if(stays) from settled").first()[0] == 6 and max(held) < 150 and held[-1] <= 6


DELETION = "report_id string, ts timestamp"


def test_lives_equal_the_batch_purge(spark, tmp_path):
    day = 86_400
    rows = [(f"r{i:03d}", 1_767_225_600 + i * day // 4) for i in range(200)]
    gone = [(r, t + 2 * day) for r, t in rows[::7]] + [("r005", rows[4][1]), ("never", rows[0][1])]
    held = []
    for i in range(4):
        part = rows[i * 50 : (i + 1) * 50]
        spark.createDataFrame(part, "report_id string, epoch long").select("report_id", F.timestamp_seconds("epoch").alias("ts"), "epoch").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
        mine = [g for g in gone if part[0][1] <= g[1] <= part[-1][1]]
        spark.createDataFrame(mine, "report_id string, e long").select("report_id", F.timestamp_seconds("e").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "gone" / f"p{i}"))
        read = lambda schema, name: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / name))
        lives = rights.report_lives(read("report_id string, ts timestamp, epoch long", "in"), read(DELETION, "gone"), 15)
        query = lives.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        came = [r for r in rows[: (i + 1) * 50]]
        told = spark.read.parquet(str(tmp_path / "out"))
        now = max([came[-1][1], *(t for _, t in gone if t <= part[-1][1])])
        at = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        batch = governance.retention_purge(spark.createDataFrame(came, "report_id string, epoch long").withColumn("occurred_at", at("epoch")), now, 15)
        known = {r for r, t in gone if t <= part[-1][1]}
        stones = spark.createDataFrame([(r,) for r in known], "report_id string").select(X.tombstone_key(F.col("report_id")).alias("hash"))
        want = {X_ for (X_,) in governance.tombstone_anti(batch, stones).select(X.tombstone_key(F.col("report_id"))).collect()}
        assert {r.hash for r in rights.standing(told).collect()} == want and want
    # 15 days of four reports, and deletions of reports that never came.
    assert max(held[1:]) <= 75


def test_a_report_is_held_against_those_it_may_repeat_only():
    looks = []

    class Report:
        def __init__(self, i, token, kind):
            self.report_id, self.lat, self.lon, self.token, self.kind, self.home, self.edge = f"r{i:05d}", 38.5, -121.7, token, kind, True, 100.0
            self._epoch = 1000 + i // 10

        @property
        def epoch(self):
            looks.append(1)
            return self._epoch

    n = 4000
    # All in one spot and window: half of a reporter of their own each, half of a kind of its own each; every tenth repeats the one before.
    rows = [Report(i, f"u{i - (i % 10 == 9)}" if i % 20 < 10 else None, f"k{i - (i % 10 == 9)}") for i in range(n)]
    got = {r.report_id: r.stays for r in D.settle(rows, [], 15.0, 600)}
    assert [i for i in range(n) if not got[f"r{i:05d}"]] == list(range(9, n, 10))
    assert len(looks) < 20 * n


@pytest.mark.parametrize("groups", [1, 3])
def test_lives_of_a_group_are_told_one_by_one(spark, tmp_path, groups):
    """Few entries of the state hold many reports; what is told of each is as if it were alone, over several batches."""
    day, start = 86_400, 1_767_225_600
    parts = [
        ([("a", 0), ("b", 1), ("b", 1), ("c", 2)], [("c", 2), ("early", 3)]),
        ([("early", 2), ("d", 9)], [("b", 5)]),
        ([("a", 0), ("e", 18)], []),
        ([("f", 40)], []),
        ([("g", 41)], []),
    ]
    held = []
    for i, (came, gone) in enumerate(parts):
        told = lambda rows: spark.createDataFrame(rows, "report_id string, d long").select("report_id", F.timestamp_seconds(start + F.col("d") * day).alias("ts"), (start + F.col("d") * day).alias("epoch"))
        told(came).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
        told(gone).drop("epoch").coalesce(1).write.parquet(str(tmp_path / "gone" / f"p{i}"))
        read = lambda schema, name: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / name))
        lives = rights.report_lives(read("report_id string, ts timestamp, epoch long", "in"), read(DELETION, "gone"), 15, groups)
        query = lives.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    names = {r.hash: r.report_id for r in spark.createDataFrame([(x,) for x in "abcdefg"], "report_id string").select("report_id", X.tombstone_key(F.col("report_id")).alias("hash")).collect()}
    rows = sorted((names.get(r.hash, r.hash), r.seq, (r.epoch - start) // day, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [
        ("a", 1, 0, "kept"), ("a", 2, 0, "expired"), ("b", 1, 1, "kept"), ("b", 2, 1, "deleted"), ("c", 1, 2, "kept"), ("c", 2, 2, "deleted"),
        ("d", 1, 9, "kept"), ("d", 2, 9, "expired"), ("e", 1, 18, "kept"), ("e", 2, 18, "expired"), ("f", 1, 40, "kept"), ("g", 1, 41, "kept"),
    ]
    assert max(held) <= groups
