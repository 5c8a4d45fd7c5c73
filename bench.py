"""Timings of the headline queries: prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the threads. `city_6000` and `city_20000`
are whole runs (deduplicate, geocode, snap, flag; rates, Gi*, KDE, bias) over grid cities of
300 segments and 6,000 reports, and of 800 and 20,000.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallygrid.functions import text as X  # noqa: E402
from tallygrid.functions.geo import Plane, polyline_centroid  # noqa: E402
from tallygrid.operators import city, rates, surfaces  # noqa: E402
from tallygrid.plans import registry  # noqa: E402

HEADLINE = (
    "unit_analyze", "segment_statistics", "snap_nearest", "dedupe_greedy", "run_pipeline", "kde_surface", "rates_by_type",
    "bias_shares", "getis_ord_star", "network_neighbors", "spearman", "bh_fdr", "state_public_cells", "crash_mode_rollup",
    "crash_join_violations", "county_feasibility", "weather_join", "vintage_diff",
)
PLANE = Plane(38.5, -121.7)


def grid_city(spark: SparkSession, segments: int, reports: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    side = int(segments**0.5) + 1
    i = F.col("id")
    lat, lon = 38.5 + F.floor(i / side) * 0.002, -121.7 + (i % side) * 0.003
    segs = spark.range(segments).select(
        i.alias("pos"), F.concat(F.lit("s"), F.lpad(i.cast("string"), 5, "0")).alias("segment_id"), F.concat(F.lit("St "), i.cast("string")).alias("name"),
        F.array(F.struct(lat.alias("lat"), lon.alias("lon")), F.struct(lat.alias("lat"), (lon + 0.003).alias("lon"))).alias("coords"),
    )
    s = F.pmod(F.xxhash64("id"), F.lit(segments))
    at = F.concat(F.date_format(F.timestamp_seconds(1767225600 + i * 977 % 15_000_000), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    reps = spark.range(reports).select(
        F.lpad(i.cast("string"), 8, "0").alias("report_id"), at.alias("occurred_at"),
        (38.5 + F.floor(s / side) * 0.002 + (i % 7 - 3) * 0.00002).alias("lat"), (-121.7 + (s % side) * 0.003 + (i % 29) * 0.0001).alias("lon"),
        F.lit("cyclist").alias("mode"), F.get(F.array(*(F.lit(h) for h in X.HAZARDS)), (i % 7).cast("int")).alias("hazard_type"),
        F.lit("near_miss").alias("severity"), F.lit(5.0).alias("accuracy_m"), F.lit(None).cast("string").alias("reporter_token"),
        F.lit(None).cast("string").alias("address"), X.epoch(at).alias("epoch"),
    )
    exposure = segs.select("segment_id", (500.0 + F.col("pos") % 9 * 100).alias("estimate"), F.lit("observed").alias("tier"))
    return segs, reps, exposure


def run_city(spark: SparkSession, segments: int, reports: int) -> int:
    segs, reps, exposure = (f.cache() for f in grid_city(spark, segments, reports))
    clean = city.run_pipeline(reps, segs, PLANE).cache()
    stats = city.segment_statistics(clean, segs, exposure, PLANE).cache()
    n = len(stats.drop("coords").collect())
    rates.bias_shares(stats.select("segment_id", "n"), exposure).collect()
    peak = surfaces.kde_peak(surfaces.kde_surface(reps, PLANE))
    cents = segs.withColumn("c", polyline_centroid(F.col("coords"))).select("segment_id", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"))
    surfaces.peak_segment(peak, cents).collect()
    spark.catalog.clearCache()
    return n


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = {}
    jobs = {n: (lambda n=n: registry.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()) for n in HEADLINE}
    jobs |= {f"city_{r}": (lambda s=s, r=r: run_city(spark, s, r)) for s, r in ((300, 6000), (800, 20_000))}
    run_city(spark, 20, 100)  # code is compiled and classes are loaded before anything counts
    for name, job in jobs.items():
        began = time.time()
        job()
        found[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
