"""Queries of the city pipeline and its statistics over the test tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import numerics as N
from ..functions import text as X
from ..operators import calibration, city, dedupe, hotspot, network, packed, ranks, rates, spatial, surfaces
from . import mapping as M
from .registry import query, r, sr

Z = "1.96e0"


def s_cube(x: str) -> str:
    return f"(({x}) * ({x}) * ({x}))"


def s_low(n: str, e: str, z: str = Z) -> str:
    c = s_cube(f"1e0 - 1e0 / (9e0 * {n}) - {z} / (3e0 * sqrt({n}))")
    return f"(CASE WHEN {e} > 0 THEN (CASE WHEN {n} = 0 THEN 0e0 ELSE greatest(0e0, {n} * {c}) END) * (1000e0 / {e}) END)"


def s_high(n: str, e: str, z: str = Z) -> str:
    c = s_cube(f"1e0 - 1e0 / (9e0 * ({n} + 1)) + {z} / (3e0 * sqrt({n} + 1))")
    return f"(CASE WHEN {e} > 0 THEN ({n} + 1) * {c} * (1000e0 / {e}) END)"


def s_rate(n: str, e: str) -> str:
    return f"(CASE WHEN {e} > 0 THEN {n} * (1000e0 / {e}) END)"


def s_erfc(x: str) -> str:
    """By the series of erf without cancellation under 2, by the continued fraction above: not as the columns do it."""
    series = f"({x}) * list_reduce([1e0] || list_transform(range(60, 0, -1), lambda i: i * 1e0), lambda acc, i: 1e0 + acc * 2e0 * ({x}) * ({x}) / (2e0 * i + 1e0))"
    fraction = f"list_reduce([{x}] || list_transform(range(120, 0, -1), lambda i: i * 1e0), lambda acc, i: ({x}) + i / 2e0 / acc)"
    bell = f"exp(-(({x}) * ({x}))) / sqrt(pi())"
    return f"(CASE WHEN ({x}) < 2e0 THEN 1e0 - 2e0 * {bell} * ({series}) ELSE {bell} / ({fraction}) END)"


def s_p(z: str) -> str:
    return s_erfc(f"abs({z}) / {2**0.5!r}e0")


def s_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a, b = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    return f"(2 * 6371000e0 * asin(least(1e0, sqrt({a} * {a} + cos(radians({lat1})) * cos(radians({lat2})) * {b} * {b}))))"


_HOUR = "CAST(substr(occurred_at, 12, 2) AS INT)"
_PART = "(CASE " + " ".join(f"WHEN {_HOUR} BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in X.PARTS_OF_DAY) + " END)"
_DAY = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(CAST(substr(occurred_at, 1, 10) AS DATE))]"


def attached(spark: SparkSession, d: str) -> DataFrame:
    segs = M.segments(spark, d).join(rates.segment_aggregate(M.clean(spark, d)), "segment_id", "left")
    return rates.attach_exposure(segs, M.exposure(spark, d)).withColumns({"n": F.coalesce("n", F.lit(0)), "n_primary": F.coalesce("n_primary", F.lit(0))})


def rated(spark: SparkSession, d: str) -> DataFrame:
    return rates.segment_rates(attached(spark, d))


_RATED = f"""rated AS (SELECT *, {s_rate('n_primary', 'estimate')} AS rate, {s_low('n_primary', 'estimate')} AS rate_ci_low,
  {s_high('n_primary', 'estimate')} AS rate_ci_high, NOT (n > 0 AND n < 3) AS publishable FROM attached)"""


# ---------------------------------------------------------------- pipeline


@query(M.sql("reports", """SELECT substr(occurred_at, 1, 10) BETWEEN '2024-01-05' AND '2024-01-20' AS inside, count(*) AS n
FROM reports GROUP BY 1"""))
def window_filter(spark, d):
    inside, outside = city.window_filter(M.reports(spark, d), "2024-01-05", "2024-01-20")
    both = inside.select(F.lit(True).alias("inside")).unionByName(outside.select(F.lit(False).alias("inside")))
    return both.groupBy("inside").agg(F.count("*").alias("n"))


@query(M.sql("clean", "SELECT hazard_type, count(*) AS n FROM clean GROUP BY 1"))
def classify(spark, d):
    return M.reports(spark, d).select(X.classify(F.col("hazard_type")).alias("hazard_type")).groupBy("hazard_type").agg(F.count("*").alias("n"))


@query(M.sql("clean", f"SELECT report_id, segment_id, {sr('snapped_distance_m', 3)} AS snapped_distance_m FROM clean"))
def snap_nearest(spark, d):
    return M.clean(spark, d).select("report_id", "segment_id", r("snapped_distance_m", 3))


@query(M.sql("snapped", f"SELECT report_id, segment_id, {sr('snapped_distance_m', 3)} AS snapped_distance_m FROM snapped"))
def snap_packed(spark, d):
    """Snapping through pages of edges, here of four."""
    return packed.snap_packed(M.reports(spark, d), M.segments(spark, d), M.PLANE, M.SNAP_M, 4).select("report_id", "segment_id", r("snapped_distance_m", 3))


@query(M.sql("far", f"""SELECT report_id, CASE WHEN m > 25e0 + 1e-6 OR m IS NULL THEN 'unsnapped' WHEN c > 1 THEN 'ambiguous' ELSE 'snapped' END AS status,
  CASE WHEN m <= 25e0 + 1e-6 AND c > 1 THEN ids END AS competitors
FROM reports LEFT JOIN (
  SELECT f.report_id, any_value(m) AS m, count(*) AS c, string_agg(segment_id, ',' ORDER BY segment_id) AS ids
  FROM far f JOIN (SELECT report_id, min(d) AS m FROM far GROUP BY report_id) b USING (report_id) WHERE d - m <= 5e0 + 1e-6 GROUP BY f.report_id) USING (report_id)"""))
def snap_unambiguous(spark, d):
    out = spatial.snap_unambiguous(M.reports(spark, d), M.segments(spark, d), M.PLANE)
    return out.select("report_id", "status", F.array_join("competitors", ",").alias("competitors"))


@query(M.sql("clean", """SELECT report_id, concat_ws(',', CASE WHEN unsnapped THEN 'unsnapped' END, CASE WHEN low_accuracy THEN 'low_accuracy' END,
  CASE WHEN far_snap THEN 'far_snap' END) AS flags FROM clean"""))
def quality_flags(spark, d):
    return M.clean(spark, d).select("report_id", F.array_join("quality_flags", ",").alias("flags"))


_PAIRS = f"""pairs AS (SELECT a.report_id AS a, b.report_id AS b FROM reports a JOIN reports b
  ON a.home = b.home AND (a.epoch < b.epoch OR (a.epoch = b.epoch AND a.report_id < b.report_id)) AND b.epoch - a.epoch <= 600
  WHERE CASE WHEN a.reporter_token IS NOT NULL AND b.reporter_token IS NOT NULL THEN a.reporter_token = b.reporter_token
    ELSE a.hazard_type = b.hazard_type AND a.mode = b.mode END
  AND {s_haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 15e0)"""


@query(M.sql("reports", "SELECT a, b FROM pairs", _PAIRS))
def duplicate_pairs(spark, d):
    return dedupe.duplicate_pairs(M.reports(spark, d), M.PLANE).select("a", "b")


_GREEDY = """nodes AS (SELECT p.b, row_number() OVER (ORDER BY r.epoch, p.b) AS i, p.earlier FROM (SELECT b, list(a) AS earlier FROM pairs GROUP BY b) p JOIN reports r ON r.report_id = p.b),
greedy(i, gone) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT n.i, CASE WHEN len(list_filter(n.earlier, lambda x: NOT list_contains(g.gone, x))) > 0 THEN list_append(g.gone, n.b) ELSE g.gone END FROM greedy g JOIN nodes n ON n.i = g.i + 1),
gone AS (SELECT unnest(gone) AS report_id FROM greedy QUALIFY i = max(i) OVER ())"""


@query(M.sql("reports", "SELECT report_id FROM reports WHERE report_id NOT IN (SELECT report_id FROM gone)", _PAIRS + ",\n" + _GREEDY).replace("WITH ", "WITH RECURSIVE ", 1))
def dedupe_greedy(spark, d):
    return dedupe.dedupe(M.reports(spark, d), M.PLANE).select("report_id")


@query("""WITH g AS (SELECT regexp_replace(trim(lower(n_name)), '\\s+', ' ', 'g') AS key, n_nationkey * 1e0 AS lat, n_nationkey * 2e0 AS lon FROM nation)
SELECT c_custkey, coalesce(g.lat, 0e0) AS lat, coalesce(g.lon, 0e0) AS lon FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN g ON g.key = regexp_replace(trim(lower(CASE WHEN c_custkey % 3 = 0 THEN 'nowhere' ELSE n_name END)), '\\s+', ' ', 'g')""")
def geocode_join(spark, d):
    nations = M.table(spark, d, "nation")
    gaz = nations.select(X.address_key(F.col("n_name")).alias("key"), (F.col("n_nationkey") * 1.0).alias("lat"), (F.col("n_nationkey") * 2.0).alias("lon"))
    c = M.table(spark, d, "customer")
    rows = c.join(spatial.bounded_broadcast(nations), c.c_nationkey == nations.n_nationkey).select(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, "nowhere").otherwise(F.concat(F.lit("  "), F.upper("n_name"), F.lit(" "))).alias("address"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"),
    )
    return spatial.geocode(rows, gaz).select("c_custkey", "lat", "lon")


_INSIDE = "inside AS (SELECT * FROM reports WHERE substr(occurred_at, 1, 10) BETWEEN '2024-01-02' AND '2024-01-28')"
_RUN = ",\n".join([_INSIDE, _PAIRS.replace("reports", "inside"), _GREEDY, """ran AS (SELECT * FROM clean WHERE report_id IN (SELECT report_id FROM inside) AND report_id NOT IN (SELECT report_id FROM gone))"""])


@query(M.sql("clean", """SELECT report_id, segment_id, hazard_type, concat_ws(',', CASE WHEN unsnapped THEN 'unsnapped' END, CASE WHEN low_accuracy THEN 'low_accuracy' END,
  CASE WHEN far_snap THEN 'far_snap' END) AS flags FROM ran""", _RUN).replace("WITH ", "WITH RECURSIVE ", 1))
def run_pipeline(spark, d):
    return city.run_pipeline(M.reports(spark, d), M.segments(spark, d), M.PLANE, "2024-01-02", "2024-01-28").select("report_id", "segment_id", "hazard_type", F.array_join("quality_flags", ",").alias("flags"))


@query(M.sql("clean", """SELECT (SELECT count(*) FROM reports) AS reports_in, (SELECT count(*) FROM reports) - (SELECT count(*) FROM inside) AS out_of_window,
  (SELECT count(*) FROM gone) AS duplicates_removed, count(segment_id) AS snapped, count(*) - count(segment_id) AS unsnapped FROM ran""", _RUN).replace("WITH ", "WITH RECURSIVE ", 1))
def stage_summary(spark, d):
    return city.stage_summary(M.reports(spark, d), M.segments(spark, d), M.PLANE, "2024-01-02", "2024-01-28")


@query(M.sql("clean", f"SELECT {sr('count(*) FILTER (low_accuracy OR far_snap) / count(*)')} AS excluded_fraction FROM clean WHERE segment_id IS NOT NULL"))
def excluded_fraction(spark, d):
    return rates.excluded_fraction(M.clean(spark, d))


_COUNTERS = """counters AS (SELECT s_suppkey AS counter_id, 38.5e0 + (s_suppkey % 6) * 0.0025e0 + (s_suppkey % 5) * 0.0002e0 AS lat,
  -121.7e0 + (s_suppkey % 10 + 0.5e0) * 0.003e0 AS lon, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(floor(s_acctbal) AS DOUBLE) END AS count FROM supplier),
snapped_counts AS (SELECT counter_id, CASE WHEN (counter_id % 5) * 0.0002e0 * 110540e0 <= 30e0 THEN 'seg-' || lpad(CAST(counter_id % 6 * 10 + counter_id % 10 AS VARCHAR), 2, '0') END AS segment_id, count
  FROM counters WHERE count > 0)"""


def _snapped_counts(spark, d):
    k = F.col("s_suppkey")
    counters = M.table(spark, d, "supplier").select(
        k.alias("counter_id"), (38.5 + (k % 6) * 0.0025 + (k % 5) * 0.0002).alias("lat"), (-121.7 + (k % 10 + 0.5) * 0.003).alias("lon"),
        F.when(k % 9 != 0, F.floor("s_acctbal").cast("double")).alias("count"),
    )
    return rates.counter_snap(counters, M.segments(spark, d), M.PLANE)


@query(M.sql("", "SELECT counter_id, segment_id, count FROM snapped_counts", _COUNTERS))
def counter_snap(spark, d):
    return _snapped_counts(spark, d)


@query(M.sql("segments", f"""SELECT segment_id, {sr('estimate')} AS estimate, 'counters' AS source, '2024-01-31' AS date FROM known
UNION ALL SELECT segment_id, {sr('(SELECT median(estimate) FROM known)')}, 'modeled_flat_prior (counters)', '2024-01-31' FROM segments WHERE segment_id NOT IN (SELECT segment_id FROM known)""",
  _COUNTERS + ", known AS (SELECT segment_id, avg(count) AS estimate FROM snapped_counts WHERE segment_id IS NOT NULL GROUP BY 1)"))
def exposure_build(spark, d):
    return rates.build_exposure(_snapped_counts(spark, d), M.segments(spark, d), "counters", "2024-01-31", "mean", True).withColumn("estimate", r("estimate"))


@query(M.sql("attached", f"""SELECT segment_id, 'rgb(' || floor(220 + (20 - 220) * s + 0.5e0)::INT || ', ' || floor(232 + (91 - 232) * s + 0.5e0)::INT || ', ' || floor(235 + (115 - 235) * s + 0.5e0)::INT || ')' AS color
FROM (SELECT segment_id, sqrt(n / greatest(1, max(n) OVER ())) AS s FROM attached)"""))
def map_color(spark, d):
    a = attached(spark, d)
    return a.crossJoin(F.broadcast(a.agg(F.max("n").alias("most")))).select("segment_id", rates.map_color(F.col("n"), F.col("most")).alias("color"))


@query(M.sql("reports", f"SELECT {sr('avg(lat)', 7)} AS lat0, {sr('avg(lon)', 7)} AS lon0 FROM reports"))
def reference_point(spark, d):
    plane = geo.reference_point(M.reports(spark, d))
    return spark.range(1).select(r(F.lit(plane.lat0), 7).alias("lat0"), r(F.lit(plane.lon0), 7).alias("lon0"))


@query(M.sql("reports", "SELECT count(*) AS n FROM reports WHERE lon BETWEEN -121.695e0 AND -121.68e0 AND lat BETWEEN 38.501e0 AND 38.509e0"))
def bbox_filter(spark, d):
    return M.reports(spark, d).where(spatial.bbox(-121.695, 38.501, -121.68, 38.509)).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- rates


@query(M.sql("counted", "SELECT * FROM counted"))
def segment_aggregate(spark, d):
    return rates.segment_aggregate(M.clean(spark, d)).select("segment_id", "n", "n_primary")


@query(M.sql("clean", """SELECT segment_id, CAST(sum(n) AS BIGINT) AS n, CASE WHEN sum(n) >= 5 THEN string_agg(hazard_type || '=' || n, ',' ORDER BY hazard_type) END AS breakdown
FROM (SELECT segment_id, hazard_type, count(*) AS n FROM clean WHERE segment_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""))
def hazard_breakdown(spark, d):
    out = rates.hazard_breakdown(M.clean(spark, d))
    pairs = F.transform(F.map_entries("hazard_breakdown"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("segment_id", "n", F.array_join(pairs, ",").alias("breakdown"))


@query(M.sql("attached", "SELECT segment_id, estimate, tier FROM attached"))
def attach_exposure(spark, d):
    return attached(spark, d).select("segment_id", "estimate", "tier")


@query(M.sql("segments exposure", "SELECT segment_id FROM exposure WHERE segment_id NOT IN (SELECT segment_id FROM segments WHERE pos % 5 <> 0)"))
def exposure_mismatch(spark, d):
    return rates.exposure_mismatch(M.segments(spark, d).where("pos % 5 <> 0"), M.exposure(spark, d))


@query(M.sql("attached", "SELECT count(*) AS segments, count(*) FILTER (estimate > 0) AS usable, count(*) FILTER (estimate > 0) / count(*) AS coverage FROM attached"))
def exposure_coverage(spark, d):
    return rates.exposure_coverage(attached(spark, d))


@query(f"""SELECT k, {sr('lo / hi')} AS ratio, {sr('1 - lo / hi')} AS disagreement FROM (
SELECT o_custkey AS k, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY 1) WHERE n >= 2""")
def corroboration(spark, d):
    o = M.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list("o_totalprice").alias("readings"))
    ratio, other = rates.corroboration(F.col("readings"))
    return o.select("k", r(ratio).alias("ratio"), r(other).alias("disagreement")).where("ratio is not null")


@query(M.sql("exposure", "SELECT segment_id, abs(epoch(CAST(date AS TIMESTAMP)) - epoch(TIMESTAMP '2024-01-01')) > 365 * 86400 AS stale FROM exposure"))
def is_stale(spark, d):
    at = lambda c: F.unix_timestamp(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return M.exposure(spark, d).select("segment_id", rates.is_stale(at(F.col("date")), at(F.lit("2024-01-01"))).alias("stale"))


@query(M.sql("reports", "SELECT max(occurred_at) AS reference FROM reports"))
def reference_date(spark, d):
    return rates.reference_date(M.reports(spark, d))


@query(M.sql("attached", f"""SELECT count(*) AS units, {sr('sum((n - t * estimate) * (n - t * estimate) / (t * estimate)) / (count(*) - 1)')} AS phi
FROM attached, (SELECT sum(n) / sum(estimate) AS t FROM attached WHERE estimate > 0) WHERE estimate > 0"""))
def dispersion(spark, d):
    return rates.dispersion(attached(spark, d)).select("units", r("phi"))


@query(M.sql("attached", f"""SELECT segment_id, n, {sr('rate')} AS rate, {sr('rate_ci_low')} AS rate_ci_low, {sr('rate_ci_high')} AS rate_ci_high, publishable,
  CASE WHEN NOT coalesce(estimate > 0, false) THEN 'exposure_unknown' WHEN n < 5 THEN 'uncertain' ELSE 'certain' END AS confidence_label,
  CASE WHEN {s_rate('n', 'estimate')} < rate_ci_low OR {s_rate('n', 'estimate')} > rate_ci_high THEN {sr(s_rate('n', 'estimate') + ' - rate')} END AS delta
FROM rated""", _RATED))
def segment_rates(spark, d):
    return rated(spark, d).select(
        "segment_id", "n", r("rate"), r("rate_ci_low"), r("rate_ci_high"), "publishable", "confidence_label", r(F.col("rate_sensitivity_delta")).alias("delta")
    )


@query(M.sql("attached", f"""SELECT segment_id, concat_ws(',', CASE WHEN coalesce(abs(epoch(CAST(date AS TIMESTAMP)) - epoch(TIMESTAMP '1998-07-15')) > 7 * 86400, false) THEN 'exposure_stale' END,
  CASE WHEN NOT coalesce(estimate > 0, false) THEN 'exposure_unknown' END, CASE WHEN n > n_primary * 2 THEN 'geocode_low_confidence' END,
  CASE WHEN n > 0 AND n < 200 THEN 'low_sample' END) AS flags FROM attached"""))
def published_flags(spark, d):
    at = lambda c: F.unix_timestamp(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    stale = rates.is_stale(at(F.col("date")), at(F.lit("1998-07-15")), 7)
    flags = rates.published_flags(F.col("n"), 200, rates.usable(F.col("estimate")), stale, F.col("n") > F.col("n_primary") * 2)
    return attached(spark, d).select("segment_id", F.array_join(flags, ",").alias("flags"))


@query(M.sql("attached", f"""SELECT segment_id, {sr(f"greatest(0e0, n + (n * {s_cube('1e0 - 1e0 / (9e0 * n) - 1.96e0 / (3e0 * sqrt(n))')} - n) * sqrt(2.5e0))")} AS low,
  {sr(f"n + ((n + 1) * {s_cube('1e0 - 1e0 / (9e0 * (n + 1)) + 1.96e0 / (3e0 * sqrt(n + 1))')} - n) * sqrt(2.5e0)")} AS high FROM attached WHERE n > 0"""))
def quasi_poisson_ci(spark, d):
    n, phi = F.col("n"), F.lit(2.5)
    return attached(spark, d).where("n > 0").select(
        "segment_id", r(N.widened(n, N.byar_low(n, N.Z_CITY), phi)).alias("low"), r(N.widened(n, N.byar_high(n, N.Z_CITY), phi)).alias("high")
    )


@query(M.sql("clean exposure", f"""SELECT segment_id, hazard_type, n, {sr(s_rate('n', 'estimate'))} AS rate, {sr(s_low('n', 'estimate'))} AS rate_ci_low, {sr(s_high('n', 'estimate'))} AS rate_ci_high
FROM (SELECT segment_id, hazard_type, count(*) AS n FROM clean WHERE segment_id IS NOT NULL GROUP BY 1, 2) JOIN exposure USING (segment_id) WHERE n >= 5 AND estimate > 0"""))
def rates_by_type(spark, d):
    return rates.rates_by_type(M.clean(spark, d), M.exposure(spark, d)).select("segment_id", "hazard_type", "n", r("rate"), r("rate_ci_low"), r("rate_ci_high"))


@query(f"""SELECT o_orderpriority AS k, hits, n, {sr('greatest(0e0, centre - half)')} AS low, {sr('least(1e0, centre + half)')} AS high FROM (
  SELECT *, (p + 3.8416e0 / (2 * n)) / (1 + 3.8416e0 / n) AS centre, 1.96e0 * sqrt(p * (1 - p) / n + 3.8416e0 / (4e0 * n * n)) / (1 + 3.8416e0 / n) AS half FROM (
    SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS hits, count(*) FILTER (o_orderstatus = 'F') / count(*) AS p FROM orders GROUP BY 1))""")
def wilson_ci(spark, d):
    o = M.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("hits"), F.count("*").alias("n"))
    low, high = N.wilson(F.col("hits"), F.col("n"), 1.96)
    return o.select("k", "hits", "n", r(low).alias("low"), r(high).alias("high"))


_SHARES = """shares AS (SELECT segment_id, n / sum(n) OVER () AS report_share, estimate / sum(estimate) OVER () AS exposure_share,
  n / sum(n) OVER () - estimate / sum(estimate) OVER () AS difference FROM attached WHERE estimate > 0)"""


def _shares(spark, d):
    return rates.bias_shares(attached(spark, d).select("segment_id", "n"), M.exposure(spark, d))


@query(M.sql("attached", f"SELECT segment_id, {sr('report_share', 6)} AS report_share, {sr('exposure_share', 6)} AS exposure_share, {sr('difference', 6)} AS difference FROM shares", _SHARES))
def bias_shares(spark, d):
    return _shares(spark, d).select("segment_id", r("report_share", 6), r("exposure_share", 6), r("difference", 6))


@query(M.sql("attached", f"""SELECT side, place, segment_id, {sr('difference', 6)} AS difference FROM (
  SELECT 'over' AS side, CAST(row_number() OVER (ORDER BY difference DESC, segment_id) AS INT) AS place, * FROM shares WHERE difference > 0
  UNION ALL SELECT 'under', CAST(row_number() OVER (ORDER BY difference, segment_id) AS INT), * FROM shares WHERE difference < 0) WHERE place <= 3""", _SHARES))
def bias_extremes(spark, d):
    return rates.bias_extremes(_shares(spark, d)).select("side", "place", "segment_id", r("difference", 6))


@query(M.sql("attached", "SELECT segment_id, n, NOT (n > 0 AND n < 150) AS publishable FROM attached"))
def k_anonymity(spark, d):
    return attached(spark, d).select("segment_id", "n", rates.publishable(F.col("n"), 150).alias("publishable"))


# ---------------------------------------------------------------- hot spots and graph


_UNITS = """units AS (SELECT s.segment_id AS id, s.lat, (s.lon1 + s.lon2) / 2e0 AS lon, coalesce(c.n, 0) AS n, e.estimate AS exposure
  FROM segments s LEFT JOIN (SELECT home AS segment_id, count(*) AS n FROM reports GROUP BY 1) c USING (segment_id) LEFT JOIN exposure e USING (segment_id))"""
_GI = """whole AS (SELECT count(*) AS m, avg(value) AS mean, stddev_pop(value) AS sd FROM vals),
gi AS (SELECT a AS id, CASE WHEN m < 3 OR sd = 0 OR sd * sqrt(greatest(0e0, (m * w - w * w) / (m - 1))) = 0 THEN 0e0
    ELSE (wx - mean * w) / (sd * sqrt(greatest(0e0, (m * w - w * w) / (m - 1)))) END AS z, w AS neighbors
  FROM (SELECT n.a, count(*) AS w, sum(v.value) AS wx FROM near n JOIN vals v ON v.id = n.b WHERE n.a IN (SELECT id FROM vals) GROUP BY n.a), whole)"""
_BAND = f"""near AS (SELECT a.id AS a, b.id AS b FROM units a, units b WHERE {s_haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 300e0 AND a.exposure > 0 AND b.exposure > 0),
vals AS (SELECT id, {s_rate('n', 'exposure')} AS value FROM units WHERE exposure > 0)"""


def _bh(source: str) -> str:
    return f"""tested AS (SELECT *, {s_p('z')} AS p FROM {source}),
ranked AS (SELECT *, count(*) OVER (ORDER BY p) AS r, count(*) OVER () AS m FROM tested),
flagged AS (SELECT *, coalesce(p <= (SELECT max(p) FROM ranked WHERE p <= r / m * 0.05e0), false) AS rejected FROM tested)"""


@query(M.sql("segments reports exposure", f"""SELECT u.id, n, {sr(s_rate('n', 'exposure'))} AS rate, {sr(s_low('n', 'exposure', '1.959963984540054e0'))} AS rate_ci_low,
  {sr(s_high('n', 'exposure', '1.959963984540054e0'))} AS rate_ci_high, {sr('z')} AS z, {sr('p', 5)} AS p, coalesce(rejected AND z > 0, false) AS significant
FROM units u LEFT JOIN flagged f USING (id)""", ",\n".join([_UNITS, _BAND, _GI, _bh("gi")])))
def unit_analyze(spark, d):
    """Rates, intervals and hot spots of all units: the library's one-call analysis."""
    out = hotspot.unit_analyze(M.units(spark, d), M.PLANE, 300.0)
    return out.select("id", "n", r("rate"), r("rate_ci_low"), r("rate_ci_high"), r("z"), r("p", 5), "significant")


@query(M.sql("segments reports exposure", "SELECT a, b FROM near WHERE a <> b", ",\n".join([_UNITS, _BAND])))
def band_neighbors(spark, d):
    return spatial.band_neighbors(M.units(spark, d).where("exposure > 0").select("id", "lat", "lon"), M.PLANE, 300.0)


@query(M.sql("segments reports exposure", f"SELECT id, {sr('z')} AS z, neighbors FROM gi", ",\n".join([_UNITS, _BAND, _GI])))
def getis_ord_star(spark, d):
    u = spatial.kept(M.units(spark, d).where("exposure > 0"))
    near = spatial.band_neighbors(u.select("id", "lat", "lon"), M.PLANE, 300.0)
    return hotspot.getis_ord_star(u.select("id", N.rate(F.col("n"), F.col("exposure")).alias("value")), near).select("id", r("z"), "neighbors")


@query(f"""WITH s AS (SELECT p_partkey AS id, (p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () * 3e0 AS z FROM part),
{_bh('s')} SELECT id, rejected FROM flagged""")
def bh_fdr(spark, d):
    part = M.table(spark, d, "part")
    whole = part.agg(F.avg("p_retailprice").alias("m"), F.stddev_pop("p_retailprice").alias("s"))
    z = part.crossJoin(F.broadcast(whole)).select(F.col("p_partkey").alias("id"), ((F.col("p_retailprice") - F.col("m")) / F.col("s") * 3.0).alias("z"))
    return hotspot.benjamini_hochberg(z.withColumn("p", N.two_sided_p(F.col("z")))).select("id", "rejected")


_WIDE = "((p_retailprice - 1400e0) / 60e0)"


@query(f"SELECT p_partkey AS id, {sr('p', 9)} AS p, {sr('log10(p)', 6)} AS log10_p FROM (SELECT p_partkey, {s_p(_WIDE)} AS p FROM part)")
def two_sided_p(spark, d):
    p = N.two_sided_p((F.col("p_retailprice") - 1400.0) / 60.0)
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("id"), p.alias("p")).select("id", r("p", 9), r(F.log10("p"), 6).alias("log10_p"))


_LENGTH = s_haversine("lat", "lon1", "lat", "lon2")
_ADJ = f"""ends AS (SELECT segment_id, lat, lon1 AS lon FROM segments UNION ALL SELECT segment_id, lat, lon2 FROM segments),
lengths AS (SELECT segment_id, {_LENGTH} AS len FROM segments),
adj AS (SELECT DISTINCT a.segment_id AS u, b.segment_id AS v, x.len / 2 + y.len / 2 AS w FROM ends a JOIN ends b ON a.segment_id <> b.segment_id
  JOIN lengths x ON x.segment_id = a.segment_id JOIN lengths y ON y.segment_id = b.segment_id
  WHERE {s_haversine('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 5e0)"""


@query(M.sql("segments", f"SELECT u, v, {sr('w', 3)} AS w FROM adj", _ADJ))
def segment_adjacency(spark, d):
    return network.segment_adjacency(M.segments(spark, d), M.PLANE).select("u", "v", r("w", 3))


_REACH = """walk AS (SELECT segment_id AS a, segment_id AS b, 0e0 AS d FROM segments UNION
  SELECT w.a, e.v, w.d + e.w FROM walk w JOIN adj e ON e.u = w.b WHERE w.d + e.w <= 600e0)"""


@query(M.sql("segments", f"SELECT a, b, {sr('min(d)', 3)} AS d FROM walk GROUP BY a, b", _ADJ + ",\n" + _REACH).replace("WITH ", "WITH RECURSIVE ", 1))
def network_neighbors(spark, d):
    s = M.segments(spark, d)
    return network.network_neighbors(s, network.segment_adjacency(s, M.PLANE), 600.0).select("a", "b", r("d", 3))


_SIG = f"""vals AS (SELECT segment_id AS id, rate AS value FROM rated WHERE rate IS NOT NULL), near AS (SELECT DISTINCT a, b FROM walk)"""
_CITY = ",\n".join([_RATED, _ADJ, _REACH.replace("600e0", "300e0"), _SIG, _GI, _bh("gi")])
_CITY_SQL = M.sql("attached", "", _CITY).replace("WITH ", "WITH RECURSIVE ", 1)


@query(_CITY_SQL + f"""SELECT segment_id, n, {sr('rate')} AS rate, {sr('rate_ci_low')} AS rate_ci_low, {sr('rate_ci_high')} AS rate_ci_high, {sr('z')} AS z,
  coalesce(rejected AND z > 0, false) AS significant, publishable FROM rated LEFT JOIN flagged f ON f.id = segment_id""")
def segment_statistics(spark, d):
    out = city.segment_statistics(M.clean(spark, d), M.segments(spark, d), M.exposure(spark, d), M.PLANE)
    return out.select("segment_id", "n", r("rate"), r("rate_ci_low"), r("rate_ci_high"), r("z"), "significant", "publishable")


_FAR = s_haversine("p.lat", "p.lon", "q.lat", "q.lon")
_PAIRING = f"""cents AS (SELECT segment_id AS id, lat, (lon1 + lon2) / 2e0 AS lon FROM segments),
far_apart AS (SELECT p.id AS p, q.id AS q, {_FAR} AS d FROM cents p JOIN cents q ON p.id <> q.id),
turns(taken, a, b) AS (SELECT CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) UNION ALL
  SELECT list_concat(taken, list_filter([a, b], lambda x: x IS NOT NULL)), a, b FROM (
    SELECT t.taken, t.a, (SELECT arg_min(f.q, (f.d, f.q)) FROM far_apart f WHERE f.p = t.a AND NOT list_contains(t.taken, f.q)) AS b
    FROM (SELECT taken, (SELECT min(id) FROM cents WHERE NOT list_contains(taken, id)) AS a FROM turns) t) WHERE a IS NOT NULL),
of AS (SELECT a AS segment_id, a AS unit FROM turns WHERE a IS NOT NULL UNION ALL SELECT b, a FROM turns WHERE b IS NOT NULL)"""


@query(M.sql("segments", "SELECT segment_id, unit FROM of", _PAIRING).replace("WITH ", "WITH RECURSIVE ", 1))
def maup_pairing(spark, d):
    return network.maup_pairs(M.units(spark, d).select(F.col("id").alias("segment_id"), "lat", "lon"))


_COARSE = f"""coarse AS (SELECT unit, n * (1000e0 / e) AS rate FROM (SELECT unit, sum(n) FILTER (estimate > 0) AS n, sum(estimate) FILTER (estimate > 0) AS e FROM rated JOIN of USING (segment_id) GROUP BY 1) WHERE e > 0),
vals AS (SELECT unit AS id, rate AS value FROM coarse), near AS (SELECT DISTINCT x.unit AS a, y.unit AS b FROM walk w JOIN of x ON x.segment_id = w.a JOIN of y ON y.segment_id = w.b),
top AS (SELECT segment_id, unit, row_number() OVER (ORDER BY rate DESC, segment_id) AS place FROM rated JOIN of USING (segment_id) WHERE publishable AND rate IS NOT NULL QUALIFY place <= 5),
ranks AS (SELECT unit, row_number() OVER (ORDER BY rate DESC, unit) AS place FROM coarse),
fine AS (SELECT DISTINCT unit FROM top WHERE unit IN (SELECT unit FROM coarse)), best AS (SELECT unit FROM ranks WHERE place <= 5)"""


@query(M.sql("attached", f"""SELECT (SELECT count(*) FROM of) AS fine_units, (SELECT count(DISTINCT unit) FROM of) AS coarse_units, t.segment_id AS top_hotspot_id, r.place AS coarse_rank,
  coalesce(f.rejected AND f.z > 0, false) AS still_significant, r.place = 1 AND coalesce(f.rejected AND f.z > 0, false) AS survives,
  {sr('(SELECT count(*) FROM fine JOIN best USING (unit)) / (SELECT count(*) FROM (SELECT unit FROM fine UNION SELECT unit FROM best))')} AS topk_overlap
FROM (SELECT * FROM top WHERE place = 1) t LEFT JOIN ranks r USING (unit) LEFT JOIN flagged f ON f.id = t.unit""",
  ",\n".join([_RATED, _ADJ, _REACH.replace("600e0", "300e0"), _PAIRING, _COARSE, _GI, _bh("gi")])).replace("WITH ", "WITH RECURSIVE ", 1))
def maup_rank_stability(spark, d):
    segs = M.segments(spark, d)
    near = network.network_neighbors(segs, network.segment_adjacency(segs, M.PLANE), 300.0).select("a", "b")
    pairs = network.maup_pairs(M.units(spark, d).select(F.col("id").alias("segment_id"), "lat", "lon"))
    return network.maup_rank_stability(rated(spark, d), pairs, near).withColumn("topk_overlap", r("topk_overlap"))


_SEED, _SHUFFLES = 20260101, 50
_ROUND = "SELECT *, r{k} AS l{j}, xor(l{k}, ((r{k} * r{k} % 2147483647) * a{k} + r{k} * b{k} + c{k}) % 2147483647 >> 8 & mask) AS r{j} FROM ({inner})"


def _feistel(inner: str) -> str:
    """The rounds of the network around rows with x, bits, mask and the keys."""
    inner = f"SELECT *, x >> bits AS l0, x & mask AS r0 FROM ({inner})"
    for k in range(calibration.ROUNDS):
        inner = _ROUND.format(k=k, j=k + 1, inner=inner)
    return inner


_KEYS = "keys AS (SELECT shuffle, " + ", ".join(
    f"CAST('0x' || substr(md5('{_SEED}-' || shuffle || '-{k}'), {1 + 8 * i}, 8) AS BIGINT) >> 1 AS {n}{k}" for k in range(calibration.ROUNDS) for i, n in enumerate("abc")
) + f" FROM range({_SHUFFLES}) t(shuffle))"


@query(M.sql("segments reports exposure", """SELECT shuffle, count(*) FILTER (r <= last AND z > 0) AS false_positives FROM (SELECT *, max(CASE WHEN p <= r / m * 0.05e0 THEN r END) OVER (PARTITION BY shuffle) AS last FROM ranked) GROUP BY shuffle""",
  ",\n".join([_UNITS, _BAND, _KEYS, f"""placed AS (SELECT id, n, exposure, row_number() OVER (ORDER BY id) - 1 AS place FROM units WHERE exposure > 0),
size AS (SELECT most, (SELECT min(b) FROM range(1, 31) t(b) WHERE power(4, b) >= most) AS bits FROM (SELECT count(*) AS most FROM placed)),
walk(shuffle, i, x, turn) AS (SELECT shuffle, place, place, 0 FROM placed, keys UNION ALL
  SELECT shuffle, i, (l{calibration.ROUNDS} << bits) | r{calibration.ROUNDS}, turn + 1 FROM ({_feistel("SELECT *, (1 << bits) - 1 AS mask FROM walk JOIN keys USING (shuffle), size WHERE turn = 0 OR x >= most")})),
mixed AS (SELECT w.shuffle, p.id, v.n * (1000e0 / p.exposure) AS value FROM walk w JOIN placed p ON p.place = w.i JOIN placed v ON v.place = w.x, size WHERE w.turn > 0 AND w.x < most),
whole AS (SELECT shuffle, count(*) AS m, avg(value) AS mean, stddev_pop(value) AS sd FROM mixed GROUP BY 1),
gi AS (SELECT shuffle, a, m, CASE WHEN sd * sqrt(greatest(0e0, (m * w - w * w) / (m - 1))) = 0 THEN 0e0 ELSE (wx - mean * w) / (sd * sqrt(greatest(0e0, (m * w - w * w) / (m - 1)))) END AS z
  FROM (SELECT shuffle, n.a, count(*) AS w, sum(v.value) AS wx FROM near n JOIN mixed v ON v.id = n.b GROUP BY 1, 2) JOIN whole USING (shuffle)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY shuffle ORDER BY p, a) AS r FROM (SELECT *, {s_p('z')} AS p FROM gi))"""])).replace("WITH ", "WITH RECURSIVE ", 1))
def null_calibration(spark, d):
    u = M.units(spark, d)
    near = spatial.band_neighbors(u.where("exposure > 0").select("id", "lat", "lon"), M.PLANE, 300.0)
    out = calibration.null_calibration(u.select("id", "n", "exposure"), near, _SHUFFLES, _SEED)
    return out.select(F.col("shuffle").cast("long").alias("shuffle"), "false_positives")


@query(M.sql("reports", f"""SELECT a AS id, count(*) AS neighbors, {sr('sum(b.value)')} AS total FROM (SELECT r.report_id AS a, s.value FROM reports r JOIN (SELECT report_id, lat, lon, accuracy_m AS value FROM reports) s
  ON abs(r.lat - s.lat) < 0.004e0 AND abs(r.lon - s.lon) < 0.005e0 AND {s_haversine('r.lat', 'r.lon', 's.lat', 's.lon')} <= 300e0) b GROUP BY a"""))
def band_sums(spark, d):
    """Number of reports within 300 m of each report, and the sum of their accuracies: by cell sums, not by pairs."""
    rows = M.reports(spark, d).select(F.col("report_id").alias("id"), "lat", "lon", F.col("accuracy_m").alias("value"))
    return hotspot.band_sums(rows, M.PLANE, 300.0).select(F.col("a").alias("id"), F.col("w").alias("neighbors"), r(F.col("wx")).alias("total"))


@query("""WITH n AS (SELECT l_orderkey AS way, l_linenumber AS i, l_suppkey AS node FROM lineitem),
shared AS (SELECT node FROM n GROUP BY node HAVING count(DISTINCT way) >= 2),
m AS (SELECT *, node IN (SELECT node FROM shared) OR row_number() OVER (PARTITION BY way ORDER BY i) = 1 OR row_number() OVER (PARTITION BY way ORDER BY i DESC) = 1 AS cut FROM n)
SELECT way AS way_id, CAST(count(*) FILTER (cut) - 1 AS BIGINT) AS pieces FROM m GROUP BY way HAVING count(*) FILTER (cut) >= 2""")
def osm_split(spark, d):
    node = F.struct((F.col("l_suppkey") * 1.0).alias("lat"), F.lit(0.0).alias("lon"))
    ways = M.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("way_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("i"), node.alias("p")))), lambda x: x["p"]).alias("nodes")
    )
    return network.split_ways(ways).groupBy("way_id").agg(F.count("*").alias("pieces"))


# ---------------------------------------------------------------- surfaces, time, weather


_KDE = f"""box AS (SELECT min(lat) AS lo_lat, (max(lat) - min(lat)) / 12 AS dlat, min(lon) AS lo_lon, (max(lon) - min(lon)) / 12 AS dlon FROM reports),
cells AS (SELECT r.r * 12 + c.c AS pos, lo_lat + (r.r + 0.5e0) * dlat AS lat, lo_lon + (c.c + 0.5e0) * dlon AS lon FROM box, range(12) r(r), range(12) c(c)),
kde AS (SELECT pos, any_value(c.lat) AS lat, any_value(c.lon) AS lon, coalesce(sum(exp(-0.5e0 * d2 / 22500e0)) FILTER (d2 <= 360000e0), 0e0) AS intensity FROM (
  SELECT c.*, power((p.lon - c.lon) * {M._K}, 2) + power((p.lat - c.lat) * 110540e0, 2) AS d2 FROM cells c, reports p) c GROUP BY pos)"""


def _kde(spark, d):
    return surfaces.kde_surface(M.reports(spark, d), M.PLANE, 150.0, 12)


@query(M.sql("reports", f"SELECT CAST(pos AS INT) AS pos, {sr('intensity', 3)} AS intensity FROM kde", _KDE))
def kde_surface(spark, d):
    return _kde(spark, d).select("pos", r("intensity", 3))


_ODD = lambda v: f"(CAST(greatest(1, ceil({v})) AS INT) + CASE WHEN CAST(greatest(1, ceil({v})) AS INT) % 2 = 0 THEN 1 ELSE 0 END)"


@query(M.sql("reports", f"""SELECT CAST(r.r * 12 + c.c AS INT) AS pos, {sr("coalesce(sum(n * exp(-0.5e0 * dx * dx / 22500e0) * exp(-0.5e0 * dy * dy / 22500e0)) FILTER (abs(dx) <= 600e0 + fx * per / 2 AND abs(dy) <= 600e0 + fy * 110540e0 / 2), 0e0)", 3)} AS intensity
FROM range(12) r(r), range(12) c(c), LATERAL (SELECT *, ((bx + 0.5e0) * fx - (c.c + 0.5e0) * dlon) * per AS dx, ((by_ + 0.5e0) * fy - (r.r + 0.5e0) * dlat) * 110540e0 AS dy FROM bins) GROUP BY r.r, c.c""",
  f"""box AS (SELECT min(lat) AS lo_lat, (max(lat) - min(lat)) / 12 AS dlat, min(lon) AS lo_lon, (max(lon) - min(lon)) / 12 AS dlon, {M._K} AS per FROM reports),
fine AS (SELECT *, {_ODD("dlat * 110540e0 / (150e0 / 8)")} AS sy, {_ODD("dlon * per / (150e0 / 8)")} AS sx FROM box), steps AS (SELECT *, dlat / sy AS fy, dlon / sx AS fx FROM fine),
bins AS (SELECT least(12 * sy - 1, CAST(floor((lat - lo_lat) / fy) AS INT)) AS by_, least(12 * sx - 1, CAST(floor((lon - lo_lon) / fx) AS INT)) AS bx, count(*) AS n, any_value(fx) AS fx, any_value(fy) AS fy, any_value(dlat) AS dlat, any_value(dlon) AS dlon, any_value(per) AS per
  FROM reports, steps GROUP BY 1, 2)"""))
def kde_binned(spark, d):
    return surfaces.kde_binned(M.reports(spark, d), M.PLANE, 150.0, 12).select("pos", r("intensity", 3))


@query(M.sql("reports segments", f"""SELECT s.segment_id, {sr(s_haversine('s.lat', '((s.lon1 + s.lon2) / 2e0)', 'p.lat', 'p.lon'), 2)} AS d
FROM segments s, (SELECT * FROM kde ORDER BY intensity DESC, pos LIMIT 1) p ORDER BY {s_haversine('s.lat', '((s.lon1 + s.lon2) / 2e0)', 'p.lat', 'p.lon')}, s.segment_id LIMIT 1""", _KDE))
def kde_peak_segment(spark, d):
    cents = M.units(spark, d).select(F.col("id").alias("segment_id"), "lat", "lon")
    return surfaces.peak_segment(surfaces.kde_peak(_kde(spark, d)), cents).select("segment_id", r("d", 2))


@query(M.sql("reports", f"SELECT CAST({_HOUR} AS VARCHAR) AS key, count(*) AS n, {sr('count(*) / sum(count(*)) OVER ()', 6)} AS share FROM reports GROUP BY 1"))
def temporal_by_hour(spark, d):
    return surfaces.temporal_breakdown(M.reports(spark, d), "hour").select("key", "n", r("share", 6))


@query(M.sql("reports", f"SELECT {_DAY} AS key, count(*) AS n FROM reports GROUP BY 1"))
def temporal_by_weekday(spark, d):
    return surfaces.temporal_breakdown(M.reports(spark, d), "weekday").select("key", "n")


@query(M.sql("reports", f"SELECT {_PART} AS key, count(*) AS n FROM reports GROUP BY 1"))
def temporal_by_part(spark, d):
    return surfaces.temporal_breakdown(M.reports(spark, d), "part").select("key", "n")


@query(M.sql("reports", "SELECT hazard_type AS key, count(*) AS n FROM reports WHERE hazard_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, min((epoch, report_id)) LIMIT 1"))
def first_seen_peak(spark, d):
    return surfaces.first_seen_peak(M.reports(spark, d), "hazard_type")


@query(M.sql("weather", "SELECT date, coalesce(wet, precip_mm > 0, false) AS wet FROM weather"))
def scan_weather(spark, d):
    return M.weather(spark, d).select("date", surfaces.is_wet(F.col("wet"), F.col("precip_mm")).alias("wet"))


@query(M.sql("reports weather", """SELECT count(*) FILTER (w IS NOT NULL) AS matched, count(*) FILTER (w IS NULL) AS unmatched, count(*) FILTER (w) AS wet, count(*) FILTER (NOT w) AS dry
FROM reports LEFT JOIN (SELECT date, coalesce(wet, precip_mm > 0, false) AS w FROM weather) ON date = substr(occurred_at, 1, 10)"""))
def weather_join(spark, d):
    return surfaces.weather_join(M.reports(spark, d), M.weather(spark, d)).select("matched", "unmatched", "wet", "dry")


_CONDITION = "(CASE WHEN precip_mm > 1 THEN 'rain' WHEN wet THEN 'showers' ELSE 'clear' END)"


@query(M.sql("reports weather", f"""SELECT {_CONDITION} AS condition, count(*) AS n, {sr('(SELECT avg(CAST(coalesce(wet, precip_mm > 0, false) AS DOUBLE)) FROM weather)')} AS baseline_wet_share
FROM reports JOIN weather ON date = substr(occurred_at, 1, 10) GROUP BY 1"""))
def weather_by_condition(spark, d):
    days = M.weather(spark, d).withColumn("condition", F.expr(_CONDITION))
    return surfaces.weather_by_condition(M.reports(spark, d), days).withColumn("baseline_wet_share", r("baseline_wet_share"))


@query(M.sql("clean", f"SELECT segment_id, {_PART} AS part, count(*) AS true_count FROM clean WHERE segment_id IS NOT NULL GROUP BY 1, 2"))
def dp_true_counts(spark, d):
    return surfaces.dp_true_counts(M.clean(spark, d))


#: The secret of the query, told here so that SQL can draw the same noise; a release has one of its own.
_DEMO_SECRET = bytes(range(32))
_PADS = {name: bytes(b ^ pad for b in _DEMO_SECRET.ljust(64, b"\0")).hex() for name, pad in (("inner", 0x36), ("outer", 0x5C))}
_NOISE = f"""noise AS (SELECT *, -1e0 * sign(u) * ln(1e0 - 2e0 * abs(u)) AS noise FROM (SELECT *, (CAST('0x' || substr(sha256(from_hex('{_PADS['outer']}') || from_hex(sha256(from_hex('{_PADS['inner']}') || encode(segment_id || chr(31) || part)))), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0 - 0.5e0 AS u
  FROM (SELECT segment_id, {_PART} AS part, count(*) AS true_count FROM clean WHERE segment_id IS NOT NULL GROUP BY 1, 2)))"""


@query(M.sql("clean", "SELECT segment_id, part, CAST(greatest(0, round(true_count + noise)) AS BIGINT) AS published FROM noise", _NOISE))
def dp_release(spark, d):
    return surfaces.dp_release(surfaces.dp_true_counts(M.clean(spark, d)), 1.0, True, True, _DEMO_SECRET)


@query(M.sql("clean", f"""SELECT count(*) AS cells, 1e0 AS noise_scale, count(*) * 1e0 AS composed_epsilon, {sr('avg(abs(noise))')} AS mean_absolute_noise, avg(abs(noise)) >= greatest(avg(true_count), 1) AS theater FROM noise""", _NOISE))
def dp_accounting(spark, d):
    return surfaces.dp_accounting(surfaces.dp_true_counts(M.clean(spark, d)), 1.0, _DEMO_SECRET)


# ---------------------------------------------------------------- geometry scalars


@query(M.sql("reports", f"SELECT report_id, {sr(s_haversine('lat', 'lon', '38.5e0', '-121.7e0'), 3)} AS d FROM reports"))
def haversine_m(spark, d):
    return M.reports(spark, d).select("report_id", r(geo.haversine(F.col("lat"), F.col("lon"), F.lit(38.5), F.lit(-121.7)), 3).alias("d"))


@query(M.sql("reports", f"SELECT report_id, {sr(f'(lon - -121.7e0) * {M._K}', 3)} AS x, {sr('(lat - 38.5e0) * 110540e0', 3)} AS y, CAST(floor((lon - -121.7e0) * {M._K} / 50e0) AS BIGINT) AS cx FROM reports"))
def project_xy(spark, d):
    x, y = M.PLANE.x(F.col("lon")), M.PLANE.y(F.col("lat"))
    return M.reports(spark, d).select("report_id", r(x, 3).alias("x"), r(y, 3).alias("y"), geo.cell(x, 50.0).alias("cx"))


@query(M.sql("segments", f"SELECT segment_id, {sr(_LENGTH, 3)} AS length, {sr('(lon1 + lon2) / 2e0', 6)} AS lon FROM segments"))
def polyline_measures(spark, d):
    c = F.col("coords")
    return M.segments(spark, d).select("segment_id", r(geo.polyline_length(c), 3).alias("length"), r(geo.polyline_centroid(c)["lon"], 6).alias("lon"))


@query(M.sql("segments", f"SELECT segment_id, CAST(greatest(1, ceil({_LENGTH} / 50e0)) + 1 AS BIGINT) AS points FROM segments"))
def densify(spark, d):
    return M.segments(spark, d).select("segment_id", F.size(geo.samples(F.col("coords"), 50.0, geo.LONGEST_EDGE_M)).cast("long").alias("points"))


@query(M.sql("segments", f"SELECT segment_id, CAST(floor(len / 50e0) + 2 AS BIGINT) AS points, {sr('x0 + (x1 - x0) * (3 * 50e0 / len)', 3)} AS x FROM (SELECT *, x1 - x0 AS len FROM (SELECT segment_id, (lon1 - -121.7e0) * {M._K} AS x0, (lon2 - -121.7e0) * {M._K} AS x1 FROM segments))"))
def densify_floor(spark, d):
    points = geo.densify(F.col("coords"), M.PLANE, 50.0)
    return M.segments(spark, d).select("segment_id", F.size(points).cast("long").alias("points"), r(F.get(points, F.lit(3))["x"], 3).alias("x"))


@query(M.sql("segments", "SELECT segment_id, street, 'c' || (pos % 10) || '|c' || (pos % 10 + 1) AS span FROM segments"))
def street_and_span(spark, d):
    return M.segments(spark, d).select("segment_id", X.street_name(F.col("name")).alias("street"), F.array_join(X.span(F.col("name")), "|").alias("span"))


# ---------------------------------------------------------------- ranks


@query(M.sql("attached", f"SELECT CAST(row_number() OVER (ORDER BY rate DESC, pos) AS INT) AS place, segment_id, {sr('rate')} AS rate FROM rated WHERE publishable AND rate IS NOT NULL QUALIFY place <= 10", _RATED))
def rank_by_rate(spark, d):
    return ranks.rank_by_rate(rated(spark, d), 10).select("place", "segment_id", r("rate"))


@query(M.sql("attached", f"SELECT CAST(row_number() OVER (ORDER BY rate DESC, segment_id) AS INT) AS place, segment_id, {sr('rate')} AS rate FROM rated WHERE publishable AND rate IS NOT NULL QUALIFY place <= 10", _RATED))
def rank_by_rate_id(spark, d):
    return ranks.rank_by_rate(rated(spark, d), 10, "segment_id").select("place", "segment_id", r("rate"))


@query(f"""WITH t AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2e0 AS rx,
  rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2e0 AS ry FROM part)
SELECT count(*) AS n, {sr('corr(rx, ry)', 6)} AS rho FROM t""")
def spearman(spark, d):
    return ranks.spearman(M.table(spark, d, "part"), "p_size", "p_retailprice").select("n", r("rho", 6))


_TWO = """a AS (SELECT segment_id, rate FROM rated WHERE rate IS NOT NULL ORDER BY rate DESC, segment_id LIMIT 5),
b AS (SELECT segment_id, CAST(n AS DOUBLE) AS rate FROM rated ORDER BY n DESC, segment_id LIMIT 5)"""


def _two(spark, d):
    a = rated(spark, d)
    return a, a.select("segment_id", F.col("n").cast("double").alias("rate"))


@query(M.sql("attached", "SELECT count(*) AS shared FROM a WHERE segment_id IN (SELECT segment_id FROM b)", _RATED + "," + _TWO))
def shared_topk(spark, d):
    return ranks.shared_top(*_two(spark, d))


@query(M.sql("attached", f"""SELECT {sr('(SELECT count(*) FROM a JOIN b USING (segment_id)) / (SELECT count(*) FROM (SELECT segment_id FROM a UNION SELECT segment_id FROM b))')} AS overlap""", _RATED + "," + _TWO))
def topk_overlap(spark, d):
    return ranks.topk_overlap(*_two(spark, d)).select(r("overlap"))


@query(M.sql("attached", """SELECT count(*) AS comparable, count(*) FILTER (x.pb < y.pb) AS concordant FROM c x JOIN c y ON x.pa < y.pa""",
  _RATED + """, c AS (SELECT segment_id, row_number() OVER (ORDER BY rate DESC, segment_id) AS pa, row_number() OVER (ORDER BY n DESC, segment_id) AS pb FROM rated WHERE rate IS NOT NULL AND publishable)"""))
def kendall_concordance(spark, d):
    a = rated(spark, d).select("segment_id", "rate", "publishable", "n")
    return ranks.kendall_concordance(a, a.withColumn("rate", F.when(F.col("rate").isNotNull(), F.col("n").cast("double"))), 16)


@query("""SELECT count(*) AS comparable, count(*) FILTER (x.pb < y.pb) AS concordant FROM c x JOIN c y ON x.pa < y.pa""".replace("SELECT", "WITH c AS (SELECT row_number() OVER (ORDER BY p_retailprice DESC, CAST(p_partkey AS VARCHAR)) AS pa, row_number() OVER (ORDER BY p_size DESC, CAST(p_partkey AS VARCHAR)) AS pb FROM part)\nSELECT", 1))
def kendall_many(spark, d):
    part = M.table(spark, d, "part").withColumn("segment_id", F.col("p_partkey").cast("string"))
    return ranks.kendall_concordance(part.select("segment_id", F.col("p_retailprice").alias("rate")), part.select("segment_id", F.col("p_size").alias("rate")), 300)


@query(M.sql("attached", f"""SELECT segment_id, {sr('rate')} AS rate FROM rated, (SELECT median(rate) AS m FROM rated WHERE publishable AND rate IS NOT NULL)
WHERE publishable AND rate IS NOT NULL ORDER BY abs(rate - m), segment_id LIMIT 1""", _RATED))
def median_reference_segment(spark, d):
    return ranks.median_reference(rated(spark, d)).select("segment_id", r("rate"))


@query(M.sql("attached", f"SELECT segment_id, CAST(min(k) AS INT) AS needed FROM attached, range(0, 501) t(k) WHERE estimate > 0 AND {s_low('k', 'estimate')} > 700e0 GROUP BY segment_id"))
def reports_to_distinguish(spark, d):
    return ranks.reports_to_distinguish(attached(spark, d), 700.0).where("needed is not null")


@query(M.sql("clean", """SELECT segment_id, hazard_type, n FROM (SELECT segment_id, hazard_type, count(*) AS n FROM clean WHERE segment_id IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, hazard_type) = 1"""))
def dominant_hazard(spark, d):
    return ranks.dominant_type(rates.hazard_counts(M.clean(spark, d)))


@query(M.sql("attached", f"""SELECT segment_id, {sr('rate')} AS rate, CAST((SELECT count(DISTINCT v) FROM (SELECT (SELECT list_sort(list(rate)) FROM rated WHERE rate IS NOT NULL)[CAST(floor(i * ((SELECT count(*) FROM rated WHERE rate IS NOT NULL) - 1) / 5e0 + 0.5e0) AS INT) + 1] AS v
  FROM range(1, 5) t(i)) WHERE v < rate) AS INT) AS class FROM rated WHERE rate IS NOT NULL""", _RATED))
def rate_classes(spark, d):
    return ranks.rate_classes(rated(spark, d)).select("segment_id", r("rate"), "class")


_PLANTED = "planted AS (SELECT * REPLACE (CASE WHEN pos BETWEEN 22 AND 25 THEN estimate / 20e0 ELSE estimate END AS estimate) FROM attached),\n"
_PLANTED_SQL = M.sql("attached", "", _PLANTED + _CITY.replace("FROM attached)", "FROM planted)")).replace("WITH ", "WITH RECURSIVE ", 1)


def _planted_statistics(spark, d):
    """Statistics with a planted hot spot: a twentieth of the exposure on four neighbouring blocks."""
    planted = F.substring("segment_id", 5, 2).cast("int").between(22, 25)
    exposure = M.exposure(spark, d).withColumn("estimate", F.when(planted, F.col("estimate") / 20).otherwise(F.col("estimate")))
    return city.segment_statistics(M.clean(spark, d), M.segments(spark, d), exposure, M.PLANE)


@query(_PLANTED_SQL + f"SELECT segment_id, {sr('z')} AS z FROM rated JOIN flagged f ON f.id = segment_id WHERE rejected AND z > 0 AND publishable")
def hotspots_by_z(spark, d):
    return _planted_statistics(spark, d).where("significant and publishable").orderBy(F.desc("z")).select("segment_id", r("z"))


@query(_PLANTED_SQL + f"""SELECT 'corridor-' || substr(sha256(ids), 1, 12) AS corridor_id, name, ids AS segment_ids, n, date AS exposure_date, {sr(s_rate('n', 'e'))} AS rate, {sr(s_low('n', 'e'))} AS rate_ci_low,
  {sr(s_high('n', 'e'))} AS rate_ci_high, CASE WHEN n >= 5 THEN 'certain' ELSE 'uncertain' END AS confidence_label FROM (
  SELECT any_value(street) || ' (c' || min(pos % 10) || '–c' || (max(pos % 10) + 1) || ')' AS name, string_agg(segment_id, ',' ORDER BY segment_id) AS ids, CAST(sum(n) AS BIGINT) AS n,
    CASE WHEN count(estimate) = count(*) THEN sum(estimate) END AS e, CASE WHEN count(DISTINCT date) = 1 THEN min(date) ELSE 'mixed' END AS date
  FROM (SELECT r.*, pos - row_number() OVER (ORDER BY pos) AS island FROM rated r JOIN flagged f ON f.id = segment_id WHERE rejected AND z > 0 AND publishable) GROUP BY pos // 10, island HAVING count(*) > 1)""")
def corridors(spark, d):
    """Corridors of the significant segments around the planted hot spot."""
    out = network.corridors(_planted_statistics(spark, d).withColumns({"exposure_source": F.col("source"), "exposure_date": F.col("date")}), M.PLANE)
    return out.select("corridor_id", "name", F.array_join("segment_ids", ",").alias("segment_ids"), "n", "exposure_date", r("rate"), r("rate_ci_low"), r("rate_ci_high"), "confidence_label")


@query(M.sql("attached", "SELECT segment_id, rate IS NULL AS unknown FROM rated WHERE street ILIKE '%row 3%'", _RATED))
def name_contains_filter(spark, d):
    return rated(spark, d).where(F.lower("name").contains("row 3")).select("segment_id", F.col("rate").isNull().alias("unknown"))


@query(M.sql("attached", f"SELECT CAST(row_number() OVER (ORDER BY rate DESC NULLS LAST, segment_id) AS INT) AS place, segment_id FROM rated", _RATED))
def table_sort(spark, d):
    placed = ranks.numbered(rated(spark, d), [F.col("rate").desc_nulls_last(), "segment_id"], "at")
    return placed.select((F.col("at") + 1).cast("int").alias("place"), "segment_id")
