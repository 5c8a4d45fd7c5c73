"""The star-schema test tables as spatial and crash tables, in Spark and as SQL with equal values.

A segment is a block of a grid of 60, on which customers live, and users too. An event is a report
near its user's block; one in thirteen lies off the streets. Exposure is the number of orders
of the customers who live on a block. Orders are crashes, their lines the persons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import METRES_PER_LAT, Plane
from ..functions.text import HAZARDS

PLANE = Plane(38.5, -121.7)
SNAP_M, SNAP_RADIUS = 25.0, 1000.0
#: Hazards of the event types, one of them outside the vocabulary.
EVENT_HAZARDS = {"error": "close_pass", "click": "dooring", "view": "surface_hazard", "signup": "signal", "purchase": "glitter"}
USER_MODES = ("cyclist", "pedestrian", "wheelchair", "scooter", "other")
SEVERITY = ("near_miss", "minor", "serious")
TIERS = ("observed", "modeled", "proxy", "unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], at) -> object:
    return F.get(F.array(*(F.lit(v) for v in values)), at.cast("int"))


def _sql_pick(values: tuple[str, ...], at: str) -> str:
    return "(CASE " + at + "".join(f" WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END)"


def _block(i) -> object:
    return F.concat(F.lit("seg-"), F.lpad(i.cast("string"), 2, "0"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, segment_id, name, coords of the blocks on which customers live; blocks of a row touch."""
    i = F.col("id")
    blocks = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 60).cast("long").alias("id")).where("id is not null").distinct()
    row, col = F.floor(i / 10), i % 10
    point = lambda lon: F.struct((38.5 + row * 0.0025).alias("lat"), lon.alias("lon"))
    return blocks.select(
        i.alias("pos"), _block(i).alias("segment_id"),
        F.concat(F.lit("Row "), row.cast("string"), F.lit(" St (c"), col.cast("string"), F.lit("–c"), (col + 1).cast("string"), F.lit(")")).alias("name"),
        F.array(point(-121.7 + col * 0.003), point(-121.7 + (col + 1) * 0.003)).alias("coords"),
    )


def reports(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Reports of the table of events, or of a frame, which may be a stream, of its columns."""
    e = table(spark, sf_dir, "events") if events is None else events
    home = F.col("user_id") % 60
    away = F.when(F.col("event_id") % 13 == 0, 0.001).otherwise(0.0)
    hazard = F.create_map(*(F.lit(x) for kv in EVENT_HAZARDS.items() for x in kv))[F.col("event_type")]
    at = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-08:00"))
    return e.select(
        F.col("event_id").alias("report_id"), _block(home).alias("home"), at.alias("occurred_at"),
        (38.5 + F.floor(home / 10) * 0.0025 + (F.col("event_id") % 7 - 3) * 0.00002 + away).alias("lat"),
        (-121.7 + (home % 10 + 0.5) * 0.003 + (F.col("event_id") % 11 - 5) * 0.0001).alias("lon"),
        _pick(USER_MODES, F.col("user_id") % 5).alias("mode"), hazard.alias("hazard_type"),
        _pick(SEVERITY, F.col("event_id") % 3).alias("severity"),
        (F.col("event_id") % 40 + 1).cast("double").alias("accuracy_m"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("reporter_token"),
        F.lit(None).cast("string").alias("address"),
        F.unix_timestamp(F.to_timestamp(at)).cast("long").alias("epoch"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapped, classified and flagged reports."""
    from ..operators.city import clean_records

    return clean_records(reports(spark, sf_dir), segments(spark, sf_dir), PLANE, SNAP_M)


def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    s = F.col("o_custkey") % 60
    return (
        o.where(s % 17 != 0)
        .groupBy(s.alias("s"))
        .agg((F.count("*") * 1.0).alias("estimate"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("date"))
        .select(_block(F.col("s")).alias("segment_id"), "estimate", F.lit("orders").alias("source"), "date", _pick(TIERS, F.col("s") % 4).alias("tier"))
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, lat, lon, n, exposure of the blocks."""
    from ..functions.geo import polyline_centroid

    counts = reports(spark, sf_dir).groupBy(F.col("home").alias("segment_id")).agg(F.count("*").alias("n"))
    return (
        segments(spark, sf_dir)
        .join(counts, "segment_id", "left")
        .join(exposure(spark, sf_dir), "segment_id", "left")
        .withColumn("c", polyline_centroid(F.col("coords")))
        .select(F.col("segment_id").alias("id"), F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"), F.coalesce("n", F.lit(0)).alias("n"), F.col("estimate").alias("exposure"))
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a day of events but every seventh; wet by flag on every third, else by rain."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct().where(F.dayofmonth("day") % 7 != 0)
    d = F.dayofmonth("day")
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("date"), F.when(d % 3 == 0, d % 2 == 0).alias("wet"), ((d % 5) * 0.5).alias("precip_mm")
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as persons of a crash: case_id, person, mode, fatal."""
    mode = F.concat("l_returnflag", F.lit("-"), "l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("person"), mode.alias("mode"), (F.col("l_quantity") > 45).alias("fatal")
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as crashes: case_id, state, county, occurred_on."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("case_id"), F.col("c_nationkey").cast("long").alias("state"), (F.col("o_custkey") % 40).alias("county"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("occurred_on"), F.year("o_orderdate").cast("long").alias("year"),
    )


# ---------------------------------------------------------------- the same as SQL

_K = repr(PLANE.per_lon) + "e0"
_hazard = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_HAZARDS.items()) + " END"
_known = ", ".join(f"'{h}'" for h in HAZARDS)

CTES = {
    "segments": """segments AS (
  SELECT i AS pos, 'seg-' || lpad(CAST(i AS VARCHAR), 2, '0') AS segment_id, 'Row ' || (i // 10) || ' St' AS street,
    38.5e0 + (i // 10) * 0.0025e0 AS lat, -121.7e0 + (i % 10) * 0.003e0 AS lon1, -121.7e0 + (i % 10 + 1) * 0.003e0 AS lon2
  FROM (SELECT DISTINCT c_custkey % 60 AS i FROM customer WHERE c_custkey IS NOT NULL))""",
    "reports": f"""reports AS (
  SELECT event_id AS report_id, 'seg-' || lpad(CAST(user_id % 60 AS VARCHAR), 2, '0') AS home,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-08:00' AS occurred_at,
    38.5e0 + ((user_id % 60) // 10) * 0.0025e0 + (event_id % 7 - 3) * 0.00002e0 + CASE WHEN event_id % 13 = 0 THEN 0.001e0 ELSE 0e0 END AS lat,
    -121.7e0 + (user_id % 60 % 10 + 0.5e0) * 0.003e0 + (event_id % 11 - 5) * 0.0001e0 AS lon,
    {_sql_pick(USER_MODES, 'user_id % 5')} AS mode, {_hazard} AS hazard_type, {_sql_pick(SEVERITY, 'event_id % 3')} AS severity,
    CAST(event_id % 40 + 1 AS DOUBLE) AS accuracy_m, CASE WHEN event_id % 4 <> 0 THEN 'u' || user_id END AS reporter_token,
    CAST(NULL AS VARCHAR) AS address, CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 28800 AS epoch
  FROM events)""",
    "far": f"""far AS (
  SELECT report_id, segment_id, sqrt(ex * ex + ey * ey) AS d FROM (
    SELECT report_id, segment_id, px - (ax + t * dx) AS ex, py - (ay + t * dy) AS ey FROM (
      SELECT *, greatest(0e0, least(1e0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy))) AS t FROM (
        SELECT *, bx - ax AS dx, b_y - ay AS dy FROM (
          SELECT r.report_id, s.segment_id, (r.lon - -121.7e0) * {_K} AS px, (r.lat - 38.5e0) * {METRES_PER_LAT}e0 AS py,
            (s.lon1 - -121.7e0) * {_K} AS ax, (s.lat - 38.5e0) * {METRES_PER_LAT}e0 AS ay,
            (s.lon2 - -121.7e0) * {_K} AS bx, (s.lat - 38.5e0) * {METRES_PER_LAT}e0 AS b_y
          FROM reports r, segments s))))
  WHERE sqrt(ex * ex + ey * ey) <= {SNAP_RADIUS}e0)""",
    "snapped": f"""snapped AS (
  SELECT r.*, CASE WHEN n.d <= {SNAP_M}e0 THEN n.segment_id END AS segment_id, n.d AS snapped_distance_m
  FROM reports r LEFT JOIN (SELECT report_id, min(d) AS d, arg_min(segment_id, (d, segment_id)) AS segment_id FROM far GROUP BY report_id) n USING (report_id))""",
    "clean": f"""clean AS (
  SELECT report_id, occurred_at, epoch, segment_id, snapped_distance_m, mode, severity, reporter_token,
    CASE WHEN hazard_type IN ({_known}) THEN hazard_type ELSE 'other' END AS hazard_type,
    segment_id IS NULL AS unsnapped, accuracy_m > {SNAP_M}e0 AS low_accuracy,
    segment_id IS NOT NULL AND snapped_distance_m > {SNAP_M}e0 * 0.6e0 AS far_snap
  FROM snapped)""",
    "exposure": f"""exposure AS (
  SELECT 'seg-' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') AS segment_id, count(*) * 1e0 AS estimate,
    strftime(max(o_orderdate), '%Y-%m-%d') AS date, {_sql_pick(TIERS, 'any_value(o_custkey % 60) % 4')} AS tier
  FROM orders WHERE o_custkey % 60 % 17 <> 0 GROUP BY o_custkey % 60)""",
    "counted": """counted AS (
  SELECT segment_id, count(*) AS n, count(*) FILTER (NOT low_accuracy AND NOT far_snap) AS n_primary FROM clean WHERE segment_id IS NOT NULL GROUP BY segment_id)""",
    "attached": """attached AS (
  SELECT s.pos, s.segment_id, s.street, s.lat, (s.lon1 + s.lon2) / 2e0 AS lon, coalesce(c.n, 0) AS n, coalesce(c.n_primary, 0) AS n_primary, e.estimate, e.tier, e.date
  FROM segments s LEFT JOIN counted c USING (segment_id) LEFT JOIN exposure e USING (segment_id))""",
    "weather": """weather AS (
  SELECT strftime(day, '%Y-%m-%d') AS date, CASE WHEN d % 3 = 0 THEN d % 2 = 0 END AS wet, (d % 5) * 0.5e0 AS precip_mm
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS day, dayofmonth(ts) AS d FROM events) WHERE d % 7 <> 0)""",
    "persons": """persons AS (
  SELECT l_orderkey AS case_id, l_linenumber AS person, l_returnflag || '-' || l_linestatus AS mode, l_quantity > 45 AS fatal FROM lineitem)""",
    "cases": """cases AS (
  SELECT o_orderkey AS case_id, CAST(c_nationkey AS BIGINT) AS state, o_custkey % 40 AS county, strftime(o_orderdate, '%Y-%m-%d') AS occurred_on,
    CAST(year(o_orderdate) AS BIGINT) AS year FROM orders JOIN customer ON o_custkey = c_custkey)""",
}
NEEDS = {"far": ("reports", "segments"), "snapped": ("far",), "clean": ("snapped",), "counted": ("clean",), "attached": ("segments", "counted", "exposure")}


def sql(needs: str, body: str, more: str = "") -> str:
    """A query with the tables it needs, and those that these need, as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    parts = [CTES[n] for n in order] + ([more] if more else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
