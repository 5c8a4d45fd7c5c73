"""Queries of the crash-record operators: orders are crashes, order lines persons, nations states."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crash as C
from ..operators.ranks import numbered
from . import mapping as M
from .registry import query

_LINE_MODES = ("A-F", "N-F", "N-O", "R-F")


def _accidents(spark, d):
    """Orders as rows of text with some faults planted by key."""
    o, k = M.table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(
        k.alias("case_id"),
        F.when(k % 19 == 0, "x").otherwise(k.cast("string")).alias("ST_CASE"),
        F.when(k % 97 == 0, "1974").otherwise(F.date_format("o_orderdate", "yyyy")).alias("YEAR"),
        F.when(k % 23 == 0, "13").otherwise(F.date_format("o_orderdate", "M")).alias("MONTH"),
        F.date_format("o_orderdate", "d").alias("DAY"),
        (k % 30).cast("string").alias("HOUR"), (k % 70).cast("string").alias("MINUTE"),
        F.when(k % 29 == 0, "77.7777").otherwise((k % 80).cast("string")).alias("LATITUDE"),
        F.when(k % 31 == 0, "-190").otherwise((-(k % 170)).cast("string")).alias("LONGITUD"),
        F.when(k % 37 == 0, "0").otherwise("1").alias("FATALS"),
    )


_REASON = """CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 97 = 0 OR o_orderkey < 1 THEN 'invalid_identity' WHEN o_orderkey % 23 = 0 THEN 'invalid_date'
  WHEN o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN 'invalid_location' WHEN o_orderkey % 37 = 0 THEN 'invalid_fatality_count' END"""


@query(f"SELECT o_orderkey AS case_id, {_REASON} AS reason FROM orders")
def crash_row_map(spark, d):
    return C.map_rows(_accidents(spark, d)).select("case_id", "reason")


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM orders) WHERE reason IS NOT NULL GROUP BY 1")
def crash_reject_accounting(spark, d):
    return C.reject_accounting(C.map_rows(_accidents(spark, d)))


@query("""SELECT o_orderkey AS case_id, CASE WHEN o_orderkey % 30 <= 23 AND o_orderkey % 70 <= 59
  THEN lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 70 AS VARCHAR), 2, '0') END AS local_time FROM orders""")
def crash_local_time(spark, d):
    return C.map_rows(_accidents(spark, d)).select("case_id", "local_time")


@query("SELECT o_custkey * 12 + month(o_orderdate) AS k, any_value(o_orderkey) AS o_orderkey FROM orders GROUP BY 1 HAVING count(*) = 1")
def crash_duplicates(spark, d):
    rows = M.table(spark, d, "orders").select((F.col("o_custkey") * 12 + F.month("o_orderdate")).alias("k"), "o_orderkey")
    return C.drop_all_duplicates(rows, "k")[0]


@query("""SELECT p_partkey, CASE WHEN t NOT IN (1,2,3,4,5,6,7,8,9,10,19) THEN NULL WHEN t = 5 THEN 'pedestrian' WHEN t IN (6, 7) THEN 'pedalcyclist'
  WHEN t IN (4, 8, 10) THEN 'other_road_user' WHEN t = 19 OR b IN (98, 99) THEN 'unknown' WHEN b BETWEEN 80 AND 89 THEN 'motorcyclist'
  WHEN b BETWEEN 1 AND 97 THEN 'motor_vehicle_occupant' END AS mode
FROM (SELECT p_partkey, p_partkey % 21 AS t, p_partkey % 100 AS b FROM part)""")
def crash_mode_code(spark, d):
    return M.table(spark, d, "part").select("p_partkey", C.mode_code(F.col("p_partkey") % 21, F.col("p_partkey") % 100, "2022-2024").alias("mode"))


@query("""SELECT p_partkey, CASE p_partkey % 1000 WHEN 0 THEN 'not_applicable' WHEN 997 THEN 'other' WHEN 998 THEN 'not_reported' WHEN 999 THEN 'unknown' ELSE 'reported' END AS status FROM part""")
def county_status(spark, d):
    return M.table(spark, d, "part").select("p_partkey", C.county_status(F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("status"))


@query("""WITH p AS (SELECT l_orderkey AS k, l_linenumber AS i, count(*) AS n, max(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS f FROM lineitem WHERE l_orderkey % 41 <> 0 GROUP BY 1, 2),
c AS (SELECT k, max(n) AS most, sum(f) AS fatal FROM p GROUP BY 1),
x AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE (SELECT count(DISTINCT l_linenumber) FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l_quantity > 45) END AS declared FROM orders)
SELECT 'duplicate_line' AS violation, k AS key FROM c WHERE most > 1
UNION ALL SELECT 'orphan_line', k FROM c WHERE k NOT IN (SELECT k FROM x)
UNION ALL SELECT 'header_without_lines', k FROM x WHERE k NOT IN (SELECT k FROM c)
UNION ALL SELECT 'fatal_mismatch', k FROM x JOIN c USING (k) WHERE declared IS DISTINCT FROM fatal""")
def crash_join_violations(spark, d):
    p = M.persons(spark, d)
    fatal = p.where("fatal").groupBy("case_id").agg(F.count_distinct("person").alias("f"))
    o = M.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"))
    headers = o.join(fatal, "case_id", "left").select("case_id", F.when(F.col("case_id") % 50 == 0, -1).otherwise(F.coalesce("f", F.lit(0))).alias("declared"))
    return C.join_violations(headers, p.where("case_id % 41 <> 0"), "case_id", "person", "declared", F.col("fatal"))


@query("SELECT count(*) AS excluded FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE " + _REASON + " IS NOT NULL)")
def crash_exclude_rejected(spark, d):
    bad = C.map_rows(_accidents(spark, d)).where("reason is not null").select("case_id")
    return M.persons(spark, d).join(bad, "case_id", "left_semi").agg(F.count("*").alias("excluded"))


@query("SELECT l_orderkey AS case_id, " + ", ".join(
    f"count(*) FILTER (l_returnflag || '-' || l_linestatus = '{m}') AS \"{m}_involved\", count(*) FILTER (l_returnflag || '-' || l_linestatus = '{m}' AND l_quantity > 45) AS \"{m}_fatal\"" for m in _LINE_MODES
) + " FROM lineitem GROUP BY 1")
def crash_mode_rollup(spark, d):
    return C.mode_rollup(M.persons(spark, d), "case_id", "mode", F.col("fatal"), _LINE_MODES)


def _state_cells(spark, d):
    rows = M.persons(spark, d).join(M.cases(spark, d).select("case_id", "state", "county", "year"), "case_id")
    return rows, C.mode_cells(rows, "state", "case_id", "mode")


_CELLS = "cells AS (SELECT state, mode, count(DISTINCT case_id) AS cases FROM persons JOIN cases USING (case_id) GROUP BY 1, 2)"


@query(M.sql("persons cases", "SELECT state, mode, CASE WHEN cases >= 60 THEN 'published' ELSE 'suppressed_or_zero' END AS status, CASE WHEN cases >= 60 THEN cases END AS cases FROM cells", _CELLS))
def state_mode_cells(spark, d):
    return C.suppress(_state_cells(spark, d)[1], "cases", 60)


@query(M.sql("persons cases", """SELECT count(*) AS cells, count(*) FILTER (cases >= 60) AS published_cells, CAST(sum(cases) AS BIGINT) AS contributions,
  CAST(coalesce(sum(cases) FILTER (cases < 60), 0) AS BIGINT) AS suppressed_contributions FROM cells""", _CELLS))
def cell_accounting(spark, d):
    return C.cell_accounting(_state_cells(spark, d)[1], "cases", 60)


@query(M.sql("persons cases", """SELECT n.state, m.mode, CASE WHEN cases >= 60 THEN 'published' ELSE 'suppressed_or_zero' END AS status, CASE WHEN cases >= 60 THEN cases END AS cases
FROM (SELECT CAST(n_nationkey AS BIGINT) AS state FROM nation) n CROSS JOIN (SELECT DISTINCT mode FROM persons) m LEFT JOIN cells USING (state, mode)""", _CELLS))
def state_public_cells(spark, d):
    states = M.table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("state"))
    return C.dense_cells(states, M.persons(spark, d), _state_cells(spark, d)[1], "state", "mode", k=60)


@query(M.sql("persons cases", """SELECT mode, state, county, count(DISTINCT case_id) AS cases, 0 AS level FROM persons JOIN cases USING (case_id) GROUP BY 1, 2, 3
UNION ALL SELECT mode, state, NULL, count(DISTINCT case_id), 1 FROM persons JOIN cases USING (case_id) GROUP BY 1, 2
UNION ALL SELECT mode, NULL, NULL, count(DISTINCT case_id), 3 FROM persons JOIN cases USING (case_id) GROUP BY 1""").replace("0 AS level", "CAST(0 AS BIGINT) AS level").replace(", 1 FROM", ", CAST(1 AS BIGINT) FROM").replace(", 3 FROM", ", CAST(3 AS BIGINT) FROM"))
def county_feasibility(spark, d):
    return C.grouping_totals(_state_cells(spark, d)[0], "state", "county", "mode", "case_id")


_COUNTY = "coded AS (SELECT state, CASE county WHEN 0 THEN '000' WHEN 1 THEN '997' WHEN 2 THEN '999' ELSE lpad(CAST(county AS VARCHAR), 3, '0') END AS code, mode, case_id FROM persons JOIN cases USING (case_id))"


def _coded(spark, d):
    rows, _ = _state_cells(spark, d)
    code = F.when(F.col("county") == 0, "000").when(F.col("county") == 1, "997").when(F.col("county") == 2, "999").otherwise(F.lpad(F.col("county").cast("string"), 3, "0"))
    return C.county_cells(rows.withColumn("code", code), "state", "code", "mode", "case_id")


_KINDS = """SELECT CASE WHEN code IN ('000', '997', '999') THEN 'sentinel' ELSE 'county' END AS kind, state, CASE code WHEN '000' THEN 'not_applicable' WHEN '997' THEN 'other' WHEN '999' THEN 'unknown' ELSE {cell} END AS cell, mode, count(DISTINCT case_id) AS cases FROM coded GROUP BY ALL
UNION ALL SELECT 'total', state, NULL, mode, count(DISTINCT case_id) FROM coded GROUP BY ALL"""


@query(M.sql("persons cases", _KINDS.replace("{cell}", "code"), _COUNTY))
def county_sentinels(spark, d):
    return _coded(spark, d)


@query(M.sql("persons cases", _KINDS.replace("{cell}", "'g' || (CAST(code AS INT) // 4)"), _COUNTY))
def county_projection_reconciled(spark, d):
    cells = _coded(spark, d)
    crosswalk = cells.where("kind = 'county'").select("state", "cell").distinct().withColumn("geoid", F.concat(F.lit("g"), F.floor(F.col("cell").cast("int") / 4).cast("string")))
    return C.project_counties(cells, crosswalk)


@query(M.sql("persons cases", "SELECT lpad(CAST(state AS VARCHAR), 2, '0') || lpad(CAST(county // 2 AS VARCHAR), 3, '0') AS geoid, mode, CAST(sum(cases) AS BIGINT) AS cases FROM cc GROUP BY 1, 2",
  "cc AS (SELECT state, county, mode, count(DISTINCT case_id) AS cases FROM persons JOIN cases USING (case_id) GROUP BY 1, 2, 3)"))
def county_projection(spark, d):
    rows, _ = _state_cells(spark, d)
    cells = rows.groupBy("state", "county", "mode").agg(F.count_distinct("case_id").alias("cases"))
    geoid = F.concat(F.lpad(F.col("state").cast("string"), 2, "0"), F.lpad(F.floor(F.col("county") / 2).cast("string"), 3, "0"))
    crosswalk = rows.select("state", "county").distinct().withColumn("geoid", geoid)
    return C.project_cells(cells, crosswalk, ["state", "county"], "geoid", "mode", "cases")


@query("""SELECT a.n_nationkey, a.n_name FROM nation a WHERE NOT EXISTS (SELECT 1 FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS n_name FROM nation) b
  WHERE a.n_nationkey IS NOT DISTINCT FROM b.n_nationkey AND a.n_name IS NOT DISTINCT FROM b.n_name)""")
def boundary_validate_join(spark, d):
    n = M.table(spark, d, "nation").select("n_nationkey", "n_name")
    other = n.withColumn("n_name", F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")))
    return C.unequal_rows(n, other, ["n_nationkey", "n_name"]).select("n_nationkey", "n_name")


_PARTS = "(CASE WHEN h BETWEEN 0 AND 5 THEN 'overnight' WHEN h BETWEEN 6 AND 9 THEN 'am_peak' WHEN h BETWEEN 10 AND 15 THEN 'midday' WHEN h BETWEEN 16 AND 19 THEN 'pm_peak' ELSE 'evening' END)"


@query(M.sql("clean", f"""SELECT segment_id, part, mode, count(DISTINCT report_id) AS cases FROM (
  SELECT segment_id, {_PARTS} AS part, report_id, unnest(CASE WHEN mode = 'other' THEN ['unknown_mode'] ELSE [mode] END) AS mode
  FROM (SELECT *, CAST(substr(occurred_at, 12, 2) AS INT) AS h FROM clean WHERE segment_id IS NOT NULL)) GROUP BY 1, 2, 3 HAVING count(DISTINCT report_id) >= 5"""))
def segment_time_mode_cells(spark, d):
    from ..functions import text as X

    rows = M.clean(spark, d).select(
        "segment_id", X.part_of_day(X.local_hour(F.col("occurred_at"))).alias("part"), F.col("report_id").alias("case_id"),
        F.when(F.col("mode") == "other", F.array().cast("array<string>")).otherwise(F.array("mode")).alias("modes"),
    )
    return C.segment_time_cells(rows)


@query(M.sql("cases", """SELECT state, year, total, before FROM (SELECT state, year, count(*) AS total, lag(count(*)) OVER (PARTITION BY state ORDER BY year) AS before FROM cases GROUP BY 1, 2)
WHERE total < before AND NOT (year % 2 = 0)"""))
def lineage_regression(spark, d):
    totals = M.cases(spark, d).groupBy("state", "year").agg(F.count("*").alias("total")).withColumn("allowed", F.col("year") % 2 == 0)
    return C.regressions(totals, "state", "year", "total").select("state", "year", "total", "before")


@query(M.sql("persons cases", """SELECT mode, count(*) FILTER (cases >= 60) AS published, count(*) FILTER (cases < 60) AS suppressed, max(cases) FILTER (cases >= 60) AS most FROM cells GROUP BY mode""", _CELLS))
def mode_summary(spark, d):
    cells = C.suppress(_state_cells(spark, d)[1], "cases", 60)
    return cells.groupBy("mode").agg(
        F.count_if(F.col("status") == "published").alias("published"), F.count_if(F.col("status") != "published").alias("suppressed"), F.max("cases").alias("most")
    )


@query(M.sql("persons cases", "SELECT CAST(row_number() OVER (ORDER BY cases DESC, state) AS INT) AS place, state, cases FROM cells WHERE mode = 'N-O' AND cases >= 60", _CELLS))
def burden_rank(spark, d):
    cells = C.suppress(_state_cells(spark, d)[1], "cases", 60).where("mode = 'N-O' and status = 'published'")
    return numbered(cells, [F.desc("cases"), "state"], "at").select((F.col("at") + 1).cast("int").alias("place"), "state", "cases")


@query(M.sql("persons cases", "SELECT mode, max(cases) FILTER (state = 3 AND cases >= 60) AS a, max(cases) FILTER (state = 7 AND cases >= 60) AS b FROM cells GROUP BY mode", _CELLS))
def state_comparison(spark, d):
    return C.suppress(_state_cells(spark, d)[1], "cases", 60).groupBy("mode").agg(
        F.max(F.when(F.col("state") == 3, F.col("cases"))).alias("a"), F.max(F.when(F.col("state") == 7, F.col("cases"))).alias("b")
    )


@query(M.sql("persons cases", """SELECT year, mode, CASE WHEN cases >= 60 THEN 'published' ELSE 'suppressed_or_zero' END AS status, CASE WHEN cases >= 60 THEN cases END AS cases
FROM (SELECT year, mode, count(DISTINCT case_id) AS cases FROM persons JOIN cases USING (case_id) WHERE state = 5 GROUP BY 1, 2)"""))
def state_profile_by_year(spark, d):
    rows, _ = _state_cells(spark, d)
    return C.suppress(rows.where("state = 5").groupBy("year", "mode").agg(F.count_distinct("case_id").alias("cases")), "cases", 60)


@query(M.sql("persons cases", """SELECT count(*) FILTER (a >= 60 AND b >= 60) AS comparable, count(*) FILTER (NOT coalesce(a >= 60 AND b >= 60, false)) AS excluded FROM (
  SELECT state, max(cases) FILTER (mode = 'N-O') AS a, max(cases) FILTER (mode = 'R-F') AS b FROM cells GROUP BY state)""", _CELLS))
def mode_scatter(spark, d):
    cells = C.suppress(_state_cells(spark, d)[1], "cases", 60)
    two = cells.groupBy("state").agg(F.max(F.when(F.col("mode") == "N-O", F.col("cases"))).alias("a"), F.max(F.when(F.col("mode") == "R-F", F.col("cases"))).alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return two.agg(F.count_if(both).alias("comparable"), F.count_if(~both).alias("excluded"))


@query(M.sql("persons cases", "SELECT state, " + ", ".join(f"max(cases) FILTER (mode = '{m}' AND cases >= 60) AS \"{m}\"" for m in _LINE_MODES) + " FROM cells GROUP BY state", _CELLS))
def state_mode_matrix(spark, d):
    cells = C.suppress(_state_cells(spark, d)[1], "cases", 60)
    return cells.groupBy("state").pivot("mode", list(_LINE_MODES)).agg(F.max("cases"))


@query(M.sql("persons cases", "SELECT state, mode, cases FROM cells WHERE mode = 'N-O' AND cases >= 60", _CELLS))
def state_table_filter(spark, d):
    return C.suppress(_state_cells(spark, d)[1], "cases", 60).where("mode = 'N-O' and status = 'published'").select("state", "mode", "cases")


@query("""SELECT count(*) AS missing FROM (SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer WHERE c_nationkey % 6 <> 0)""")
def national_coverage_set(spark, d):
    n = M.table(spark, d, "nation").select("n_nationkey")
    seen = M.table(spark, d, "customer").where("c_nationkey % 6 <> 0").select(F.col("c_nationkey").alias("n_nationkey"))
    return n.join(seen, "n_nationkey", "left_anti").agg(F.count("*").alias("missing"))


@query(M.sql("persons", "SELECT case_id, concat_ws(',', " + ", ".join(f"CASE WHEN bool_or(mode = '{m}') THEN '{m}' END" for m in _LINE_MODES) + ") AS modes FROM persons GROUP BY case_id"))
def modes_intersection(spark, d):
    seen = M.persons(spark, d).groupBy("case_id").agg(F.collect_set("mode").alias("s"))
    order = F.array(*(F.lit(m) for m in _LINE_MODES))
    return seen.select("case_id", F.array_join(F.filter(order, lambda m: F.array_contains("s", m)), ",").alias("modes"))


@query("SELECT count(*) = count(DISTINCT y) AS unique_years FROM (SELECT year(o_orderdate) AS y FROM orders GROUP BY year(o_orderdate))")
def unique_sorted_years(spark, d):
    y = M.table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return y.agg((F.count("*") == F.count_distinct("y")).alias("unique_years"))
