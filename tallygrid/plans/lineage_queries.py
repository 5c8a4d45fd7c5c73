"""Queries of releases, contracts and artifacts over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage as L
from . import mapping as M
from .city_queries import _GREEDY, _PAIRS, _RATED, rated
from .crash_queries import _state_cells
from .registry import query


@query("""WITH c AS (SELECT o_custkey AS year, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + CASE WHEN o_custkey % 40 = 0 THEN 1 ELSE 0 END AS revision, sha256(CAST(o_orderkey AS VARCHAR)) AS digest,
  CASE WHEN o_orderkey % 30 = 0 THEN 'x' ELSE lag(sha256(CAST(o_orderkey AS VARCHAR))) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) END AS previous, o_orderkey % 7 AS stage FROM orders),
s AS (SELECT *, row_number() OVER w AS place, lag(digest) OVER w AS before, lag(stage) OVER w AS was FROM c WINDOW w AS (PARTITION BY year ORDER BY revision))
SELECT year, CAST(revision AS BIGINT) AS revision, 'gap' AS violation FROM s WHERE revision <> place UNION ALL SELECT year, CAST(revision AS BIGINT), 'predecessor' FROM s WHERE previous IS DISTINCT FROM before
UNION ALL SELECT year, CAST(revision AS BIGINT), 'stage' FROM s WHERE stage < was""")
def year_contracts(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    digest = F.sha2(F.col("o_orderkey").cast("string"), 256)
    rows = M.table(spark, d, "orders").select(
        F.col("o_custkey").alias("year"),
        (F.row_number().over(w) + F.when(F.col("o_custkey") % 40 == 0, 1).otherwise(0)).cast("long").alias("revision"), digest.alias("digest"),
        F.when(F.col("o_orderkey") % 30 == 0, "x").otherwise(F.lag(digest).over(w)).alias("previous"), (F.col("o_orderkey") % 7).alias("stage"),
    )
    return L.contract_violations(rows)


_INDEX = "SELECT CAST(doc_id AS VARCHAR) AS name, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents"


def _index(spark, d):
    return L.release_index(M.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("content")))


@query(_INDEX)
def release_index(spark, d):
    return _index(spark, d)


@query("""SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'unlisted' ELSE 'changed' END AS problem FROM documents
WHERE (doc_id % 11 = 0 AND doc_id % 7 <> 0) OR (doc_id % 7 = 0 AND doc_id % 11 <> 0) OR (doc_id % 5 = 0 AND doc_id % 11 <> 0 AND doc_id % 7 <> 0)""")
def county_index_verify(spark, d):
    every, k = _index(spark, d), F.col("name").cast("long")
    there = every.where(k % 11 != 0).withColumn("sha256", F.when(k % 5 == 0, "other").otherwise(F.col("sha256")))
    return L.index_mismatch(every.where(k % 7 != 0), there)


@query("SELECT p_partkey, 'p_brand' AS field, p_brand AS before, p_brand || '!' AS after FROM part WHERE p_partkey % 9 = 0")
def correction_ledger(spark, d):
    old = M.table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    new = old.withColumn("p_brand", F.when(F.col("p_partkey") % 9 == 0, F.concat("p_brand", F.lit("!"))).otherwise(F.col("p_brand")))
    return L.correction_ledger(old, new, "p_partkey", ("p_brand",))


@query(M.sql("persons cases", """SELECT g.geoid, m.mode, CASE WHEN cases >= 12 THEN 'published' ELSE 'suppressed_or_zero' END AS status, CASE WHEN cases >= 12 THEN cases END AS cases
FROM (SELECT DISTINCT state * 100 + county AS geoid FROM cases) g CROSS JOIN (SELECT DISTINCT mode FROM persons) m LEFT JOIN cc USING (geoid, mode)""",
  "cc AS (SELECT state * 100 + county AS geoid, mode, count(DISTINCT case_id) AS cases FROM persons JOIN cases USING (case_id) GROUP BY 1, 2)"))
def county_public_cells(spark, d):
    rows, _ = _state_cells(spark, d)
    geoid = (F.col("state") * 100 + F.col("county")).alias("geoid")
    cells = rows.select(geoid, "mode", "case_id").groupBy("geoid", "mode").agg(F.count_distinct("case_id").alias("cases"))
    return L.public_county_cells(M.cases(spark, d).select(geoid), M.persons(spark, d), cells, 12)


@query("""WITH w AS (SELECT DISTINCT c_nationkey AS a FROM customer), x AS (SELECT n_nationkey AS a, CASE WHEN n_nationkey % 6 <> 0 THEN n_name END AS geoid FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 8 = 1 UNION ALL SELECT 99, 'z'),
k AS (SELECT a, count(*) AS n, count(geoid) AS known FROM x GROUP BY a)
SELECT 'duplicate' AS problem, count(*) AS n FROM k WHERE n > 1 UNION ALL SELECT 'unresolved', count(*) FROM k WHERE known = 0
UNION ALL SELECT 'missing', count(*) FROM w WHERE a NOT IN (SELECT a FROM k) UNION ALL SELECT 'surplus', count(*) FROM k WHERE a NOT IN (SELECT a FROM w)""")
def crosswalk_review(spark, d):
    n = M.table(spark, d, "nation").select(F.col("n_nationkey").alias("a"), "n_name")
    first = n.where("a <> 3").select("a", F.when(F.col("a") % 6 != 0, F.col("n_name")).alias("geoid"))
    walk = first.unionByName(n.where("a % 8 = 1").select("a", F.col("n_name").alias("geoid"))).unionByName(spark.sql("SELECT 99 AS a, 'z' AS geoid"))
    return L.crosswalk_problems(walk, M.table(spark, d, "customer").select(F.col("c_nationkey").alias("a")), ["a"])


@query("""SELECT count(*) FILTER (a) AS outcomes, count(*) FILTER (b) AS summaries, count(*) FILTER (a AND b IS NULL) AS without_summary, count(*) FILTER (b AND a IS NULL) AS without_outcome,
  count(*) FILTER (f1 <> f2) AS fatality_mismatch FROM (SELECT o_orderkey AS k, true AS a, 1 AS f1 FROM orders WHERE o_orderkey % 13 <> 0)
FULL JOIN (SELECT l_orderkey AS k, true AS b, count(*) FILTER (l_quantity > 45) AS f2 FROM lineitem WHERE l_orderkey % 17 <> 0 GROUP BY 1) USING (k)""")
def joined_artifact(spark, d):
    o = M.table(spark, d, "orders").where("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("case_id"), F.lit(1).alias("fatality_count"))
    s = M.persons(spark, d).where("case_id % 17 <> 0").groupBy("case_id").agg(F.count_if("fatal").alias("fatalities"))
    return L.artifact_accounting(o, s, "case_id")


def _setting(w: int, d: str) -> str:
    """The duplicates under a window and a distance, under names of their own."""
    pairs, name = _PAIRS.replace("<= 600", f"<= {w}").replace("<= 15e0", f"<= {d}"), f"{w}_{d}"
    return (pairs + ",\n" + _GREEDY).replace("pairs", f"pairs_{name}").replace("nodes", f"nodes_{name}").replace("greedy", f"greedy_{name}").replace("gone AS (SELECT unnest(gone) AS", f"gone_{name} AS (SELECT unnest(gone) AS")


_SETTINGS = [(w, d) for w in (300, 600) for d in ("8e0", "15e0")]


@query(M.sql("clean", " UNION ALL ".join(f"""SELECT {s} AS snap_max, {w} AS window_s, {d} AS distance_m, count(*) AS kept, count(*) FILTER (snapped_distance_m <= {s}) AS snapped
FROM clean WHERE report_id NOT IN (SELECT report_id FROM gone_{w}_{d})""" for s in ("10e0", "25e0") for w, d in _SETTINGS), ",\n".join(_setting(*x) for x in _SETTINGS)).replace("WITH ", "WITH RECURSIVE ", 1))
def sensitivity_grid(spark, d):
    return L.sensitivity_grid(M.reports(spark, d), M.segments(spark, d), M.PLANE, (10.0, 25.0), (300, 600), (8.0, 15.0))


@query("SELECT n_nationkey, CASE n_nationkey % 4 " + " ".join(f"WHEN {t} THEN '{a}'" for t, (a, _) in L.CLAIMS.items()) + " END AS allowed FROM nation")
def claim_compile(spark, d):
    return L.claims(M.table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") % 4).alias("tier"))).select("n_nationkey", "allowed")


@query(M.sql("attached", """SELECT segment_id, 'class_without_rate' AS violation FROM rated WHERE rate IS NULL AND pos % 2 = 0
UNION ALL SELECT segment_id, 'small_cell' FROM rated WHERE n > 0 AND n < 160""", _RATED))
def symbology_verify(spark, d):
    return L.symbology_violations(rated(spark, d).withColumn("class", F.when(F.col("pos") % 2 == 0, 1)), 160)




def _shards(spark, d):
    n = M.table(spark, d, "nation").select(F.col("n_regionkey").alias("state"), "n_nationkey", "n_name")
    return L.state_shards(n, "state", ["n_nationkey"]), L.state_shards(n.where("state <> 2").withColumn("state", F.when(F.col("state") == 4, 9).otherwise(F.col("state"))).drop("n_name"), "state", ["n_nationkey"])


_SHARDS = """a AS (SELECT n_regionkey AS state, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' || chr(10) AS c FROM nation GROUP BY 1),
b AS (SELECT CASE n_regionkey WHEN 4 THEN 9 ELSE n_regionkey END AS state, '[' || string_agg('{"n_nationkey":' || n_nationkey || '}', ',' ORDER BY n_nationkey) || ']' || chr(10) AS c FROM nation WHERE n_regionkey <> 2 GROUP BY 1)"""


@query(M.sql("", "SELECT state, CAST(5 AS INT) AS features, strlen(c) AS bytes, sha256(c) AS sha256 FROM a", _SHARDS))
def county_boundary_publish(spark, d):
    return _shards(spark, d)[0].select("state", "features", "bytes", "sha256")


@query(M.sql("", """SELECT state, strlen(a.c) AS value_bytes, sha256(a.c) AS value_sha256, strlen(b.c) AS boundary_bytes, sha256(b.c) AS boundary_sha256,
  CASE WHEN state = 9 THEN 'unlisted_state' WHEN a.c IS NULL THEN 'missing_values' WHEN b.c IS NULL THEN 'missing_boundaries' END AS problem
FROM a FULL JOIN b USING (state)""", _SHARDS))
def county_release_index(spark, d):
    values, boundaries = _shards(spark, d)
    return L.county_release_index(values, boundaries, M.table(spark, d, "region").select(F.col("r_regionkey").alias("state")))


@query("""SELECT o_orderkey AS case_id, problem FROM (SELECT *, unnest([CASE WHEN o_orderkey % 11 = 0 THEN 'no date' END, CASE WHEN o_orderkey % 13 = 0 THEN 'no state' END,
  CASE WHEN o_orderkey % 90 + 10 > 90 THEN 'place out of range' END, CASE WHEN o_orderkey % 17 = 0 THEN 'no fatality' END]) AS problem FROM orders) WHERE problem IS NOT NULL""")
def outcome_artifact(spark, d):
    k = F.col("o_orderkey")
    rows = M.table(spark, d, "orders").select(
        k.alias("case_id"), F.when(k % 11 == 0, "1999-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("occurred_on"),
        F.when(k % 13 != 0, k % 50).alias("state_code"), (k % 90 + 10).cast("double").alias("lat"), F.lit(-100.0).alias("lon"), F.when(k % 17 == 0, 0).otherwise(1).alias("fatality_count"),
    )
    return L.outcome_problems(rows, "case_id")


@query(M.sql("persons cases", """SELECT case_id, state, people, strlen(county_code) AS digits FROM (SELECT case_id, state, printf('%03d', county) AS county_code FROM cases WHERE year = 1996)
JOIN (SELECT case_id, count(*) AS people FROM persons GROUP BY 1) USING (case_id)"""))
def joined_artifact_v2(spark, d):
    cases = M.cases(spark, d).where("year = 1996")
    people = M.persons(spark, d).join(cases.select("case_id"), "case_id", "left_semi").groupBy("case_id").agg(F.count("*").alias("people"))
    places = cases.select("case_id", "state", F.lpad(F.col("county").cast("string"), 3, "0").alias("county_code"))
    whole = cases.join(people.select("case_id"), "case_id", "left_semi")
    out = L.joined_records(whole.select("case_id", "year", "state"), people, places.join(people.select("case_id"), "case_id", "left_semi"), "case_id", 1996)
    return out.select("case_id", "outcome.state", "summary.people", F.length("jurisdiction.county_code").cast("long").alias("digits"))
