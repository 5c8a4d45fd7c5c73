"""Queries of moderation, rights, coverage, preregistration, vintages and conformance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import governance as G
from ..operators import rates, releases
from . import mapping as M
from .city_queries import _RATED, attached, rated, s_p, sr
from .registry import query, r

_SUB = """subs AS (SELECT event_id AS submission_id, ['pending', 'approved', 'rejected', 'approved'][CAST(event_id % 4 AS INT) + 1] AS status, user_id,
  epoch(date_trunc('second', ts)) AS received, CASE WHEN event_id % 4 <> 0 THEN epoch(date_trunc('second', ts)) + (event_id % 50) * 1800 END AS decided FROM events)"""


def _subs(spark, d):
    e = M.table(spark, d, "events")
    k, at = F.col("event_id"), F.unix_timestamp(F.col("ts").cast("timestamp"))
    status = F.get(F.array(*(F.lit(x) for x in ("pending", "approved", "rejected", "approved"))), (k % 4).cast("int"))
    return e.select(k.alias("submission_id"), status.alias("status"), "user_id", at.alias("received_epoch"), F.when(k % 4 != 0, at + (k % 50) * 1800).alias("decided_epoch"))


@query(M.sql("", "SELECT status AS key, count(*) AS n FROM subs GROUP BY 1", _SUB))
def moderation_status(spark, d):
    return G.moderation_counts(_subs(spark, d), F.col("status"))


@query(M.sql("", "SELECT user_id AS key, CASE WHEN NOT (count(*) > 0 AND count(*) < 70) THEN count(*) END AS n FROM subs GROUP BY 1", _SUB))
def moderation_counts_k(spark, d):
    return G.moderation_counts(_subs(spark, d), F.col("user_id"), 70)


_FLAGGED = """flagged AS (SELECT *, CASE WHEN submission_id % 5 = 0 THEN ['email', 'phone'] WHEN submission_id % 700 = 3 THEN ['plate'] ELSE [] END AS flags,
  CASE submission_id % 3 WHEN 0 THEN 'Duplicate of another' WHEN 1 THEN 'just SPAM' END AS reason FROM subs)"""


@query(M.sql("", """SELECT breakdown, key, CASE WHEN n = 0 OR n >= 100 THEN n END AS n, n > 0 AND n < 100 AS withheld FROM cells
UNION ALL SELECT 'withheld', 'cells', count(*) FILTER (n > 0 AND n < 100), false FROM cells""", _SUB + "," + _FLAGGED + """, seen AS (
  SELECT 'status' AS breakdown, status AS key FROM flagged UNION ALL SELECT 'flag', unnest(flags) FROM flagged
  UNION ALL SELECT 'reason', CASE submission_id % 3 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'spam' ELSE 'other' END FROM flagged WHERE status = 'rejected'),
names AS (SELECT 'status' AS breakdown, unnest(['pending', 'approved', 'rejected']) AS key UNION ALL SELECT 'reason', unnest(['duplicate', 'spam', 'identifier-leak', 'invalid-location', 'off-topic', 'other'])),
cells AS (SELECT breakdown, key, coalesce(n, 0) AS n FROM names FULL JOIN (SELECT breakdown, key, count(*) AS n FROM seen GROUP BY ALL) USING (breakdown, key))"""))
def moderation_report(spark, d):
    k = F.col("submission_id")
    flags = F.when(k % 5 == 0, F.array(F.lit("email"), F.lit("phone"))).when(k % 700 == 3, F.array(F.lit("plate"))).otherwise(F.array().cast("array<string>"))
    return G.moderation_report(_subs(spark, d).withColumns({"flags": flags, "reason": F.when(k % 3 == 0, "Duplicate of another").when(k % 3 == 1, "just SPAM")}), 100)


@query(M.sql("reports", """SELECT b.report_id, 'pending' AS status, concat_ws(',', CASE WHEN b.report_id % 10 = 1 THEN 'possible_email_in_note' END, CASE WHEN b.report_id % 10 = 3 THEN 'possible_plate_in_note' END,
  CASE WHEN q.report_id IS NOT NULL OR row_number() OVER (PARTITION BY y, x, hazard_type, hour ORDER BY b.report_id) > 1 THEN 'possible_duplicate' END) AS flags
FROM (SELECT *, floor(lat * 1e4 + 0.5e0) AS y, floor(lon * 1e4 + 0.5e0) AS x, substr(occurred_at, 1, 13) AS hour FROM reports WHERE report_id % 2 = 1 AND hazard_type <> 'glitter') b
LEFT JOIN (SELECT floor(lat * 1e4 + 0.5e0) AS y, floor(lon * 1e4 + 0.5e0) AS x, hazard_type, substr(occurred_at, 1, 13) AS hour, min(report_id) AS report_id FROM reports WHERE report_id % 2 = 0 AND report_id % 6 <> 0 GROUP BY ALL) q
USING (y, x, hazard_type, hour)"""))
def submit(spark, d):
    rows = M.reports(spark, d)
    k = F.col("report_id")
    batch = rows.where((k % 2 == 1) & (F.col("hazard_type") != "glitter")).withColumn("note", F.when(k % 10 == 1, "write to a@b.org").when(k % 10 == 3, "it was abc1234"))
    queue = rows.where(k % 2 == 0).withColumn("status", F.when(k % 6 == 0, "rejected").otherwise("pending"))
    gone = G.record_tombstones(rows.where("false").select(F.lit("").alias("hash")), rows.where(k % 2 == 0))
    return G.submit(batch, queue, gone).select("report_id", "status", F.array_join("flags", ",").alias("flags"))


@query(M.sql("", f"SELECT count(*) AS decided, {sr('median((decided - received) / 3600e0)', 2)} AS median_hours FROM subs WHERE decided IS NOT NULL", _SUB))
def moderation_latency(spark, d):
    return G.decision_latency(_subs(spark, d))


@query(M.sql("", "SELECT submission_id, status FROM subs WHERE status = 'pending'", _SUB))
def list_submissions(spark, d):
    return _subs(spark, d).where("status = 'pending'").select("submission_id", "status")


@query("""SELECT user_id AS submission_id, CASE WHEN bool_or(event_id % 400 = 7) THEN 'rejected' ELSE arg_max(CASE WHEN event_id % 2 = 0 THEN 'approved' ELSE 'pending' END, event_id) END AS status FROM events GROUP BY 1""")
def approve_reject(spark, d):
    k = F.col("event_id")
    status = F.when(k % 400 == 7, "rejected").when(k % 2 == 0, "approved").otherwise("pending")
    return G.latest_state(M.table(spark, d, "events").select(F.col("user_id").alias("submission_id"), k.alias("seq"), status.alias("status")))


@query(rf"""SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}') THEN 'possible_email_in_note' END,
  CASE WHEN regexp_matches(text, '\b\d{{3}}[-.\s]?\d{{3}}[-.\s]?\d{{4}}\b') THEN 'possible_phone_in_note' END,
  CASE WHEN len(list_filter(regexp_extract_all(regexp_replace(upper(text), '[^\p{{L}}\p{{N}}_]', '  ', 'g'), '(?:^| )([A-Z0-9]{{5,8}})(?: |$)', 1), lambda x: regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]'))) > 0 THEN 'possible_plate_in_note' END) AS flags FROM documents""")
def pii_flags(spark, d):
    return M.table(spark, d, "documents").select("doc_id", F.array_join(X.pii_flags(F.col("text")), ",").alias("flags"))


@query("SELECT doc_id, CASE WHEN " + " WHEN ".join(
    "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + f") THEN '{name}'" for name, words in X.REASONS
) + " ELSE 'other' END AS category FROM documents")
def reason_category(spark, d):
    return M.table(spark, d, "documents").select("doc_id", X.reason_category(F.col("text")).alias("category"))


@query(M.sql("reports", """SELECT report_id, row_number() OVER (PARTITION BY floor(lat * 1e4 + 0.5e0), floor(lon * 1e4 + 0.5e0), hazard_type, substr(occurred_at, 1, 13) ORDER BY report_id) > 1 AS possible_duplicate FROM reports"""))
def coarse_dup_key(spark, d):
    return G.coarse_duplicates(M.reports(spark, d)).select("report_id", "possible_duplicate")


@query(M.sql("reports", """SELECT report_id FROM reports WHERE report_id % 10 <> 3"""))
def tombstone_anti(spark, d):
    rows = M.reports(spark, d)
    gone = G.record_tombstones(rows.where("false").select(F.lit("").alias("hash")), rows.where("report_id % 10 = 3"))
    return G.tombstone_anti(rows, gone).select("report_id")


@query("SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS hash FROM orders")
def tombstone_key(spark, d):
    return M.table(spark, d, "orders").select("o_orderkey", X.tombstone_key(F.col("o_orderkey")).alias("hash"))


@query(M.sql("reports", "SELECT count(*) FILTER (reporter_token = 'u7') AS mine, count(*) FILTER (reporter_token IS DISTINCT FROM 'u7') AS others FROM reports"))
def token_split(spark, d):
    mine, others = G.token_split(M.reports(spark, d), "u7")
    return mine.agg(F.count("*").alias("mine")).crossJoin(others.agg(F.count("*").alias("others")))


@query(M.sql("reports", "SELECT report_id FROM reports WHERE epoch >= epoch(TIMESTAMP '2024-01-31 00:00:00') - 15 * 86400"))
def retention_purge(spark, d):
    return G.retention_purge(M.reports(spark, d), 1706659200, 15).select("report_id")


@query(M.sql("reports", "SELECT report_id, CASE WHEN report_id % 3 = 0 THEN 'queue' ELSE 'store' END AS origin FROM reports WHERE report_id % 3 = 0 OR report_id % 2 = 0"))
def approved_union_dedupe(spark, d):
    rows = M.reports(spark, d).select("report_id")
    pick = lambda n, name: rows.where(F.col("report_id") % n == 0).withColumn("origin", F.lit(name))
    return G.approved_union(pick(3, "queue"), pick(2, "store"))


@query(M.sql("reports", """SELECT report_id, concat_ws('; ', CASE WHEN hazard_type NOT IN ('close_pass','dooring','surface_hazard','sightline','signal','debris','other') THEN 'hazard_type: not valid' END,
  CASE WHEN report_id % 7 = 3 THEN 'lat: not valid' END, CASE WHEN report_id % 5 = 2 THEN 'location: not valid' END, CASE WHEN report_id % 40 = 0 THEN 'accuracy_m: not valid' END) AS problems FROM reports"""))
def validate_report(spark, d):
    k = F.col("report_id")
    rows = M.reports(spark, d).withColumns({
        "lat": F.when(k % 7 == 3, 91.0).otherwise(F.col("lat")), "lon": F.when(k % 5 != 2, F.col("lon")), "accuracy_m": F.when(k % 40 == 0, 0.0).otherwise(F.col("accuracy_m")),
    })
    return G.validate_reports(rows).select("report_id", F.array_join("problems", "; ").alias("problems"))


@query(M.sql("attached", """SELECT *, usable / segments AS usable_share, observed / segments AS observed_share,
  CASE WHEN usable = 0 THEN 0 WHEN usable / segments < 0.5 THEN 1 WHEN observed / segments < 0.5 THEN 2 ELSE 3 END AS tier
FROM (SELECT count(*) AS segments, count(*) FILTER (estimate > 0) AS usable, count(*) FILTER (estimate > 0 AND tier = 'observed') AS observed,
  count(*) FILTER (estimate > 0 AND abs(epoch(CAST(date AS TIMESTAMP)) - epoch(TIMESTAMP '1998-07-15')) > 7 * 86400) AS stale FROM attached)"""))
def coverage_assess(spark, d):
    at = lambda c: F.unix_timestamp(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return G.coverage_assess(attached(spark, d), rates.is_stale(at(F.col("date")), at(F.lit("1998-07-15")), 7))


@query("""SELECT count(*) AS groups, count(*) FILTER (n < 52) AS small_groups, CAST(coalesce(sum(n) FILTER (n < 52), 0) AS BIGINT) AS small_rows, CAST(sum(n) AS BIGINT) AS rows
FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)""")
def studio_readiness(spark, d):
    groups = M.table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return G.readiness(groups, 52)


_SIG = "sig AS (SELECT *, rate > 500e0 AND pos % 2 = 0 AS significant FROM rated)"


def _sig(spark, d):
    return rated(spark, d).withColumn("significant", F.coalesce((F.col("rate") > 500) & (F.col("pos") % 2 == 0), F.lit(False)))


@query(M.sql("attached", f"SELECT segment_id, {sr('rate')} AS predicted_rate FROM sig WHERE significant AND publishable AND rate IS NOT NULL", _RATED + "," + _SIG))
def preregistration_build(spark, d):
    return G.preregister(_sig(spark, d)).select("segment_id", r("predicted_rate"))


@query(M.sql("attached", f"""SELECT evaluable, hits, unevaluable, {sr('hits / evaluable')} AS hit_rate FROM (
  SELECT count(*) FILTER (h.rate IS NOT NULL) AS evaluable, count(*) FILTER (h.rate IS NOT NULL AND h.rate > 700e0) AS hits, count(*) FILTER (h.rate IS NULL) AS unevaluable
  FROM (SELECT segment_id FROM sig WHERE significant AND publishable AND rate IS NOT NULL) p LEFT JOIN (SELECT * FROM rated WHERE pos % 4 <> 0) h USING (segment_id))""", _RATED + "," + _SIG))
def preregistration_score(spark, d):
    later = rated(spark, d).where("pos % 4 <> 0").withColumn("significant", F.col("rate") > 700)
    return G.score_preregistration(G.preregister(_sig(spark, d)), later).select("evaluable", "hits", "unevaluable", r("hit_rate"))


_OLD_METHODS = {"fdr_alpha": 0.05, "min_publish_n": 3, "getis_ord_band_m": 300.0}


@query(M.sql("attached", """SELECT segment_id, change, CASE WHEN change = 'withdrawn' THEN 'suppression' WHEN old_n IS NULL THEN 'threshold_change' WHEN old_n <> new_n THEN 'new_reports'
  WHEN old_e IS DISTINCT FROM new_e THEN 'revised_exposure' ELSE 'recomputation' END AS cause
FROM (SELECT *, CASE WHEN new_hot AND NOT old_hot THEN 'appeared' WHEN old_hot AND new_n IS NULL THEN 'withdrawn' WHEN old_hot AND NOT new_hot THEN 'disappeared' END AS change FROM (
  SELECT segment_id, old_n, old_e, new_n, new_e, coalesce(old_n IS NOT NULL AND pos % 2 = 0, false) AS old_hot, coalesce(new_n IS NOT NULL AND pos % 5 < 2, false) AS new_hot FROM (
    SELECT pos, segment_id, CASE WHEN pos % 7 <> 0 THEN n END AS old_n, CASE WHEN pos % 7 <> 0 THEN estimate END AS old_e,
      CASE WHEN pos % 11 <> 0 THEN CASE WHEN pos % 3 = 0 THEN n + 1 ELSE n END END AS new_n, CASE WHEN pos % 4 = 0 THEN coalesce(estimate, 0) + 5 ELSE estimate END AS new_e FROM attached)))
WHERE change IS NOT NULL"""))
def vintage_diff(spark, d):
    """Hot spots of two releases: some segments are withheld in one, some have more reports, some another exposure; the floor was lowered."""
    base = attached(spark, d).select(
        "pos", "segment_id", (F.col("pos") % 2 == 0).alias("significant"), F.col("n").alias("report_count"), F.col("estimate").alias("exposure_estimate"), F.lit("counts").alias("exposure_source"), F.lit("2024").alias("exposure_date")
    )
    new = base.where("pos % 11 <> 0").withColumns({
        "significant": F.col("pos") % 5 < 2, "report_count": F.when(F.col("pos") % 3 == 0, F.col("report_count") + 1).otherwise(F.col("report_count")),
        "exposure_estimate": F.when(F.col("pos") % 4 == 0, F.coalesce("exposure_estimate", F.lit(0.0)) + 5).otherwise(F.col("exposure_estimate")),
    })
    return releases.hotspot_changes(base.where("pos % 7 <> 0"), new, _OLD_METHODS, _OLD_METHODS | {"min_publish_n": 2})


@query(M.sql("attached", """SELECT unnest(list_filter([
    CASE WHEN has AND NOT coalesce(e > 0, false) THEN 'HR1: a rate without a positive exposure' END, CASE WHEN has AND source IS NULL THEN 'HR1: a rate without the source of its exposure' END,
    CASE WHEN has AND date IS NULL THEN 'HR1: a rate without the date of its exposure' END, CASE WHEN has AND low IS NULL THEN 'HR2: a rate without an interval' END,
    CASE WHEN has AND pos % 10 = 4 AND low IS NOT NULL THEN 'HR2: a rate outside its interval' END, CASE WHEN has AND n > 0 AND n < 160 AND NOT (pos % 3 = 0 AND pos % 8 <> 5) THEN 'HR2: a small sample that is not marked' END,
    CASE WHEN has AND (n > 0 OR rate > 0) AND n = 0 THEN 'HR2: reports without an n of 1 or more' END, CASE WHEN pos % 8 = 5 THEN 'HR3: quality_flags is missing or no array' END,
    CASE WHEN n > 0 AND n < 150 THEN 'HR4: fewer reports than may be told' END, CASE WHEN pos % 12 = 7 THEN 'HR4: a property tells of single reports' END], lambda x: x IS NOT NULL)) AS problem, segment_id
FROM (SELECT *, rate IS NOT NULL OR pos % 9 = 0 AS has FROM (SELECT pos, segment_id, n, estimate AS e, CASE WHEN pos % 6 <> 1 THEN 'orders' END AS source, date, CASE WHEN estimate > 0 THEN 1e0 END AS low,
  CASE WHEN estimate > 0 THEN n * (1000e0 / estimate) END AS rate FROM attached))"""))
def conformance_rules(spark, d):
    """Published rows with planted faults against the hard rules."""
    pos = F.col("pos")
    rate = F.coalesce("rate", F.when(pos % 9 == 0, 1.0))
    known = F.col("rate").isNotNull()
    rows = rated(spark, d).select(
        "segment_id", "n", F.col("n").alias("report_count"), rate.alias("rate"), F.col("estimate").alias("exposure_estimate"), F.when(pos % 6 != 1, "orders").alias("exposure_source"),
        F.col("date").alias("exposure_date"), F.when(known, F.when(pos % 10 == 4, rate + 1).otherwise(0.0)).alias("rate_ci_low"), F.when(known, rate + 2).alias("rate_ci_high"),
        F.when(pos % 8 != 5, F.when(pos % 3 == 0, F.array(F.lit("low_sample"))).otherwise(F.array().cast("array<string>"))).alias("quality_flags"),
        F.when(pos % 12 == 7, F.struct(F.lit(1).alias("reporter_token"))).alias("more"),
    )
    found = releases.feature_problems(releases.features(rows), 150, 160)
    return found.select(F.concat("rule", F.lit(": "), "problem").alias("problem"), "segment_id")


@query(M.sql("attached", f"""SELECT {sr('count(*) FILTER (hot AND flag) / count(*) FILTER (hot)')} AS recall, {sr('count(*) FILTER (hot AND flag) / count(*) FILTER (flag)')} AS precision,
  {sr('count(*) FILTER (NOT hot AND flag) / count(*) FILTER (NOT hot)')} AS background_fp FROM (SELECT pos % 6 = 0 AS hot, coalesce(significant, false) AS flag FROM sig)""", _RATED + "," + _SIG))
def scorecard(spark, d):
    truth = M.segments(spark, d).select("segment_id", F.when(F.col("pos") % 6 == 0, "hotspot").otherwise("background").alias("role"), F.lit(1.0).alias("true_rate"))
    return G.scorecard(_sig(spark, d).select("segment_id", "significant", "rate_ci_low", "rate_ci_high"), truth).select("recall", "precision", "background_fp")


@query("SELECT p_partkey, CASE p_type WHEN 'PROMO BURNISHED COPPER' THEN 'copper' WHEN 'promo burnished copper' THEN 'never' ELSE 'none' END AS mapped FROM part")
def crosswalk_exact(spark, d):
    rules = spark.createDataFrame([(1, "PROMO BURNISHED COPPER", "copper"), (2, "promo burnished copper", "never"), (3, "PROMO BURNISHED", "part")], "priority int, pattern string, target string")
    return G.crosswalk_lookup(M.table(spark, d, "part"), rules, "p_type", "none", exact=True).select("p_partkey", "mapped")


@query("SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'metal' WHEN contains(lower(p_type), 'a') THEN 'has_a' ELSE 'none' END AS mapped FROM part")
def crosswalk_lookup(spark, d):
    rules = spark.createDataFrame([(1, "BRASS", "metal"), (2, "a", "has_a"), (3, "brass", "late")], "priority int, pattern string, target string")
    return G.crosswalk_lookup(M.table(spark, d, "part"), rules, "p_type", "none").select("p_partkey", "mapped")


@query(M.sql("attached", f"""SELECT count(*) FILTER (significant AND publishable) AS hotspots, string_agg(segment_id, ',' ORDER BY rate DESC, segment_id) FILTER (place <= 3) AS top
FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN publishable THEN rate END DESC NULLS LAST, segment_id) AS place FROM sig)""", _RATED + "," + _SIG))
def bottom_line_top3(spark, d):
    rows = _sig(spark, d)
    top = rows.where("publishable and rate is not null").orderBy(F.desc("rate"), "segment_id").limit(3)
    names = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rate")).alias("o"), "segment_id"))), lambda x: x["segment_id"]), ",").alias("top"))
    return rows.agg(F.count_if(F.col("significant") & F.col("publishable")).alias("hotspots")).crossJoin(names)


@query(M.sql("segments reports", """SELECT count(*) AS leaks FROM segments s WHERE EXISTS (SELECT 1 FROM reports r WHERE floor(r.lat * 1e6 + 0.5e0) = floor(s.lat * 1e6 + 0.5e0)
  AND floor(r.lon * 1e6 + 0.5e0) IN (floor(s.lon1 * 1e6 + 0.5e0), floor(s.lon2 * 1e6 + 0.5e0)))"""))
def forbidden_key_guard(spark, d):
    rows = G.published_rows(rated(spark, d).select("segment_id", "coords", "rate", "publishable"))
    return G.geometry_leaks(rows, M.reports(spark, d)).agg(F.count("*").alias("leaks"))


_METADATA = '{"peak": 12, "mode": "all", "points": [38.50252, -121.69850, 38.505, -121.6985, 38.50502, -121.6984], "note": null}'


@query(M.sql("reports", f"""SELECT 'private key' AS problem, k AS what FROM (VALUES ('note'), ('mode')) t(k)
UNION ALL SELECT 'raw coordinate', CAST(report_id AS VARCHAR) FROM reports WHERE contains('{_METADATA}', CAST(round(lat, 5) AS VARCHAR)) AND contains('{_METADATA}', CAST(round(lon, 5) AS VARCHAR))"""))
def metadata_guard(spark, d):
    return G.metadata_leaks(_METADATA, M.reports(spark, d))
