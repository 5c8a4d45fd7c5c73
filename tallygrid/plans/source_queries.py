"""Queries of scalar text functions and of sinks over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from . import mapping as M
from .registry import query


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slug(spark, d):
    return M.table(spark, d, "part").select("p_partkey", X.slug(F.col("p_name")).alias("slug"))


@query("""SELECT k, 'corridor-' || substr(sha256(ids), 1, 12) AS corridor_id FROM (
  SELECT o_custkey AS k, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS ids FROM orders GROUP BY 1)""")
def corridor_id(spark, d):
    o = M.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list(F.col("o_orderkey").cast("string")).alias("ids"))
    return o.select("k", X.corridor_id(F.col("ids")).alias("corridor_id"))


@query("""SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || lower(to_hex((CAST('0x' || substr(h, 17, 2) AS INT) & 63) | 128)) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS id
FROM (SELECT o_orderkey, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode('case:' || o_orderkey)) AS h FROM orders)""")
def uuid5_id(spark, d):
    return M.table(spark, d, "orders").select("o_orderkey", X.uuid5(uuid.NAMESPACE_URL, F.concat(F.lit("case:"), F.col("o_orderkey").cast("string"))).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN strftime(make_timestamp((1700000000 + o_orderkey * 977) * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders")
def iso_from_epoch_ms(spark, d):
    k = F.col("o_orderkey")
    return M.table(spark, d, "orders").select("o_orderkey", X.iso_from_epoch_ms(F.when(k % 5 > 0, (1700000000 + k * 977) * 1000).otherwise(0)).alias("at"))


@query(M.sql("reports", "SELECT report_id, occurred_at AS at FROM reports"))
def normalize_datetime(spark, d):
    naive = F.when(F.col("report_id") % 2 == 0, F.substring("occurred_at", 1, 19)).otherwise(F.col("occurred_at"))
    return M.reports(spark, d).select("report_id", X.with_offset(naive, "-08:00").alias("at"))


@query(M.sql("reports", "SELECT report_id, epoch FROM reports"))
def parse_ts(spark, d):
    return M.reports(spark, d).select("report_id", X.epoch(F.col("occurred_at")).alias("epoch"))


@query(M.sql("segments", """SELECT segment_id, '{"type":"Feature","geometry":{"type":"LineString","coordinates":[[' || lon1 || ',' || lat || '],[' || lon2 || ',' || lat || ']]},"properties":{"segment_id":"' || segment_id || '"}}' AS feature FROM segments"""))
def geojson_features(spark, d):
    from ..sources.sinks import features

    return features(M.segments(spark, d).select("segment_id", "coords")).select("segment_id", "feature")


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'África' WHEN 1 THEN 'América' ELSE 'otra' END AS label FROM nation")
def label_translate(spark, d):
    labels = F.create_map(F.lit(0), F.lit("África"), F.lit(1), F.lit("América"))
    return M.table(spark, d, "nation").select("n_nationkey", F.coalesce(labels[F.col("n_regionkey")], F.lit("otra")).alias("label"))
