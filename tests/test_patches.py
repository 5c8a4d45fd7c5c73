"""Reports settled by patches against the pairs, without listing pairs of copies."""

from pyspark.sql import functions as F

from tallygrid.operators import dedupe
from tallygrid.plans import mapping as M


def test_patches_settle_as_pairs(spark, data):
    reports = M.reports(spark, data.replace("sf0.001", "sf0.01"))
    reports = reports.unionByName(reports.where("report_id % 50 = 0")).unionByName(reports.where("report_id % 90 = 0").withColumn("epoch", F.lit(None).cast("long")))
    want = {r.report_id for r in dedupe.removed_reports(dedupe.duplicate_pairs(reports, M.PLANE)).collect()}
    for most in (dedupe.PATCH, 250):
        got = {r.report_id for r in dedupe.removed_by_setting(reports, M.PLANE, [(600, 15.0)], most).collect()}
        assert got == want and got


def test_copies_are_not_paired(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "duplicate_pairs", None)
    rows = spark.range(30_000).selectExpr("id report_id", "100L + id % 7 epoch", "38.5D lat", "-121.7D lon", "cast(null as string) reporter_token", "'debris' hazard_type", "'other' mode")
    assert [r.report_id for r in dedupe.dedupe(rows, M.PLANE).collect()] == [0]
