"""Queries that replay the event table as a stream, through state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.shared import new_folder
from ..streaming import dedupe, intake, rights
from . import mapping as M
from .city_queries import _GREEDY, _PAIRS
from .registry import query

_SECONDS = 600


def _reports(spark, d):
    """The reports as a stream, ids as text in the order of the numbers. A stream reads a single file by a pattern only."""
    schema = M.table(spark, d, "events").schema
    rows = M.reports(spark, d, spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]"))
    return rows.withColumns({"ts": F.timestamp_seconds("epoch"), "report_id": F.lpad(F.col("report_id").cast("string"), 19, "0")})


@query(M.sql("reports", f"""SELECT report_id, report_id NOT IN (SELECT report_id FROM gone) AS stays, true AS sure FROM reports
WHERE epoch < (SELECT max(epoch) FROM reports) - {_SECONDS}""", _PAIRS + ",\n" + _GREEDY).replace("WITH ", "WITH RECURSIVE ", 1))
def stream_dedupe(spark, d):
    """Reports settled by the replayed stream: all but those of the last ten minutes, which the watermark has not passed."""
    folder = new_folder(spark, "stream-dedupe")
    told = intake.replay(dedupe.dedupe_stream(_reports(spark, d), M.PLANE, late=f"{_SECONDS} seconds"), f"{folder}/out", f"{folder}/state")
    return told.select(F.col("report_id").cast("long").alias("report_id"), "stays", "sure")


@query(M.sql("reports", """SELECT sha256(lpad(CAST(report_id AS VARCHAR), 19, '0')) AS hash, epoch FROM reports
WHERE epoch >= (SELECT max(epoch) FROM reports) - 15 * 86400 AND report_id % 10 <> 3"""))
def stream_rights(spark, d):
    """Reports that stand at the end of the replay: of the last 15 days and not deleted by their contributors."""
    folder = new_folder(spark, "stream-rights")
    rows = _reports(spark, d)
    lives = rights.report_lives(rows, rows.where(F.col("report_id").cast("long") % 10 == 3).select("report_id", "ts"), 15)
    return rights.standing(intake.replay(lives, f"{folder}/out", f"{folder}/state"))
