"""Reports as a stream: late rows, repeated ids, running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh_reports(reports: DataFrame, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Reports with a watermark, each report_id once within it."""
    return reports.withWatermark(time, late).dropDuplicatesWithinWatermark(["report_id"])


def window_counts(reports: DataFrame, key: str, time: str = "ts", size: str = "1 hour") -> DataFrame:
    """(start, key, n): reports per window and key; append mode tells a window once it is past the watermark."""
    return reports.groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def write_accepted(reports: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append validated reports to Parquet; a batch that runs again replaces its own folder."""
    from ..operators.governance import validate_reports

    def store(batch: DataFrame, number: int) -> None:
        good = validate_reports(batch).where(F.size("problems") == 0).drop("problems")
        good.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = reports.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def replay(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there now, append what it gives to Parquet below `path`, and read that."""
    query = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
