"""Addresses looked up in a service once: answers are kept in a table, and failures are told apart from unknown places."""

from __future__ import annotations

import json
import time
import urllib.parse
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import address_key

ANSWER = "key string, lat double, lon double, status string, problem string"
#: Given an address and headers, the text of the service's answer; raises if there is none.
Transport = Callable[[str, dict], str]


def place_in(text: str) -> tuple[float, float] | None:
    """The first place of a JSON list of places with lat and lon; None for an empty list; raises if it is anything else."""
    found = json.loads(text)
    if not isinstance(found, list):
        raise ValueError("the answer is no list")
    return (float(found[0]["lat"]), float(found[0]["lon"])) if found else None


def search_url(base: str, address: str) -> str:
    return f"{base}?{urllib.parse.urlencode({'q': address, 'format': 'jsonv2', 'limit': 1})}"


def known_answers(spark: SparkSession, table: str) -> DataFrame:
    """What the table at this path holds; nothing if it is not there yet."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(table)
    if not there.getFileSystem(context._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], ANSWER)
    return spark.read.schema(ANSWER).option("recursiveFileLookup", "true").parquet(table)


def _asker(transport: Transport, base: str, headers: dict, pause: float, attempts: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = 0.0
        for frame in frames:
            rows = []
            for key, address in zip(frame["key"], frame["address"]):
                for attempt in range(attempts):
                    time.sleep(max(0.0, ready - time.monotonic()))
                    ready = time.monotonic() + pause * 2**attempt  # longer after each failure
                    try:
                        place = place_in(transport(search_url(base, address), headers))
                    except (OSError, ValueError, KeyError, TypeError) as error:
                        row = (key, None, None, "failed", f"{type(error).__name__}: {error}")
                        continue
                    row = (key, *place, "found", None) if place else (key, None, None, "unknown", None)
                    break
                ready = time.monotonic() + pause
                rows.append(row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")])

    return run


def look_up(
    addresses: DataFrame, table: str, transport: Transport, base: str = "https://nominatim.openstreetmap.org/search", agent: str = "tallygrid",
    per_second: float = 1.0, tasks: int = 1, attempts: int = 3,
) -> DataFrame:
    """key, lat, lon, status (found, unknown, failed) and problem of each different address (column `address`; nulls and blanks aside).

    Only keys that the table does not hold are asked for, each once, by so many tasks that keep to the rate together; what is
    found or known not to be there is added to the table, so a second run asks nothing. A failure (no connection, or an answer
    that cannot be read) is tried again with longer pauses, told with its problem, and not kept. A task that runs again after a
    lost executor asks its addresses again.
    """
    spark = addresses.sparkSession
    keyed = addresses.select(address_key(F.col("address")).alias("key"), "address").where("key <> ''").groupBy("key").agg(F.min("address").alias("address"))
    known = known_answers(spark, table).select(*(c.split()[0] for c in ANSWER.split(", ")))
    fresh = keyed.join(known.select("key"), "key", "left_anti").repartition(tasks, "key")
    run = _asker(transport, base, {"User-Agent": agent}, tasks / per_second, attempts)
    # Asked once and written; what failed lies beside the table, for this run only to tell.
    name = uuid.uuid4().hex
    asked, failures = f"{table.rstrip('/')}-runs/{name}", F.col("status") == "failed"
    fresh.mapInPandas(run, ANSWER).write.parquet(asked)
    came = spark.read.schema(ANSWER).parquet(asked)
    if not came.where(~failures).isEmpty():
        came.where(~failures).write.parquet(f"{table.rstrip('/')}/{name}")
    answers = known_answers(spark, table).dropDuplicates(["key"]).join(keyed.select("key"), "key", "left_semi")
    return answers.select(*known.columns).unionByName(came.where(failures))


def placed(reports: DataFrame, answers: DataFrame) -> DataFrame:
    """Reports with an address at (0, 0) put where the answers say; the others, and those not found, stay as they are."""
    from ..operators.spatial import geocode

    return geocode(reports, answers.where("status = 'found'").select("key", "lat", "lon"))
