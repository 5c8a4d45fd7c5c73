"""The folder that all executors share, and tables that are worked out once."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (as JSON, which is more than they take in memory) up to which a table is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only where it is unset and Spark runs in one process."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        # Spark puts a folder of its own below the one that is set.
        return os.path.dirname(folder.rstrip("/"))
    folder = context.getConf().get("spark.checkpoint.dir") or ""
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallygrid-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; the files go with the frame where Spark's cleaner is told so."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def is_small(frame: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> bool:
    """Whether a table that was worked out has no more than so many rows and bytes; no more than `rows` are looked at."""
    said = F.octet_length(F.to_json(F.struct(*frame.columns)))
    n, size = frame.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(said), F.lit(0))).first()
    return n <= rows and size <= bytes_


def bounded_broadcast(frame: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> DataFrame:
    """`frame`, worked out once, with a broadcast hint if its rows and bytes are counted to be few."""
    frame = kept(frame)
    return F.broadcast(frame) if is_small(frame, rows, bytes_) else frame
