"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, unless their PYTHONPATH has it."""
    context = spark.sparkContext
    there = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(ROOT.parent) in there or context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tallygrid-"), "tallygrid.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(ROOT.rglob("*.py")):
            z.write(path, path.relative_to(ROOT.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def carry(*modules) -> None:
    """Send what functions use of these modules along with them: Spark's own worker for state on the driver gets no archive."""
    from pyspark import cloudpickle

    for module in modules:
        cloudpickle.register_pickle_by_value(module)
