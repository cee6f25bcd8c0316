"""Make the package importable in Python workers (the ``--py-files`` way)."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application. Needed wherever Python
    runs there: completions, line ranges, checks of configurations, training data."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="corpusflow-ship-")) / "corpusflow"
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
