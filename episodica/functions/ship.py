"""Making this package importable on the executors, as --py-files would."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    if (app := spark.sparkContext.applicationId) not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='episodica-')}/episodica", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
