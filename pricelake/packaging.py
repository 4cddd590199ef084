"""Sends this package to the executors, for sessions that were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Zip the package on the driver and add it to the session once; the executors fetch it from the driver."""
    application = spark.sparkContext.applicationId
    if application not in _sent:
        target = os.path.join(tempfile.mkdtemp(prefix="pricelake-package-"), "pricelake.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(ROOT):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(ROOT)))
        spark.sparkContext.addPyFile(target)
        _sent.add(application)
    return spark
