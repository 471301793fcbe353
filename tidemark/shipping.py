"""Sends this package to the executors' Python workers."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: add the package as a py-file, served by the driver to every executor."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    atexit.register(Path(name).unlink, missing_ok=True)
    context.addPyFile(name)
    _SENT.add(context.applicationId)
