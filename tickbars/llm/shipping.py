"""The library's code for the Python workers of a session, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tickbars

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once for each application; Spark copies it to the executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tickbars.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="tickbars-code-"), "tickbars.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
