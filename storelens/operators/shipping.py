"""This package's code on the executors, for functions that run in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import storelens

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once per application.

    Spark's file server hands it out; only the driver reads the archive it writes.
    """
    app = spark.sparkContext.applicationId
    home = Path(storelens.__file__).parent
    if app in _SHIPPED or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="storelens-code-")) / "storelens.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
