"""Give the executors this package's code."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: add a zip of the package to what executors import."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="textloom-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, os.path.join(package.name, p.relative_to(package)))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)
