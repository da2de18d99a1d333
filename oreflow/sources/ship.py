"""Makes this package importable in Python workers, wherever the session was started from."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's source files to all executors, once for each application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _done:
        return
    top = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="oreflow-")  # the driver's; Spark copies the file from there to the executors
    target = os.path.join(folder, f"{top.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(top.rglob("*.py")):
            archive.write(path, path.relative_to(top.parent))
    context.addPyFile(target)
    _done.add(context.applicationId)
