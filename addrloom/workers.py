"""Makes this package importable in Python workers, wherever the driver has it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Sends the package's source (some 100 KB) to the executors, once per application.

    Functions of a module reach a worker by name; a cluster's workers know neither the driver's
    path nor its working folder.
    """
    context = spark.sparkContext
    if getattr(context, "_addrloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="addrloom-")) / "addrloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    context.addPyFile(str(target))
    context._addrloom_shipped = True
