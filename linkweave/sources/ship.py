"""Make the package importable on executors that do not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="linkweave-")  # the driver's own: Spark serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "linkweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
