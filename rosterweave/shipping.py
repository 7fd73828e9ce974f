"""The package on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so that operators with Python code run wherever the driver was started."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="rosterweave-")  # on the driver, which serves the file as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    file = f"{folder}/{root.name}-{app}.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(file)
    _shipped.add(app)
