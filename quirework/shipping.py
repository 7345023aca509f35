"""Sends the package's own sources to the executors, so that Arrow functions import it wherever a worker starts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; the driver serves the archive, no shared folder is needed."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quirework-")) / "quirework.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
