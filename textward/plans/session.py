"""Making this package importable on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import textward

_ARCHIVE = "textward.zip"


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors once, like ``--py-files`` on submit."""
    sc = spark.sparkContext
    if any(f.endswith("/" + _ARCHIVE) for f in sc.listFiles):
        return
    root = Path(textward.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="textward-src-")) / _ARCHIVE
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
