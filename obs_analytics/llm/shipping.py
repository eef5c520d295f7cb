"""Give executors' Python workers this package, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per
    application, so tasks can import it on any machine."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)
