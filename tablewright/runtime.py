"""Making this package importable where Python runs on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each Spark context.

    Only needed by operators that run Python on executors, and harmless where the package is
    installed there already.
    """
    context = spark.sparkContext
    if getattr(context, "_tablewright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tablewright-")) / "tablewright_source.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, str(Path("tablewright") / file.relative_to(root)))
    context.addPyFile(str(archive))
    context._tablewright_shipped = True
