"""The package's code for Python workers that cannot import it themselves."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a Spark context; Spark copies it to each of them."""
    context = spark.sparkContext
    if getattr(context, "_framelake_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="framelake-code-")) / "framelake_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    context.addPyFile(str(path))
    context._framelake_shipped = True
