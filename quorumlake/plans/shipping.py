"""Makes the package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCHES, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the job's Python files, once an application. Python workers get batches of at
    most ``BATCH_ROWS`` rows, unless the session names another number: texts can be long."""
    if spark.conf.get(BATCHES) == "10000":  # Spark's default
        spark.conf.set(BATCHES, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="quorumlake-")) / "quorumlake.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)
