"""Give the executors this package, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


#: Bytes of an Arrow batch at most, unless the session has its own limit: rows here are whole texts.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application's Python files, once per application, and keep Arrow batches small."""
    if spark.conf.get(BATCH_KEY) == f"{64 << 20}b":  # Spark's own default
        spark.conf.set(BATCH_KEY, f"{BATCH_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
