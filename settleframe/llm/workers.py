"""Making this package importable in Spark's Python workers, and bounding what
reaches them at once."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import settleframe


BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once per Spark context, as a zip that
    Spark itself serves from the driver (what ``--py-files`` does).

    Unless the session says otherwise, Arrow batches end at 4 MB: the default of
    10,000 rows is tens of megabytes of whole texts, in the JVM and in Python.
    """
    if spark.conf.get(_BATCH_KEY, None) is None:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_settleframe_shipped", False):
        return
    root = Path(settleframe.__file__).parent
    if root.is_dir():  # else the package itself came in a zip
        path = Path(tempfile.mkdtemp(prefix="settleframe-py-")) / "settleframe.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(path))
    sc._settleframe_shipped = True
