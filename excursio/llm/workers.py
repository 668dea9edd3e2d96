"""The package on Python workers.

Operators whose tasks run Python refer to this package; a worker on another machine, or one that
was started in another folder, finds it only if the driver has handed it out.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_READY: set[str] = set()


#: Rows of a batch that goes to a Python worker, where whole texts go along from stage to stage.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Keep the batches of the session's later Python stages small: texts have any length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def ready(spark: SparkSession) -> None:
    """Hand the package out to the application's workers, once."""
    context = spark.sparkContext
    if context.applicationId in _READY:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as files:
        for source in sorted(package.rglob("*.py")):
            files.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _READY.add(context.applicationId)
