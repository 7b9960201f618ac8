"""This package on the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import scenequarry
from pyspark.sql import SparkSession


#: Rows that go to a Python task at once, at most: whole texts are wide rows, and each batch stands in both processes' memory.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Give the package to all workers of the session, once; the driver serves the file, as with ``--py-files``.

    Functions that run in tasks can then name their helpers, also where the session was started without the package. Arrow
    batches of the session are kept at ``BATCH_ROWS`` rows; a smaller setting stays.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_scenequarry_shipped", False):
        return
    root = Path(scenequarry.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="scenequarry-")) / "scenequarry.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
    context._scenequarry_shipped = True
