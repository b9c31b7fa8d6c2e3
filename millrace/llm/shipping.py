"""Readies a session for the text operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import millrace
from millrace.llm.files import save_bytes
from millrace.session import shared_dir

#: Rows of an Arrow batch, unless the session says otherwise. Texts are long: Spark's
#: default of 10,000 rows would be held whole by a task, in the JVM and in Python.
BATCH_ROWS = "1000"
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shipped(spark: SparkSession) -> SparkSession:
    """Adds the package's code, which the executors' Python workers may lack, to the
    session's Python files, once per context, from an archive in the shared folder; and
    keeps Arrow batches small."""
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, BATCH_ROWS)
    context = spark.sparkContext
    if not getattr(context, "_millrace_shipped", False):
        root = Path(millrace.__file__).parent
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        path = f"{shared_dir(spark)}/millrace/code-{uuid.uuid4().hex}.zip"
        save_bytes(path, archive.getvalue())
        context.addPyFile(path)
        context._millrace_shipped = True
    return spark
