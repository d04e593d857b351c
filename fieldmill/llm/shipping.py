"""Makes this library importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Hand the package to the session's workers, once a session, unless ``PYTHONPATH`` already has it.

    Spark's own file distribution carries a small archive of the Python sources.
    """
    context = spark.sparkContext
    on_path = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT in on_path or getattr(context, "_fieldmill_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="fieldmill-")) / "fieldmill_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((_ROOT / "fieldmill").rglob("*.py")):
            out.write(source, source.relative_to(_ROOT))
    context.addPyFile(str(archive))
    context._fieldmill_shipped = True
