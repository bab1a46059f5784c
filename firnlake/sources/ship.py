"""The package for Python workers: executors get it with the session's files, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package to the session's files, once for each context; nothing if it already runs from an archive."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_firnlake_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="firnlake-")) / "firnlake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    context.addPyFile(str(archive))
    # the driver's own Python workers, which plan streams, look here only
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(root.parent), context.environment.get("PYTHONPATH")]))
    context._firnlake_shipped = True
