"""Sends this package to the Python workers of a session that was started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application, unless PYTHONPATH or --py-files already name the package.

    The archive is the driver's alone: Spark serves it to the workers.
    """
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(_PACKAGE.parent) in known or context.applicationId in _SENT:
        return
    archive = Path(tempfile.mkdtemp()) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
