"""Make the package importable on executors that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ensure_on_executors(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else the package itself was imported from an archive
        archive = Path(tempfile.mkdtemp(prefix="textloom-")) / "textloom.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, f"{root.name}/{path.relative_to(root)}")
        context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
