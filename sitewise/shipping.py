"""The package on executors that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> str:
    """Packs the package and gives it to all executors, those that start later too; gives the archive's path."""
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="sitewise-")) / "sitewise.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(here.rglob("*.py")):
            archive.write(file, file.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(path))
    return str(path)
