"""What jobs need from the cluster: the package on its workers and a shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Make this package importable for the Python workers of every executor, once a session."""
    context = spark.sparkContext
    if getattr(context, "_skymart_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="skymart-package-")) / "skymart_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, os.path.join(_PACKAGE.name, source.relative_to(_PACKAGE)))
    context.addPyFile(str(target))
    context._skymart_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = getattr(context, "_skymart_folder", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = context._skymart_folder = tempfile.mkdtemp(prefix="skymart-shared-")
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write rows that several steps read to the shared folder, and cut their lineage there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
