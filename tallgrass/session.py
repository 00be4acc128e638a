"""Session settings shared by the command line, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | None = None, memory: str = "8g", name: str = "tallgrass") -> SparkSession:
    """A session on this machine; on a cluster the caller brings its own."""
    cores = cores or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: its functions run there, installed or not."""
    context = spark.sparkContext
    if getattr(context, "_tallgrass_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallgrass-")) / "tallgrass.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    context._tallgrass_shipped = True
