"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: The folder that a session in one process made for itself, and the application it is for.
_made: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a session in one process gets a temporary folder that goes with it; a cluster has to name one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _made.get(context.applicationId)
    if not folder:
        if not re.match(r"local(\[[^\]]*\])?$", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="tallgrass-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        folder = _made[context.applicationId] = "file://" + made  # the setting itself can't be changed once the session is there
    return folder.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_folder(spark)}/tallgrass/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that still read them can't be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that go to Python at once. Texts are long: Spark's 10,000 would be tens of megabytes on both sides of each task.
BATCH_ROWS = 1000


@contextlib.contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    most = int(before or "10000")
    spark.conf.set(key, str(min(rows, most) if most > 0 else rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: this cuts lineage and survives lost executors.

    Python gets ``batch_rows`` rows at once meanwhile, and the session's setting afterwards again.
    """
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _batches_of(spark, batch_rows):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
