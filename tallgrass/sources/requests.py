"""Requests to a service as a stream: what is asked for stands in a log of requests, what was answered in the stream's checkpoint.

A run adds the requests that the log lacks, and the stream goes on where it stood. The driver holds neither requests nor answers. Beside
the table ``cache`` are the folders ``cache.requests`` (a file for some requests, whose ids stand in arrays of bounded length) and ``cache.state``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.operators import incremental

Ask = Callable[[list], list[tuple]]


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table in the folder ``path``, or one without rows."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def forget(spark: SparkSession, cache: str) -> None:
    """Deletes the cache with its requests and state."""
    for path in (cache + ".state", cache + ".requests", cache):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def request(wanted: DataFrame, key: str, cache: str, size: int, wave: int) -> None:
    """Adds a request for every ``size`` of the wanted keys that no request has named, ``wave`` requests to a file."""
    spark, kind = wanted.sparkSession, wanted.schema[key].dataType.simpleString()
    named = table(spark, cache + ".requests", f"batch long, ids array<{kind}>").select(F.explode("ids").alias(key))
    todo = incremental.batches(incremental.pending(wanted.select(key), named, key), key, size)
    rows = todo.groupBy("batch").agg(F.sort_array(F.collect_list(key)).alias("ids"))  # ``size`` to a batch
    if not rows.isEmpty():
        rows.write.mode("append").option("maxRecordsPerFile", wave).parquet(cache + ".requests")


def answer(spark: SparkSession, kind: str, cache: str, ask: Ask, schema: str, tasks: int) -> None:
    """Answers the requests that are open, a file of them at a time in ``tasks`` tasks, and appends each file's answers to ``cache`` as a whole.

    A request is asked again only if the run broke off before its file's answers were there.
    """
    names = [field.name for field in spark.createDataFrame([], schema).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids in batch["ids"]:
                yield pd.DataFrame(ask(list(ids)), columns=names)

    open_ = spark.readStream.schema(f"batch long, ids array<{kind}>").option("maxFilesPerTrigger", 1).parquet(cache + ".requests")
    answers = open_.repartition(tasks).mapInPandas(run, schema)
    stream = answers.writeStream.format("parquet").option("path", cache).option("checkpointLocation", cache + ".state").trigger(availableNow=True).start()
    try:
        stream.awaitTermination()
    finally:
        stream.stop()


def answers(wanted: DataFrame, key: str, cache: str, ask: Ask, schema: str, size: int = 1, wave: int = 8, tasks: int | None = None, refresh: bool = False) -> DataFrame:
    """The table ``cache`` with the answers to all wanted keys, of which only those are asked for that never were.

    ``ask`` gets up to ``size`` keys and returns rows of ``schema``; a key without an answer needs no row to be remembered. ``wave`` requests are kept together, asked by
    ``tasks`` tasks (one for each, if not said otherwise). Null keys are left out. ``refresh`` asks for everything again. One run at a time.
    """
    spark = wanted.sparkSession
    if refresh:
        forget(spark, cache)
    request(wanted, key, cache, size, wave)
    kind = wanted.schema[key].dataType.simpleString()
    if not table(spark, cache + ".requests", f"batch long, ids array<{kind}>").isEmpty():
        answer(spark, kind, cache, ask, schema, tasks or wave)
    return table(spark, cache, schema)
