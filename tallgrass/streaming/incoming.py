"""Transcripts as they arrive. An extension: the batch operators hold no state, so the same flags run on a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallgrass.functions import text as T

SCHEMA = "sr_episode_id bigint, segment_index int, start double, end double, duration double, text string"


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of JSON lines with ``SCHEMA``."""
    return spark.readStream.schema(SCHEMA).json(folder)


def flagged(stream: DataFrame) -> DataFrame:
    """Reasons why a segment is noise or framing; row by row, so no watermark is needed."""
    return stream.withColumns({"artifact_reasons": T.artifact_reasons(F.col("text")), "boilerplate_reasons": T.boilerplate_reasons(F.col("text"), F.col("start"), F.col("end"), F.col("duration"))})


def start(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there, exactly once, and stops."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
