"""Markdown catalogues: headings carried forward, table rows, the list of curated topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line``, ``text`` of text files; every file is read as a whole, so its lines keep their order."""
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return files.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))


def carry_headings(lines: DataFrame, heading: Column, order: str, keys: list[str]) -> DataFrame:
    """Adds ``heading``: the last one at or above each line."""
    above = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("heading", F.last(heading, ignorenulls=True).over(above))


def topic_rows(lines: DataFrame, stop: str = r"^#+ ", after: str | None = None) -> DataFrame:
    """Rows ``| label | description | ids |`` of each file, up to the heading that matches ``stop``.

    Two topics with one slug, or a file without topics, are errors when the result is collected by ``checked``.
    """
    cells = F.transform(F.split(F.regexp_replace(F.trim("text"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    end = F.min(F.when(F.col("text").rlike(stop), F.col("line"))).over(Window.partitionBy("file"))
    rows = lines.withColumn("__end", end).filter(F.col("__end").isNull() | (F.col("line") < F.col("__end")))
    rows = rows.filter(F.trim("text").startswith("|")).withColumn("c", cells).filter((F.size("c") >= 3) & F.col("c")[2].rlike(r"\d"))
    ids = F.transform(F.regexp_extract_all(F.col("c")[2], F.lit(r"\d+"), 0), lambda x: x.cast("int"))
    return rows.select("file", "line", T.simple_slug(F.col("c")[0]).alias("topic_id"), F.col("c")[0].alias("label"), F.col("c")[1].alias("description"), ids.alias("raw_topic_ids"))


def checked(topics: DataFrame) -> DataFrame:
    """The topics; raises where a slug comes twice or there is none."""
    if topics.limit(1).count() == 0:
        raise ValueError("no topics")
    twice = topics.groupBy("topic_id").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"topic {twice[0][0]} comes twice")
    return topics


def with_guidance(topics: DataFrame, guidance: DataFrame) -> DataFrame:
    """Topics with their examples; both sides must have the same topic ids."""
    both = topics.withColumn("__t", F.lit(1)).join(guidance.withColumn("__g", F.lit(1)), "topic_id", "full_outer")
    fault = F.when(F.col("__t").isNull() | F.col("__g").isNull(), F.raise_error(F.concat(F.lit("topic on one side only: "), F.col("topic_id"))))
    query = F.concat(F.col("label"), F.lit(". "), F.col("description"), F.lit(" "), F.array_join("positive_examples", " "))
    return both.withColumn("topic_id", F.coalesce(fault, F.col("topic_id"))).withColumn("query_text", query).drop("__t", "__g")
