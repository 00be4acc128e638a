"""Semantic segmentation of transcripts: boundary scores, globally best cuts, chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.functions import vectors as V

#: Fixed values of the segmentation.
WINDOW_UNITS, SEMANTIC_WEIGHT, STRONG_PAUSE, MUSIC_FLOOR = 3, 0.82, 5.0, 1.8
MIN_WORDS, TARGET_WORDS, MAX_WORDS, THRESHOLD, LENGTH_PENALTY = 140, 450, 1800, 0.85, 0.14


def prefix_words(units: DataFrame, ident: str, order: list[str], words: str) -> DataFrame:
    """Adds ``prefix``: the words of an episode up to and with each unit."""
    line = Window.partitionBy(ident).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return units.withColumn("prefix", F.sum(words).over(line))


def score_boundaries(units: DataFrame, window_units: int = WINDOW_UNITS) -> DataFrame:
    """A row for every place between two units: how much the mean vectors on its sides differ, and the pause.

    All inside Catalyst: the vectors before and from each place on by lags and leads, added position by position, and exact quartiles.
    """
    line = Window.partitionBy("sr_episode_id").orderBy("unit_index")
    unit = units.select("sr_episode_id", "unit_index", V.unit(F.col("embedding")).alias("v"))
    names = [*(f"b{n}" for n in range(1, window_units + 1)), *(f"f{n}" for n in range(1, window_units))]
    unit = unit.withColumns({c: (F.lag if c[0] == "b" else F.lead)("v", int(c[1:])).over(line) for c in names}).filter("unit_index > 0")

    def mean(columns: list[str]) -> Column:
        total = F.col(columns[0])
        for c in columns[1:]:
            total = F.when(F.col(c).isNull(), total).otherwise(F.zip_with(total, F.col(c), lambda x, y: x + y))
        return V.scale(total, sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0)))

    sides = unit.select("sr_episode_id", "unit_index", mean(names[:window_units]).alias("l"), mean(["v", *names[window_units:]]).alias("r"))
    length = lambda c: F.greatest(V.norm(F.col(c)), F.lit(1e-12))
    apart = F.greatest(F.lit(0.0), 1 - V.dot(F.col("l"), F.col("r")) / length("l") / length("r"))
    scores = sides.select("sr_episode_id", "unit_index", apart.alias("semantic_distance"))
    spread = scores.groupBy("sr_episode_id").agg(F.percentile("semantic_distance", F.lit(0.25)).alias("lo"), F.percentile("semantic_distance", F.lit(0.9)).alias("hi"))
    pause = F.greatest(F.lit(0.0), F.col("pause_before_seconds"))
    rows = scores.join(spread, "sr_episode_id").join(units.select("sr_episode_id", "unit_index", pause.alias("pause_seconds"), F.col("start_seconds").alias("timestamp_seconds")), ["sr_episode_id", "unit_index"])
    semantic = F.least(F.greatest((F.col("semantic_distance") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-6)), F.lit(0.0)), F.lit(1.5))
    rows = rows.withColumns({"semantic_score": semantic, "pause_score": F.least(F.log1p("pause_seconds") / F.log(F.lit(4.0)), F.lit(1.5)), "likely_music_break": F.col("pause_seconds") >= STRONG_PAUSE})
    mixed = SEMANTIC_WEIGHT * F.col("semantic_score") + (1 - SEMANTIC_WEIGHT) * F.col("pause_score")
    rows = rows.withColumn("boundary_score", F.when(F.col("likely_music_break"), F.greatest(mixed, F.lit(MUSIC_FLOOR))).otherwise(mixed))
    return rows.withColumnRenamed("unit_index", "boundary_index").drop("lo", "hi")


def best_cuts(words: np.ndarray, scores: np.ndarray, least: int = MIN_WORDS, target: int = TARGET_WORDS, most: int = MAX_WORDS, threshold: float = THRESHOLD, penalty: float = LENGTH_PENALTY) -> list[int]:
    """Ends of the chunks with the highest total of boundary gains less length penalties.

    ``scores[i]`` is that of the cut before unit i. Of equal totals the shorter last chunk wins. One unit may be longer
    than ``most``; the whole transcript may be shorter than ``least``. Where no split is possible there is one chunk.
    """
    n = len(words)
    upto = np.concatenate([[0], np.cumsum(words)])
    total, source = np.full(n + 1, -np.inf), np.full(n + 1, -1)
    total[0] = 0.0
    for end in range(1, n + 1):
        starts = np.arange(end - 1, min(end - 1, int(np.searchsorted(upto, upto[end] - most))) - 1, -1)  # longer ones are not usable
        size = upto[end] - upto[starts]
        usable = ((size <= most) | (starts == end - 1)) & ((size >= least) | ((starts == 0) & (end == n)))
        gain = total[starts] - penalty * ((size - target) / max(target, 1)) ** 2 + (scores[end] - threshold if end < n else 0.0)
        gain[~usable] = -np.inf
        pick = int(gain.argmax())
        if gain[pick] > -np.inf:
            total[end], source[end] = gain[pick], starts[pick]
    if source[n] < 0:
        return [n]
    ends = [n]
    while source[ends[-1]] > 0:
        ends.append(int(source[ends[-1]]))
    return ends[::-1]


def select_boundaries(units: DataFrame, boundaries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``boundaries`` with ``selected`` and ``selection_reason``. Dynamic programming, an episode at a time in Arrow batches."""
    places = units.select("sr_episode_id", "unit_index", "word_count").join(boundaries.select("sr_episode_id", F.col("boundary_index").alias("unit_index"), "boundary_score"), ["sr_episode_id", "unit_index"], "left")

    def cut(episode: pd.DataFrame) -> pd.DataFrame:
        episode = episode.sort_values("unit_index")
        ends = best_cuts(episode["word_count"].to_numpy(), episode["boundary_score"].fillna(0.0).to_numpy())[:-1]
        return pd.DataFrame({"sr_episode_id": episode["sr_episode_id"].iloc[ends].to_numpy(), "boundary_index": episode["unit_index"].iloc[ends].to_numpy()})

    kind = units.schema["sr_episode_id"].dataType.simpleString()
    chosen = places.groupBy("sr_episode_id").applyInPandas(cut, f"sr_episode_id {kind}, boundary_index int").withColumn("selected", F.lit(True))
    rows = boundaries.join(chosen, ["sr_episode_id", "boundary_index"], "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    reason = F.when(F.col("likely_music_break"), "music_break").when(F.col("boundary_score") >= threshold, "semantic_transition").otherwise("length_constraint")
    return rows.withColumn("selection_reason", F.when(F.col("selected"), reason))


def materialise(units: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Chunks: units between selected boundaries, with their text, times and content id."""
    cuts = boundaries.filter("selected").select("sr_episode_id", F.col("boundary_index").alias("unit_index"), "boundary_score", F.lit(1).alias("cut"))
    rows = units.join(cuts, ["sr_episode_id", "unit_index"], "left")
    rows = rows.withColumn("chunk_index", F.sum(F.coalesce("cut", F.lit(0))).over(Window.partitionBy("sr_episode_id").orderBy("unit_index")))
    first = F.min_by(F.struct("boundary_score", "pause_before_seconds"), "unit_index")
    chunks = rows.groupBy("sr_episode_id", "chunk_index").agg(
        F.min("start_seconds").alias("start_seconds"), F.max("end_seconds").alias("end_seconds"), F.sum("word_count").alias("word_count"), F.count(F.lit(1)).alias("unit_count"), F.min("unit_index").alias("unit_start_index"), (F.max("unit_index") + 1).alias("unit_end_index"),
        T.squeeze(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_index", "text"))), lambda u: u["text"]), " ")).alias("text"), first.alias("first"),
    )
    chunks = chunks.withColumns({"chunk_id": T.content_id(F.col("sr_episode_id"), "c", F.col("chunk_index"), F.col("text")), "duration_seconds": F.col("end_seconds") - F.col("start_seconds"), "boundary_score": F.col("first.boundary_score"), "pause_before_seconds": F.col("first.pause_before_seconds")})
    return chunks.drop("first")
