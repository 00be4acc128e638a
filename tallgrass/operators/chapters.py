"""Chapters: anchors found in transcripts, boundaries accepted greedily, segment ranges."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T

#: How far a window may differ in width, weights of the two similarities, least score, least gap.
WIDTH_SLACK, SEQUENCE_WEIGHT, OVERLAP_WEIGHT, LEAST_SCORE, LEAST_GAP = 4, 0.7, 0.3, 0.64, 3


def anchor_score(target: list[str], window: list[str]) -> float:
    common = len(set(target) & set(window)) / max(len(set(target)), 1)
    return SEQUENCE_WEIGHT * SequenceMatcher(a=target, b=window).ratio() + OVERLAP_WEIGHT * common


def match_anchors(segments: DataFrame, anchors: DataFrame, ident: str, index: str = "segment_index") -> DataFrame:
    """For each anchor (``ident``, ``anchor``), the segment at whose end a window of words fits it best, and the score.

    Windows are a few words narrower to a few wider than the anchor; the first best wins. Anchors of fewer than two words
    are left out. Words are found by Catalyst; the Ratcliff-Obershelp ratio has no built-in, so it runs an episode at a time.
    """
    kind = segments.schema[ident].dataType.simpleString()
    lines = segments.select(ident, F.col(index).cast("int").alias("i"), T.word_list(F.col("text")).alias("w"), F.lit(None).cast("string").alias("anchor"))
    asked = anchors.select(ident, F.lit(-1).alias("i"), T.word_list(F.col("anchor")).alias("w"), "anchor").filter(F.size("w") >= 2)

    def best(episode: pd.DataFrame) -> pd.DataFrame:
        segs, out, flow, ends = episode[episode["i"] >= 0].sort_values("i"), [], [], []
        for i, words in zip(segs["i"], segs["w"], strict=True):
            flow.extend(words)
            if flow:
                ends.append((int(i), len(flow)))
        for row in episode[episode["i"] < 0].itertuples():
            target, top = list(row.w), (-1.0, -1)
            for i, end in ends:
                for width in range(max(2, len(target) - WIDTH_SLACK), len(target) + WIDTH_SLACK + 1):
                    score = anchor_score(target, flow[max(0, end - width) : end])
                    if score > top[0]:
                        top = (score, i)
            if top[1] >= 0:
                out.append((episode[ident].iloc[0], row.anchor, top[1], top[0]))
        return pd.DataFrame(out, columns=[ident, "anchor", index, "score"])

    return lines.unionByName(asked).groupBy(ident).applyInPandas(best, f"{ident} {kind}, anchor string, {index} int, score double")


def accept_boundaries(found: Column, least_score: float = LEAST_SCORE, gap: int = LEAST_GAP) -> Column:
    """Boundaries (array of ``segment_index``, ``score``) kept in order: weak and early ones go, of two that are close the better stays."""
    usable = F.array_sort(F.filter(found, lambda b: (b["score"] >= least_score) & (b["segment_index"] >= gap)))

    def step(kept: Column, b: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        close = (F.size(kept) > 0) & (b["segment_index"] - last["segment_index"] < gap)
        swap = F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(b))
        return F.when(~close, F.concat(kept, F.array(b))).when(b["score"] > last["score"], swap).otherwise(kept)

    return F.aggregate(usable, F.slice(usable, 1, 0), step)


def chapter_ranges(boundaries: DataFrame, counts: DataFrame, ident: str, index: str = "segment_index") -> DataFrame:
    """Inclusive segment ranges: each boundary ends a chapter, the rest is the last one. ``counts`` has ``segments`` by ``ident``."""
    ends = boundaries.select(ident, F.col(index).cast("long").alias("last")).union(counts.select(ident, (F.col("segments") - 1).cast("long"))).distinct()
    line = Window.partitionBy(ident).orderBy("last")
    rows = ends.withColumn("first", F.coalesce(F.lag("last").over(line) + 1, F.lit(0)))
    return rows.filter("first <= last").select(ident, (F.row_number().over(line) - 1).alias("chapter_index"), "first", "last")
