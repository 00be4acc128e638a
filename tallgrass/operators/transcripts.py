"""Transcript cleaning and the folding of segments into units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T

#: Fixed values of the unit builder.
TARGET_WORDS, MIN_WORDS, PAUSE_SECONDS = 80, 24, 1.5


def valid_segments(segments: DataFrame, ident: str = "sr_episode_id", index: str = "segment_index") -> DataFrame:
    """Segments with text and readable times whose end is not before their start; text squeezed, words counted."""
    rows = segments.select(ident, index, F.col("start").try_cast("double").alias("start"), F.col("end").try_cast("double").alias("end"), T.squeeze(F.coalesce("text", F.lit(""))).alias("text"))
    rows = rows.filter((F.col("text") != "") & F.col("start").isNotNull() & (F.col("end") >= F.col("start")))
    return rows.withColumn("word_count", F.size(F.split("text", " ")))


def flag_segments(segments: DataFrame, ident: str = "sr_episode_id") -> DataFrame:
    """Adds ``artifact_reasons`` and ``boilerplate_reasons``; nothing is removed, so what is dropped later can be audited."""
    duration = F.max("end").over(Window.partitionBy(ident))
    rows = segments.withColumn("__d", duration).withColumn("boilerplate_reasons", T.boilerplate_reasons(F.col("text"), F.col("start"), F.col("end"), F.col("__d")))
    rows = rows.withColumn("__w", T.swedish_words(F.col("text")))
    return rows.withColumn("artifact_reasons", T.artifact_reasons(F.col("text"), F.col("__w"))).drop("__d", "__w")


def clean(flagged: DataFrame) -> DataFrame:
    return flagged.filter((F.size("artifact_reasons") == 0) & (F.size("boilerplate_reasons") == 0))


def removed(flagged: DataFrame) -> DataFrame:
    return flagged.filter((F.size("artifact_reasons") > 0) | (F.size("boilerplate_reasons") > 0))


def trailing_cut(segments: DataFrame, is_credit: Column, is_cue: Column, ident: str = "sr_episode_id", tail: float = T.TAIL_SECONDS, audit: DataFrame | None = None) -> DataFrame:
    """Segments before the trailing recommendation. It begins at the last credit of the final ``tail`` seconds, from
    segments or from ``audit`` (``ident``, ``start`` of credits removed before), or else at the first cue there."""
    duration = F.max("end").over(Window.partitionBy(ident))
    late = segments.withColumns({"__credit": is_credit, "__cue": is_cue, "__d": duration}).filter(F.col("start") >= F.col("__d") - tail)
    ends = late.groupBy(ident).agg(F.max(F.when(F.col("__credit"), F.col("start"))).alias("__c"), F.min(F.when(F.col("__cue"), F.col("start"))).alias("__q"))
    if audit is not None:
        before = audit.groupBy(ident).agg(F.max("start").alias("__a"))
        ends = ends.join(before, ident, "full_outer").select(ident, F.greatest("__c", "__a").alias("__c"), "__q")
    cut = ends.select(ident, F.coalesce("__c", "__q").alias("__cut"))
    return segments.join(cut, ident, "left").filter(F.col("__cut").isNull() | (F.col("start") < F.col("__cut"))).drop("__cut")


def pauses(rows: DataFrame, ident: str, order: str, start: str = "start", end: str = "end") -> DataFrame:
    """Adds ``pause_before``: seconds since the end of the row before, 0 for the first and where they overlap."""
    before = F.lag(end).over(Window.partitionBy(ident).orderBy(order))
    return rows.withColumn("pause_before", F.greatest(F.lit(0.0), F.coalesce(F.col(start) - before, F.lit(0.0))))


def build_units(segments: DataFrame, ident: str = "sr_episode_id", index: str = "segment_index", target: int = TARGET_WORDS, least: int = MIN_WORDS, pause: float = PAUSE_SECONDS) -> DataFrame:
    """Units of an episode: a unit closes when it has ``least`` words, and either ``target`` words or a pause follows.

    A last unit of fewer than ``least`` words joins the one before, unless a pause is between them. The fold over an
    episode's ordered segments stays inside Catalyst; one episode's segments are a bounded array.
    """
    kind = "array<struct<unit:int,words:int>>"
    listed = segments.groupBy(ident).agg(F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), "start", "end", "word_count"))).alias("segs"))
    zero = F.struct(F.lit(0).alias("unit"), F.lit(0).alias("words"), F.lit(None).cast("double").alias("end"), F.array().cast(kind).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.greatest(F.lit(0.0), F.coalesce(s["start"] - acc["end"], F.lit(0.0)))
        close = (acc["words"] > 0) & (acc["words"] >= least) & ((acc["words"] >= target) | (gap >= pause))
        unit = acc["unit"] + close.cast("int")
        words = F.when(close, s["word_count"]).otherwise(acc["words"] + s["word_count"])
        return F.struct(unit.alias("unit"), words.alias("words"), s["end"].alias("end"), F.concat(acc["out"], F.array(F.struct(unit.alias("unit"), words.alias("words")))).alias("out"))

    folded = listed.withColumn("u", F.aggregate("segs", zero, step, lambda acc: acc["out"]))
    rows = folded.select(ident, F.posexplode(F.arrays_zip("segs", "u")).alias("p", "z")).select(ident, F.col("z.segs.i").alias(index), F.col("z.segs.start").alias("start"), F.col("z.segs.end").alias("end"), F.col("z.segs.word_count").alias("word_count"), F.col("z.u.unit").alias("unit"))
    whole, line = Window.partitionBy(ident), Window.partitionBy(ident).orderBy(index)
    rows = rows.withColumns({"last": F.max("unit").over(whole), "before": F.lag("end").over(line)})
    in_last = F.col("unit") == F.col("last")
    rows = rows.withColumns({"tail_words": F.sum(F.when(in_last, F.col("word_count"))).over(whole), "tail_gap": F.min_by(F.greatest(F.lit(0.0), F.col("start") - F.col("before")), F.when(in_last, F.col(index))).over(whole)})
    merge = in_last & (F.col("last") > 0) & (F.col("tail_words") < least) & (F.col("tail_gap") < pause)
    rows = rows.withColumn("unit_index", F.col("unit") - merge.cast("int")).select(ident, index, "unit_index")
    rows = rows.join(segments, [ident, index])
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), "text"))), lambda t: t["text"])
    units = rows.groupBy(ident, "unit_index").agg(F.min("start").alias("start_seconds"), F.max_by("end", index).alias("end_seconds"), T.squeeze(F.array_join(texts, " ")).alias("text"), F.sum("word_count").cast("long").alias("word_count"), F.count(F.lit(1)).alias("segment_count"))
    units = pauses(units, ident, "unit_index", "start_seconds", "end_seconds").withColumnRenamed("pause_before", "pause_before_seconds")
    return units.withColumn("unit_id", T.content_id(F.col(ident), "u", F.col("unit_index"), F.col("text")))


def audit(flagged: DataFrame) -> DataFrame:
    """How often each reason occurs, by kind, and the numbers of segments kept and removed."""
    kinds = [flagged.select(F.lit(k).alias("kind"), F.explode(f"{k}_reasons").alias("reason")).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n")) for k in ("artifact", "boilerplate")]
    kept = (F.size("artifact_reasons") == 0) & (F.size("boilerplate_reasons") == 0)
    totals = flagged.groupBy(F.lit("segments").alias("kind"), F.when(kept, "kept").otherwise("removed").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return kinds[0].unionByName(kinds[1]).unionByName(totals)


def audit_report(flagged: DataFrame, ident: str = "sr_episode_id") -> DataFrame:
    """``json``, one row: numbers of segments, episodes, kept and removed segments, and of every reason."""
    counts = audit(flagged)
    reasons = lambda kind: F.map_from_entries(F.sort_array(F.filter(F.collect_list(F.when(F.col("kind") == kind, F.struct("reason", "n"))), lambda x: x.isNotNull())))
    of = lambda reason: F.coalesce(F.sum(F.when((F.col("kind") == "segments") & (F.col("reason") == reason), F.col("n"))), F.lit(0).cast("long"))
    sums = counts.agg(of("kept").alias("kept"), of("removed").alias("removed"), reasons("artifact").alias("artifact_reasons"), reasons("boilerplate").alias("boilerplate_reasons"))
    episodes = flagged.agg(F.count_distinct(ident).alias("episodes"))  # one row
    whole = sums.join(F.broadcast(episodes)).select((F.col("kept") + F.col("removed")).alias("segments"), "episodes", "kept", "removed", "artifact_reasons", "boilerplate_reasons")
    return whole.select(F.to_json(F.struct(*whole.columns)).alias("json"))
