"""Topic assignment with auditable thresholds, evidence roll-ups, calibration, term weights and clustering."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallgrass.functions import vectors as V
from tallgrass.operators import layout
from tallgrass.operators.neighbours import neighbours
from tallgrass.staging import stage

#: Topics of a catalogue that go to every task as one array; larger catalogues come in parts, one after the other.
MAX_TOPICS = 10_000


@dataclass(frozen=True)
class Thresholds:
    """What an assignment needs. ``None`` turns a rule off."""

    min_similarity: float = 0.51
    min_winner_margin: float = 0.01
    accept_ambiguous_above: float | None = 0.56
    supporting_min: float | None = 0.495
    supporting_margin: float = 0.008
    min_negative_margin: float | None = None
    secondary_min: float | None = None
    secondary_max_gap: float = 0.015


def negative_pairs(examples: DataFrame, topic: str, value: str, order: str | None = None) -> DataFrame:
    """``topic`` and ``pair``, an array of its two negative examples in the order of ``order``; any other number of them is an error."""
    place = F.lit(0) if order is None else F.col(order)
    pairs = examples.groupBy(topic).agg(F.transform(F.sort_array(F.collect_list(F.struct(place.alias("p"), F.col(value).alias("v")))), lambda x: x["v"]).alias("pair"))
    fault = F.raise_error(F.concat(F.lit("not two negative examples: "), F.col(topic).cast("string")))
    return pairs.withColumn("pair", F.when(F.size("pair") == 2, F.col("pair")).otherwise(fault.cast(pairs.schema["pair"].dataType)))


def decide(chunks: DataFrame, topics: DataFrame, rules: Thresholds = Thresholds(), floors: Mapping[str, float] | None = None, negatives: DataFrame | None = None) -> DataFrame:
    """A decision for every chunk: best and second topic, margins, acceptance, tier and the reason of a rejection.

    ``chunks`` has ``embedding``; ``topics`` has ``topic_id`` and ``embedding`` (unit vectors), ``negatives`` has ``topic_id`` and ``embedding``, two rows a topic
    (any other number is an error). The catalogue travels as an array column, MAX_TOPICS at a time, so a chunk meets all topics in its own
    row and keeps the two best. Of equal similarities the smaller topic id wins.
    """
    number = topics.count()
    if number < 2:
        raise ValueError("at least two topics are needed")
    parts = -(-number // MAX_TOPICS)
    kind = topics.schema["topic_id"].dataType.simpleString()
    one = F.struct(F.lit(None).cast("double").alias("minus"), F.lit(None).cast(kind).alias("topic_id"))
    rows = chunks.withColumn("__top", F.struct(one.alias("first"), one.alias("second")))

    def keep(top: Column, t: Column) -> Column:
        new = F.struct((-V.dot(F.col("embedding"), t["embedding"])).alias("minus"), t["topic_id"].alias("topic_id"))
        better = lambda old: old["minus"].isNull() | (new < old)
        return F.when(better(top["first"]), F.struct(new.alias("first"), top["first"].alias("second"))).when(better(top["second"]), F.struct(top["first"].alias("first"), new.alias("second"))).otherwise(top)

    for part in range(parts):
        some = topics if parts == 1 else topics.filter(F.pmod(F.xxhash64("topic_id"), F.lit(parts)) == part)
        catalogue = some.agg(F.collect_list(F.struct("topic_id", "embedding")).alias("__topics"))
        rows = rows.join(F.broadcast(catalogue)).withColumn("__top", F.aggregate("__topics", F.col("__top"), keep)).drop("__topics")
    first, second = F.col("__top.first"), F.col("__top.second")
    rows = rows.select("*", first["topic_id"].alias("best_topic_id"), (-first["minus"]).alias("best_similarity"), second["topic_id"].alias("runner_up_topic_id"), (-second["minus"]).alias("runner_up_similarity"))
    rows = rows.drop("__top").withColumn("winner_margin", F.col("best_similarity") - F.col("runner_up_similarity"))
    floor = lambda topic: F.coalesce(F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(float(v)))])[topic], F.lit(rules.min_similarity)) if floors else F.lit(rules.min_similarity)
    rows = rows.withColumn("required_similarity", floor(F.col("best_topic_id")))
    if negatives is None:
        rows = rows.withColumn("negative_similarity", F.lit(None).cast("double"))
    else:
        against = negative_pairs(negatives, "topic_id", "embedding").select(F.col("topic_id").alias("best_topic_id"), F.col("pair").alias("__neg"))
        rows = rows.join(F.broadcast(against) if parts == 1 else against, "best_topic_id", "left")
        rows = rows.withColumn("negative_similarity", F.array_max(F.transform("__neg", lambda n: V.dot(F.col("embedding"), n)))).drop("__neg")
    rows = rows.withColumn("negative_margin", F.col("best_similarity") - F.col("negative_similarity"))
    best, margin = F.col("best_similarity"), F.col("winner_margin")
    passes_negative = F.lit(True) if rules.min_negative_margin is None else F.coalesce(F.col("negative_margin") >= rules.min_negative_margin, F.lit(True))
    passes_margin = margin >= rules.min_winner_margin
    if rules.accept_ambiguous_above is not None:
        passes_margin = passes_margin | (best >= rules.accept_ambiguous_above)
    strong = (best >= F.col("required_similarity")) & passes_margin & passes_negative
    supporting = F.lit(False)
    if rules.supporting_min is not None:
        supporting = ~strong & (best >= rules.supporting_min) & (margin >= rules.supporting_margin) & passes_negative
    below = F.when(best < rules.supporting_min, "below_supporting_threshold") if rules.supporting_min is not None else F.when(best < F.col("required_similarity"), "below_topic_threshold")
    reason = F.coalesce(below, F.when(~passes_margin & ~supporting, "ambiguous_winner"), F.when(~passes_negative, "negative_near_miss"), F.when(~(strong | supporting), "below_topic_threshold"))
    return rows.withColumns({"accepted": strong | supporting, "evidence_tier": F.when(strong, "strong").when(supporting, "supporting"), "rejection_reason": reason})


def assignments(decisions: DataFrame, rules: Thresholds = Thresholds(), floors: Mapping[str, float] | None = None) -> DataFrame:
    """Accepted topics of the chunks by rank; with ``secondary_min`` the second topic too where it comes close to the first."""
    accepted = decisions.filter("accepted")
    keep = [c for c in decisions.columns if c in ("chunk_id", "sr_episode_id", "word_count", "start_seconds", "end_seconds", "excerpt")]
    first = accepted.select(*keep, F.col("best_topic_id").alias("topic_id"), F.col("best_similarity").alias("similarity"), F.lit(1).alias("chunk_topic_rank"), "winner_margin", "evidence_tier")
    if rules.secondary_min is None:
        return first
    own = F.lit(rules.min_similarity)
    if floors:
        own = F.coalesce(F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(float(v)))])[F.col("runner_up_topic_id")], own)
    near = (F.col("runner_up_similarity") >= F.greatest(F.lit(rules.secondary_min), own)) & (F.col("winner_margin") <= rules.secondary_max_gap)
    second = accepted.filter(near).select(*keep, F.col("runner_up_topic_id").alias("topic_id"), F.col("runner_up_similarity").alias("similarity"), F.lit(2).alias("chunk_topic_rank"), (-F.col("winner_margin")).alias("winner_margin"), F.lit("secondary").alias("evidence_tier"))
    return first.unionByName(second)


def curated_rollup(assigned: DataFrame, totals: DataFrame, min_coverage: float = 0.03, min_words: int = 140, single_min: float = 0.515, supporting_chunks: int = 2, supporting_coverage: float = 0.08, supporting_words: int = 250) -> DataFrame:
    """Topics of an episode with enough evidence, ranked by score = coverage x mean similarity; ties by topic id.

    ``totals`` has ``sr_episode_id`` and ``episode_words``. The representative excerpt is that of the most similar chunk.
    """
    strong = F.col("evidence_tier").isNull() | F.col("evidence_tier").isin("strong", "secondary")
    sums = assigned.groupBy("sr_episode_id", "topic_id").agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.sum(strong.cast("long")).alias("strong_chunk_count"),
        F.sum("word_count").alias("evidence_words"),
        (F.sum(F.col("similarity") * F.col("word_count")) / F.sum("word_count")).alias("mean_similarity"),
        F.max("similarity").alias("max_similarity"),
        F.max(F.struct("similarity", (-F.col("start_seconds")).alias("early"), "chunk_id"))["chunk_id"].alias("representative_chunk_id"),
    )
    rows = sums.join(totals, "sr_episode_id").withColumn("coverage", F.col("evidence_words") / F.greatest(F.col("episode_words"), F.lit(1)))
    by_strong = (F.col("strong_chunk_count") >= 1) & (F.col("evidence_words") >= min_words) & (F.col("coverage") >= min_coverage) & ((F.col("chunk_count") >= 2) | (F.col("max_similarity") >= single_min))
    by_number = (F.col("chunk_count") >= supporting_chunks) & (F.col("evidence_words") >= supporting_words) & (F.col("coverage") >= supporting_coverage)
    rows = rows.filter(by_strong | by_number).withColumn("score", F.col("coverage") * F.col("mean_similarity"))
    order = Window.partitionBy("sr_episode_id").orderBy(F.desc("score"), "topic_id")
    return rows.drop("episode_words").withColumn("rank", F.row_number().over(order))


def raw_rollup(chunk_topics: DataFrame) -> DataFrame:
    """Words and chunks of every topic of an episode, its share of the episode's words, and its rank by share."""
    sums = chunk_topics.groupBy("sr_episode_id", "topic_id").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.sum("word_count").alias("word_count"), F.min(F.struct("start_seconds", "chunk_id"))["chunk_id"].alias("representative_chunk_id"), F.min("start_seconds").alias("representative_start_seconds")
    )
    total = F.sum("word_count").over(Window.partitionBy("sr_episode_id"))
    rows = sums.withColumn("share", F.col("word_count") / F.greatest(total, F.lit(1)))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("sr_episode_id").orderBy(F.desc("share"), "topic_id")))


def dominant_topics(rollup: DataFrame, outlier: int = -1) -> DataFrame:
    """The topic with the most words of every episode; the outlier only where there is no other; ties to what comes first."""
    order = Window.partitionBy("sr_episode_id").orderBy((F.col("topic_id") == outlier).cast("int"), F.desc("word_count"), "representative_start_seconds", "topic_id")
    return rollup.withColumn("__r", F.row_number().over(order)).filter("__r = 1").select("sr_episode_id", F.col("topic_id").alias("dominant_topic_id"), "word_count")


#: Bounds of the score bands from which candidates for review are drawn.
BANDS = (0.0, 0.48, 0.50, 0.52, 0.54, 0.56, 1.0)


def calibration_sample(decisions: DataFrame, per_band: int = 2, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """Chunks for review: by topic and half-open score band, evenly spaced places in the order of (score, chunk id)."""
    s = F.col("best_similarity")
    band = F.coalesce(*[F.when((s >= lo) & (s < hi), F.lit(i)) for i, (lo, hi) in enumerate(zip(bands, bands[1:], strict=False))])
    rows = decisions.withColumn("band", band).filter("band is not null")
    group = Window.partitionBy("best_topic_id", "band")
    rows = rows.withColumns({"__p": F.row_number().over(group.orderBy("best_similarity", "chunk_id")) - 1, "__n": F.count(F.lit(1)).over(group)})
    take = F.least(F.lit(per_band), F.col("__n"))
    spaced = F.transform(F.sequence(F.lit(0), take - 1), lambda i: F.when(take <= 1, F.lit(0)).otherwise(F.floor(i * (F.col("__n") - 1) / F.greatest(take - 1, F.lit(1)))).cast("int"))
    return rows.filter(F.array_contains(spaced, F.col("__p"))).drop("__p", "__n")


def thresholds(reviews: DataFrame, group: str, score: str, relevant: str, precision: float = 0.85, least: int = 2, default: float = 0.53) -> DataFrame:
    """For each group, the smallest score from which on the precision holds with ``least`` relevant rows; else ``default``."""
    tail = Window.partitionBy(group).orderBy(F.desc(score)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    good = F.sum(F.col(relevant).cast("int")).over(tail)
    rows = reviews.withColumns({"__good": good, "__all": F.count(F.lit(1)).over(tail)})
    fits = (F.col("__good") / F.col("__all") >= precision) & (F.col("__good") >= least)
    return rows.groupBy(group).agg(F.coalesce(F.min(F.when(fits, F.col(score))), F.lit(default)).alias("threshold"))


def terms_of(docs: DataFrame, group: str, text: str, stop_words: tuple[str, ...] = (), longest: int = 2) -> DataFrame:
    """``group`` and ``term``, a row for each occurrence: words of two letters or digits or more, lower-cased, and runs of up to ``longest`` of them.

    Stop words go before the runs are built, so a run can lead over one.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), 0)
    kept = F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words
    rows = docs.select(group, kept.alias("__w"))

    # Runs of n words are runs of n - 1 with the word behind each.
    last, runs = F.col("__w"), [F.col("__w")]
    for n in range(2, longest + 1):
        fit = F.greatest(F.size("__w") - n + 1, F.lit(0))
        last = F.zip_with(F.slice(last, F.lit(1), fit), F.slice("__w", F.lit(n), fit), lambda a, b: F.concat(a, F.lit(" "), b))
        runs.append(last)
    every = F.concat(*runs) if len(runs) > 1 else runs[0]
    return rows.select(group, F.explode(every).alias("term"))


def least_groups(documents: int, min_df: int = 3) -> int:
    """Groups that a term must be in: ``min_df``, or 1 for a corpus of fewer than a hundred documents."""
    return 1 if documents < 100 else min_df


#: Occurrences that a task adds up at a time.
ADDED_ROWS = 1 << 20


def _added_up(terms: DataFrame, group: str, term: str) -> DataFrame:
    """Groups, terms and how often they occur (``n``) among some neighbouring rows; the same group and term can come again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.rename_columns(["g", "t"]))
            rows += len(batch)
            if rows >= ADDED_ROWS:
                yield from added(held)
                held, rows = [], 0
        if held:
            yield from added(held)

    def added(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = pa.Table.from_batches(held).group_by(["g", "t"]).aggregate([([], "count_all")])
        yield from sums.select(["g", "t", "count_all"]).rename_columns([group, term, "n"]).to_batches(max_chunksize=10_000)

    kind = terms.schema
    return terms.mapInArrow(run, StructType([kind[group], kind[term], StructField("n", LongType())]))


def term_weights(terms: DataFrame, group: str, term: str, min_df: int = 3) -> DataFrame:
    """Class-based term weights: square root of the frequency in the class times a BM25 inverse class frequency.

    ``terms`` has a row for each occurrence (``terms_of``); terms in fewer than ``min_df`` groups (``least_groups``) are left out.
    """
    # One shuffle, by term: what a task has of a term and group is added up before it, and what a term needs of its groups is there behind it. Most
    # terms are in few groups. They are no more than numbers from there on, which only the sizes of the groups need.
    counts = _added_up(terms.select(group, term), group, term).repartition(term).groupBy(group, term).agg(F.sum("n").alias("tf"))
    every = Window.partitionBy(term)
    counts = counts.withColumns({"f": F.sum("tf").over(every), "df": F.count(F.lit(1)).over(every)})
    enough = F.col("df") >= min_df
    counts = stage(counts.select(group, F.when(enough, F.col(term)).alias(term), "tf", F.when(enough, F.col("f")).alias("f"), F.when(enough, F.col("df")).alias("df")), "terms", 10_000)
    size = counts.groupBy(group).agg(F.sum("tf").alias("words"))
    mean = size.agg(F.avg("words").alias("average"))
    rows = counts.filter(F.col("df").isNotNull()).join(size, group).join(F.broadcast(mean))  # one row
    idf = F.log1p((F.col("average") - F.col("f") + 0.5) / (F.col("f") + 0.5))
    return rows.select(group, term, "tf", "f", "df", (F.sqrt(F.col("tf") / F.col("words")) * F.greatest(idf, F.lit(0.0))).alias("weight"))


#: Spoken-language scaffolding and words of the medium, which name no topic. They go beside a language's own stop words.
DOMAIN_STOP_WORDS = (
    "absolut", "alltså", "alltid", "bara", "börja", "började", "börjar", "dag", "egentligen", "faktiskt", "fick", "först", "förstås", "gång", "ganska", "gick", "gör", "göra", "hela", "helt", "idag", "ibland", "kanske", "känner", "kom", "kommer", "liksom", "länge", "många", "måste", "nog", "precis", "redan", "riktigt", "saker", "satt", "sedan", "sen", "ser", "sist", "sitter", "själv", "slags", "säger", "sätt", "tid", "tillbaka", "tog", "tror", "tycker", "tänker", "tänkte", "verkligen", "vet", "ville", "väldigt", "år", "ändå",
    "program", "programmet", "producent", "sommari", "sommarprogram", "app", "play", "radio", "sveriges", "sommar", "sommarprat", "sommarpratare", "sommarvärd", "vinter", "vinterprat", "vintervärd", "lyssna", "lyssnar", "lyssnare", "musik", "låten", "låt", "p1",
)

#: Broadcast framing words; three of them among the first eight keywords mark a topic as of low quality.
FRAMING = ("sr", "sverigesradio", "podd", "lista", "tekniker", "hemsidan", "radioprogram")


def low_quality(keywords, least: int = 3, first: int = 8):
    """Whether an array of keywords starts with programme framing."""
    parts = F.flatten(F.transform(F.slice(keywords, 1, first), lambda k: F.split(F.lower(k), "[_ ]")))
    return F.size(F.array_intersect(parts, F.array(*[F.lit(w) for w in FRAMING]))) >= least


def fit_clusters(df: DataFrame, vector: str, k: int = 80, seed: int = 42, starts: int = 1) -> KMeansModel:
    """Cosine k-means; of ``starts`` runs with different seeds the one with the least cost. ``write().save(path)`` keeps it."""
    rows = df.select(array_to_vector(V.unit(F.col(vector))).alias("__v"))
    fits = [KMeans(k=k, seed=seed + i, distanceMeasure="cosine", featuresCol="__v", predictionCol="topic_id", maxIter=50).fit(rows) for i in range(starts)]
    return min(fits, key=lambda m: m.summary.trainingCost)


def cluster(df: DataFrame, vector: str, k: int = 80, seed: int = 42, starts: int = 1) -> DataFrame:
    """Adds ``topic_id`` by cosine k-means."""
    return predicted(fit_clusters(df, vector, k, seed, starts), df, vector)


def predicted(model: KMeansModel, df: DataFrame, vector: str) -> DataFrame:
    """``df`` with the ``topic_id`` that a model gives it."""
    return model.transform(df.withColumn("__v", array_to_vector(V.unit(F.col(vector))))).drop("__v")


def map_2d(df: DataFrame, vector: str, ident: str | None = None) -> DataFrame:
    """Adds ``x`` and ``y``: the first two principal components; of fewer than three rows the place in the order of ``ident``, and 0."""
    few = df.limit(3).count() < 3
    if few:
        order = Window.orderBy(ident) if ident else Window.orderBy(F.lit(0))  # two rows
        return df.withColumns({"x": (F.row_number().over(order) - 1).cast("double"), "y": F.lit(0.0)})
    rows = df.withColumn("__v", array_to_vector(V.unit(F.col(vector))))
    out = PCA(k=2, inputCol="__v", outputCol="__p").fit(rows).transform(rows).withColumn("__p", vector_to_array("__p"))
    return out.withColumns({"x": F.col("__p")[0], "y": F.col("__p")[1]}).drop("__v", "__p")


def neighbourhood_map(df: DataFrame, ident: str, vector: str, k: int = 15, min_distance: float = 0.1, block_rows: int = layout.BLOCK_ROWS) -> DataFrame:
    """Adds ``x`` and ``y``: a layout that keeps the ``k`` nearest neighbours by cosine together, begun at the principal components.

    Identifiers are whole numbers and differ; rows without one, or without a vector, have null places. Of fewer than three rows see ``map_2d``.
    """
    rows = df.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    begin = stage(map_2d(rows, "v", "id").select("id", F.array("x", "y").alias("p")), "begin")
    if begin.limit(3).count() == 3:
        near = stage(neighbours(rows, "id", "v", k, centred=False).select("id", "related_id", "similarity"), "near")
        begin = layout.lay_out(layout.fuzzy_links(near), begin, min_distance, block_rows=block_rows)
    places = begin.select(F.col("id").alias("__id"), F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"))
    return df.withColumn("__id", F.col(ident).cast("long")).join(places, "__id", "left").drop("__id")


def usable(topics: DataFrame, ids: list[int] | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Topics but for the outlier and those of low quality: given ids (an unknown or excluded one is an error), or a page in the order of the ids."""
    rows = topics.filter((F.col("topic_id") != -1) & ~F.coalesce("is_low_quality", F.lit(False)))
    if ids is not None:
        wanted = sorted(set(ids))
        known = {r[0] for r in rows.filter(F.col("topic_id").isin(wanted)).select("topic_id").collect()}  # as many as were asked for
        if unknown := [i for i in wanted if i not in known]:
            raise ValueError(f"unknown or excluded topics: {unknown}")
        return rows.filter(F.col("topic_id").isin(wanted))
    rows = rows.orderBy("topic_id")
    rows = rows.offset(offset) if offset else rows
    return rows.limit(limit) if limit is not None else rows


def topic_summary(chunk_topics: DataFrame) -> DataFrame:
    """Chunks, different episodes and words of every topic."""
    return chunk_topics.groupBy("topic_id").agg(F.count(F.lit(1)).alias("chunk_count"), F.count_distinct("sr_episode_id").alias("episode_count"), F.sum("word_count").alias("word_count"))


def relabelled(topics: DataFrame, labels: DataFrame, model: str) -> DataFrame:
    """Topics with the labels that a reviewer gave (``topic_id``, ``llm_label``); the cluster's own label is kept beside it. Others stay as they are."""
    new = labels.select("topic_id", F.col("llm_label").alias("__new"))
    rows = topics.join(new, "topic_id", "left")
    found = F.col("__new").isNotNull()
    return rows.withColumns({"cluster_label": F.when(found, F.col("label")), "llm_label": F.col("__new"), "llm_model": F.when(found, F.lit(model)), "review_status": F.when(found, F.lit("unreviewed")), "label": F.coalesce("__new", "label")}).drop("__new")
