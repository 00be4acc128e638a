"""The archive's programs: each reads tables or files, runs operators, and writes tables or a document."""

from __future__ import annotations

from argparse import Namespace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass import catalog
from tallgrass.functions import text as T
from tallgrass.functions import vectors as V
from tallgrass.operators import archive, chapters, density, export, incremental, linkage, neighbours, segment, taxonomy, topics, transcripts
from tallgrass.sources import files, markdown

#: Keywords of a topic, and neighbours of an episode.
KEYWORDS, RELATED = 12, 8


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def archive_tables(spark: SparkSession, args: Namespace) -> None:
    """Episodes, appearances and speakers from saved API pages and query results."""
    episodes = archive.programmes(archive.parse_episodes(files.episodes_json(spark, args.pages)), args.include_specials)
    people = archive.merge_people(files.people_json(spark, args.people))
    appearing = archive.match_entities(archive.appearances(episodes), episodes, files.participants_json(spark, args.participants))
    full = archive.attach_ages(archive.attach_speakers(episodes.drop("speaker"), appearing), people)
    dated = appearing.join(episodes.select("sr_episode_id", "date"), "sr_episode_id")
    files.write_table(full, f"{args.out}/episodes", files.EPISODES)
    files.write_table(archive.speaker_records(dated, people), f"{args.out}/speakers", files.SPEAKERS)
    files.write_table(archive.denormalised(appearing, full), f"{args.out}/speaker_appearances", files.APPEARANCES)


def songs(spark: SparkSession, args: Namespace) -> None:
    """Songs from saved playlists (JSON lines)."""
    fields = ":string,".join(("title", "artist", "composer", "lyricist", "albumname", "recordlabel", "starttimeutc", "stoptimeutc")) + ":string"
    files.write_table(archive.music(spark.read.schema(f"sr_episode_id bigint, songs array<struct<{fields}>>").json(args.playlists)), args.out, files.MUSIC)


def _document(spark: SparkSession, document: export.Document, path: str) -> None:
    """The document in parts, and joined in ``document.json`` beside them."""
    files.write_document(document, path)
    files.join_document(spark, path, f"{path}/document.json")


def export_archive(spark: SparkSession, args: Namespace) -> None:
    """Episodes and speakers as one JSON document."""
    _document(spark, export.archive_document(spark.read.parquet(f"{args.tables}/episodes"), spark.read.parquet(f"{args.tables}/speakers")), args.out)


def segments(spark: SparkSession, args: Namespace) -> None:
    """Cleaned transcript segments, what was removed, and a JSON report of why."""
    marked = transcripts.flag_segments(files.transcripts_json(spark, args.folder, args.limit))
    columns = "sr_episode_id bigint, segment_index int, start double, end double, text string, artifact_reasons array<string>, boilerplate_reasons array<string>"
    files.write_split(marked, args.out, (F.size("artifact_reasons") > 0) | (F.size("boilerplate_reasons") > 0), columns)
    files.write_report(transcripts.audit_report(marked), f"{args.out}/report")


def units(spark: SparkSession, args: Namespace) -> None:
    """Units of cleaned segments."""
    rows = spark.read.parquet(args.segments)
    rows = transcripts.trailing_cut(rows, T.matches(F.col("text"), T.PRODUCTION_CREDIT), T.matches(F.col("text"), T.RECOMMENDATION_CUE))
    _write(transcripts.build_units(transcripts.valid_segments(rows)), args.out)


def chunks(spark: SparkSession, args: Namespace) -> None:
    """Scored boundaries between units (with embeddings), and the chunks that the selected ones leave."""
    rows = spark.read.parquet(args.units)
    cuts = segment.select_boundaries(rows, segment.score_boundaries(rows))
    _write(cuts, f"{args.out}/boundaries")
    _write(segment.materialise(rows, spark.read.parquet(f"{args.out}/boundaries")), f"{args.out}/chunks")


def topic_outputs(rows: DataFrame, stop_words: tuple[str, ...] = topics.DOMAIN_STOP_WORDS) -> dict[str, DataFrame]:
    """All tables of a topic model from chunks with ``topic_id``, ``text`` and ``embedding``: topics with keywords, episode topics, map and neighbours."""
    weights = topics.term_weights(topics.terms_of(rows, "topic_id", "text", stop_words), "topic_id", "term", topics.least_groups(rows.count()))
    order = Window.partitionBy("topic_id").orderBy(F.desc(F.round("weight", 9)), "term")
    best = weights.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= KEYWORDS)
    keywords = best.groupBy("topic_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]).alias("keywords"))
    named = topics.topic_summary(rows).join(keywords, "topic_id", "left").withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
    named = named.withColumns({"label": F.concat_ws("_", F.col("topic_id").cast("string"), F.slice("keywords", 1, 4)), "is_outlier": F.col("topic_id") == -1, "is_low_quality": topics.low_quality(F.col("keywords"))})
    roll = topics.raw_rollup(rows)
    means = V.mean_vectors(rows, ["sr_episode_id"], "embedding").withColumn("embedding", V.unit(F.col("embedding")))
    places = topics.neighbourhood_map(means, "sr_episode_id", "embedding").join(topics.dominant_topics(roll).select("sr_episode_id", "dominant_topic_id"), "sr_episode_id")
    near = neighbours.neighbours(means, "sr_episode_id", "embedding", RELATED).withColumnRenamed("related_id", "related_episode_id")
    examples = taxonomy.longest_representative(rows, ["sr_episode_id", "topic_id"])
    return {"topics": named, "episode_topics": roll.join(examples.drop("words"), ["sr_episode_id", "topic_id"], "left"), "episode_map": places.select("sr_episode_id", "x", "y", "dominant_topic_id"), "related_episodes": near}


def _payload(spark: SparkSession, folder: str) -> export.Document:
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    shown = export.topic_rows(read("topics"))
    return export.payload_document(shown, export.episode_payload(read("episode_map"), read("episode_topics"), read("related_episodes"), shown))


def topic_model(spark: SparkSession, args: Namespace) -> None:
    """Clusters of chunks (with embeddings), their tables, the model, and the browser's document. With ``min_cluster`` the clusters are those of density, with outliers."""
    rows = spark.read.parquet(args.chunks)
    if args.min_cluster:
        placed = rows.join(incremental.numbered(rows, "chunk_id", "__n"), "chunk_id")
        found = density.density_clusters(placed, "__n", "embedding", args.min_cluster, args.min_samples)
        _write(placed.join(found, "__n").drop("__n"), f"{args.out}/chunk_topics")
    else:
        model = topics.fit_clusters(rows, "embedding", args.topics, starts=args.starts)
        model.write().overwrite().save(f"{args.out}/model")
        _write(topics.predicted(model, rows, "embedding"), f"{args.out}/chunk_topics")
    for name, table in topic_outputs(spark.read.parquet(f"{args.out}/chunk_topics")).items():
        _write(table, f"{args.out}/{name}")
    centres = V.mean_vectors(spark.read.parquet(f"{args.out}/chunk_topics"), ["topic_id"], "embedding")
    _write(files.to_half(centres, "embedding"), f"{args.out}/topic_vectors")
    _document(spark, _payload(spark, args.out), f"{args.out}/document")


def topic_tree(spark: SparkSession, args: Namespace) -> None:
    """The tree of a model's topics."""
    centres = files.from_half(spark.read.parquet(f"{args.model}/topic_vectors"), "embedding")
    _write(linkage.merge_tree(centres, "topic_id", "embedding"), f"{args.model}/topic_tree")


def label(spark: SparkSession, args: Namespace) -> None:
    """A model's topics with the labels of a table (topic_id, llm_label); with --apply the document is written anew."""
    known = spark.read.parquet(f"{args.model}/topics")
    wanted = topics.usable(known, args.topic_ids, args.offset, args.limit).select("topic_id")
    found = spark.read.parquet(args.labels).join(wanted, "topic_id", "left_semi")
    _write(topics.relabelled(known, found, args.reviewer), f"{args.model}/labelled_topics")
    if args.apply:
        _replace(spark, f"{args.model}/labelled_topics", args.model)


def _replace(spark: SparkSession, new: str, folder: str) -> None:
    _write(spark.read.parquet(new), f"{folder}/topics")
    _document(spark, _payload(spark, folder), f"{folder}/document")


def apply_hierarchy(spark: SparkSession, args: Namespace) -> None:
    """A reviewed proposal (topic_id, parent_label) for all usable topics of a model."""
    _write(taxonomy.applied(spark.read.parquet(f"{args.model}/topics"), spark.read.parquet(args.proposal)), f"{args.model}/parented_topics")
    _replace(spark, f"{args.model}/parented_topics", args.model)


def merge_hierarchy(spark: SparkSession, args: Namespace) -> None:
    """Editorial topics and themes over a model's clusters: a table of raw_topic_id, topic_id and theme gives the four roll-ups."""
    mapping = spark.read.parquet(args.mapping)
    names = mapping.select("topic_id", "theme").distinct()
    rows = spark.read.parquet(f"{args.model}/chunk_topics")
    totals = rows.groupBy("sr_episode_id").agg(F.sum("word_count").alias("episode_words"))
    mapped = taxonomy.map_to_topics(rows.withColumnRenamed("topic_id", "raw_topic_id"), mapping.select("raw_topic_id", "topic_id"), names).drop("theme")
    for name, table in taxonomy.rollups(taxonomy.evidence_gate(mapped), totals, names.join(taxonomy.theme_ids(names), "theme")).items():
        _write(table, f"{args.out}/{name}")


def curated(spark: SparkSession, args: Namespace) -> None:
    """Decisions, assignments and episode topics of chunks against a catalogue (topic_id, embedding), and the browser's document."""
    rows, catalogue = spark.read.parquet(args.chunks), spark.read.parquet(args.catalogue)
    floors = {r["topic_id"]: r["threshold"] for r in spark.read.parquet(args.thresholds).collect()} if args.thresholds else None  # a row for each topic
    negatives = spark.read.parquet(args.negatives) if args.negatives else None
    rules = topics.Thresholds(min_negative_margin=args.negative_margin if negatives is not None else None)
    decisions = topics.decide(rows, catalogue, rules, floors, negatives)
    _write(decisions.withColumn("excerpt", T.excerpt(F.col("text"), 600)).drop("text", "embedding"), f"{args.out}/decisions")
    decided = spark.read.parquet(f"{args.out}/decisions")
    totals = rows.groupBy("sr_episode_id").agg(F.sum("word_count").alias("episode_words"))
    _write(topics.assignments(decided, rules, floors), f"{args.out}/chunk_topics")
    _write(topics.curated_rollup(spark.read.parquet(f"{args.out}/chunk_topics"), totals), f"{args.out}/episode_topics")
    roll = spark.read.parquet(f"{args.out}/episode_topics")
    means = V.mean_vectors(rows, ["sr_episode_id"], "embedding").withColumn("embedding", V.unit(F.col("embedding")))
    near = neighbours.neighbours(means, "sr_episode_id", "embedding", RELATED).withColumnRenamed("related_id", "related_episode_id")
    name = F.col("label") if "label" in catalogue.columns else F.col("topic_id").cast("string")
    shown = export.matched_topics(catalogue.select("topic_id", name.alias("label")), roll)
    payload = export.curated_payload(topics.map_2d(means, "embedding", "sr_episode_id"), roll.withColumn("share", F.col("coverage")), near, shown)
    _document(spark, export.payload_document(shown, payload, 2), f"{args.out}/document")


def calibrate(spark: SparkSession, args: Namespace) -> None:
    """Chunks for review, or, with --reviews (topic_id, score, relevant), the thresholds that they support."""
    if args.reviews:
        found = topics.thresholds(spark.read.parquet(args.reviews), "topic_id", "score", "relevant", args.precision)
        _write(found, args.out)
    else:
        _write(topics.calibration_sample(spark.read.parquet(args.decisions), args.per_band), args.out)


def guidance(spark: SparkSession, args: Namespace) -> None:
    """A catalogue in Markdown with the examples of a JSON-lines table; both must name the same topics."""
    found = markdown.checked(markdown.topic_rows(markdown.read_lines(spark, args.catalogue), after=None))
    extra = spark.read.schema("topic_id string, positive_examples array<string>, negative_examples array<string>").json(args.examples)
    _write(markdown.with_guidance(found, taxonomy.reviewed(extra, found, "topic_id")), args.out)


def chapter_ranges(spark: SparkSession, args: Namespace) -> None:
    """Chapters of transcripts from anchors (sr_episode_id, anchor)."""
    rows = spark.read.parquet(args.segments)
    found = chapters.match_anchors(rows, spark.read.parquet(args.anchors), "sr_episode_id")
    kept = found.groupBy("sr_episode_id").agg(chapters.accept_boundaries(F.collect_list(F.struct("segment_index", "score"))).alias("k")).select("sr_episode_id", F.explode("k").alias("k")).select("sr_episode_id", "k.segment_index", "k.score")
    _write(chapters.chapter_ranges(kept, rows.groupBy("sr_episode_id").agg(F.count(F.lit(1)).alias("segments")), "sr_episode_id"), args.out)


def run_query(spark: SparkSession, args: Namespace) -> None:
    """One of the registered queries over a folder of tables."""
    catalog.queries()[args.name](spark, args.tables).show(50, truncate=False)


#: Name, function, positional arguments, options with their defaults.
PROGRAMS = (
    ("archive", archive_tables, ("pages", "participants", "people", "out"), {"include_specials": False}),
    ("songs", songs, ("playlists", "out"), {}),
    ("export", export_archive, ("tables", "out"), {}),
    ("segments", segments, ("folder", "out"), {"limit": int}),
    ("units", units, ("segments", "out"), {}),
    ("chunks", chunks, ("units", "out"), {}),
    ("topics", topic_model, ("chunks", "out"), {"topics": 80, "starts": 10, "min_cluster": 0, "min_samples": int}),
    ("tree", topic_tree, ("model",), {}),
    ("label", label, ("model", "labels"), {"reviewer": "review", "topic_ids": [int], "offset": 0, "limit": int, "apply": False}),
    ("apply", apply_hierarchy, ("model", "proposal"), {}),
    ("hierarchy", merge_hierarchy, ("model", "mapping", "out"), {}),
    ("guidance", guidance, ("catalogue", "examples", "out"), {}),
    ("curated", curated, ("chunks", "catalogue", "out"), {"thresholds": str, "negatives": str, "negative_margin": 0.0}),
    ("calibrate", calibrate, ("decisions", "out"), {"reviews": str, "per_band": 2, "precision": 0.85}),
    ("chapters", chapter_ranges, ("segments", "anchors", "out"), {}),
    ("query", run_query, ("name", "tables"), {}),
)
