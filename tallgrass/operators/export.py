"""Compact JSON for the browser, built by Catalyst: one JSON text for each row, one document for the whole."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T

TOPICS_PER_EPISODE = 5


def topic_rows(topics: DataFrame) -> DataFrame:
    """Topics that are shown: no outliers, none of low quality; a missing or generated label becomes the first keywords."""
    keywords = F.filter(F.coalesce("keywords", F.array().cast("array<string>")), lambda k: k != "")
    label = T.squeeze_ends(F.coalesce("label", F.lit("")))
    generated = (label == "") | label.startswith(F.concat(F.col("topic_id").cast("string"), F.lit("_")))
    named = F.when(~generated, label).when(F.size(keywords) > 0, F.array_join(F.slice(keywords, 1, 3), " · ")).otherwise(F.concat(F.lit("Ämne "), F.col("topic_id").cast("string")))
    shown = (F.col("topic_id") != -1) & ~F.coalesce("is_outlier", F.lit(False)) & ~F.coalesce("is_low_quality", F.lit(False))
    return topics.filter(shown).select("topic_id", named.alias("label"), F.slice(keywords, 1, 8).alias("keywords"), F.col("episode_count").alias("episodes"), F.col("chunk_count").alias("chunks"))


def episode_payload(episode_map: DataFrame, episode_topics: DataFrame, related: DataFrame, shown: DataFrame, most: int = TOPICS_PER_EPISODE) -> DataFrame:
    """A row per episode of the map: place, dominant topic, best topics, neighbours. At most ``most`` topics a row are gathered."""
    order = Window.partitionBy("sr_episode_id").orderBy(F.desc("share"), "topic_id")
    best = episode_topics.join(shown.select("topic_id"), "topic_id", "left_semi").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most)
    lists = best.groupBy("sr_episode_id").agg(F.array_sort(F.collect_list(F.struct("r", "topic_id", F.round("share", 4).alias("share")))).alias("t"))
    near = related.groupBy("sr_episode_id").agg(F.array_sort(F.collect_list(F.struct("rank", "related_episode_id", F.round("similarity", 4).alias("similarity")))).alias("n"))
    rows = episode_map.join(lists, "sr_episode_id", "left").join(near, "sr_episode_id", "left")
    usable = shown.select(F.col("topic_id").alias("dominant_topic_id"), F.lit(True).alias("ok"))
    rows = rows.join(usable, "dominant_topic_id", "left")
    dominant = F.when(F.col("ok"), F.col("dominant_topic_id")).otherwise(F.coalesce(F.try_element_at("t", F.lit(1))["topic_id"], F.col("dominant_topic_id")))
    pairs = lambda c, a, b: F.transform(F.coalesce(c, F.array().cast(rows.schema[c].dataType)), lambda x: F.struct(x[a].alias("id"), x[b].alias("value")))
    return rows.select("sr_episode_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), dominant.alias("dominant"), pairs("t", "topic_id", "share").alias("topics"), pairs("n", "related_episode_id", "similarity").alias("related"))


def matched_topics(topics: DataFrame, matched: DataFrame) -> DataFrame:
    """Curated topics with the number of different episodes over all matched rows."""
    counts = matched.groupBy("topic_id").agg(F.count_distinct("sr_episode_id").alias("episodes"))
    return topics.join(counts, "topic_id").select("topic_id", "label", "episodes")


def json_lines(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and the row as JSON; null fields are left out."""
    return rows.select(F.col(key), F.to_json(F.struct(*[F.col(c) for c in rows.columns]), {"ignoreNullFields": "true"}).alias("json"))


def speaker_export(speakers: DataFrame) -> DataFrame:
    """Speakers for the browser; empty fields become null, so that they are left out of the JSON."""
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    return speakers.select(
        "wikidata_id", F.col("speaker").alias("name"), F.col("episode_count").alias("count"), F.filter("ages_at_episodes", lambda a: a.isNotNull()).alias("ages"), F.when(F.size(F.array_remove("sr_names", F.col("speaker"))) > 0, F.array_remove("sr_names", F.col("speaker"))).alias("aliases"),
        T.blank_to_null(F.col("wikidata_label")).alias("label"), T.blank_to_null(F.col("wikidata_description")).alias("description"), T.blank_to_null(F.col("wikipedia_url")).alias("wiki"), T.blank_to_null(F.col("gender")).alias("gender"), F.nullif("birth_date", F.lit("")).alias("born"), F.nullif("death_date", F.lit("")).alias("died"), some("citizenships").alias("citizenships"), some("occupations").alias("occupations"),
    )


def episode_export(episodes: DataFrame, speakers: DataFrame, image_prefix: str) -> DataFrame:
    """Episodes for the browser. A speaker id without a speaker is an error."""
    named = episodes.select("sr_episode_id", F.posexplode("episode_speakers").alias("p", "wikidata_id")).join(speakers.select("wikidata_id", "speaker"), "wikidata_id", "left")
    name = F.coalesce("speaker", F.raise_error(F.concat(F.lit("missing speaker "), F.col("wikidata_id"))))
    names = named.groupBy("sr_episode_id").agg(F.array_sort(F.collect_list(F.struct("p", name.alias("n")))).alias("l"))
    rows = episodes.join(names.select("sr_episode_id", F.transform("l", lambda x: x["n"]).alias("names")), "sr_episode_id", "left")
    image = F.when(F.coalesce("image_url", F.lit("")).startswith(image_prefix), F.substring("image_url", len(image_prefix) + 1, 10_000)).otherwise(F.col("image_url"))
    return rows.select(
        F.col("sr_episode_id").alias("id"), "date", F.col("program_type").alias("type"), T.minutes(F.col("length_seconds")).alias("minutes"), F.nullif(image, F.lit("")).alias("image"), F.col("short_summary").alias("description"), F.col("episode_speakers").alias("speakers"), F.col("speaker_ages").alias("ages"), T.initials(F.coalesce("names", F.array().cast("array<string>"))).alias("initials"), F.when(F.col("is_listeners_host"), F.lit(True)).alias("is_listeners_host"),
    )


@dataclass(frozen=True)
class Section:
    """Members of a JSON object or list: ``rows`` have the columns of ``keys``, in whose order they stand, and ``json``."""

    opening: str
    rows: DataFrame
    keys: list[str]


@dataclass(frozen=True)
class Document:
    """One JSON text in sections, each a table of any size; ``sources.files`` writes it in parts and joins them."""

    sections: list[Section]
    closing: str


def _members(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """``key`` and ``json``, which is ``"key":value``."""
    name = F.regexp_extract(F.to_json(F.array(F.col(key).cast("string"))), r"(?s)^\[(.*)\]$", 1)  # escaped as JSON
    return rows.select(key, F.concat(name, F.lit(":"), value).alias("json"))


def archive_document(episodes: DataFrame, speakers: DataFrame, image_prefix: str = T.IMAGE_URL) -> Document:
    """The speakers by id and the list of episodes by date, as the browser reads them. A speaker id without a speaker is an error."""
    people = speaker_export(speakers)
    people = _members(people, "wikidata_id", F.to_json(F.struct(*[c for c in people.columns if c != "wikidata_id"])))
    rows = episode_export(episodes, speakers, image_prefix)
    whole = F.to_json(F.struct(*[c for c in rows.columns if c != "is_listeners_host"]), {"ignoreNullFields": "false"})
    host = F.when(F.col("is_listeners_host"), F.concat(F.expr("substring(j, 1, length(j) - 1)"), F.lit(',"is_listeners_host":true}'))).otherwise(F.col("j"))
    rows = rows.withColumn("j", whole).select("date", "id", host.alias("json"))
    return Document([Section('{"speakers":{', people, ["wikidata_id"]), Section('},"episodes":[', rows, ["date", "id"])], "]}")


def _pairs(column: str, text_id: bool) -> Column:
    """``[[id,number],...]`` of an array of ``id`` and ``value``."""
    ident = (lambda x: F.concat(F.lit('"'), x["id"], F.lit('"'))) if text_id else (lambda x: x["id"].cast("string"))
    return F.concat(F.lit("["), F.array_join(F.transform(column, lambda x: F.concat(F.lit("["), ident(x), F.lit(","), x["value"].cast("string"), F.lit("]"))), ","), F.lit("]"))


def payload_document(shown: DataFrame, payload: DataFrame, version: int = 1) -> Document:
    """Topics and episodes by id. ``shown`` has ``topic_id`` and what is told of a topic, ``payload`` the rows of ``episode_payload`` or ``curated_payload``."""
    topics = _members(shown, "topic_id", F.to_json(F.struct(*[c for c in shown.columns if c != "topic_id"])))
    text_id = version > 1
    dominant = F.coalesce(F.to_json(F.struct("dominant"), {"ignoreNullFields": "false"}), F.lit('{"dominant":null}'))
    body = F.concat(F.lit('{"x":'), F.col("x").cast("string"), F.lit(',"y":'), F.col("y").cast("string"), F.lit(","), F.regexp_extract(dominant, r"^\{(.*)\}$", 1), F.lit(',"topics":'), _pairs("topics", text_id), F.lit(',"related":'), _pairs("related", False), F.lit("}"))
    episodes = _members(payload, "sr_episode_id", body)
    return Document([Section(f'{{"version":{version},"topics":{{', topics, ["topic_id"]), Section('},"episodes":{', episodes, ["sr_episode_id"])], "}}")


def curated_payload(episode_map: DataFrame, episode_topics: DataFrame, related: DataFrame, topics: DataFrame, most: int = TOPICS_PER_EPISODE) -> DataFrame:
    """A row per episode of the map, with the topics of the catalogue only; the best of them is the dominant one, null without any."""
    rows = episode_payload(episode_map.withColumn("dominant_topic_id", F.lit(None).cast("string")), episode_topics, related, topics, most)
    return rows.withColumn("dominant", F.try_element_at("topics", F.lit(1))["id"])


def report_lines(topics: DataFrame, examples: DataFrame, most: int = 5) -> DataFrame:
    """Markdown sections of the topics, largest first, with up to ``most`` examples each."""
    lists = examples.withColumn("r", F.row_number().over(Window.partitionBy("topic_id").orderBy("rank", "sr_episode_id"))).filter(F.col("r") <= most)
    lists = lists.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("r", "excerpt"))).alias("e"))
    rows = topics.join(lists, "topic_id", "left")
    body = F.concat_ws("\n", F.concat(F.lit("## "), F.col("label"), F.lit(" ("), F.col("chunk_count").cast("string"), F.lit(")")), F.array_join(F.transform(F.coalesce("e", F.array().cast("array<struct<r:int,excerpt:string>>")), lambda x: F.concat(F.lit("- "), x["excerpt"])), "\n"))
    return rows.select("topic_id", "chunk_count", body.alias("section")).orderBy(F.desc("chunk_count"), "topic_id")
