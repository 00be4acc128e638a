"""Two-level taxonomy: raw clusters to topics to themes, gates on evidence, roll-ups, checks."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.staging import stage

# Evidence that noisy topics need (substrings of the lower-cased text), and editorial additions.
EVIDENCE_RULES: dict[str, dict[str, Any]] = {
    "boxning": {"min_chunks": 3, "min_distinct_terms": 2, "terms": ["boxning", "boxare", "boxas", "proffsboxare", "mma", "sparring", "fighter", "gonggongen"]},
    "fotboll": {"min_chunks": 2, "min_distinct_terms": 2, "terms": ["fotboll", "fotbolls", "allsvenskan", "landslag", "premier league", "champions league", "zlatan", "målvakt", "forward", "degerfors", "manchester", "lazio", "benfica", "sampdoria", "juventus"]},
}
MANUAL_SHARES = {557543: {"poesi": 0.55, "karlek": 0.30}, 1569347: {"poesi": 0.55, "ensamhet": 0.30, "karlek": 0.15}}


def map_to_topics(chunks: DataFrame, raw_to_topic: DataFrame, topic_to_theme: DataFrame) -> DataFrame:
    """Chunks with their topic and theme; unmapped clusters go. The dimension tables are small; Catalyst sees their sizes."""
    return chunks.join(raw_to_topic, "raw_topic_id").join(topic_to_theme, "topic_id")


def evidence_gate(rows: DataFrame, rules: Mapping[str, Mapping[str, Any]] = EVIDENCE_RULES, group: str = "sr_episode_id", topic: str = "topic_id", text: str = "text") -> DataFrame:
    """Rows whose (group, topic) has enough chunks and enough different terms. Topics without a rule pass.

    Terms are looked for chunk by chunk and combined by a maximum, so no group's text is brought together.
    """
    passed = rows.select(group, topic).distinct().filter(~F.col(topic).isin(list(rules)))
    for name, rule in rules.items():
        lower = F.lower(F.coalesce(text, F.lit("")))
        seen = [F.max(lower.contains(term.lower()).cast("int")) for term in rule.get("terms", [])]
        counts = rows.filter(F.col(topic) == name).groupBy(group, topic).agg(F.count(F.lit(1)).alias("__n"), sum(seen, F.lit(0)).alias("__t"))
        passed = passed.union(counts.filter((F.col("__n") >= rule.get("min_chunks", 1)) & (F.col("__t") >= rule.get("min_distinct_terms", 1))).select(group, topic))
    return rows.join(passed, [group, topic], "left_semi")


def with_manual(episode_topics: DataFrame, manual: Mapping[int, Mapping[str, float]] = MANUAL_SHARES) -> DataFrame:
    """Computed rows and editorial ones (no chunks, no words, fixed share), ranked together by share and topic id."""
    spark = episode_topics.sparkSession
    extra = spark.createDataFrame([(e, t, 0, 0, s, "manual") for e, topics in manual.items() for t, s in topics.items()], "sr_episode_id long, topic_id string, chunk_count long, word_count long, share double, assignment_source string")
    known = spark.createDataFrame([(e,) for e in manual], "sr_episode_id long")
    rows = episode_topics.withColumn("assignment_source", F.lit("clustered"))
    extra = extra.join(F.broadcast(known), "sr_episode_id", "left_semi").join(rows.select("sr_episode_id", "topic_id"), ["sr_episode_id", "topic_id"], "left_anti")
    both = rows.drop("rank").unionByName(extra, allowMissingColumns=True)
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("sr_episode_id").orderBy(F.desc("share"), "topic_id")))


def theme_ids(labels: DataFrame, label: str = "theme") -> DataFrame:
    """``broad-01`` and so on, in code-point order of the labels."""
    rank = F.dense_rank().over(Window.orderBy(label))
    return labels.select(label).distinct().withColumn("broad_id", F.concat(F.lit("broad-"), F.lpad(rank.cast("string"), 2, "0")))


def longest_representative(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """The longest chunk of each group (``representative``, ``words``); of equally long ones that with the smallest id."""
    best = F.max(F.struct("word_count", (-F.col("chunk_id")).alias("m"), "chunk_id")).alias("b") if dict(chunks.dtypes)["chunk_id"] != "string" else F.min(F.struct((-F.col("word_count")).alias("w"), "chunk_id", "word_count")).alias("b")
    return chunks.groupBy(*keys).agg(best).select(*keys, F.col("b.chunk_id").alias("representative"), F.col("b.word_count").alias("words"))


def rollups(chunks: DataFrame, totals: DataFrame, themes: DataFrame, manual: Mapping[int, Mapping[str, float]] = MANUAL_SHARES) -> dict[str, DataFrame]:
    """The four tables of the hierarchy: ``topics``, ``episode_topics``, ``broad`` and ``episode_broad``.

    ``chunks`` (``chunk_id``, ``sr_episode_id``, ``topic_id``, ``word_count``) passed the gate of evidence; ``totals`` has ``episode_words`` by
    episode, ``themes`` ``topic_id``, ``theme`` and ``broad_id`` of every topic. Editorial rows count as episodes of their
    topic and theme but bring no chunks or words. A share is of all words of the episode.
    """
    episode = chunks.groupBy("sr_episode_id", "topic_id").agg(F.count(F.lit(1)).alias("chunk_count"), F.sum("word_count").alias("word_count"))
    episode = stage(episode.join(totals, "sr_episode_id").withColumn("share", F.col("word_count") / F.col("episode_words")).drop("episode_words"), "shares")
    episode = with_manual(episode, manual).join(themes, "topic_id")
    episode = episode.join(longest_representative(chunks, ["sr_episode_id", "topic_id"]).drop("words"), ["sr_episode_id", "topic_id"], "left")
    episode = stage(episode, "episode-topics")  # all four tables come from it
    sums = episode.groupBy("topic_id").agg(F.sum("chunk_count").alias("chunk_count"), F.count_distinct("sr_episode_id").alias("episode_count"), F.sum("word_count").alias("word_count"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("chunk_count", "episode_count", "word_count")}
    topics = themes.join(sums, "topic_id", "left").withColumns(zero)
    lists = themes.groupBy("broad_id", "theme").agg(F.array_sort(F.collect_set("topic_id")).alias("topic_ids"))
    broad = lists.join(episode.groupBy("broad_id").agg(F.count_distinct("sr_episode_id").alias("episode_count")), "broad_id", "left").withColumn("episode_count", zero["episode_count"])
    wide = episode.groupBy("sr_episode_id", "broad_id", "theme").agg(F.sum("chunk_count").alias("chunk_count"), F.sum("word_count").alias("word_count"))
    wide = wide.join(totals, "sr_episode_id", "left").withColumn("share", F.coalesce(F.col("word_count") / F.col("episode_words"), F.lit(0.0))).drop("episode_words")
    return {"topics": topics, "episode_topics": episode, "broad": broad, "episode_broad": wide}


def reviewed(rows: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Answers of a review, one for each expected key; a missing, unknown or repeated key is an error."""
    faults = partition_faults(rows, rows.limit(0), key, expected).limit(5).collect()
    if faults:
        raise ValueError("invalid answers: " + ", ".join(f"{r[0]} {r[1]}" for r in faults))
    return rows


def applied(topics: DataFrame, proposal: DataFrame) -> DataFrame:
    """The catalogue with the parents of a reviewed proposal (``topic_id``, ``parent_label``), which must cover every usable topic exactly once."""
    used = topics.filter((F.col("topic_id") != -1) & ~F.coalesce("is_low_quality", F.lit(False)))
    new = reviewed(proposal.select("topic_id", "parent_label"), used, "topic_id")
    return topics.drop("parent_label").join(new, "topic_id", "left")


def partition_faults(assigned: DataFrame, excluded: DataFrame, ident: str, universe: DataFrame) -> DataFrame:
    """Ids that are ``duplicate``, ``missing`` or ``extra`` against the universe; none for a partition."""
    both = assigned.select(ident).unionByName(excluded.select(ident)).groupBy(ident).agg(F.count(F.lit(1)).alias("n"))
    joined = universe.select(ident).distinct().withColumn("u", F.lit(True)).join(both, ident, "full_outer")
    fault = F.when(F.col("u").isNull(), "extra").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return joined.select(ident, fault.alias("fault")).filter("fault is not null")


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side."""
    l, r = left.select(key).distinct().withColumn("l", F.lit(1)), right.select(key).distinct().withColumn("r", F.lit(1))
    return l.join(r, key, "full_outer").filter("l is null or r is null").select(key, F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"))
