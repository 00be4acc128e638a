"""Search queries over orders with their customers, nations and regions, and the browser's payloads over embeddings."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.functions import vectors as V
from tallgrass.operators import export, neighbours, search, textindex, topics
from tallgrass.plans.registry import query, table
from tallgrass.plans.vector_queries import chunks
from tallgrass.staging import own_folder

_ROWS = """WITH r AS (SELECT o_orderkey AS sr_episode_id, strftime(o_orderdate, '%Y-%m-%d') AS date, lower(o_orderpriority || ' ' || c_mktsegment) AS description, c_name AS speaker, n_name, r_name, o_orderstatus AS program_type, n_regionkey AS theme, n_nationkey AS topic,
 CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) - 1930 - c_custkey % 40 END AS age, o_custkey % 3 = 0 AS comes_back FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) """


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    age = F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate") - 1930 - F.col("c_custkey") % 40).cast("long")
    return rows.select(
        F.col("o_orderkey").alias("sr_episode_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.concat_ws(" ", "o_orderpriority", "c_mktsegment").alias("description"), F.col("c_name").alias("speaker"), F.col("o_orderstatus").alias("program_type"), (F.col("o_custkey") % 3 == 0).alias("returning"), F.array("n_name").alias("citizenships"), F.array("c_mktsegment").alias("occupations"), F.array("o_orderpriority").alias("genders"),
        F.array(F.col("n_nationkey")).alias("topic_ids"), F.array(F.col("n_regionkey")).alias("theme_ids"), F.array(age).alias("ages"), F.col("r_name").alias("theme"),
    )


@query(_ROWS + "SELECT sr_episode_id, date, speaker FROM r WHERE description LIKE '%high%' AND date >= '1995-01-01' AND date < '1999-01-01' AND theme IN (1, 3) AND age BETWEEN 40 AND 60 ORDER BY date DESC, sr_episode_id DESC LIMIT 100")
def facet_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text, years, themes and ages, newest first, one page."""
    found = search.matching(records(spark, sf_dir), search.Filters(text="High", year_from=1995, year_to=1998, themes=(1, 3), age_from=40, age_to=60))
    return search.page(found, "newest").select("sr_episode_id", "date", "speaker")


def _index(rows: DataFrame, ident: str, column: str) -> str:
    path = f"{own_folder(rows.sparkSession)}/text-index-{uuid.uuid4().hex}"
    textindex.build(rows, ident, column, path)
    return path


@query(_ROWS + "SELECT sr_episode_id, date, speaker FROM r WHERE description LIKE '%low h%' AND date >= '1995-01-01' AND date < '1999-01-01' AND theme IN (1, 3) ORDER BY date DESC, sr_episode_id DESC LIMIT 100")
def facet_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text by the index, the other filters and the page as ever."""
    found = textindex.containing(spark, _index(records(spark, sf_dir), "sr_episode_id", "description"), "Low H")
    found = search.matching(found, search.Filters(text="Low H", year_from=1995, year_to=1998, themes=(1, 3)))
    return search.page(found, "newest").select("sr_episode_id", "date", "speaker")


#: Searches of the documents: one, two and more characters, white space inside, other letters, and one without a result.
SEARCHES = ("7", "zq", "license", " of the ", "ü", "@", "no such text anywhere")


@query("SELECT s.item, doc_id FROM documents JOIN (SELECT unnest(['7', 'zq', 'license', ' of the ', 'ü', '@', 'no such text anywhere']) AS item) s ON contains(lower(text), trim(s.item))")
def text_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a text, for some texts, over one index of all documents."""
    path = _index(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = [textindex.containing(spark, path, text).select(F.lit(text).alias("item"), "doc_id") for text in SEARCHES]
    return reduce(DataFrame.unionByName, found)


@query(_ROWS + "SELECT sr_episode_id, speaker, age FROM r WHERE comes_back AND program_type = 'O' AND topic IN (2, 7, 11) ORDER BY age DESC NULLS LAST, date DESC, sr_episode_id DESC LIMIT 100")
def facet_search_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen topics take the place of themes; missing ages come last."""
    found = search.matching(records(spark, sf_dir), search.Filters(program_type="O", returning=True, topics=(2, 7, 11), themes=(0,)))
    return search.page(found, "age_down").select("sr_episode_id", "speaker", F.col("ages")[0].alias("age"))


@query(_ROWS + "SELECT sr_episode_id, speaker FROM r WHERE n_name = 'NATION_3' OR r_name = 'ASIA' ORDER BY speaker, date DESC, sr_episode_id DESC LIMIT 50 OFFSET 100")
def facet_page_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of fifty in Swedish order of the names."""
    found = records(spark, sf_dir).filter(F.array_contains("citizenships", "NATION_3") | (F.col("theme") == "ASIA"))
    return search.page(found, "speaker", 50, 100).select("sr_episode_id", "speaker")


@query(_ROWS + "SELECT n_name AS value, count(DISTINCT sr_episode_id) AS episodes FROM r GROUP BY n_name")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet_values(records(spark, sf_dir), "citizenships")


@query(_ROWS + "SELECT r_name AS value, count(DISTINCT sr_episode_id) AS episodes FROM r GROUP BY r_name")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet_values(records(spark, sf_dir), "theme", is_array=False)


@query(_ROWS + "SELECT min(substr(date, 1, 4))::INT AS first_year, max(substr(date, 1, 4))::INT AS last_year, min(age) AS youngest, max(age) AS oldest FROM r")
def facet_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facet_bounds(records(spark, sf_dir))


@query(_ROWS + "SELECT sr_episode_id, date FROM r WHERE (date, sr_episode_id) < ('1996-06-01', 1000) ORDER BY date DESC, sr_episode_id DESC LIMIT 100")
def facet_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind a row, by its key."""
    return search.page_after(records(spark, sf_dir), "1996-06-01", 1000).select("sr_episode_id", "date")


@query("""WITH p AS (SELECT o_orderkey, [o_custkey, o_custkey % 13 + 1] AS ids FROM orders), x AS (SELECT o_orderkey, generate_subscripts(ids, 1) AS i, unnest(ids) AS id FROM p), n AS (SELECT o_custkey AS id, count(*) AS k FROM orders GROUP BY 1),
s AS (SELECT o_orderkey, i, id, c_name, c_mktsegment, n_name, coalesce(k, 0) AS k FROM x JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey LEFT JOIN n USING (id))
SELECT o_orderkey AS sr_episode_id, string_agg(c_name, '|' ORDER BY i) AS speakers, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS citizenships, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS occupations, max((k > 1)::INT) = 1 AS returning FROM s GROUP BY o_orderkey""")
def search_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with the facets of their speakers; here two customers an order."""
    ident = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    episodes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sr_episode_id"), F.array(ident(F.col("o_custkey")), ident(F.col("o_custkey") % 13 + 1)).alias("episode_speakers"))
    number = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("episode_count"))
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(number, "c_custkey", "left")
    people = people.select(ident(F.col("c_custkey")).alias("wikidata_id"), F.col("c_name").alias("speaker"), F.lit("g").alias("gender"), F.array("n_name").alias("citizenships"), F.array("c_mktsegment").alias("occupations"), F.coalesce("episode_count", F.lit(0).cast("long")).alias("episode_count"))
    rows = search.assemble(episodes, people)
    return rows.select("sr_episode_id", *[F.array_join(c, "|").alias(c) for c in ("speakers", "citizenships", "occupations")], "returning")


@query(_ROWS + "SELECT sr_episode_id, r_name AS theme, CASE WHEN coalesce(lag(substr(date, 1, 4)) OVER w, '') <> substr(date, 1, 4) THEN substr(date, 1, 4) END AS header FROM r WINDOW w AS (PARTITION BY r_name ORDER BY date DESC, sr_episode_id DESC)")
def group_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.with_headers(records(spark, sf_dir), F.substring("date", 1, 4), [F.desc("date"), F.desc("sr_episode_id")], ["theme"])
    return rows.select("sr_episode_id", "theme", "header")


def _payload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = chunks(spark, sf_dir).withColumnRenamed("label", "topic_id")
    roll = topics.raw_rollup(rows)
    summary = rows.groupBy("topic_id").agg(F.count(F.lit(1)).alias("chunk_count"), F.count_distinct("sr_episode_id").alias("episode_count"))
    label = F.when(F.col("topic_id") % 2 == 0, F.concat(F.col("topic_id").cast("string"), F.lit("_auto"))).otherwise(F.concat(F.lit("Topic "), F.col("topic_id").cast("string")))
    summary = summary.withColumns({"label": label, "keywords": F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d")), "is_outlier": F.col("topic_id") == 9, "is_low_quality": F.col("topic_id") == 4})
    shown = export.topic_rows(summary)
    first = V.mean_vectors(rows, ["sr_episode_id"], "embedding")
    places = first.select("sr_episode_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    places = places.join(topics.dominant_topics(roll).select("sr_episode_id", "dominant_topic_id"), "sr_episode_id")
    near = neighbours.neighbours(first.select("sr_episode_id", "embedding"), "sr_episode_id", "embedding", 3)
    near = near.withColumnRenamed("related_id", "related_episode_id")
    return shown, export.episode_payload(places, roll, near, shown)


@query("""WITH c AS (SELECT vec_id % 50 AS ep, label FROM embeddings) SELECT label AS topic_id, CASE WHEN label % 2 = 0 THEN 'a · b · c' ELSE 'Topic ' || label END AS label, 'a b c d' AS keywords, count(DISTINCT ep) AS episodes, count(*) AS chunks FROM c WHERE label NOT IN (9, 4) GROUP BY c.label""")
def payload_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, _ = _payload(spark, sf_dir)
    return shown.withColumn("keywords", F.array_join("keywords", " "))


_PAY = """WITH c AS (SELECT vec_id % 50 AS ep, label AS t, 100 + vec_id % 400 AS w, vec_id * 10 AS st FROM embeddings), g AS (SELECT ep, t, sum(w) AS w, min(st) AS st FROM c GROUP BY ALL), s AS (SELECT *, w / sum(w) OVER (PARTITION BY ep) AS share FROM g),
d AS (SELECT ep, t AS dom FROM (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY w DESC, st, t) AS k FROM s) WHERE k = 1), v AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY share DESC, t) AS r FROM s WHERE t NOT IN (9, 4)) """


@query(_PAY + """SELECT d.ep AS sr_episode_id, CASE WHEN dom IN (9, 4) THEN coalesce((SELECT t FROM v WHERE v.ep = d.ep AND r = 1), dom) ELSE dom END AS dominant, round(e.x, 5) AS x, v.t AS topic_id, round(v.share, 4) AS share FROM d JOIN v ON v.ep = d.ep AND r <= 5 JOIN (SELECT vec_id % 50 AS ep, avg(embedding[1]::DOUBLE) AS x FROM embeddings GROUP BY 1) e ON e.ep = d.ep""")
def payload_json_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload, exploded so that SQL can compare it."""
    _, rows = _payload(spark, sf_dir)
    return rows.select("sr_episode_id", "dominant", "x", F.explode("topics").alias("t")).select("sr_episode_id", "dominant", "x", F.col("t.id").alias("topic_id"), F.col("t.value").alias("share"))


@query(_PAY + """SELECT d.ep AS sr_episode_id, CASE WHEN dom IN (9, 4) THEN coalesce((SELECT t FROM v WHERE v.ep = d.ep AND r = 1), dom) ELSE dom END AS dominant, count(v.t) AS topics, string_agg(v.t::VARCHAR, ',' ORDER BY v.r) AS topic_ids FROM d LEFT JOIN v ON v.ep = d.ep AND r <= 5 GROUP BY ALL""")
def payload_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text of every row, read again."""
    _, rows = _payload(spark, sf_dir)
    back = F.from_json("json", "sr_episode_id bigint, dominant bigint, topics array<struct<id:bigint,value:double>>")
    lines = export.json_lines(rows, "sr_episode_id").select("sr_episode_id", back.alias("j"))
    ids = F.transform("j.topics", lambda t: t["id"].cast("string"))
    return lines.select("sr_episode_id", "j.dominant", F.size("j.topics").cast("long").alias("topics"), F.array_join(ids, ",").alias("topic_ids"))


_SHOWN = """WITH c AS (SELECT vec_id % 50 AS ep, label FROM embeddings) SELECT label::VARCHAR AS topic_id, CASE WHEN label % 2 = 0 THEN 'a · b · c' ELSE 'Topic ' || label END AS label, count(DISTINCT ep) AS episodes, count(*) AS chunks FROM c WHERE label NOT IN (9, 4) GROUP BY c.label"""
_TOPIC = "map<string,struct<label:string,episodes:bigint,chunks:bigint>>"


def _member(kind: str) -> Column:
    """A member of a JSON object, read from its text."""
    return F.from_json(F.concat(F.lit("{"), F.col("json"), F.lit("}")), kind)


@query(_SHOWN)
def payload_document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topics of the whole document, read from its text."""
    members = export.payload_document(*_payload(spark, sf_dir)).sections[0].rows
    read = members.select(F.explode(_member(_TOPIC)).alias("topic_id", "t"))
    return read.select("topic_id", "t.label", "t.episodes", "t.chunks")


@query(_PAY + """SELECT d.ep AS sr_episode_id, round(e.x, 5) AS x, coalesce(string_agg(v.t || ':' || round(v.share, 4), ',' ORDER BY v.r), '') AS topics FROM d JOIN (SELECT vec_id % 50 AS ep, avg(embedding[1]::DOUBLE) AS x FROM embeddings GROUP BY 1) e ON e.ep = d.ep LEFT JOIN v ON v.ep = d.ep AND r <= 5 GROUP BY ALL""")
def payload_document_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The episodes of the whole document, read from its text."""
    members = export.payload_document(*_payload(spark, sf_dir)).sections[1].rows
    read = members.select(F.explode(_member("map<string,struct<x:double,y:double,dominant:int,topics:array<array<double>>,related:array<array<double>>>>")).alias("k", "e"))
    pairs = F.transform("e.topics", lambda t: F.concat(t[0].cast("int").cast("string"), F.lit(":"), t[1].cast("string")))
    return read.select(F.col("k").cast("long").alias("sr_episode_id"), "e.x", F.array_join(pairs, ",").alias("topics"))


@query("""WITH p AS (SELECT c_custkey, c_name, c_nationkey FROM customer), o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey % 4 = 0 AS host FROM orders)
SELECT o_orderkey AS id, date, (o_orderkey % 5000 + 30) // 60 AS minutes, CASE WHEN o_orderkey % 2 = 0 THEN '/i/' || o_orderkey END AS image, 'Q' || o_custkey AS speaker, c_name AS name, CASE WHEN host THEN true END AS is_listeners_host FROM o JOIN p ON c_custkey = o_custkey""")
def archive_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes and their speakers from the text of the archive's document; orders stand for episodes."""
    key = F.col("o_orderkey")
    ident = lambda c: F.concat(F.lit("Q"), F.col(c).cast("string"))
    episodes = table(spark, sf_dir, "orders").select(
        key.alias("sr_episode_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("Sommar").alias("program_type"), (key % 5000).alias("length_seconds"), F.when(key % 2 == 0, F.concat(F.lit(T.IMAGE_URL + "/i/"), key.cast("string"))).alias("image_url"), F.lit("text").alias("short_summary"),
        F.array(ident("o_custkey")).alias("episode_speakers"), F.array(F.lit(None).cast("int")).alias("speaker_ages"), (key % 4 == 0).alias("is_listeners_host"),
    )
    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")
    people = table(spark, sf_dir, "customer").select(
        ident("c_custkey").alias("wikidata_id"), F.col("c_name").alias("speaker"), F.lit(1).alias("episode_count"), F.array(F.lit(30), F.lit(None).cast("int")).alias("ages_at_episodes"), F.array("c_name", "c_mktsegment").alias("sr_names"),
        F.lit(" ").alias("wikidata_label"), none.alias("wikidata_description"), none.alias("wikipedia_url"), none.alias("gender"), none.alias("birth_date"), none.alias("death_date"), empty.alias("citizenships"), empty.alias("occupations"),
    )
    speakers, listed = (section.rows for section in export.archive_document(episodes, people).sections)
    names = speakers.select(F.explode(_member("map<string,struct<name:string,ages:array<int>,aliases:array<string>,label:string>>")).alias("speaker", "p")).select("speaker", F.col("p.name").alias("name"))
    listed = listed.select(F.from_json("json", "id bigint, date string, minutes bigint, image string, speakers array<string>, is_listeners_host boolean").alias("e")).select("e.id", "e.date", "e.minutes", "e.image", F.col("e.speakers")[0].alias("speaker"), "e.is_listeners_host")
    return listed.join(names, "speaker")


@query("SELECT label AS topic_id, 'Topic ' || label AS label, count(DISTINCT vec_id % 50) AS episodes FROM embeddings GROUP BY embeddings.label")
def payload_json_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunks(spark, sf_dir).withColumnRenamed("label", "topic_id")
    catalogue = rows.select("topic_id").distinct().withColumn("label", F.concat(F.lit("Topic "), F.col("topic_id").cast("string")))
    return export.matched_topics(catalogue, rows)


@query("""WITH c AS (SELECT vec_id % 50 AS ep, 't' || label AS t, 100 + vec_id % 400 AS w FROM embeddings), g AS (SELECT ep, t, sum(w) AS w FROM c GROUP BY ALL), s AS (SELECT *, w / sum(w) OVER (PARTITION BY ep) AS share FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY share DESC, t) AS k FROM s)
SELECT ep AS sr_episode_id, max(CASE WHEN k = 1 THEN t END) AS dominant, string_agg(t || ':' || round(share, 4), ',' ORDER BY k) AS topics FROM r WHERE k <= 5 GROUP BY ep""")
def curated_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of the second version of the document, whose topics have names for ids."""
    rows = chunks(spark, sf_dir).withColumn("topic_id", F.concat(F.lit("t"), F.col("label").cast("string")))
    roll = topics.raw_rollup(rows)
    shown = topics.topic_summary(rows).select("topic_id", F.col("topic_id").alias("label"), F.col("episode_count").alias("episodes"), F.col("chunk_count").alias("chunks"))
    places = rows.groupBy("sr_episode_id").agg(F.lit(0.5).alias("x"), F.lit(0.25).alias("y"))
    near = rows.select("sr_episode_id").distinct().select("sr_episode_id", F.lit(1).alias("related_episode_id"), F.lit(0.5).alias("similarity"), F.lit(1).alias("rank"))
    members = export.payload_document(shown, export.curated_payload(places, roll, near, shown), 2).sections[1].rows
    read = members.select(F.explode(_member("map<string,struct<dominant:string,topics:array<array<string>>>>")).alias("k", "e"))
    return read.select(F.col("k").cast("long").alias("sr_episode_id"), "e.dominant", F.array_join(F.transform("e.topics", lambda t: F.array_join(t, ":")), ",").alias("topics"))


@query("SELECT n_name AS key, CAST(abs(list_reduce(list_transform(string_split(n_name, ''), lambda c: ascii(c)::BIGINT), lambda h, c: ((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648, 0::BIGINT)) % 12 AS BIGINT) AS colour FROM nation")
def topic_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), T.colour_of(F.col("n_name")).cast("long").alias("colour"))
