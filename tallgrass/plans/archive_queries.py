"""Archive queries: orders stand for episodes, customers for speakers, events for song plays, nations and regions for topics and themes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.operators import archive, incremental, search, segment, taxonomy, topics
from tallgrass.plans.registry import query, table

_K = "CAST(json_extract_string(props, '$.k') AS INT)"


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


@query(f"""WITH e AS (SELECT *, {_K} AS k FROM events), f AS (SELECT *, min(event_id) OVER (PARTITION BY user_id, lower(event_type), k) AS first, row_number() OVER (PARTITION BY user_id, lower(event_type), k ORDER BY round(value)::INT % 4 DESC, event_id) AS r FROM e)
SELECT user_id, event_id, event_type, k, row_number() OVER (PARTITION BY user_id ORDER BY ts, first) AS track_number FROM f WHERE r = 1""")
def playlist_dedup_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = F.round("value").cast("int") % 4
    rows = archive.number_songs(_plays(spark, sf_dir), "user_id", [T.music_key(F.col("event_type")), F.coalesce("k", F.lit(-1))], rich, F.col("ts"), "event_id")
    return rows.select("user_id", "event_id", "event_type", "k", "track_number")


@query("""WITH t AS (SELECT doc_id, lower(text) AS s FROM documents UNION ALL SELECT -1, 'sommar sommar' UNION ALL SELECT -2, 'signatur: vintergatan'),
w AS (SELECT doc_id, list_filter(regexp_extract_all(s, '[\\p{L}\\p{N}]+'), lambda x: x <> 'signatur') AS t FROM t)
SELECT doc_id, (len(t) >= 2 AND list_distinct(t) = ['sommar']) OR t = ['vintergatan'] AS is_theme_song FROM w""")
def theme_song_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, "Sommar sommar"), (-2, "Signatur: Vintergatan")], "doc_id long, title string")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("title")).union(extra)
    return rows.select("doc_id", T.is_theme_song(F.col("title")).alias("is_theme_song"))


@query("SELECT event_id, (trim(event_type) <> '')::INT + (props IS NOT NULL AND trim(props) <> '')::INT + (nullif(CASE WHEN event_id % 3 = 0 THEN '  ' ELSE event_type END, '  ') IS NOT NULL)::INT AS score FROM events")
def metadata_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.when(F.col("event_id") % 3 == 0, F.lit("  ")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", T.filled_fields(F.col("event_type"), F.col("props"), gap).alias("score"))


_NAMES = "WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) || ' och ' || p_type WHEN p_partkey % 3 = 1 THEN p_name ELSE p_name || ' och ' || p_brand END AS name FROM part), "


def _credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, first = F.col("p_partkey") % 3, F.split_part("p_name", F.lit(" "), F.lit(1))
    name = F.when(k == 0, F.concat(first, F.lit(" och "), F.col("p_type"))).when(k == 1, F.col("p_name")).otherwise(F.concat(F.col("p_name"), F.lit(" och "), F.col("p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@query(_NAMES + """s AS (SELECT p_partkey, name, split_part(name, ' och ', 1) AS a, substr(name, instr(name, ' och ') + 5) AS b, instr(name, ' och ') > 0 AS two FROM p),
l AS (SELECT p_partkey, CASE WHEN NOT two THEN [name] WHEN instr(a, ' ') = 0 AND instr(b, ' ') > 0 THEN [a || ' ' || list_extract(string_split(b, ' '), -1), b] ELSE [a, b] END AS names FROM s)
SELECT p_partkey, generate_subscripts(names, 1) AS speaker_index, p_partkey || ':' || generate_subscripts(names, 1) AS speaker_appearance_id, unnest(names) AS speaker FROM l""")
def appearances_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive.appearances(_credits(spark, sf_dir), "p_partkey", "name")
    return rows.withColumn("speaker_index", F.col("speaker_index").cast("long"))


@query("SELECT o.o_orderkey, c.c_custkey, c.c_name, o.o_orderdate, o.o_orderpriority FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def appearances_denorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand for episodes, their orders for appearances."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderpriority")
    return archive.denormalised(orders, people, "c_custkey").select("o_orderkey", "c_custkey", "c_name", "o_orderdate", "o_orderpriority")


@query("""WITH f AS (SELECT user_id, event_type, min(event_id) AS m FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type, ',' ORDER BY m) AS types, count(*) AS n FROM f GROUP BY user_id""")
def attach_ordered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive.ordered_ids(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type", "types")
    return rows.select("user_id", F.array_join("types", ",").alias("types"), F.size("types").cast("long").alias("n"))


_AGE = """CASE WHEN b IS NULL THEN NULL WHEN length(b) = 4 THEN y - b::INT - 1 WHEN length(b) = 7 THEN y - substr(b, 1, 4)::INT - (m <= substr(b, 6, 2)::INT)::INT
 ELSE CASE WHEN substr(b, 6) = '02-29' AND NOT (y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0)) THEN NULL ELSE y - substr(b, 1, 4)::INT - (md < substr(b, 6))::INT END END"""
_BORN = "substr(strftime(DATE '1930-01-01' + CAST(o_custkey * 37 % 20000 AS INT), '%Y-%m-%d'), 1, CASE WHEN o_orderkey % 3 = 0 THEN 4 WHEN o_orderkey % 3 = 1 THEN 7 ELSE 10 END)"
_DIED = "CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '1996' ELSE '1996-06' END WHEN o_orderkey % 5 = 1 THEN '1997-03-15' END"


@query(f"""WITH a AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, {_BORN} AS b, {_DIED} AS x FROM orders),
p AS (SELECT *, substr(d, 1, 4)::INT AS y, substr(d, 6, 2)::INT AS m, substr(d, 6) AS md FROM a),
g AS (SELECT *, CASE WHEN x IS NULL THEN false WHEN length(x) = 4 THEN y > x::INT WHEN length(x) = 7 THEN substr(d, 1, 7) > x ELSE d > x END AS gone, {_AGE} AS age FROM p)
SELECT o_orderkey, b AS birth, x AS death, CASE WHEN gone OR age < 0 THEN NULL ELSE age END AS age FROM g""")
def conservative_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("o_custkey") * 37 % 20000).cast("int"))
    k = F.col("o_orderkey")
    birth = F.when(k % 3 == 0, F.date_format(born, "yyyy")).when(k % 3 == 1, F.date_format(born, "yyyy-MM")).otherwise(F.date_format(born, "yyyy-MM-dd"))
    death = F.when(k % 5 == 0, F.when(k % 2 == 0, "1996").otherwise("1996-06")).when(k % 5 == 1, "1997-03-15")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", birth.alias("birth"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("aired"), death.alias("death"))
    return rows.select("o_orderkey", "birth", "death", T.age_at(F.col("birth"), F.col("aired"), F.col("death")).alias("age"))


@query("""WITH e AS (SELECT o_orderkey, year(o_orderdate) AS y, [o_custkey, o_custkey % 7 + 1, 1000000000] AS ids FROM orders), x AS (SELECT o_orderkey, y, generate_subscripts(ids, 1) AS p, unnest(ids) AS id FROM e),
a AS (SELECT o_orderkey, p, CASE WHEN c_nationkey % 2 = 0 THEN y - (1930 + c_custkey % 40) - 1 END AS age FROM x LEFT JOIN customer ON c_custkey = id)
SELECT o_orderkey, string_agg(coalesce(age::VARCHAR, '-'), ',' ORDER BY p) AS ages, count(*) AS n FROM a GROUP BY o_orderkey""")
def aligned_array_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages of three people an order: one may be without a birth date, one is not known at all; all keep their places."""
    ident = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sr_episode_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.array(ident(F.col("o_custkey")), ident(F.col("o_custkey") % 7 + 1), F.lit("Q1000000000")).alias("episode_speakers"))
    born = F.when(F.col("c_nationkey") % 2 == 0, (F.lit(1930) + F.col("c_custkey") % 40).cast("string"))
    people = table(spark, sf_dir, "customer").select(ident(F.col("c_custkey")).alias("wikidata_id"), born.alias("birth_date"), F.lit(None).cast("string").alias("death_date"))
    rows = archive.attach_ages(orders, people)
    ages = F.transform("speaker_ages", lambda a: F.coalesce(a.cast("string"), F.lit("-")))
    return rows.select(F.col("sr_episode_id").alias("o_orderkey"), F.array_join(ages, ",").alias("ages"), F.size("speaker_ages").cast("long").alias("n"))


@query("""WITH e AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_custkey, o_orderpriority AS label FROM orders),
p AS (SELECT d, 'Q' || (o_custkey + 1) AS id, min(upper(label)) AS label FROM e WHERE o_custkey % 5 <> 0 GROUP BY ALL), lone AS (SELECT d, count(*) AS n, min(id) AS id FROM p GROUP BY d),
s AS (SELECT o_orderkey, d, 1 AS i, label FROM e UNION ALL SELECT o_orderkey, d, 2, 'Nobody' FROM e WHERE o_orderkey % 3 = 0), c AS (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS speakers FROM s),
m AS (SELECT c.o_orderkey, c.i, count(*) AS n, min(p.id) AS id FROM c JOIN p ON p.d = c.d AND lower(p.label) = lower(c.label) GROUP BY ALL)
SELECT c.o_orderkey, c.i AS speaker_index, CASE WHEN m.n = 1 THEN m.id WHEN lone.n = 1 AND speakers = 1 THEN lone.id END AS matched FROM c LEFT JOIN m ON m.o_orderkey = c.o_orderkey AND m.i = c.i LEFT JOIN lone ON lone.d = c.d""")
def match_unique_else_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for episodes, their priority for the speaker's name; every third has a second speaker whom nobody knows."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sr_episode_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_custkey", "o_orderpriority")
    first = orders.select("sr_episode_id", F.lit(1).alias("speaker_index"), F.col("o_orderpriority").alias("speaker"))
    speakers = first.union(orders.filter("sr_episode_id % 3 = 0").select("sr_episode_id", F.lit(2), F.lit("Nobody")))
    known = orders.filter("o_custkey % 5 <> 0").select("date", F.concat(F.lit("Q"), (F.col("o_custkey") + 1).cast("string")).alias("wikidata_id"), F.upper("o_orderpriority").alias("label"))
    rows = archive.match_entities(speakers, orders, known.union(known.select("date", F.lit("x"), "label")))
    return rows.select(F.col("sr_episode_id").alias("o_orderkey"), "speaker_index", F.col("wikidata_id").alias("matched"))


_PEOPLE = f"""WITH e AS (SELECT event_id AS pos, 'Q' || (user_id + 1) AS id, event_type, {_K} AS k FROM events WHERE user_id % 11 <> 0) """


def _people_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the people query: fields are blank or null in some, and say different things in others."""
    rows = _plays(spark, sf_dir)
    k, some = F.col("k"), lambda n: F.when(F.col("event_id") % n == 0, F.lit("")).otherwise(F.col("event_type"))
    who = F.when(F.col("user_id") % 11 == 0, F.lit("http://x/no-id")).otherwise(F.concat(F.lit("http://x/Q"), (F.col("user_id") + 1).cast("string")))
    return rows.select(
        F.col("event_id").alias("pos"), who.alias("speaker"), some(3).alias("speakerLabel"), some(2).alias("speakerDescription"), F.when(k % 10 == 0, F.concat(F.lit("sv"), k.cast("string"))).alias("svArticle"), F.when(k % 3 == 0, F.concat(F.lit("en"), k.cast("string"))).alias("enArticle"),
        F.when(k % 4 == 0, F.concat(F.lit("http://x/Q"), (k + 1).cast("string"))).otherwise(F.lit("unknown")).alias("gender"), F.when(k % 8 == 0, F.lit("")).otherwise(F.lit("g")).alias("genderLabel"), F.concat(F.lit("+19"), F.lpad((k % 90 + 10).cast("string"), 2, "0"), F.lit("-05-06T00:00:00Z")).alias("birthDate"), (k % 3 + 9).cast("string").alias("birthPrecision"),
        F.lit(None).cast("string").alias("deathDate"), F.lit(None).cast("string").alias("deathPrecision"), F.concat(F.lit("http://x/Q"), (k % 5 + 1).cast("string")).alias("citizenship"), F.concat(F.lit("land "), F.col("event_id").cast("string")).alias("citizenshipLabel"), F.lit(None).cast("string").alias("occupation"), F.lit(None).cast("string").alias("occupationLabel"),
    )


@query(_PEOPLE + """, c AS (SELECT id, k % 5 + 1 AS v, min(pos) AS p, max(pos) AS q FROM e GROUP BY ALL), l AS (SELECT id, string_agg('Q' || v, ',' ORDER BY p) AS citizenship_ids, string_agg('land ' || q, ',' ORDER BY p) AS citizenships FROM c GROUP BY id),
h AS (SELECT id AS wikidata_id, arg_min(event_type, pos) FILTER (pos % 3 <> 0) AS wikidata_label, arg_min(event_type, pos) FILTER (pos % 2 <> 0) AS wikidata_description, coalesce('sv' || arg_max(k, pos) FILTER (k % 10 = 0), 'en' || arg_min(k, pos) FILTER (k % 3 = 0)) AS wikipedia_url,
 'Q' || (arg_min(k, pos) FILTER (k % 4 = 0) + 1) AS gender_id, CASE WHEN arg_min(k, pos) FILTER (k % 4 = 0) % 8 = 0 THEN 'Q' || (arg_min(k, pos) FILTER (k % 4 = 0) + 1) WHEN count(*) FILTER (k % 4 = 0) > 0 THEN 'g' END AS gender,
 substr('19' || lpad((arg_min(k, pos) % 90 + 10)::VARCHAR, 2, '0') || '-05-06', 1, CASE arg_min(k, pos) % 3 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) AS birth_date FROM e GROUP BY id)
SELECT h.*, citizenship_ids, citizenships FROM h JOIN l ON l.id = h.wikidata_id""")
def first_last_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive.merge_people(_people_rows(spark, sf_dir))
    return rows.select("wikidata_id", "wikidata_label", "wikidata_description", "wikipedia_url", "gender", "gender_id", "birth_date", *[F.array_join(c, ",").alias(c) for c in ("citizenship_ids", "citizenships")])


@query("""WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS d, year(o_orderdate) AS y, CASE WHEN o_orderkey % 4 = 0 THEN 'B ' ELSE 'A ' END || (o_orderkey % 3) AS name FROM orders),
n AS (SELECT o_custkey, name, min((d, o_orderkey)) AS first FROM o GROUP BY ALL), l AS (SELECT o_custkey, string_agg(name, ',' ORDER BY first) AS sr_names, arg_max(name, first) AS speaker FROM n GROUP BY o_custkey),
v AS (SELECT o_custkey, count(*) AS episode_count, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS episode_ids, string_agg(coalesce(CASE WHEN c_nationkey % 2 = 0 THEN y - 1951 END::VARCHAR, '-'), ',' ORDER BY o_orderkey) AS ages FROM o JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey)
SELECT 'Q' || o_custkey AS wikidata_id, speaker, sr_names, episode_count, episode_ids, ages FROM l JOIN v USING (o_custkey)""")
def speaker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand for speakers, who go by several names; the name that was newly seen last is theirs."""
    ident = lambda c: F.concat(F.lit("Q"), F.col(c).cast("string"))
    name = F.concat(F.when(F.col("o_orderkey") % 4 == 0, "B ").otherwise("A "), (F.col("o_orderkey") % 3).cast("string"))
    appearing = table(spark, sf_dir, "orders").select(ident("o_custkey").alias("wikidata_id"), name.alias("speaker"), F.col("o_orderkey").alias("sr_episode_id"), F.lit(1).alias("speaker_index"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    people = table(spark, sf_dir, "customer").select(ident("c_custkey").alias("wikidata_id"), F.when(F.col("c_nationkey") % 2 == 0, "1950").alias("birth_date"), F.lit(None).cast("string").alias("death_date"))
    rows = archive.speaker_records(appearing, people)
    ages = F.array_join(F.transform("ages_at_episodes", lambda a: F.coalesce(a.cast("string"), F.lit("-"))), ",")
    return rows.select("wikidata_id", "speaker", F.array_join("sr_names", ",").alias("sr_names"), F.col("episode_count").cast("long").alias("episode_count"), F.array_join(F.col("episode_ids").cast("array<string>"), ",").alias("episode_ids"), ages.alias("ages"))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate AS d, CASE WHEN month(o_orderdate) BETWEEN 6 AND 9 THEN 'Sommar' WHEN month(o_orderdate) IN (12, 1) THEN 'Vinter' WHEN o_orderpriority = '1-URGENT' THEN 'Vinter' WHEN o_orderpriority = '2-HIGH' THEN 'Sommar' END AS program_type FROM orders)
SELECT o_orderkey, program_type, year(d) - CASE WHEN program_type = 'Vinter' AND month(d) = 1 THEN 1 ELSE 0 END AS season_year, CASE WHEN program_type = 'Vinter' THEN 'VT' ELSE '' END || (year(d) - CASE WHEN program_type = 'Vinter' AND month(d) = 1 THEN 1 ELSE 0 END) AS label FROM o""")
def season_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = F.when(F.col("o_orderpriority") == "1-URGENT", "ett vinterprogram").when(F.col("o_orderpriority") == "2-HIGH", "Sommarvärd är").otherwise("annat")
    rows = table(spark, sf_dir, "orders").withColumn("program_type", T.program_type(F.month("o_orderdate"), F.lit(""), summary))
    year = T.season_year(F.col("o_orderdate"), F.coalesce("program_type", F.lit("")))
    return rows.select("o_orderkey", "program_type", year.alias("season_year"), T.season_label(F.coalesce("program_type", F.lit("")), year).alias("label"))


@query("SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm', '%Y-%m-%d %H:%M:%S') AS local FROM events")
def local_date_from_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the times are written the old way, in milliseconds, half as ISO 8601."""
    ts = F.col("ts").cast("timestamp")
    old = F.concat(F.lit("/Date("), F.unix_millis(ts).cast("string"), F.lit("+0200)/"))
    value = F.when(F.col("event_id") % 2 == 0, old).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(T.stockholm(T.radio_time(value)), "yyyy-MM-dd HH:mm:ss").alias("local"))


@query("""WITH d AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'poddtips: ' || source WHEN 1 THEN 'Sommar 50 år' WHEN 2 THEN 'fråga värden ' || source ELSE source END AS s, n_chars, doc_id FROM documents),
r AS (SELECT CASE WHEN s LIKE 'poddtips%' THEN 'podcast_promo' WHEN s = 'Sommar 50 år' THEN 'anniversary' WHEN s LIKE 'fråga värden%' THEN 'question_show' WHEN doc_id % 5 = 0 THEN 'missing_audio' WHEN n_chars < 900 THEN 'too_short' WHEN doc_id % 11 = 0 THEN 'outside_season' END AS reason FROM d)
SELECT reason AS exclusion_reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def exclusion_reason_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 7
    name = F.when(k == 0, F.concat(F.lit("Poddtips: "), F.col("source"))).when(k == 1, "Sommar 50 år").when(k == 2, F.concat(F.lit("Fråga värden "), F.col("source"))).otherwise(F.col("source"))
    mp3 = F.when(F.col("doc_id") % 5 != 0, F.lit("x"))
    kind = F.when(F.col("doc_id") % 11 != 0, F.lit("Sommar"))
    rows = table(spark, sf_dir, "documents").withColumn("exclusion_reason", T.exclusion_reason(name, F.col("n_chars"), mp3, kind))
    return archive.reasons(rows)


@query("""SELECT r_name AS theme, count(*) AS chunk_count, count(DISTINCT n_nationkey) AS topics, round(sum(c_acctbal), 2) AS balance, 'broad-' || lpad((dense_rank() OVER (ORDER BY r_name))::VARCHAR, 2, '0') AS broad_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def broad_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("raw_topic_id"), "c_acctbal")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("raw_topic_id"), F.col("n_name").alias("topic_id"), "n_regionkey")
    themes = nations.select("topic_id", "n_regionkey").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("topic_id", F.col("r_name").alias("theme"))
    rows = taxonomy.map_to_topics(raw, nations.select("raw_topic_id", "topic_id"), themes)
    sums = rows.groupBy("theme").agg(F.count(F.lit(1)).alias("chunk_count"), F.count_distinct("topic_id").alias("topics"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    return sums.join(taxonomy.theme_ids(sums), "theme")


def _hierarchy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders stand for chunks, customers for episodes, nations for topics, regions for themes."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey"), F.col("n_name").alias("topic_id"), F.col("r_name").alias("theme"))
    themes = nations.select("topic_id", "theme").join(taxonomy.theme_ids(nations), "theme")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), (F.col("o_custkey") % 300).alias("sr_episode_id"), (F.col("o_custkey") % 25).alias("n_nationkey"), (F.col("o_orderkey") % 90 + 10).alias("word_count"))
    totals = rows.groupBy("sr_episode_id").agg((F.sum("word_count") * 2).alias("episode_words"))
    return taxonomy.rollups(rows.join(nations, "n_nationkey").drop("theme"), totals, themes, {3: {"NATION_1": 0.55, "NATION_2": 0.30}, 999: {"NATION_1": 0.5}})


_HIERARCHY = """WITH c AS (SELECT o_orderkey AS id, o_custkey % 300 AS ep, o_custkey % 25 AS n, o_orderkey % 90 + 10 AS w FROM orders), b AS (SELECT r_name AS theme, 'broad-' || lpad((row_number() OVER (ORDER BY r_name))::VARCHAR, 2, '0') AS broad_id FROM (SELECT DISTINCT r_name FROM nation JOIN region ON n_regionkey = r_regionkey)),
t AS (SELECT n_nationkey AS n, n_name AS topic_id, r_name AS theme, broad_id FROM nation JOIN region ON n_regionkey = r_regionkey JOIN b ON b.theme = r_name), tot AS (SELECT ep, sum(w) * 2 AS ew FROM c GROUP BY ep),
g AS (SELECT ep, topic_id, count(*) AS chunk_count, sum(w)::BIGINT AS word_count, arg_min(id, (-w, id)) AS representative FROM c JOIN t USING (n) GROUP BY ALL),
m AS (SELECT * FROM (VALUES (3, 'NATION_1', 0.55), (3, 'NATION_2', 0.30), (999, 'NATION_1', 0.5)) v(ep, topic_id, share) WHERE (ep, topic_id) NOT IN (SELECT (ep, topic_id) FROM g)),
e AS (SELECT g.ep, g.topic_id, chunk_count, word_count, word_count / ew AS share, representative, 'clustered' AS source FROM g JOIN tot USING (ep) UNION ALL SELECT ep, m.topic_id, 0, 0, share::DOUBLE, NULL, 'manual' FROM m JOIN t USING (topic_id)) """


@query(_HIERARCHY + "SELECT ep AS sr_episode_id, e.topic_id, theme, broad_id, chunk_count, word_count, round(share, 6) AS share, representative, source AS assignment_source, row_number() OVER (PARTITION BY ep ORDER BY share DESC, e.topic_id) AS rank FROM e JOIN t USING (topic_id)")
def taxonomy_episode_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _hierarchy(spark, sf_dir)["episode_topics"]
    return rows.select("sr_episode_id", "topic_id", "theme", "broad_id", "chunk_count", "word_count", F.round("share", 6).alias("share"), "representative", "assignment_source", "rank")


@query(_HIERARCHY + "SELECT t.topic_id, t.theme, t.broad_id, coalesce(sum(chunk_count), 0)::BIGINT AS chunk_count, count(DISTINCT ep) AS episode_count, coalesce(sum(word_count), 0)::BIGINT AS word_count FROM t LEFT JOIN e USING (topic_id) GROUP BY ALL")
def taxonomy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hierarchy(spark, sf_dir)["topics"].select("topic_id", "theme", "broad_id", "chunk_count", "episode_count", "word_count")


@query(_HIERARCHY + "SELECT t.broad_id, t.theme, string_agg(DISTINCT t.topic_id, ',' ORDER BY t.topic_id) AS topic_ids, count(DISTINCT ep) AS episode_count FROM t LEFT JOIN e USING (topic_id) GROUP BY ALL")
def taxonomy_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hierarchy(spark, sf_dir)["broad"].withColumn("topic_ids", F.array_join("topic_ids", ",")).select("broad_id", "theme", "topic_ids", "episode_count")


@query(_HIERARCHY + "SELECT e.ep AS sr_episode_id, broad_id, theme, sum(chunk_count)::BIGINT AS chunk_count, sum(word_count)::BIGINT AS word_count, round(coalesce(sum(word_count) / any_value(ew), 0), 6) AS share FROM e JOIN t USING (topic_id) LEFT JOIN tot ON tot.ep = e.ep GROUP BY ALL")
def taxonomy_episode_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hierarchy(spark, sf_dir)["episode_broad"].select("sr_episode_id", "broad_id", "theme", "chunk_count", "word_count", F.round("share", 6).alias("share"))


_RULES = {"src1": {"min_chunks": 30, "min_distinct_terms": 2, "terms": ["the", "eau", "ung"]}, "src2": {"min_chunks": 2, "min_distinct_terms": 3, "terms": ["the", "eau", "zzzz"]}}


@query("""WITH g AS (SELECT source, lang, count(*) AS n, max((lower(text) LIKE '%the%')::INT) + max((lower(text) LIKE '%eau%')::INT) + max((lower(text) LIKE '%ung%')::INT) AS a, max((lower(text) LIKE '%the%')::INT) + max((lower(text) LIKE '%eau%')::INT) + max((lower(text) LIKE '%zzzz%')::INT) AS b FROM documents GROUP BY source, lang),
k AS (SELECT source, lang FROM g WHERE source NOT IN ('src1', 'src2') OR (source = 'src1' AND n >= 30 AND a >= 2) OR (source = 'src2' AND n >= 2 AND b >= 3)) SELECT doc_id, source, lang FROM documents JOIN k USING (source, lang)""")
def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return taxonomy.evidence_gate(docs, _RULES, "lang", "source").select("doc_id", "source", "lang")


@query("""WITH u AS (SELECT i AS id FROM range(0, 25) t(i)), a AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey % 4 <> 1 UNION ALL SELECT n_nationkey + 20 FROM nation WHERE n_nationkey > 21), g AS (SELECT id, count(*) AS n FROM a GROUP BY id)
SELECT coalesce(u.id, g.id) AS id, CASE WHEN u.id IS NULL THEN 'extra' WHEN g.id IS NULL THEN 'missing' ELSE 'duplicate' END AS fault FROM u FULL JOIN g ON u.id = g.id WHERE u.id IS NULL OR g.id IS NULL OR n > 1""")
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"))
    return taxonomy.partition_faults(ids.filter("id % 4 <> 1"), ids.filter("id > 21").select((F.col("id") + 20).alias("id")), "id", spark.range(25))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("WITH l AS (SELECT doc_id FROM labels WHERE quality = 1), r AS (SELECT doc_id FROM labels WHERE toxic = 1) SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, CASE WHEN r.doc_id IS NULL THEN 'left' ELSE 'right' END AS side FROM l FULL JOIN r USING (doc_id) WHERE l.doc_id IS NULL OR r.doc_id IS NULL")
def key_set_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return taxonomy.key_differences(labels.filter("quality = 1"), labels.filter("toxic = 1"), "doc_id")


@query("WITH d AS (SELECT DISTINCT o_custkey FROM orders) SELECT o_custkey, (row_number() OVER (ORDER BY o_custkey) - 1) // 100 AS batch FROM d")
def key_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.batches(table(spark, sf_dir, "orders"), "o_custkey", 100)


@query("""WITH r AS (SELECT n_name AS topic_id, o_custkey % 200 AS ep, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT ep AS sr_episode_id, topic_id, count(*) AS chunk_count, round(count(*) / 100.0, 4) AS share, 'clustered' AS assignment_source FROM r GROUP BY ALL UNION ALL SELECT 3, 'poesi', 0, 0.55, 'manual' UNION ALL SELECT 3, 'karlek', 0, 0.3, 'manual')
SELECT *, row_number() OVER (PARTITION BY sr_episode_id ORDER BY share DESC, topic_id) AS rank FROM s""")
def manual_union_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sums = rows.groupBy((F.col("o_custkey") % 200).alias("sr_episode_id"), F.col("n_name").alias("topic_id")).agg(F.count(F.lit(1)).alias("chunk_count"))
    sums = sums.withColumns({"word_count": F.lit(0).cast("long"), "share": F.round(F.col("chunk_count") / 100.0, 4)})
    return taxonomy.with_manual(sums, {3: {"poesi": 0.55, "karlek": 0.30}}).drop("word_count")


@query("SELECT c_custkey, lpad(((CAST(c_acctbal * 10 AS BIGINT) + 30) // 60)::VARCHAR, 4, '0') AS minutes, upper(substr(split_part(c_name, '#', 1), 1, 1)) AS initial FROM customer WHERE c_acctbal > 0")
def display_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.round(F.col("c_acctbal") * 10).cast("long")
    names = F.array(F.split_part("c_name", F.lit("#"), F.lit(1)))
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey", F.lpad(T.minutes(seconds).cast("string"), 4, "0").alias("minutes"), T.initials(names).alias("initial"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS season, o_orderdate AS aired FROM orders), p AS (SELECT a.o_orderkey, b.o_orderkey AS other, b.season, b.aired, row_number() OVER (PARTITION BY a.o_orderkey, b.season ORDER BY b.aired, b.o_orderkey) AS r FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey)
SELECT o_orderkey, other, season, row_number() OVER (PARTITION BY o_orderkey ORDER BY aired DESC, other DESC) AS position FROM p WHERE r = 1""")
def same_entity_other_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    return search.others_of_same(orders, "o_orderkey", "o_custkey", "season", "o_orderdate")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS prefix FROM lineitem""")
def prefix_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order stand for units, quantities for words."""
    rows = segment.prefix_words(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "prefix")


@query("""WITH w AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders SEMI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_mktsegment = 'BUILDING') USING (o_custkey))
SELECT o_orderkey, CASE WHEN l.doc_id IS NULL THEN 'fetch' ELSE 'cached' END AS origin, position FROM w LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = w.o_orderkey WHERE position <= 200""")
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 wanted episodes in their order, and which of them the cache has."""
    segment_ = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders")
    cache = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("o_orderkey"))
    wanted = orders.join(segment_, "o_custkey").select("o_orderkey")
    return incremental.fetch_plan(orders, wanted, cache, "o_orderkey", ["o_orderdate", "o_orderkey"], 200).select("o_orderkey", "origin", F.col("position").cast("long").alias("position"))


@query("""WITH a AS (SELECT o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) - 1950 END AS age FROM orders) SELECT o_custkey, round(avg(age), 6) AS mean_age, count(*) - count(age) AS unknown FROM a GROUP BY o_custkey""")
def mean_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the ages that are known; null without any."""
    age = F.when(F.col("o_orderkey") % 4 != 0, F.year("o_orderdate") - 1950)
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.transform(F.collect_list(F.struct(age.alias("age"))), lambda x: x["age"]).alias("ages"))
    return rows.select("o_custkey", F.round(search.mean_age(F.col("ages")), 6).alias("mean_age"), F.size(F.filter("ages", lambda a: a.isNull())).cast("long").alias("unknown"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS title FROM orders), l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
SELECT l_orderkey AS sr_episode_id, l_linenumber AS line, CASE WHEN l_orderkey % 2 = 0 THEN coalesce(CASE WHEN l_orderkey % 6 <> 0 THEN title END, 'line ' || l_linenumber) ELSE 'line ' || l_linenumber END AS source_title, CASE WHEN l_orderkey % 2 = 0 THEN date END AS date, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 0 END AS speakers FROM l LEFT JOIN o ON o_orderkey = l_orderkey""")
def chunk_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines stand for chunks; orders with odd keys are unknown, every sixth has no title."""
    k = F.col("o_orderkey")
    episodes = table(spark, sf_dir, "orders").filter(k % 2 == 0).select(k.alias("sr_episode_id"), F.when(k % 6 != 0, F.col("o_orderpriority")).otherwise("").alias("source_title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.year("o_orderdate").alias("year"), F.lit("x").alias("program_type"), F.array(F.lit("Q1")).alias("episode_speakers"))
    chunks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sr_episode_id"), F.col("l_linenumber").alias("line"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("source_title"))
    return archive.with_metadata(chunks, episodes).select("sr_episode_id", "line", "source_title", "date", F.size("episode_speakers").alias("speakers"))


_MONTHS = "['jan.', 'feb.', 'mars', 'apr.', 'maj', 'juni', 'juli', 'aug.', 'sep.', 'okt.', 'nov.', 'dec.']"


@query(f"""SELECT o_orderkey, day(o_orderdate) || ' ' || {_MONTHS}[month(o_orderdate)] || ' ' || year(o_orderdate) AS date, (o_orderkey % 90) || ' min' AS duration, upper(substr(c_name, 1, 1)) || substr(c_name, 2) AS name,
 'https://www.sverigesradio.se/avsnitt/' || o_orderkey AS url, CASE WHEN o_orderkey % 3 <> 0 THEN 'https://static-cdn.sr.se/' || o_orderkey END AS image, substr(o_orderpriority, 1, 4) AS excerpt FROM orders JOIN customer ON o_custkey = c_custkey""")
def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a result's card shows."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    image = F.when(key % 3 != 0, F.concat(F.lit("/"), key.cast("string"))).otherwise("")
    return rows.select("o_orderkey", T.short_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), T.duration(key % 90).alias("duration"), T.capitalise(F.concat(F.lower(F.substring("c_name", 1, 1)), F.expr("substring(c_name, 2)"))).alias("name"), T.episode_url(key).alias("url"), T.image_url(image).alias("image"), T.excerpt(F.col("o_orderpriority"), 4).alias("excerpt"))


@query("""WITH r AS (SELECT p_partkey, 'mlx::' || p_name || '::prompt=' || coalesce(nullif(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END, ''), 'none') || '::max_length=' || p_size AS recipe FROM part)
SELECT p_partkey, trim(regexp_replace(recipe, '[^a-zA-Z0-9._-]+', '-', 'g'), '-') || '-' || substr(sha256(recipe), 1, 8) AS folder FROM r""")
def recipe_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts stand for models of embeddings."""
    prompt = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", T.recipe_slug(T.embedding_recipe(F.lit("mlx"), F.col("p_name"), prompt, F.col("p_size"))).alias("folder"))


@query("SELECT n_nationkey AS topic_id, n_name AS label FROM nation WHERE n_nationkey <> 4 AND n_nationkey % 5 <> 2 ORDER BY n_nationkey LIMIT 9 OFFSET 3")
def usable_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations stand for topics; every fifth is of low quality, 4 stands for the outlier."""
    key = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(F.when(key == 4, -1).otherwise(key).alias("topic_id"), F.col("n_name").alias("label"), (key % 5 == 2).alias("is_low_quality"))
    return topics.usable(rows, offset=3, limit=9).select("topic_id", "label")


@query("SELECT n_name AS topic_id, n_name AS label, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def leaf_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return search.leaf_options(rows.select(F.col("n_name").alias("topic_id"), F.col("n_name").alias("label"), F.col("r_name").alias("parent")), ["ASIA", "EUROPE"])


@query("SELECT n_nationkey AS topic_id, CASE WHEN n_nationkey % 3 = 0 THEN 'new ' || n_name ELSE n_name END AS label, CASE WHEN n_nationkey % 3 = 0 THEN n_name END AS cluster_label, CASE WHEN n_nationkey % 3 = 0 THEN 'unreviewed' END AS review_status FROM nation")
def relabelled_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("topic_id"), F.col("n_name").alias("label"))
    new = rows.filter("topic_id % 3 = 0").select("topic_id", F.concat(F.lit("new "), F.col("label")).alias("llm_label"))
    return topics.relabelled(rows, new, "m").select("topic_id", "label", "cluster_label", "review_status")


@query("SELECT n_nationkey AS topic_id, CASE WHEN n_nationkey % 5 <> 2 THEN r_name END AS parent_label FROM nation JOIN region ON n_regionkey = r_regionkey")
def applied_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proposal for all nations but those of low quality is applied."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    catalogue = rows.select(F.col("n_nationkey").alias("topic_id"), (F.col("n_nationkey") % 5 == 2).alias("is_low_quality"), F.col("r_name").alias("r"))
    proposal = catalogue.filter("not is_low_quality").select("topic_id", F.col("r").alias("parent_label"))
    return taxonomy.applied(catalogue, proposal).select("topic_id", "parent_label")
