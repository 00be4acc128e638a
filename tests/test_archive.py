"""Archive operators: small tables in, exact rows out."""

import json

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import archive, incremental, taxonomy
from tallgrass.sources import files

AUDIO = {"id": 1, "duration": 2997, "url": "u.mp3", "filesizeinbytes": 5}


def raw(spark, *rows):
    full = [{"id": i, "title": "Anna Ek 2015", "description": "d", "url": "x", "publishdateutc": "/Date(1435143600000)/", "downloadpodfile": AUDIO, **r} for i, r in enumerate(rows, 1)]
    return spark.read.schema(archive.RAW_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in full]))


def test_episodes(spark):
    got = archive.programmes(archive.parse_episodes(raw(spark, {"title": "Kalle Moraeus 2015", "photographer": "P"}, {"title": "Trailer"}, {"downloadpodfile": None, "listenpodfile": {"id": 2, "duration": 60, "url": "l"}}))).collect()
    assert len(got) == 1
    assert (got[0].date, got[0].year, got[0].program_type, got[0].length_seconds, got[0].speaker, got[0].image_credit) == ("2015-06-24", 2015, "Sommar", 2997, "Kalle Moraeus", "P")
    counts = {r.exclusion_reason: r.n for r in archive.reasons(archive.parse_episodes(raw(spark, {"title": "Trailer"}, {"downloadpodfile": None}))).collect()}
    assert counts == {"trailer": 1, "missing_audio": 1}


def test_reissues_get_their_date(spark):
    rows = raw(spark, {"title": "Sommar i P1 med Anna Ek", "description": "Programmet är från den 4 juli 1974.", "publishdateutc": "2020-10-01T10:00:00"})
    got = archive.parse_episodes(rows).first()
    assert (got.date, got.year, got.program_type) == ("1974-07-04", 1974, "Sommar")


def test_matching(spark):
    speakers = spark.createDataFrame([(1, 1, "Anna Ek"), (2, 1, "Bo Al"), (2, 2, "Cy Di"), (3, 1, "Emil Beer"), (4, 1, "Dag Em"), (5, 1, "Dag Em")], "sr_episode_id int, speaker_index int, speaker string")
    episodes = spark.createDataFrame([(1, "2020-06-01"), (2, "2020-06-02"), (3, "2020-06-03"), (4, "2020-06-04"), (5, "2020-06-05")], "sr_episode_id int, date string")
    people = spark.createDataFrame([("2020-06-01", "Q1", None), ("2020-06-01", "t12", None), ("2020-06-02", "Q2", "bo  AL"), ("2020-06-02", "Q3", "Other"), ("2020-06-04", "Q4", "X"), ("2020-06-04", "Q5", "Y"), ("2020-06-05", "Q6", "Dag Em"), ("2020-06-05", "Q7", "Dag Em")], "date string, wikidata_id string, label string")
    got = {(r.sr_episode_id, r.speaker_index): r.wikidata_id for r in archive.match_entities(speakers, episodes, people).collect()}
    assert got == {(1, 1): "Q1", (2, 1): "Q2", (2, 2): None, (3, 1): "Q113960293", (4, 1): None, (5, 1): None}


def test_a_day_of_many_speakers_and_participants_makes_no_pairs(spark):
    """Two thousand speakers and participants of one day and name: no step of the match has more rows than speakers and participants."""
    speakers = spark.range(2000).select(F.col("id").alias("sr_episode_id"), F.lit(1).alias("speaker_index"), F.when(F.col("id") == 0, "Hooja").otherwise("Same Name").alias("speaker"))
    episodes = spark.range(2000).select(F.col("id").alias("sr_episode_id"), F.lit("2020-01-01").alias("date"))
    name = F.when(F.col("id") == 5, "HOOJA").when(F.col("id") == 6, "joakim lithner").otherwise("same name")
    people = spark.range(2000).select(F.lit("2020-01-01").alias("date"), F.concat(F.lit("Q"), F.col("id") + 1).alias("wikidata_id"), name.alias("label"))
    found = archive.match_entities(speakers, episodes, people)
    assert found.filter("wikidata_id IS NOT NULL").count() == 0 and found.count() == 2000
    one = archive.match_entities(speakers, episodes, people.filter("wikidata_id <> 'Q6'")).filter("wikidata_id IS NOT NULL").collect()
    assert [(r.sr_episode_id, r.wikidata_id) for r in one] == [(0, "Q7")]
    joins = archive.match_entities(speakers, episodes, people)._jdf.queryExecution().optimizedPlan().toString()
    assert joins.count("Join Inner") == 0


def test_speakers_and_ages_stay_aligned(spark):
    episodes = spark.createDataFrame([(1, "2020-01-01")], "sr_episode_id int, date string")
    appearing = spark.createDataFrame([(1, 2, "B", "Q2"), (1, 1, "A", "Q1"), (1, 3, "A", "Q1"), (1, 4, "C", "Q3")], "sr_episode_id int, speaker_index int, speaker string, wikidata_id string")
    people = spark.createDataFrame([("Q1", "1980", None), ("Q3", "1990", None)], "wikidata_id string, birth_date string, death_date string")
    got = archive.attach_ages(archive.attach_speakers(episodes, appearing), people).first()
    assert got.episode_speakers == ["Q1", "Q2", "Q3"] and got.speaker_ages == [39, None, 29]
    with pytest.raises(Exception, match="no entity"):
        archive.attach_speakers(episodes, appearing.withColumn("wikidata_id", F.lit(None).cast("string"))).collect()
    assert archive.attach_speakers(episodes, appearing.filter("false")).first().episode_speakers == []


def test_ages_of_one_person_in_every_episode(spark, monkeypatch):
    """A person in very many episodes, and places without one, are not brought together by their id; the result is the same."""
    people = spark.createDataFrame([("Q1", "1980", None), ("Q3", "1990", None), ("Q9", None, None)], "wikidata_id string, birth_date string, death_date string")
    rows = [(i, "2020-01-01", ["Q1", None, f"Q{i}", "Q77"]) for i in range(2, 40)]
    episodes = spark.createDataFrame(rows, "sr_episode_id int, date string, episode_speakers array<string>")
    monkeypatch.setattr(archive, "HOT_ROWS", 10)
    apart = archive._with_dates(episodes.select("sr_episode_id", F.explode("episode_speakers").alias("wikidata_id")), people)
    assert apart.count() == 4 * len(rows) and apart.filter("birth_date = '1980'").count() == len(rows)
    got = {r.sr_episode_id: r.speaker_ages for r in archive.attach_ages(episodes, people).collect()}
    assert got == {i: [39, None, 29 if i == 3 else None, None] for i, _, _ in rows}


def test_people_merge(spark):
    fields = files.PEOPLE_FIELDS
    rows = [
        {"pos": 0, "speaker": "http://e/Q1", "birthDate": "+1820-01-02T00:00:00Z", "birthPrecision": "11", "deathDate": "+1852-00-00T00:00:00Z", "deathPrecision": "9", "enArticle": "en1", "citizenship": "http://e/Q34", "citizenshipLabel": "Sverige", "occupation": "http://e/Q5"},
        {"pos": 1, "speaker": "http://e/Q1", "speakerLabel": "Jenny", "svArticle": "sv1", "gender": "http://e/Q6", "citizenship": "http://e/Q35", "occupation": "http://e/Q5", "occupationLabel": "sångare", "birthDate": "+1999-01-01", "birthPrecision": "11"},
        {"pos": 2, "speaker": "_:b1", "speakerLabel": "nobody"},
    ]
    df = spark.createDataFrame([tuple(r.get(f) for f in ("pos", *fields)) for r in rows], "pos int, " + ", ".join(f"{f} string" for f in fields))
    got = archive.merge_people(df).collect()
    assert len(got) == 1
    p = got[0]
    assert (p.wikidata_label, p.birth_date, p.death_date, p.wikipedia_url, p.gender, p.gender_id) == ("Jenny", "1820-01-02", "1852", "sv1", "Q6", "Q6")
    assert (p.citizenships, p.citizenship_ids, p.occupations, p.occupation_ids) == (["Sverige", "Q35"], ["Q34", "Q35"], ["sångare"], ["Q5"])


def test_newest_name_is_the_one_newly_seen(spark):
    appearing = spark.createDataFrame([("Q1", "A", 1, 1, "2010-01-01"), ("Q1", "B", 2, 1, "2011-01-01"), ("Q1", "A", 3, 1, "2012-01-01")], "wikidata_id string, speaker string, sr_episode_id int, speaker_index int, date string")
    people = spark.createDataFrame([("Q1", "1980-05", None)], "wikidata_id string, birth_date string, death_date string")
    got = archive.speaker_records(appearing, people).first()
    assert (got.speaker, got.sr_names, got.episode_count, got.episode_ids, got.ages_at_episodes) == ("B", ["A", "B"], 3, [1, 2, 3], [29, 30, 31])


def test_songs(spark):
    song = lambda title, start=None, **more: {"title": title, "artist": "X", "starttimeutc": start, **more}
    lists = [{"sr_episode_id": 9, "songs": [song("Late", "/Date(2000)/"), song(" early ", "/Date(1000)/"), song("EARLY", "/Date(1000)/", composer="C"), song("No time"), song("Sommar sommar", "/Date(3000)/")]}]
    fields = "title string, artist string, composer string, lyricist string, albumname string, recordlabel string, starttimeutc string, stoptimeutc string"
    df = spark.read.schema(f"sr_episode_id bigint, songs array<struct<{fields.replace(' string', ':string')}>>").json(spark.sparkContext.parallelize([json.dumps(x) for x in lists]))
    got = [(r.track_number, r.title, r.composer, r.is_theme_song) for r in archive.music(df).orderBy("track_number").collect()]
    assert got == [(1, "EARLY", "C", False), (2, "Late", None, False), (3, "Sommar sommar", None, True), (4, "No time", None, False)]


def test_images_are_replaced_only_where_asked(spark):
    rows = spark.createDataFrame([(1, "bad"), (2, "good"), (3, "bad")], "sr_episode_id int, image_url string")
    new = spark.createDataFrame([(1, "portrait"), (2, "unused")], "sr_episode_id int, image_url string")
    got = {r.sr_episode_id: r.image_url for r in archive.replace_images(rows, ["bad"], new).collect()}
    assert got == {1: "portrait", 2: "good", 3: "bad"}


def test_upsert_computes_only_what_is_missing(spark):
    now, cache = spark.range(5).withColumnRenamed("id", "k"), spark.createDataFrame([(1, "c"), (9, "c")], "k bigint, v string")
    asked = []

    def compute(missing):
        asked.extend(sorted(r.k for r in missing.collect()))
        return missing.withColumn("v", F.lit("n"))

    got = {r.k: (r.v, r.origin) for r in incremental.upsert(now, cache, "k", compute).collect()}
    assert asked == [0, 2, 3, 4] and got[1] == ("c", "cached") and got[0] == ("n", "computed") and len(got) == 5


def test_batches(spark):
    got = incremental.batches(spark.range(250).repartition(7), "id", 100).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in got} == {0: 100, 1: 100, 2: 50}


def test_taxonomy(spark):
    ids = spark.range(10)
    assert taxonomy.partition_faults(ids.filter("id < 6"), ids.filter("id >= 6"), "id", spark.range(10)).count() == 0
    got = {(r.id, r.fault) for r in taxonomy.partition_faults(ids.filter("id < 6"), ids.filter("id in (5, 8)"), "id", spark.range(8)).collect()}
    assert got == {(5, "duplicate"), (6, "missing"), (7, "missing"), (8, "extra"), (9, "extra")} - {(9, "extra")}
    rows = spark.createDataFrame([(1, "boxning", "hemma mma"), (1, "boxning", "en boxare"), (1, "boxning", "x"), (2, "boxning", "boxare mma"), (3, "annat", "x")], "sr_episode_id int, topic_id string, text string")
    assert {r.sr_episode_id for r in taxonomy.evidence_gate(rows).collect()} == {1, 3}
    topics = spark.createDataFrame([(557543, "sport", 3, 100, 0.4, 1), (1, "sport", 3, 100, 1.0, 1)], "sr_episode_id long, topic_id string, chunk_count long, word_count long, share double, rank int")
    got = [(r.sr_episode_id, r.topic_id, r.rank) for r in taxonomy.with_manual(topics, {557543: {"poesi": 0.55, "karlek": 0.30}}).orderBy("sr_episode_id", "rank").collect()]
    assert got == [(1, "sport", 1), (557543, "poesi", 1), (557543, "sport", 2), (557543, "karlek", 3)]
