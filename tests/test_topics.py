"""Topics, search, export, sources and the stream."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import export, linkage, neighbours, search, topics
from tallgrass.sources import files, markdown
from tallgrass.sources.radio_api import RadioApi
from tallgrass.streaming import incoming


def vectors(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} string, embedding array<double>")


def test_tiers_and_reasons(spark):
    topic = vectors(spark, [("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "topic_id")
    chunk = vectors(spark, [("win", [0.6, 0.1]), ("tie", [0.52, 0.519]), ("loud tie", [0.6, 0.599]), ("support", [0.50, 0.1]), ("low", [0.3, 0.1])], "chunk_id")
    got = {r.chunk_id: (r.accepted, r.evidence_tier, r.rejection_reason) for r in topics.decide(chunk, topic).collect()}
    assert got == {"win": (True, "strong", None), "tie": (False, None, "ambiguous_winner"), "loud tie": (True, "strong", None), "support": (True, "supporting", None), "low": (False, None, "below_supporting_threshold")}


def test_floors_vetoes_and_second_topics(spark):
    topic = vectors(spark, [("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "topic_id")
    chunk = vectors(spark, [("x", [0.6, 0.59])], "chunk_id")
    rules = topics.Thresholds(supporting_min=None, secondary_min=0.5)
    assert topics.decide(chunk, topic, rules, {"a": 0.7}).first().rejection_reason == "below_topic_threshold"
    pairs = topics.assignments(topics.decide(chunk, topic, rules), rules).orderBy("chunk_topic_rank").collect()
    assert [(r.topic_id, r.evidence_tier) for r in pairs] == [("a", "strong"), ("b", "secondary")]
    negatives = vectors(spark, [("a", [0.9, 0.0]), ("a", [0.1, 0.0])], "topic_id")
    veto = topics.Thresholds(supporting_min=None, min_negative_margin=0.1)
    assert topics.decide(chunk, topic, veto, negatives=negatives).first().rejection_reason == "negative_near_miss"
    with pytest.raises(ValueError, match="two topics"):
        topics.decide(chunk, topic.limit(1))


def test_evidence(spark):
    rows = [(1, "a", f"c{i}", 150, 0.50, "supporting", float(i)) for i in range(2)] + [(2, "a", "d", 300, 0.51, "strong", 0.0)]
    df = spark.createDataFrame(rows, "sr_episode_id int, topic_id string, chunk_id string, word_count int, similarity double, evidence_tier string, start_seconds double")
    totals = spark.createDataFrame([(1, 500), (2, 1000)], "sr_episode_id int, episode_words int")
    got = topics.curated_rollup(df, totals).collect()
    assert [(r.sr_episode_id, r.coverage, r.chunk_count, r.rank) for r in got] == [(1, 0.6, 2, 1)]


def test_calibration(spark):
    df = spark.createDataFrame([(f"c{i}", "a", 0.50 + i / 1000) for i in range(5)] + [("top", "a", 1.0)], "chunk_id string, best_topic_id string, best_similarity double")
    assert {r.chunk_id for r in topics.calibration_sample(df, 3).collect()} == {"c0", "c2", "c4"}
    reviews = spark.createDataFrame([("a", 0.60, True), ("a", 0.56, True), ("a", 0.54, True), ("a", 0.52, False), ("b", 0.9, True)], "t string, s double, ok boolean")
    assert {r.t: r.threshold for r in topics.thresholds(reviews, "t", "s", "ok").collect()} == {"a": 0.54, "b": 0.53}


def test_neighbours_agree_over_blocks(spark):
    rows = [(i, [float((i * 7 + j * j) % 13) for j in range(6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    key = lambda r: (r.id, r["rank"], r.related_id, round(r.similarity, 9))
    one, many = (sorted(map(key, neighbours.neighbours(df, "id", "v", 5, block_rows=b).collect())) for b in (100, 9))
    assert one == many and len(one) == 300


def test_of_a_product_little_is_looked_at():
    """A row of many equal scores keeps the first ones; one that has its k best keeps what reaches the last of them."""
    score = np.tile(np.arange(2000) % 7 / 7, (3, 1))
    row, col = neighbours._largest(score, np.array([-np.inf, 5.5 / 7, 1.0]), 4)
    assert (row < 2).all() and len(row) <= 16
    best = sorted(range(2000), key=lambda j: (-score[0, j], j))[:4]
    assert all(set(best) <= set(col[row == i]) for i in (0, 1))


def test_neighbours_of_copies_over_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in (rng.normal(size=5) if i % 3 else np.ones(5))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>").repartition(3)
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    moved = unit - unit.mean(axis=0)
    s = np.round((moved := moved / np.linalg.norm(moved, axis=1, keepdims=True)) @ moved.T, 9)
    want = {(i, j, r) for i in range(300) for r, j in enumerate(sorted((j for j in range(300) if j != i), key=lambda j: (-s[i, j], j))[:6], 1)}
    for block in (1000, 40):
        assert {(r.id, r.related_id, r["rank"]) for r in neighbours.neighbours(df, "id", "v", 6, block_rows=block).collect()} == want


def test_term_weights_read_the_texts_once(spark, tmp_path):
    """Texts are cut into terms once however often the counts are used; groups without a name count for others and get no row."""
    seen = spark.sparkContext.accumulator(0)

    def cut(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = [(g, f"w{i % (7 + (g or 0))}") for g in (1, 2, 3, None) for i in range(200)] + [(1, "alone")]
    terms = spark.createDataFrame(rows, "g int, t string").repartition(3).mapInArrow(cut, "g int, t string")
    got = {(r.g, r.t): (r.tf, r.f, r.df) for r in topics.term_weights(terms, "g", "t", 3).collect()}
    tf = lambda g, t: sum(r == (g, t) for r in rows)
    groups = (1, 2, 3, None)
    want = {(g, t): (tf(g, t), sum(tf(h, t) for h in groups), sum(tf(h, t) > 0 for h in groups)) for g in (1, 2, 3) for t in {r[1] for r in rows} if tf(g, t)}
    assert got == {k: v for k, v in want.items() if v[2] >= 3}
    assert seen.value == len(rows)


def test_search(spark):
    rows = [(1, "2010-07-01", "om havet", "Östen", [30, None], [1], [1]), (2, "2011-01-01", "om skogen", "Åsa", [None], [2], [1]), (3, "2012-07-01", "Havet igen", "Zara", [60], [1], [2])]
    df = spark.createDataFrame(rows, "sr_episode_id int, date string, description string, speaker string, ages array<int>, topic_ids array<int>, theme_ids array<int>")
    ids = lambda f, mode="newest", **more: [r.sr_episode_id for r in search.page(search.matching(df, f), mode, **more).collect()]
    assert ids(search.Filters(text="HAVET")) == [3, 1]
    assert ids(search.Filters(topics=(1,), themes=(1,))) == [3, 1] and ids(search.Filters(themes=(1,))) == [2, 1]
    assert ids(search.Filters(age_from=25, age_to=40)) == [1]
    assert ids(search.Filters(), "speaker") == [3, 2, 1]
    assert ids(search.Filters(), "age_up") == [1, 3, 2] and ids(search.Filters(), "age_down") == [3, 1, 2]
    assert ids(search.Filters(year_from=2011), "oldest", size=1, offset=1) == [3]


def test_payload(spark):
    summary = spark.createDataFrame([(1, "1_x", ["k", "l"], False, False, 2, 3), (2, "Named", [], False, False, 1, 1), (-1, "o", [], True, False, 9, 9), (4, "bad", [], False, True, 1, 1)], "topic_id int, label string, keywords array<string>, is_outlier boolean, is_low_quality boolean, episode_count int, chunk_count int")
    shown = export.topic_rows(summary)
    assert {r.topic_id: r.label for r in shown.collect()} == {1: "k · l", 2: "Named"}
    places = spark.createDataFrame([(10, 0.123456, 1.0, 4)], "sr_episode_id int, x double, y double, dominant_topic_id int")
    shares = spark.createDataFrame([(10, 1, 0.25), (10, 2, 0.65), (10, 4, 0.1), (11, 1, 1.0)], "sr_episode_id int, topic_id int, share double")
    near = spark.createDataFrame([(10, 20, 0.12345, 1)], "sr_episode_id int, related_episode_id int, similarity double, rank int")
    got = json.loads(export.json_lines(export.episode_payload(places, shares, near, shown), "sr_episode_id").first().json)
    assert got == {"sr_episode_id": 10, "x": 0.12346, "y": 1.0, "dominant": 2, "topics": [{"id": 2, "value": 0.65}, {"id": 1, "value": 0.25}], "related": [{"id": 20, "value": 0.1235}]}


def test_exports_fail_on_dangling_speakers(spark):
    episodes = spark.createDataFrame([(1, "2020-01-01", "Sommar", 3000, "http://i/a.jpg", "s", ["Q1", "Q2"], [3, None], True)], "sr_episode_id int, date string, program_type string, length_seconds int, image_url string, short_summary string, episode_speakers array<string>, speaker_ages array<int>, is_listeners_host boolean")
    speakers = spark.createDataFrame([("Q1", "Anna Ek"), ("Q2", "Bo Al")], "wikidata_id string, speaker string")
    got = export.episode_export(episodes, speakers, "http://i/").first()
    assert (got.minutes, got.image, got.initials, got.is_listeners_host, got.ages) == (50, "a.jpg", "AE · BA", True, [3, None])
    with pytest.raises(Exception, match="missing speaker Q2"):
        export.episode_export(episodes, speakers.limit(1), "http://i/").collect()


def test_sources(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"p{page}.json").write_text(json.dumps({"pagination": {"totalpages": 2}, "episodes": [{"id": page, "title": "T"}]}))
    spark.dataSource.register(RadioApi)
    rows = spark.read.format("radio_api").option("url", f"{tmp_path}/p{{page}}.json").load()
    assert sorted(r.id for r in rows.collect()) == [1, 2]
    assert spark.read.format("radio_api").option("url", f"{tmp_path}/p{{page}}.json").option("max_pages", 1).load().count() == 1
    assert {r.id for r in files.episodes_json(spark, f"{tmp_path}/p*.json").collect()} == {1, 2}
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "12.json").write_text(json.dumps({"segments": [{"start": 0, "end": 1, "text": "a"}]}))
    (folder / "x.json").write_text("{}")
    (folder / "13.json").write_text("{broken")
    assert [(r.sr_episode_id, r.text) for r in files.transcripts_json(spark, str(folder)).collect()] == [(12, "a")]
    (tmp_path / "c.md").write_text("| Topic | About | Raw |\n|---|---|---|\n| Kärlek | om kärlek | 3, 185 |\n\n## Next\n| Nej | x | 1 |\n")
    found = markdown.checked(markdown.topic_rows(markdown.read_lines(spark, str(tmp_path / "c.md")), stop="^## ")).collect()
    assert [(r.topic_id, r.raw_topic_ids) for r in found] == [("karlek", [3, 185])]
    files.write_table(spark.createDataFrame([(1, "x")], "sr_episode_id int, mp3_url string"), f"{tmp_path}/w", "sr_episode_id bigint, mp3_url string")
    assert files.lookup(spark, f"{tmp_path}/w", 1)["mp3_url"] == "x"
    with pytest.raises(KeyError):
        files.lookup(spark, f"{tmp_path}/w", 2)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"sr_episode_id": 1, "segment_index": 0, "start": 1.0, "end": 2.0, "duration": 900.0, "text": "Dags för sommar i P1"}))
    query = incoming.start(incoming.flagged(incoming.segments(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().boilerplate_reasons == ["programme_announcement"]


def test_clusters_and_map(spark):
    df = spark.createDataFrame([(i, [1.0, 0.01 * i, 0.0] if i % 2 else [0.0, 0.01 * i, 1.0]) for i in range(20)], "id int, v array<double>")
    got = topics.cluster(df, "v", k=2).collect()
    assert len({(r.id % 2, r.topic_id) for r in got}) == 2
    assert topics.map_2d(df, "v").filter(F.col("x").isNotNull()).count() == 20


def test_tree(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.99, 0.1]), (5, [0.0, 1.0])], "id int, v array<double>")
    got = [(r.part_a, r.part_b, r.node, r.leaves) for r in linkage.merge_tree(df, "id", "v").orderBy("step").collect()]
    assert got == [(1, 2, 6, 2), (6, 5, 7, 3)]
