"""Readers behind caches, whole documents, and the smaller operators of catalogues."""

import io
import json
from datetime import datetime, timezone
from email.message import Message
from urllib.error import HTTPError, URLError

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.operators import export, incremental, linkage, search, taxonomy, topics, transcripts
from tallgrass.sources import fetching, files, versioned


def test_waits():
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert [fetching.wait_seconds(h, now) for h in ("7", "0", None, "soon", "Mon, 01 Jan 2024 00:00:30 GMT")] == [7, 1, 65, 65, 30]


class Answer(io.BytesIO):
    def __exit__(self, *_):
        pass


def test_one_retry_where_requests_are_limited():
    slept, headers = [], Message()
    headers["Retry-After"] = "3"
    limited = lambda: HTTPError("http://x", 429, "", headers, None)
    for faults, fine in (([limited()], True), ([URLError("x"), limited(), URLError("x")], True), ([limited(), limited()], False), ([HTTPError("http://x", 500, "", headers, None)], False)):
        left = list(faults)

        def send(request, timeout):
            if left:
                raise left.pop(0)
            return Answer(b'{"a": 1}')

        if fine:
            assert fetching.get_json("http://x", {"q": "1"}, send=send, sleep=slept.append) == {"a": 1}
        else:
            with pytest.raises(HTTPError):
                fetching.get_json("http://x", send=send, sleep=slept.append)
    assert slept == [3, 1, 3, 1, 3]


def test_query_results_are_cached(spark, tmp_path):
    asked, path = [], tmp_path / "cache" / "p.json"
    answer = {"results": {"bindings": [{"speaker": {"value": "http://x/Q5"}, "date": {"value": "2020-07-01"}, "speakerLabel": {"value": "A"}}, {"speaker": {"value": "http://x/Q6"}}]}}
    fetch = lambda: asked.append(1) or answer
    for _ in range(2):
        assert [tuple(r) for r in fetching.participants(spark, path, fetch).collect()] == [("2020-07-01", "Q5", "A"), (None, "Q6", None)]
    path.write_text("{broken")
    fetching.participants(spark, path, fetch)
    fetching.participants(spark, path, fetch, refresh=True)
    assert len(asked) == 3


def test_people_come_in_batches_and_only_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def fetch(names, log=str(log)):
        import json
        import uuid
        from pathlib import Path

        Path(log, uuid.uuid4().hex).write_text(json.dumps(names))
        return [{"speaker": {"value": f"http://x/{n}"}, "n": {"value": str(i)}} for n in names if n != "Q7" for i in range(2)]

    ids = spark.createDataFrame([(f"Q{i}",) for i in range(1, 12)] * 2 + [("x",), (None,)], "wikidata_id string")
    cache = str(tmp_path / "people")
    got = fetching.people(ids.filter("wikidata_id <> 'Q11'"), cache, fetch, size=3, wave=2).collect()
    assert len(got) == 18 and {r.wikidata_id for r in got} == {f"Q{i}" for i in range(1, 11)} - {"Q7"}
    asked = sorted(n for p in log.iterdir() for n in json.loads(p.read_text()))
    assert asked == sorted(f"Q{i}" for i in range(1, 11)) and max(len(json.loads(p.read_text())) for p in log.iterdir()) == 3
    assert len(fetching.people(ids, cache, fetch, size=3).collect()) == 20  # only Q11 is asked for
    assert sum(len(json.loads(p.read_text())) for p in log.iterdir()) == 11


def test_a_run_that_breaks_off_goes_on_without_asking_twice(spark, tmp_path):
    log, cache = tmp_path / "log", str(tmp_path / "people")
    log.mkdir()

    def fetch(names, log=str(log)):
        from pathlib import Path

        if "Q5" in names and not Path(log, "ready").exists():
            raise OSError("the service is away")
        for name in names:
            with Path(log, name).open("a") as file:
                file.write("x")
        return [{"speaker": {"value": f"http://x/{n}"}} for n in names if n != "Q1"]

    ids = spark.createDataFrame([(f"Q{i}",) for i in range(1, 10)], "wikidata_id string")
    with pytest.raises(Exception, match="the service is away"):
        fetching.people(ids, cache, fetch, size=2, wave=1)
    (log / "ready").write_text("")
    some = spark.createDataFrame([("Q2",), ("Q20",)], "wikidata_id string")
    assert {r.wikidata_id for r in fetching.people(some, cache, fetch, size=2, wave=1).collect()} == {"Q2", "Q20"}
    # The second run wanted two ids, and also took up what the first one had left.
    assert {p.name: p.read_text() for p in log.iterdir() if p.name != "ready"} == {f"Q{i}": "x" for i in [*range(1, 10), 20]}
    assert {r.wikidata_id for r in fetching.people(ids, cache, fetch).collect()} == {f"Q{i}" for i in range(2, 10)}
    assert (log / "Q1").read_text() == "x"  # an id without an answer is not asked for again
    assert fetching.people(some, cache, fetch, refresh=True).count() == 2 and (log / "Q2").read_text() == "xx"
    assert fetching.people(ids.limit(0), str(tmp_path / "none"), fetch).count() == 0


def test_playlists_keep_the_order(spark, tmp_path):
    def fetch(i):
        return {"song": [{"title": f"t{i}"}]}

    episodes = spark.createDataFrame([(i, f"/Date({i})/", 10 - i) for i in range(10)], "sr_episode_id long, publishdateutc string, place int")
    ids = episodes.filter("sr_episode_id <> 8").select("sr_episode_id")
    cache = str(tmp_path / "songs")
    first = fetching.playlists(episodes, ids, cache, fetch, ["place"], most=3).collect()
    assert [r.sr_episode_id for r in first] == [9, 7, 6] and json.loads(first[0].songs) == [{"title": "t9"}]
    assert spark.read.parquet(cache).count() == 3
    assert [r.sr_episode_id for r in fetching.playlists(episodes, ids, cache, fetch, ["place"], most=4).collect()] == [9, 7, 6, 5]
    assert spark.read.parquet(cache).count() == 4
    with pytest.raises(ValueError):
        fetching.playlists(episodes, ids, cache, fetch, ["place"], most=0)


def test_portraits(spark):
    def fetch(i):
        return {"item": {"imageSrc": f"new{i}"}} if i != 2 else {}

    episodes = spark.createDataFrame([(1, "bad"), (2, "bad"), (3, "good")], "sr_episode_id long, image_url string")
    assert {r.sr_episode_id: r.image_url for r in fetching.portraits(episodes, ["bad"], fetch).collect()} == {1: "new1", 2: "bad", 3: "good"}


def test_people_of_triples(spark):
    rows = [("Q1", "label", "En", "sv"), ("Q1", "label", "One", "en"), ("Q2", "label", "Two", "en"), ("G", "label", "kvinna", "sv"), ("Q1", "P21", "G", None), ("Q1", "P27", "C1", None), ("Q1", "P27", "C2", None), ("C2", "label", "Land", "sv")]
    triples = spark.createDataFrame(rows, "s string, p string, o string, lang string")
    got = fetching.people_of_triples(triples, spark.createDataFrame([("Q1",), ("Q2",), ("Q2",)], "s string")).collect()
    assert sorted((r.speaker, r.speakerLabel, r.gender, r.genderLabel, r.citizenship, r.citizenshipLabel) for r in got) == sorted([("Q1", "En", "G", "kvinna", "C1", None), ("Q1", "En", "G", "kvinna", "C2", "Land"), ("Q2", "Two", None, None, None, None)], key=str)


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.5, 1.25, -3.0]), (2, None), (3, [])], "id int, v array<double>")
    half = files.to_half(rows, "v")
    assert [len(r.v or b"") for r in half.orderBy("id").collect()] == [6, 0, 0]
    assert [r.v for r in files.from_half(half, "v").orderBy("id").collect()] == [[0.5, 1.25, -3.0], None, []]
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "sr_episode_id int, t string").coalesce(1).write.parquet(str(tmp_path / "t"))
    assert {r.sr_episode_id: r.t for r in files.by_key(spark, str(tmp_path / "t")).collect()} == {1: "c", 2: "b"}
    folder = tmp_path / "s"
    folder.mkdir()
    for name in ("9", "10", "100"):
        (folder / f"{name}.json").write_text(json.dumps({"segments": [{"start": 0, "end": 1, "text": name}], "meta": {"sr_episode_id": 7 if name == "10" else None}}))
    assert {r.sr_episode_id for r in files.transcripts_json(spark, str(folder), 2, "meta").collect()} == {9, 7}


def test_documents(spark, tmp_path):
    speakers = spark.createDataFrame([("Q1", 'A "x"', ["A", 'A "x"'], 2, [30, None], "", None, "w", None, "1950", None, [], ["o"])], "wikidata_id string, speaker string, sr_names array<string>, episode_count int, ages_at_episodes array<int>, wikidata_label string, wikidata_description string, wikipedia_url string, gender string, birth_date string, death_date string, citizenships array<string>, occupations array<string>")
    schema = "sr_episode_id long, date string, program_type string, length_seconds long, image_url string, short_summary string, episode_speakers array<string>, speaker_ages array<int>, is_listeners_host boolean"
    episodes = spark.createDataFrame([(5, "2020-07-02", "Sommar", 3629, T.IMAGE_URL + "/a.jpg", "s", ["Q1"], [None], True), (4, "2020-07-01", "Sommar", 3631, None, None, [], [], False)], schema)
    files.write_document(export.archive_document(episodes, speakers), str(tmp_path / "d"))
    files.join_document(spark, str(tmp_path / "d"), str(tmp_path / "d.json"))
    assert json.loads((tmp_path / "d.json").read_text()) == {
        "speakers": {"Q1": {"name": 'A "x"', "count": 2, "ages": [30], "aliases": ["A"], "wiki": "w", "born": "1950", "occupations": ["o"]}},
        "episodes": [
            {"id": 4, "date": "2020-07-01", "type": "Sommar", "minutes": 61, "image": None, "description": None, "speakers": [], "ages": [], "initials": ""},
            {"id": 5, "date": "2020-07-02", "type": "Sommar", "minutes": 60, "image": "/a.jpg", "description": "s", "speakers": ["Q1"], "ages": [None], "initials": 'A"', "is_listeners_host": True},
        ],
    }
    places = spark.createDataFrame([(1, 0.123456, -2.0), (2, 0.0, 1.0)], "sr_episode_id long, x double, y double")
    rolls = spark.createDataFrame([(1, "b", 0.25), (1, "a", 0.25), (1, "zz", 0.9)], "sr_episode_id long, topic_id string, share double")
    near = spark.createDataFrame([(1, 2, 0.51239, 1)], "sr_episode_id long, related_episode_id long, similarity double, rank int")
    shown = spark.createDataFrame([("a", 'say "hi"'), ("b", "B")], "topic_id string, label string")
    files.write_document(export.payload_document(shown, export.curated_payload(places, rolls, near, shown), 2), str(tmp_path / "p"))
    files.join_document(spark, str(tmp_path / "p"), str(tmp_path / "p.json"))
    assert json.loads((tmp_path / "p.json").read_text()) == {"version": 2, "topics": {"a": {"label": 'say "hi"'}, "b": {"label": "B"}}, "episodes": {"1": {"x": 0.12346, "y": -2.0, "dominant": "a", "topics": [["a", 0.25], ["b", 0.25]], "related": [[2, 0.5124]]}, "2": {"x": 0.0, "y": 1.0, "dominant": None, "topics": [], "related": []}}}


def test_documents_in_parts(spark, tmp_path):
    """Many parts give the bytes that one would; a failed run leaves the version before, and nothing of its own."""
    keys = [f"k{i:04d}" for i in range(500)]
    rows = spark.createDataFrame([(k, f'"{k}":{{"t":"a, b\\\\n{k}"}}') for k in keys], "k string, json string").repartition(7)
    none = rows.filter("false")
    document = export.Document([export.Section('{"a":{', rows, ["k"]), export.Section('},"b":[', none, ["k"]), export.Section('],"c":{', rows, ["k"])], "}}")
    path, out = str(tmp_path / "parts"), tmp_path / "whole.json"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_document(document, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files.join_document(spark, path, str(out))
    members = ",".join(f'"{k}":{{"t":"a, b\\\\n{k}"}}' for k in keys)
    assert out.read_text() == f'{{"a":{{{members}}},"b":[],"c":{{{members}}}}}'
    said = versioned.manifest(spark, path)
    assert sum("part" in piece for piece in said["layout"]) > 2
    broken = export.Document([document.sections[0], export.Section("x", rows.withColumn("json", F.raise_error(F.lit("broken"))), ["k"])], "")
    with pytest.raises(Exception, match="broken"):
        files.write_document(broken, path)
    assert versioned.manifest(spark, path) == said and {p.name for p in (tmp_path / "parts").iterdir() if not p.name.endswith(".crc")} == {"manifest.json", said["version"]}
    files.write_document(document, path)
    files.write_document(document, path)
    now = versioned.manifest(spark, path)
    assert now["before"] != said["version"] and {p.name for p in (tmp_path / "parts").iterdir() if p.name.startswith("v-")} == {now["version"], now["before"]}
    files.join_document(spark, path, str(out))
    assert out.read_text().startswith('{"a":{"k0000"')


def test_transcripts_are_limited_by_name(spark, tmp_path):
    for name in ("3", "20", "100", "x1"):
        (tmp_path / f"{name}.json").write_text("{" if name == "100" else json.dumps({"segments": [{"start": 0, "end": 1, "text": name}]}))
    some = files.transcripts_json(spark, str(tmp_path), 2)
    assert len(some.inputFiles()) == 2 and {r.sr_episode_id for r in some.collect()} == {3, 20}
    assert {r.sr_episode_id for r in files.transcripts_json(spark, str(tmp_path)).collect()} == {3, 20}
    assert files.transcripts_json(spark, str(tmp_path / "none"), 2).collect() == [] if (tmp_path / "none").mkdir() is None else False


def test_cache_of_computed_columns(spark, tmp_path):
    """What is there is taken, by content and recipe; what no row has goes; a failed run changes nothing."""
    path, calls = str(tmp_path / "cache"), []

    def compute(missing):
        rows = missing.collect()
        calls.append(sorted(r.text or "" for r in rows))
        return spark.createDataFrame([(r.content_key, len(r.text or "")) for r in rows], "content_key string, size int")

    make = lambda rows: spark.createDataFrame(rows, "id int, text string")
    run = lambda rows, recipe="m1": {(r.id, r.text, r.size, r.origin) for r in incremental.refresh(make(rows), path, ["text"], recipe, compute).collect()}
    assert run([(1, "a"), (2, "bb"), (3, "a"), (4, None)]) == {(1, "a", 1, "computed"), (2, "bb", 2, "computed"), (3, "a", 1, "computed"), (4, None, 0, "computed")}
    assert calls == [["", "a", "bb"]]  # a text once, however many rows have it
    assert run([(9, "bb"), (5, "ccc"), (4, None)]) == {(9, "bb", 2, "cached"), (5, "ccc", 3, "computed"), (4, None, 0, "cached")}
    assert calls[1:] == [["ccc"]] and spark.read.parquet(versioned.current(spark, path)).count() == 3  # "a" went
    before = versioned.manifest(spark, path)

    def fails(missing):
        raise RuntimeError("service is down")

    with pytest.raises(RuntimeError):
        incremental.refresh(make([(1, "new")]), path, ["text"], "m1", fails)
    assert versioned.manifest(spark, path) == before
    assert run([(9, "bb")], "m2") == {(9, "bb", 2, "computed")}
    assert run([]) == set()


def test_places_in_order(spark):
    keys = spark.createDataFrame([(f"k{i % 700:04d}",) for i in range(1500)] + [(None,)], "k string").repartition(5)
    got = [(r.k, r.position) for r in incremental.numbered(keys, "k").orderBy("position").collect()]
    assert got == [(f"k{i:04d}", i) for i in range(700)]
    assert incremental.numbered(keys.filter("false"), "k").count() == 0
    assert {r.batch for r in incremental.batches(keys, "k", 300).collect()} == {0, 1, 2}


def test_catalogues(spark):
    rows = spark.createDataFrame([(-1, "o", False), (0, "a", False), (1, "b", True), (2, "c", None)], "topic_id int, label string, is_low_quality boolean")
    assert [r.topic_id for r in topics.usable(rows).collect()] == [0, 2]
    assert [r.topic_id for r in topics.usable(rows, [2]).collect()] == [2] and [r.topic_id for r in topics.usable(rows, offset=1).collect()] == [2]
    with pytest.raises(ValueError):
        topics.usable(rows, [1])
    proposal = spark.createDataFrame([(0, "P"), (2, "Q")], "topic_id int, parent_label string")
    assert {r.topic_id: r.parent_label for r in taxonomy.applied(rows, proposal).collect()} == {-1: None, 0: "P", 1: None, 2: "Q"}
    for bad in (proposal.limit(1), proposal.union(proposal), proposal.union(spark.createDataFrame([(9, "x")], "topic_id int, parent_label string"))):
        with pytest.raises(ValueError):
            taxonomy.applied(rows, bad)
    examples = spark.createDataFrame([("a", 1, "y"), ("a", 0, "x"), ("b", 0, "z")], "t string, o int, v string")
    assert topics.negative_pairs(examples.filter("t = 'a'"), "t", "v", "o").first().pair == ["x", "y"]
    with pytest.raises(Exception, match="two negative examples"):
        topics.negative_pairs(examples, "t", "v", "o").collect()
    shown = search.shown(spark.createDataFrame([(list(range(9)), [1, 2, 3])], "related array<int>, topics array<int>")).first()
    assert shown.related == [0, 1, 2, 3, 4, 5] and shown.topics == [1, 2]


def test_more_topics_than_travel_together(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = [(int(i), (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))]
    catalogue = spark.createDataFrame(vectors, "topic_id int, embedding array<double>")
    chunks = spark.createDataFrame([(i, v) for i, v in vectors[:20]], "chunk_id int, embedding array<double>")
    columns = ["chunk_id", "best_topic_id", "runner_up_topic_id"]
    want = sorted(map(tuple, topics.decide(chunks, catalogue).select(columns).collect()))
    monkeypatch.setattr(topics, "MAX_TOPICS", 7)
    assert sorted(map(tuple, topics.decide(chunks, catalogue).select(columns).collect())) == want
    sims = np.array([v for _, v in vectors]) @ np.array([v for _, v in vectors[:20]]).T
    assert [(b, r) for _, b, r in want] == [tuple(int(x) for x in np.argsort(-sims[:, i])[:2]) for i in range(20)]


def test_terms_and_small_maps(spark, tmp_path):
    docs = spark.createDataFrame([("g", "Det är år av x Sol, sol"), ("h", None)], "g string, t string")
    assert sorted(r.term for r in topics.terms_of(docs, "g", "t", ("det", "av")).collect()) == sorted(["är", "år", "sol", "sol", "är år", "år sol", "sol sol"])
    assert (topics.least_groups(99), topics.least_groups(100)) == (1, 3)
    two = spark.createDataFrame([(5, [1.0, 0.0]), (3, [0.0, 1.0])], "id int, v array<double>")
    assert {r.id: (r.x, r.y) for r in topics.map_2d(two, "v", "id").collect()} == {3: (0.0, 0.0), 5: (1.0, 0.0)}
    many = spark.createDataFrame([(i, [1.0, 0.01 * i] if i % 2 else [-1.0, 0.01 * i]) for i in range(20)], "id int, v array<double>")
    model = topics.fit_clusters(many, "v", 2, starts=2)
    model.write().overwrite().save(str(tmp_path / "model"))
    assert (tmp_path / "model").is_dir() and len(model.clusterCenters()) == 2


def test_tree_is_that_of_all_distances(spark):
    """Against average linkage from the whole matrix of distances."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(25, 5))
    df = spark.createDataFrame([(i - 1, v.tolist()) for i, v in enumerate(vectors)], "id int, v array<double>")
    got = [(r.distance, r.leaves) for r in linkage.merge_tree(df, "id", "v").orderBy("step").collect()]
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    groups, want = [[i] for i in range(25)], []
    while len(groups) > 1:
        d, i, j = min((float(np.mean(1 - u[a] @ u[b].T)), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        want.append((d, len(groups[i]) + len(groups[j])))
        groups[i] = groups[i] + groups.pop(j)
    assert [n for _, n in got] == [n for _, n in want]
    assert [d for d, _ in got] == pytest.approx([d for d, _ in want])


def test_majority(spark):
    rows = [("ja " * 20,), ("ja " * 14 + "nej b c d e f",), ("ja " * 13 + "nej b c d e f g",), ("a b " * 10,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r.r for r in df.select(T.artifact_reasons(F.col("t")).alias("r")).collect()] == [["dominant_token_loop"], ["dominant_token_loop"], [], [], []]


def test_audit_report(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0, "Dags för Sommar i P1"), (1, 1.0, 2.0, "hej"), (2, 0.0, 1.0, "hej")], "sr_episode_id int, start double, end double, text string")
    report = json.loads(transcripts.audit_report(transcripts.flag_segments(rows)).first().json)
    assert report == {"segments": 3, "episodes": 2, "kept": 2, "removed": 1, "artifact_reasons": {}, "boilerplate_reasons": {"programme_announcement": 1}}
