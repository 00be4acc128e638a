"""The programs one after another, from saved files to the browser's documents."""

import json
import random

import pytest

from tallgrass.__main__ import main, parser
from tallgrass.programs import PROGRAMS


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("programs")


def document(path):
    return json.loads((path / "document.json").read_text())


def test_archive_and_export(spark, folder):
    audio = {"id": 1, "duration": 3600, "url": "http://a/1.mp3", "filesizeinbytes": 10}
    raw = [{"id": i, "title": f"Person {i}", "description": "text", "url": "u", "publishdateutc": f"2020-07-0{i}T08:00:00Z", "downloadpodfile": audio, "imageurl": "x"} for i in (1, 2)]
    (folder / "pages.json").write_text(json.dumps({"episodes": raw}))
    value = lambda **k: {n: {"value": v} for n, v in k.items()}
    (folder / "participants.json").write_text(json.dumps({"results": {"bindings": [value(speaker=f"http://x/Q{i}", speakerLabel=f"Person {i}", date=f"2020-07-0{i}T00:00:00Z") for i in (1, 2)]}}))
    (folder / "people.json").write_text(json.dumps({"results": {"bindings": [value(speaker=f"http://x/Q{i}", speakerLabel=f"Person {i}", birthDate="1980-05-06T00:00:00Z", birthPrecision="11") for i in (1, 2)]}}))
    main(["archive", *[str(folder / f"{n}.json") for n in ("pages", "participants", "people")], str(folder / "archive")], spark)
    main(["export", str(folder / "archive"), str(folder / "archive.json")], spark)
    found = document(folder / "archive.json")
    assert [(e["id"], e["ages"]) for e in found["episodes"]] == [(1, [40]), (2, [40])] and found["speakers"]["Q2"]["name"] == "Person 2"


def test_transcripts_to_topics(spark, folder):
    rng = random.Random(1)
    (folder / "t").mkdir()
    for i in range(1, 5):
        words = "hav båt segel vind" if i % 2 else "skog träd löv stig"
        said = [{"start": 10.0 * k, "end": 10.0 * k + 9, "text": " ".join(rng.choices(words.split(), k=30))} for k in range(40)]
        (folder / "t" / f"{i}.json").write_text(json.dumps({"segments": [{"start": 0, "end": 1, "text": "Dags för Sommar i P1"}, *said]}))
    out = str(folder)
    main(["segments", f"{out}/t", f"{out}/s"], spark)
    assert json.loads("".join(p.read_text() for p in (folder / "s/report").glob("part-*")))["removed"] == 4
    main(["units", f"{out}/s/clean", f"{out}/u"], spark)
    from pyspark.sql import functions as F

    vector = F.when(F.col("sr_episode_id") % 2 == 1, F.array(F.lit(1.0), F.rand(1) / 10, F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.rand(2) / 10, F.lit(1.0)))
    spark.read.parquet(f"{out}/u").withColumn("embedding", vector).write.parquet(f"{out}/ue")
    main(["chunks", f"{out}/ue", f"{out}/c"], spark)
    spark.read.parquet(f"{out}/c/chunks").withColumn("embedding", vector).write.parquet(f"{out}/ce")
    main(["topics", f"{out}/ce", f"{out}/m", "--topics", "2", "--starts", "2"], spark)
    main(["tree", f"{out}/m"], spark)
    assert spark.read.parquet(f"{out}/m/topic_tree").count() == 1
    whole = document(folder / "m/document")
    assert whole["version"] == 1 and set(whole["episodes"]) == {"1", "2", "3", "4"} and len(whole["topics"]) == 2
    assert len({whole["episodes"][e]["dominant"] for e in "13"}) == 1

    main(["topics", f"{out}/ce", f"{out}/d", "--min-cluster", "2", "--min-samples", "1"], spark)
    found = spark.read.parquet(f"{out}/d/chunk_topics").select("sr_episode_id", "topic_id").collect()
    assert len(found) == spark.read.parquet(f"{out}/ce").count() and not {r.topic_id for r in found if r.sr_episode_id % 2} & {r.topic_id for r in found if r.sr_episode_id % 2 == 0} - {-1}
    assert set(document(folder / "d/document")["episodes"]) == {"1", "2", "3", "4"}

    labels = spark.createDataFrame([(0, "Noll"), (1, "Ett")], "topic_id int, llm_label string")
    labels.write.parquet(f"{out}/labels")
    main(["label", f"{out}/m", f"{out}/labels", "--topic-ids", "1", "--apply"], spark)
    assert document(folder / "m/document")["topics"]["1"]["label"] == "Ett"
    spark.createDataFrame([(0, "P"), (1, "P")], "topic_id int, parent_label string").write.parquet(f"{out}/proposal")
    main(["apply", f"{out}/m", f"{out}/proposal"], spark)
    assert {r.parent_label for r in spark.read.parquet(f"{out}/m/topics").collect()} == {"P"}
    spark.createDataFrame([(0, "havet", "Natur"), (1, "skogen", "Natur")], "raw_topic_id int, topic_id string, theme string").write.parquet(f"{out}/mapping")
    main(["hierarchy", f"{out}/m", f"{out}/mapping", f"{out}/h"], spark)
    assert spark.read.parquet(f"{out}/h/broad").first().episode_count >= 4

    spark.createDataFrame([("hav", [0.9, 0.0, 0.0]), ("skog", [0.0, 0.0, 0.9])], "topic_id string, embedding array<double>").write.parquet(f"{out}/catalogue")
    main(["curated", f"{out}/ce", f"{out}/catalogue", f"{out}/k"], spark)
    curated = document(folder / "k/document")
    assert curated["version"] == 2 and {e: v["dominant"] for e, v in curated["episodes"].items()} == {"1": "hav", "2": "skog", "3": "hav", "4": "skog"}
    main(["calibrate", f"{out}/k/decisions", f"{out}/sample"], spark)
    assert spark.read.parquet(f"{out}/sample").count() > 0
    spark.createDataFrame([("hav", 0.9, True), ("hav", 0.8, True)], "topic_id string, score double, relevant boolean").write.parquet(f"{out}/reviews")
    main(["calibrate", f"{out}/k/decisions", f"{out}/thresholds", "--reviews", f"{out}/reviews"], spark)
    assert spark.read.parquet(f"{out}/thresholds").first().threshold == 0.8

    spark.read.parquet(f"{out}/s/clean").filter("sr_episode_id = 1").select("sr_episode_id", F.col("text").alias("anchor")).limit(1).write.parquet(f"{out}/anchors")
    main(["chapters", f"{out}/s/clean", f"{out}/anchors", f"{out}/chapters"], spark)
    assert spark.read.parquet(f"{out}/chapters").count() >= 1


def test_guidance(spark, folder):
    (folder / "c.md").write_text("| Ämne | Om | Rå |\n|---|---|---|\n| Hav | om hav | 1, 2 |\n")
    (folder / "g.jsonl").write_text(json.dumps({"topic_id": "hav", "positive_examples": ["a"], "negative_examples": ["b", "c"]}))
    main(["guidance", str(folder / "c.md"), str(folder / "g.jsonl"), str(folder / "g")], spark)
    assert spark.read.parquet(str(folder / "g")).first().query_text == "Hav. om hav a"


def test_every_program_has_help():
    names = [p[0] for p in PROGRAMS]
    assert len(names) == len(set(names)) and all(p[1].__doc__ for p in PROGRAMS)
    assert parser().parse_args(["topics", "a", "b"]).topics == 80
