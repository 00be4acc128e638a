"""Units of a stream, whose segments come in any order, against units of the whole table."""

import json
import random
from datetime import datetime, timedelta

from tallgrass.operators import transcripts
from tallgrass.streaming import units

SCHEMA = "sr_episode_id bigint, segment_index int, start double, end double, text string, arrived timestamp"


def episode(rng, number, segments):
    rows, at = [], 0.0
    for i in range(segments):
        at += rng.choice([-0.2, 0.0, 0.1, 1.5, 2.5])
        long = rng.uniform(0.5, 6.0)
        text = "" if rng.random() < 0.1 else " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 3, 9, 30, 90])))
        rows.append((number, i, max(at, 0.0), max(at, 0.0) + (long if rng.random() > 0.05 else -1.0), text))
        at += long
    return rows


def test_units_of_a_shuffled_stream(spark, tmp_path):
    rng = random.Random(5)
    rows = [r for n, size in enumerate([0, 1, 2, 7, 40, 120, 3]) for r in episode(rng, n, size)]
    rows += [(20, 0, 0.0, 1.0, "kort"), (21, 0, 0.0, 1.0, None)]
    rng.shuffle(rows)
    now = datetime(2024, 1, 1)
    (tmp_path / "in").mkdir()
    size = -(-len(rows) // 5)
    for b in range(5):  # files come one after another; the last one moves the watermark far on
        part = [dict(zip(("sr_episode_id", "segment_index", "start", "end", "text"), r), arrived=(now + timedelta(minutes=b)).isoformat()) for r in rows[b * size : (b + 1) * size]]
        part += part[:2]  # the same rows again
        (tmp_path / f"in/{b}.json").write_text("\n".join(map(json.dumps, part)))
        run(spark, tmp_path)
    early = spark.read.parquet(str(tmp_path / "out")).count()
    for b, days in ((5, 2), (6, 3)):
        (tmp_path / f"in/{b}.json").write_text(json.dumps({"sr_episode_id": 99, "segment_index": 0, "start": 0.0, "end": 1.0, "text": "slut", "arrived": (now + timedelta(days=days)).isoformat()}))
        run(spark, tmp_path)
    got = {(r.sr_episode_id, r.unit_index): r for r in spark.read.parquet(str(tmp_path / "out")).filter("sr_episode_id <> 99").collect()}
    whole = spark.createDataFrame([r for r in rows], "sr_episode_id bigint, segment_index int, start double, end double, text string")
    want = {(r.sr_episode_id, r.unit_index): r for r in transcripts.build_units(transcripts.valid_segments(whole)).collect()}
    assert got.keys() == want.keys() and 0 < early < len(want)
    for key, unit in want.items():
        have = got[key].asDict()
        assert have == {c: unit[c] for c in have}


def run(spark, folder):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder / "in"))
    found = units.units(stream, "arrived", idle="10 minutes", idle_seconds=600)
    query = found.writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert not query.isActive


def test_fold_over_gaps():
    fold = units.Fold(target=4, least=2, pause=1.5)
    assert fold.add(2, (4.0, 5.0, 4, "c c c c")) == [] and fold.add(0, (0.0, 1.0, 4, "a a a a")) == []
    fold = units.Fold(4, 2, 1.5, fold.saved())  # as it comes back from the state store
    assert fold.finish() == [(0, 0.0, 1.0, "a a a a", 4, 1, 0.0), (1, 4.0, 5.0, "c c c c", 4, 1, 3.0)]
    fold = units.Fold(4, 2, 1.5)
    assert fold.add(0, (0.0, 1.0, 4, "a a a a")) == [] and fold.add(1, None) == [] and fold.add(2, (1.0, 2.0, 1, "b")) == []
    assert fold.finish() == [(0, 0.0, 2.0, "a a a a b", 5, 2, 0.0)]
