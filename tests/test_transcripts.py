"""Transcript operators, with plain loops as a second opinion."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from tallgrass.operators import chapters, segment, transcripts


def units_by_loop(segments, target=80, least=24, pause=1.5):
    groups, current = [], []
    for s in segments:
        gap = max(0.0, s[0] - current[-1][1]) if current else 0.0
        words = sum(x[2] for x in current)
        if current and words >= least and (words >= target or gap >= pause):
            groups.append(current)
            current = []
        current.append(s)
    if current:
        groups.append(current)
    if len(groups) > 1 and sum(x[2] for x in groups[-1]) < least and max(0.0, groups[-1][0][0] - groups[-2][-1][1]) < pause:
        tail = groups.pop()
        groups[-1] = groups[-1] + tail
    return [(g[0][0], g[-1][1], sum(x[2] for x in g), len(g)) for g in groups]


def test_units(spark):
    rng, rows, want = random.Random(3), [], {}
    for episode in range(12):
        at, segs = 0.0, []
        for i in range(rng.randint(1, 40)):
            at += rng.choice([0, 0, 0.5, 2.0, 8.0])
            n = rng.randint(1, 40)
            segs.append((at, at + n, n))
            rows.append((episode, i, at, at + n, " ".join(["ord"] * n)))
            at += n
        want[episode] = units_by_loop(segs)
    df = spark.createDataFrame(rows, "sr_episode_id int, segment_index int, start double, end double, text string")
    got = transcripts.build_units(transcripts.valid_segments(df)).orderBy("sr_episode_id", "unit_index").collect()
    for episode, units in want.items():
        assert [(r.start_seconds, r.end_seconds, r.word_count, r.segment_count) for r in got if r.sr_episode_id == episode] == units


def test_invalid_segments_go(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 1.0, " "), (1, 1, None, 2.0, "a"), (1, 2, 3.0, 2.0, "a"), (1, 3, 3.0, 4.0, "a  b"), (1, 4, 5.0, 6.0, None)], "sr_episode_id int, segment_index int, start double, end double, text string")
    assert [(r.segment_index, r.text, r.word_count) for r in transcripts.valid_segments(df).collect()] == [(3, "a b", 2)]


def cuts_by_search(words, scores):
    """Best total over all ways to cut."""
    n, best = len(words), None
    for k in range(n):
        for cut in itertools.combinations(range(1, n), k):
            ends, total, start, fine = [*cut, n], 0.0, 0, True
            for e in ends:
                w = sum(words[start:e])
                fine &= (w <= 1800 or e == start + 1) and (w >= 140 or (start == 0 and e == n))
                total -= 0.14 * ((w - 450) / 450) ** 2
                total += scores[e] - 0.85 if e < n else 0
                start = e
            if fine and (best is None or total > best + 1e-12):
                best = total
    return best


def test_cuts_are_the_best():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        words, scores = rng.integers(40, 900, n), rng.uniform(0, 2, n + 1)
        ends, start, total = segment.best_cuts(words, scores), 0, 0.0
        for e in ends:
            w = words[start:e].sum()
            total += -0.14 * ((w - 450) / 450) ** 2 + (scores[e] - 0.85 if e < n else 0)
            start = e
        want = cuts_by_search(words.tolist(), scores.tolist())
        assert ends[-1] == n and (want is None and ends == [n] or abs(total - want) < 1e-9)


def test_a_music_break_cuts(spark):
    rows = [(7, i, i * 100.0, i * 100.0 + 90, 8.0 if i == 3 else 0.0, f"text {i}", 100, [1.0, 0.0] if i < 3 else [0.0, 1.0]) for i in range(6)]
    units = spark.createDataFrame(rows, "sr_episode_id int, unit_index int, start_seconds double, end_seconds double, pause_before_seconds double, text string, word_count int, embedding array<double>")
    chosen = segment.select_boundaries(units, segment.score_boundaries(units))
    assert [(r.boundary_index, r.selection_reason) for r in chosen.filter("selected").collect()] == [(3, "music_break")]
    chunks = segment.materialise(units, chosen).orderBy("chunk_index").collect()
    assert [(c.word_count, c.unit_start_index, c.unit_end_index) for c in chunks] == [(300, 0, 3), (300, 3, 6)]


def test_trailing_cut(spark):
    rows = [(1, 100.0, 110.0, "credit"), (1, 900.0, 910.0, "x"), (1, 950.0, 960.0, "credit"), (1, 970.0, 980.0, "cue"), (2, 10.0, 20.0, "x"), (2, 30.0, 40.0, "cue"), (3, 1.0, 2.0, "x")]
    df = spark.createDataFrame(rows, "sr_episode_id int, start double, end double, text string")
    got = transcripts.trailing_cut(df, F.col("text") == "credit", F.col("text") == "cue")
    assert sorted((r.sr_episode_id, r.start) for r in got.collect()) == [(1, 100.0), (1, 900.0), (2, 10.0), (3, 1.0)]


def test_anchor_and_ranges(spark):
    segments = spark.createDataFrame([(1, 0, "Först talar jag om barndomen."), (1, 1, "Sedan lämnade vi huset för alltid."), (1, 2, "Ny tid."), (1, 3, "Slut nu.")], "id int, segment_index int, text string")
    asked = spark.createDataFrame([(1, "sedan lämnade vi huset för alltid"), (1, "kort")], "id int, anchor string")
    got = chapters.match_anchors(segments, asked, "id").collect()
    assert len(got) == 1 and got[0].segment_index == 1 and got[0].score > 0.9
    counts = spark.createDataFrame([(1, 4)], "id int, segments int")
    ranges = chapters.chapter_ranges(chapters.match_anchors(segments, asked, "id"), counts, "id").orderBy("first").collect()
    assert [(r["first"], r["last"]) for r in ranges] == [(0, 1), (2, 3)]


def test_close_boundaries(spark):
    found = [(1, 0.9), (3, 0.7), (5, 0.8), (9, 0.5), (10, 0.65), (13, 0.65)]
    df = spark.createDataFrame([(found,)], "b array<struct<segment_index:int,score:double>>")
    got = df.select(chapters.accept_boundaries(F.col("b")).alias("k")).first().k
    assert [(x.segment_index, x.score) for x in got] == [(5, 0.8), (10, 0.65), (13, 0.65)]
