"""Every stage of the pipeline against a plain version, on rows with every awkward case."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_operators import LOW, brute_components, words
from tokenizers import Tokenizer

import corpus_pipeline
from tallgrass.llm import mixing

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, later string, mix_size int, `row` string, `range` int, node string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    parts = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split()}
    text = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(n))
    out = [(text(lang, rng.randint(5, 60)), lang) for lang in ("en", "de") * 60]
    base = text("en", 80).split()
    out += [(" ".join(base), "en")] * 30 + [(" ".join(base).upper(), "en")]  # hot copies
    for k in (1, 1, 2, 3, 4, 8):  # near copies
        near = list(base)
        for at in rng.sample(range(len(near)), k):
            near[at] = f"new{rng.randint(0, 99)}"
        out.append((" ".join(near), "en"))
    out += [(text("en", 9000), "en"), (None, "en"), ("", None), ("  \n", "de"), ("12 -- 34", "en"), ("ok", None), (text("en", 30) + " " + text("de", 30), None)]
    numbered = [(i, t, lang, [None, "a", "b"][i % 3], None if i % 7 == 0 else 1, "x", 1, "r", 2, "n") for i, (t, lang) in enumerate(out)]
    return [*numbered, numbered[5], numbered[5], (None, text("de", 20), "de", "a", 1, "x", 1, "r", 2, "n")]


def run(spark, name, rows):
    found = STAGES[name](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    if name != "packing":
        assert found.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    return [tuple(r) for r in found.collect()]


@pytest.mark.parametrize("name", list(STAGES))
def test_no_rows_and_settings_as_before(spark, name):
    held = lambda: {k: v for k, v in spark.conf.getAll.items() if k != "spark.app.startTime"}
    before = held()
    assert run(spark, name, []) == []
    assert held() == before


def test_stages(spark, rows):
    kept = run(spark, "language_id", rows)
    assert Counter(kept) == Counter(r for r in rows if re.search(r"[^\W\d_]", r[1] or ""))

    # From here on the awkward rows come back, so that every stage sees them.
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r)
    best = [max((r for r in g), key=lambda r: -1 if r[0] is None else r[0]) for g in groups.values()]
    single = run(spark, "exact_dedup", rows)
    assert len(single) == len(groups) and sorted((r[0] is None, r[0] or 0) for r in single) == sorted((r[0] is None, r[0] or 0) for r in best)

    first = brute_components([(r[0], r[1]) for r in rows if r[0] is not None])
    near = run(spark, "jaccard_join", rows)
    assert Counter(near) == Counter(r for r in rows if r[0] is None or first[r[0]][1] == r[0])

    mixed = run(spark, "mixing", rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    target = mixing.quotas(dict(size))
    times, taken = Counter(mixed), Counter()
    number = Counter(rows)
    for r, n in times.items():
        taken[r[3]] += n * len(words(r[1]))
        assert n <= 3 * number[r] and words(r[1])
    for source, goal in target.items():
        lacks = goal - taken[source]
        own = [r for r in rows if r[3] == source and words(r[1])]
        least = min(times[r] // number[r] for r in own)
        assert lacks > -1e-6 and (least == 3 or all(len(words(r[1])) > lacks for r in own if times[r] // number[r] == least and times[r] < (least + 1) * number[r]))

    pieces = run(spark, "packing", rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r[0]: np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    cover, ends = Counter(), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in pieces:
        piece = ids[doc][start : start + length]
        assert len(piece) == length > 0 and zlib.crc32(piece.tobytes()) == crc and tokens == len(ids[doc])
        cover[doc] += length
        ends[sequence].append((offset, length))
    assert cover == {i: len(a) * Counter(r[0] for r in rows)[i] for i, a in ids.items()}
    for found in ends.values():
        assert [o for o, _ in sorted(found)] == list(np.cumsum([0, *[n for _, n in sorted(found)]])[:-1]) and sum(n for _, n in found) <= 2048
