"""Inputs on which an operator once did less than the whole job."""

import random
from collections import defaultdict

import pytest

from tallgrass.llm import exact_dedup


@pytest.mark.parametrize("keep", ["min", "max"])
def test_hot_copies_beside_texts_of_equal_opening(spark, keep):
    """A group that splitters cut is one group, wherever other texts with its opening sort."""
    rng = random.Random(3)
    opening = "the same twenty-four characters "
    texts = [opening + "mmm"] * 300 + [opening + rng.choice("az") + str(i) for i in range(200)] + ["\x00" + opening] * 40
    rng.shuffle(texts)
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t].append(i)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(rows, keep=keep, ranges=16).collect()}
    best = {t: (min if keep == "min" else max)(ids) for t, ids in groups.items()}
    assert got == {i: (best[t], len(groups[t]), i == best[t]) for i, t in enumerate(texts)}
    assert exact_dedup.drop_exact_copies(rows, keep=keep).count() == len(groups)


def test_a_hot_group_is_dealt_over_many_ranges(spark):
    """A third of all rows has one text: no range gets much more than its share."""
    rows = [(i, "the hot text" if i % 3 == 0 else f"text {i * 7919 % 6000}") for i in range(6000)]
    table = spark.createDataFrame(rows, "id long, norm string")
    splitters = exact_dedup.sample_splitters(table, 20)
    sizes = [r["count"] for r in exact_dedup._dealt(table, splitters).groupBy("range").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 900
