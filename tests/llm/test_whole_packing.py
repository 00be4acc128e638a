"""What a task of the packing holds beside the batch that it was given."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tallgrass.llm import packing


def test_a_batch_is_worked_on_in_small_parts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeghilmnorst"), rng.integers(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 1500)) for _ in range(250)]  # two megabytes
    path = public_tokenizers.path("word_bpe_49k.json")
    column = pa.array(texts)
    for _ in packing.token_ids(column.slice(0, 1), path):  # the vocabulary is read
        pass
    tracemalloc.start()
    found = [(first, ids.copy(), edges) for first, ids, edges in packing.token_ids(column, path)]
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - held < 16 << 20
    tokenizer = Tokenizer.from_file(path)
    ours = {first + i: ids[edges[i] : edges[i + 1]].tolist() for first, ids, edges in found for i in range(len(edges) - 1)}
    assert list(ours) == list(range(250)) and all(ours[i] == [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 1] for i in range(0, 250, 10))
