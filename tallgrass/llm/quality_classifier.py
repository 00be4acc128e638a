"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its hashed word and character n-grams; a softmax layer on top gives the
classes. Vectors and layer are learned together by stochastic gradient descent in numpy, from a bounded sample of labelled
documents. Once learned, vector and layer of an n-gram collapse into one number, so whole texts are scored by lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.textops import Chunk, chunks, window_hashes
from tallgrass.llm.workspace import stage

#: Most labelled documents of each class that are learned from; those whose identifiers hash lowest.
MAX_TRAIN_PER_CLASS = 2000
#: Most bytes of text that are learned from, half of them of each class.
MAX_TRAIN_BYTES = 32 << 20
BUCKETS = 1 << 16
DIM = 8
EPOCHS = 12
RATE = 0.5
SEED = 7
#: Kinds of n-grams: words, pairs of words, word triples met before, runs of three bytes, runs of four bytes.
KINDS = 5


def features(chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every n-gram of the chunk's texts, a pair of arrays for each kind."""
    words = chunk.words()
    mask = np.uint64(BUCKETS - 1)
    out = [((words.hashes & mask).astype(np.int32), words.rows)]
    pairs, rows, at = window_hashes(words, 2, False)
    same = words.hashes[at] == words.hashes[at + 1] if len(at) else np.zeros(0, bool)
    out.append((np.where(same, 1, np.where(pairs & mask < 2, 2, pairs & mask)).astype(np.int32), rows))
    triples, rows, _ = window_hashes(words, 3, False)
    order = np.lexsort((triples, rows))
    met = np.zeros(len(order), np.int32)
    met[order[1:]] = (triples[order][1:] == triples[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    out.append((met, rows))
    data, row_of = chunk.data.astype(np.uint32), np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
    for size in (3, 4):
        if len(data) < size:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.int64)))
            continue
        gram = np.zeros(len(data) - size + 1, np.uint32)
        for k in range(size):
            gram = (gram << np.uint32(8)) | data[k : len(data) - size + 1 + k]
        within = row_of[: len(gram)] == row_of[size - 1 :]
        out.append((((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int32)[within], row_of[: len(gram)][within]))
    return out


def bags(chunk: Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row: its distinct features (kind and bucket in one number) and their weights, which add up to 1."""
    found = [(kind * BUCKETS + b, rows) for kind, (b, rows) in enumerate(features(chunk))]
    ids, rows = np.concatenate([f[0] for f in found]).astype(np.int64), np.concatenate([f[1] for f in found])
    keys, number = np.unique(rows.astype(np.int64) * (KINDS * BUCKETS) + ids, return_counts=True)
    row, feature = keys // (KINDS * BUCKETS), (keys % (KINDS * BUCKETS)).astype(np.int32)
    per_kind = np.bincount(row * KINDS + feature // BUCKETS, number, chunk.rows * KINDS)
    weight = (number / per_kind[row * KINDS + feature // BUCKETS] / KINDS).astype(np.float32)
    edges = np.searchsorted(row, np.arange(chunk.rows + 1))
    for i in range(chunk.rows):
        yield i, feature[edges[i] : edges[i + 1]], weight[edges[i] : edges[i + 1]]


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = SEED) -> np.ndarray:
    """The logit of class 1 over class 0 for each feature, and the bias as the last entry.

    ``samples`` hold label, features and weights; both classes count alike. Without samples of both classes all is 0.
    """
    rng = np.random.default_rng(seed)
    number = np.bincount([s[0] for s in samples], minlength=2) if samples else np.zeros(2)
    if number.min() == 0:
        return np.zeros(KINDS * BUCKETS + 1, np.float32)
    share = number.sum() / (2 * number)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (KINDS * BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    moved = np.zeros(KINDS * BUCKETS, np.float32)
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            label, ids, weight = samples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = weight @ vectors[ids]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            p *= share[label]
            back = p @ layer
            layer -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            # Each vector has a step size of its own, which shrinks as its gradients add up: rare n-grams move far, common ones settle.
            push = weight[:, None] * back
            moved[ids] += (push * push).sum(axis=1) / DIM
            vectors[ids] -= (0.1 * rate / np.sqrt(moved[ids] + 1e-8))[:, None] * push
    return np.append(vectors @ (layer[1] - layer[0]), bias[1] - bias[0]).astype(np.float32)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for chunk in chunks(batch.column(0)):
            rows = [(labels[chunk.first + i], ids.tobytes(), weight.tobytes()) for i, ids, weight in bags(chunk)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["label", "ids", "weights"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int = MAX_TRAIN_PER_CLASS, max_bytes: int = MAX_TRAIN_BYTES) -> np.ndarray:
    """Fit on at most ``per_class`` labelled documents of each class, and at most ``max_bytes`` of their texts; only their feature bags come to the driver.

    Documents come in the order of a hash of their identifiers; those that would pass the bytes are left out, as are texts of a tenth of them or more.
    """
    spark = docs.sparkSession
    picked = []
    for value in (0, 1):
        rows = labels.filter(F.col(label_col) == value).select(id_col).distinct()
        picked += [(r[0], value) for r in rows.orderBy(F.xxhash64(id_col), id_col).limit(per_class).collect()]
    if not picked:
        return train([])
    kind = labels.schema[id_col].dataType.simpleString()
    wanted = F.broadcast(spark.createDataFrame(picked, f"id {kind}, label int"))  # 2 * per_class rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id")
    sizes = texts.groupBy("id", "label").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).orderBy(F.xxhash64("id"), "id", "label").collect()  # 2 * per_class rows at most
    fits, room = [], [max_bytes // 2, max_bytes // 2]
    for r in sizes:
        if r["bytes"] < max_bytes // 10 and r["bytes"] <= room[r["label"]]:
            fits.append((r["id"], r["label"]))
            room[r["label"]] -= r["bytes"]
    if not fits:
        return train([])
    texts = texts.join(F.broadcast(spark.createDataFrame(fits, f"id {kind}, label int")), ["id", "label"]).select("text", "label")
    found = texts.mapInArrow(_sample, "label int, ids binary, weights binary").toPandas()
    samples = [(int(r.label), np.frombuffer(r.ids, np.int32), np.frombuffer(r.weights, np.float32)) for r in found.itertuples()]
    return train(sorted(samples, key=lambda s: (s[0], s[1].tobytes())))


def score_texts(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """Probability of class 1 of every text: a lookup for each n-gram, averaged by kind."""
    out = np.zeros(len(column))
    for chunk in chunks(column):
        logit = np.full(chunk.rows, float(table[-1]))
        for kind, (bucket, rows) in enumerate(features(chunk)):
            number = np.bincount(rows, minlength=chunk.rows)
            logit += np.bincount(rows, table[kind * BUCKETS + bucket], chunk.rows) / np.maximum(number, 1) / KINDS
        out[chunk.first : chunk.first + chunk.rows] = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
    return out


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", cut: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: identifier, ``held_out``, ``score`` and ``predicted`` (1 where the score reaches ``cut``).

    ``held_out`` is a condition on the identifier; labels where it holds, and labels other than 0 and 1, are not learned from. Null and empty
    texts get the score of a document without n-grams. Repeated rows get repeated scores; with no labels of one of
    the classes every score is 0.5.
    """
    model = learn(docs, labels.filter(~held_out), id_col, text_col, label_col)
    table = docs.sparkSession.sparkContext.broadcast(model)  # KINDS * BUCKETS floats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(batch.column(1), table.value))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"id {kind}, score double")
    scored = stage(scored, "quality-scores").withColumnRenamed("id", id_col)
    return scored.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
