"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Two multinomials over hashed word and character n-grams are counted over the whole of both sides, the trusted texts
and the raw corpus. A document's score is the mean log ratio of its n-grams; it is kept where the score reaches a fixed
threshold, so every document has the same verdict in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.textops import Chunk, Words, chunks, per_row, span_hashes, window_hashes
from tallgrass.llm.workspace import stage

#: Hash buckets of each kind of n-gram.
BUCKETS = 1 << 16
#: Smoothing, in n-grams a bucket.
PRIOR = 1.0
#: Log ratio a n-gram (natural logarithm) from which a document is kept.
THRESHOLD = -0.15
#: Trusted identifiers up to this number are broadcast.
BROADCAST_IDS = 1_000_000
#: Words to the window, and share of words in repeated windows, of the base rules.
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LEADS = np.ones(256, bool)
_LEADS[0x80:0xC0] = False  # continuation bytes


def ngram_buckets(chunk: Chunk, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and rows of the n-grams: words, pairs of words, and runs of three bytes; a table of buckets for each kind."""
    mask = np.uint64(BUCKETS - 1)
    pairs, pair_rows, _ = window_hashes(words, 2, False)
    out = [((words.hashes & mask).astype(np.int32), words.rows), ((pairs & mask).astype(np.int32), pair_rows)]
    data = chunk.data.astype(np.uint32)
    if len(data) >= 3:
        grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
        rows = np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
        same = rows[:-2] == rows[2:]
        spread = (grams[same] * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        out.append((spread.astype(np.int32), rows[:-2][same]))
    else:
        out.append((np.zeros(0, np.int32), np.zeros(0, np.int64)))
    return out


KINDS = 3


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition, by side: one bincount a kind, sent as the buckets that are not empty."""
    total = np.zeros((2, KINDS * BUCKETS), np.int64)
    for batch in batches:
        trusted = np.array(batch.column(1).fill_null(False).to_pylist(), bool)
        for chunk in chunks(batch.column(0)):
            words = chunk.words()
            good = trusted[chunk.first : chunk.first + chunk.rows]
            for kind, (buckets, rows) in enumerate(ngram_buckets(chunk, words)):
                at = slice(kind * BUCKETS, (kind + 1) * BUCKETS)
                total[0, at] += np.bincount(buckets, minlength=BUCKETS)
                total[1, at] += np.bincount(buckets[good[rows]], minlength=BUCKETS)
    used = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[0][used]), pa.array(total[1][used])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, trusted: DataFrame, text_col: str, id_col: str) -> np.ndarray:
    """The log ratio of each bucket: counts over all of ``docs``, and over those whose identifiers are in ``trusted``.

    Tasks send at most ``KINDS * BUCKETS`` sums, and so much comes to the driver, whatever the size of the corpus.
    """
    marked = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    good = trusted.select(F.col(trusted.columns[0]).alias("id"), F.lit(True).alias("good")).distinct()
    if good.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        good = F.broadcast(good)  # else the texts are shuffled
    marked = marked.join(good, "id", "left").select("text", "good")
    sums = marked.mapInArrow(_count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    table = sums.toPandas()
    counts = np.full((2, KINDS * BUCKETS), PRIOR)
    counts[0, table["bucket"]] += table["raw"].to_numpy()
    counts[1, table["bucket"]] += table["target"].to_numpy()
    counts = counts.reshape(2, KINDS, BUCKETS)
    share = counts / counts.sum(axis=2, keepdims=True)
    # The target's prior follows the raw corpus, so that buckets which neither side knows say nothing.
    prior = share[0] * BUCKETS * PRIOR
    target = counts[1] - PRIOR + prior
    return np.log((target / target.sum(axis=1, keepdims=True)) / share[0]).astype(np.float32)


def base_counts(chunk: Chunk, words: Words) -> dict[str, np.ndarray]:
    """The plain counts of the contract, by row."""
    offsets = chunk.offsets
    size = len(chunk.data) + 1
    inside = np.cumsum(np.bincount(words.starts, minlength=size) - np.bincount(words.ends, minlength=size))[:-1] > 0
    out = {"n_words": words.per_row, "word_chars": per_row((inside & _LEADS[chunk.data]).astype(np.int64), offsets), "n_symbols": per_row(_SYMBOL[chunk.data].astype(np.int64), offsets)}

    # Lines that have a word, equal to an earlier line of their text.
    at, to, rows = chunk.spans(chunk.data == 10)
    has_word = np.searchsorted(words.starts, to) > np.searchsorted(words.starts, at)
    at, to, rows = at[has_word], to[has_word], rows[has_word]
    out["n_dup_lines"] = _later_copies(span_hashes(chunk.data, at, to), rows, chunk.rows)

    hashes, rows, first = window_hashes(words, REPEAT_WINDOW, False)
    order = np.lexsort((hashes, rows))
    same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found, size = first[order[twice]], len(words.starts) + 1
    cover = np.bincount(found, minlength=size) - np.bincount(found + REPEAT_WINDOW, minlength=size)
    out["n_repeat_words"] = per_row((np.cumsum(cover[:-1]) > 0).astype(np.int64), words.first)
    return out


def _later_copies(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, rows))
    same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    return np.bincount(rows[order][1:][same], minlength=n)


_OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double"


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: identifier, the base counts, ``base_failed``, ``llr`` and ``kept``.

    ``trusted``'s first column has the identifiers of the trusted documents. A null text has no words; a text without
    n-grams has the ratio 0. Texts of fewer than ``MIN_WORDS`` words, or with too many words in repeated windows, are
    not kept whatever their ratio. Repeated rows count as often as they come; null identifiers are never trusted. With
    an empty trusted table both sides say the same and every ratio is 0.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted, text_col, id_col))  # KINDS * BUCKETS floats

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                words = chunk.words()
                out = base_counts(chunk, words)
                llr = np.zeros(chunk.rows)
                for kind, (buckets, rows) in enumerate(ngram_buckets(chunk, words)):
                    number = np.bincount(rows, minlength=chunk.rows)
                    llr += np.bincount(rows, table[kind][buckets], chunk.rows) / np.maximum(number, 1) / KINDS
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
                ids = batch.column(0).slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(out[k], pa.int64()) for k in names], pa.array(llr)], ["id", *names, "llr"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"id {kind}, {_OUT}"), "quality-rules")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return scored.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "llr", (~failed & (F.col("llr") >= threshold)).alias("kept"))
