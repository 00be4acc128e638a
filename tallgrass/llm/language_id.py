"""Language ID by mixture inference.

Every language is a multinomial over hashed character n-grams, counted over all labelled texts that may be learned from.
Expectation-maximisation finds the proportions of the languages in a text; a second language joins the set only where
the likelihood it adds outweighs a penalty for each language, as in the Bayesian information criterion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.textops import LOWER, Chunk, chunks
from tallgrass.llm.workspace import BATCH_ROWS, stage

BUCKETS = 1 << 16
#: Numbers (languages x n-grams) that are worked on at once.
CELLS = 1 << 22
PRIOR = 0.05
#: Rounds of expectation-maximisation over all languages, and over a chosen set.
ROUNDS, SET_ROUNDS = 6, 6
#: A language below this share does not belong to the set.
LEAST_SHARE = 0.1
UNKNOWN = "und"

_KEEP = LOWER.copy()
_KEEP[[c for c in range(128) if not chr(c).isalpha()]] = 32


def ngrams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and rows of the runs of three bytes, A-Z lower-cased, anything in ASCII but letters as a space; runs of spaces are left out."""
    data = _KEEP[chunk.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
    gram = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    fine = (rows[:-2] == rows[2:]) & ((data[:-2] != 32) | (data[1:-1] != 32)) & ((data[1:-1] != 32) | (data[2:] != 32))
    return ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)[fine], rows[:-2][fine]


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for chunk in chunks(_lowered(batch.column(0))):
            buckets, rows = ngrams(chunk)
            own = langs[chunk.first : chunk.first + chunk.rows]
            for lang in dict.fromkeys(own):
                of = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                of += np.bincount(buckets[(own == lang)[rows]], minlength=BUCKETS)
    for lang, counts in total.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used])], ["lang", "bucket", "n"])


def learn(labelled: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """Names of the languages and the log probabilities of their buckets, over all of ``labelled``: BUCKETS numbers a language."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sums = stage(rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams").toPandas()
    names = sorted(sums["lang"].unique())
    counts = np.zeros((len(names), BUCKETS))
    counts[np.searchsorted(names, sums["lang"]) if names else [], sums["bucket"]] = sums["n"]
    overall = counts.sum(axis=0)
    back = (overall + 0.5) / (overall + 0.5).sum() if names else np.ones(BUCKETS) / BUCKETS
    counts += PRIOR * BUCKETS * back
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if names else counts


def infer(chunk: Chunk, logs: np.ndarray, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each row, and which of them belong to the row's set; as many rows at a time as CELLS allow, one at least.

    ``other`` (a number a row) gets the share of each row that none of its set explains.
    """
    k = len(logs)
    buckets, rows = ngrams(chunk)
    keys, number = np.unique(rows * BUCKETS + buckets, return_counts=True)
    row, bucket, number = keys // BUCKETS, (keys % BUCKETS).astype(np.int32), number.astype(np.float32)
    edges = np.searchsorted(row, np.arange(chunk.rows + 1))
    shares, chosen, first = np.full((k, chunk.rows), 1 / k), np.zeros((k, chunk.rows), bool), 0
    while first < chunk.rows:
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + max(1, CELLS // k), "right")) - 1)
        some = slice(edges[first], edges[last])
        log_p = logs[:, bucket[some]]
        shares[:, first:last], chosen[:, first:last] = _mixtures(row[some] - first, number[some], log_p, last - first)
        if other is not None:
            other[first:last] = _unexplained(row[some] - first, number[some], log_p, np.where(chosen, shares, 0)[:, first:last])
        first = last
    return shares, chosen


def _expected(shares: np.ndarray, p: np.ndarray, row: np.ndarray, number: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One round of expectation-maximisation: the shares that each row's n-grams support."""
    part = shares[:, row].astype(np.float32) * p
    part *= number / np.maximum(part.sum(axis=0), 1e-30)
    return np.stack([np.bincount(row, x, len(size)) for x in part]) / np.maximum(size, 1)


def _mixtures(row: np.ndarray, number: np.ndarray, log_p: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    k, size = len(log_p), np.bincount(row, number, rows)
    pure = np.stack([np.bincount(row, number * x, rows) for x in log_p])
    most = log_p.max(axis=0) if len(row) else np.zeros(0, np.float32)
    p = np.exp(log_p - most)
    shares = np.full((k, rows), 1 / k)
    for _ in range(ROUNDS):
        shares = _expected(shares, p, row, number, size)
    shares[:, size == 0] = 1 / k
    # The mixture of the larger shares, estimated anew without the others, pays half the logarithm of the text's size for each of its languages.
    chosen = shares >= LEAST_SHARE
    kept = np.where(chosen, shares, 0)
    several = chosen.sum(axis=0) > 1
    if several.any():
        kept /= np.maximum(kept.sum(axis=0), 1e-12)
        place, own = np.cumsum(several) - 1, several[row]
        of, n, likely, total = place[row[own]], number[own], p[:, own], size[several]
        inner = kept[:, several]
        for _ in range(SET_ROUNDS):
            inner = _expected(inner, likely, of, n, total)
        mixture = np.bincount(of, n * (np.log(np.maximum((inner[:, of] * likely).sum(axis=0), 1e-30)) + most[own]), len(total))
        penalty = 0.5 * np.log(np.maximum(total, 2))
        better = mixture - penalty * chosen[:, several].sum(axis=0) > pure[:, several].max(axis=0) - penalty
        at = np.flatnonzero(several)
        shares[:, at[better]] = inner[:, better]
        several[at[~better]] = False
    alone = np.zeros_like(chosen)
    alone[pure.argmax(axis=0), np.arange(rows)] = True
    return shares, np.where(several, chosen, alone)


def _unexplained(row: np.ndarray, number: np.ndarray, log_p: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Share of each row that is of no language of its set: one more part of the mixture, in which all n-grams are equally likely.

    Like a further language it has to add more likelihood than half the logarithm of the text's size, so that short texts are given the benefit of the doubt.
    """
    size = np.bincount(row, number, shares.shape[1])
    weight, p = (shares / np.maximum(shares.sum(axis=0), 1e-12)).astype(np.float32), np.zeros(len(row), np.float32)
    for own, logs in zip(weight, log_p, strict=True):
        p += own[row] * np.exp(logs) * np.float32(BUCKETS)
    other = np.full(len(size), 0.5)
    for _ in range(ROUNDS + SET_ROUNDS):
        part = other[row]
        other = np.bincount(row, number * part / (part + (1 - part) * p), len(size)) / np.maximum(size, 1)
    gain = np.bincount(row, number * np.log(other[row] / np.maximum(p, 1e-30) + 1 - other[row]), len(size))
    return np.where(gain > 0.5 * np.log(np.maximum(size, 2)), other, 0)


def lettered(chunk: Chunk) -> np.ndarray:
    """Share of each row's bytes, but for white space and control characters, that are letters or not ASCII; 1 where it has none."""
    rows = np.repeat(np.arange(chunk.rows), np.diff(chunk.offsets))
    seen, letters = (np.bincount(rows[x], minlength=chunk.rows) for x in (chunk.data > 32, _KEEP[chunk.data] != 32))
    return np.where(seen > 0, letters / np.maximum(seen, 1), 1)


def identify(docs: DataFrame, learn_from: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: identifier, ``lang_pred``, ``score`` and ``languages``.

    ``learn_from`` has texts and languages; rows without a language or text teach nothing. ``languages`` is the selected
    set, largest share first, ``lang_pred`` its first entry and ``score`` that one's share. Null texts, texts without a letter and
    every text where nothing could be learned are ``und`` with score 0 and an empty set. Whole texts count; repeated
    rows give repeated rows.
    """
    names, logs = learn(learn_from, text_col, lang_col)
    model = docs.sparkSession.sparkContext.broadcast((names, logs))  # BUCKETS floats a language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = model.value
        for batch in batches:
            text = _lowered(batch.column(1))
            known = np.array(pc.match_substring_regex(text.fill_null(""), r"\p{L}").to_pylist(), bool)
            langs, scores, sets = [UNKNOWN] * len(batch), np.zeros(len(batch)), [[] for _ in range(len(batch))]
            for chunk in chunks(text) if names else ():
                shares, chosen = infer(chunk, logs)
                order = np.argsort(-np.where(chosen, shares, -1), axis=0, kind="stable")
                for i in np.flatnonzero(known[chunk.first : chunk.first + chunk.rows]):
                    at = chunk.first + i
                    sets[at] = [names[j] for j in order[: chosen[:, i].sum(), i]]
                    langs[at], scores[at] = names[order[0, i]], shares[order[0, i], i]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.clip(scores, 0, 1)), pa.array(sets, pa.list_(pa.string()))], ["id", "lang_pred", "score", "languages"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double, languages array<string>")
    return stage(found, "languages").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Rows whose identifier, as text, has the CRC-32 ``part`` modulo ``parts``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def recognised(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` that have a letter and of which languages that are known, as ``identify`` selects them, make up ``least``; all columns.

    Texts in other languages go, by their n-grams, and those that are mostly numbers or signs, by their characters: the share of letters times
    the share of n-grams that the languages explain is what they make up. Texts too short to tell are taken for known;
    where nothing could be learned, every text with a letter stays. Null and empty texts go; repeated rows
    stay or go together; null identifiers teach like others; an empty table gives none. Other columns may have any names.
    """
    names, logs = learn(docs.filter(~held_out()), "text", "lang")
    model = docs.sparkSession.sparkContext.broadcast((names, logs))  # BUCKETS floats a language

    @F.arrow_udf("boolean")
    def known(text: pa.Array) -> pa.Array:
        names, logs = model.value
        parts = [np.zeros(0, bool)]
        for first in range(0, len(text), BATCH_ROWS):  # a batch may be tens of megabytes: not all of it is lower-cased at once
            some = _lowered(text.slice(first, BATCH_ROWS))
            kept = np.array(pc.match_substring_regex(some.fill_null(""), r"\p{L}").to_pylist(), bool)
            for chunk in chunks(some) if names else ():
                other = np.zeros(chunk.rows)
                infer(chunk, logs, other)
                kept[chunk.first : chunk.first + chunk.rows] &= (1 - other) * lettered(chunk) >= least
            parts.append(kept)
        return pa.array(np.concatenate(parts))

    # Only the texts go to Python, and a boolean comes back: the rows wait in the JVM.
    return docs.filter(known(docs["text"]))
