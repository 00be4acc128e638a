"""A corpus from documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from tallgrass.llm.workspace import own_folder
from tallgrass.session import ship_package


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter, or whose languages make up too little of them, go.

    Null and empty texts go. Repeated rows stay or go together; null identifiers and languages, and columns of any name, do no harm; no rows give none.
    """
    ship_package(spark)
    return language_id.recognised(docs)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, the one with the largest identifier stays.

    Null and empty texts are equal. Of rows that repeat identifier and text one stays; null identifiers stay only where a group has no other; no rows give none.
    """
    return exact_dedup.drop_exact_copies(docs, keep="max")


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word shingles, Jaccard similarity 0.75), the document with the smallest identifier stays.

    Texts without words are in no group and stay, as do rows without an identifier; rows that repeat one stay or go together; no rows give none.
    """
    ship_package(spark)
    return jaccard_join.first_of_groups(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the mix's targets: left out, once, or up to three times.

    Texts without words are never taken; rows without a source are a source of their own; repeated rows count as rows of their own; no rows give none.
    """
    return mixing.take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens.

    Null and empty texts are the end id alone; every row is packed, repeated ones and those without an identifier too; no rows give none.
    """
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", no_exact_copies),
    ("jaccard_join", no_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: SQL has no expectation-maximisation, column generation or tokenizer; tests/llm compares the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    folder = f"{own_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
