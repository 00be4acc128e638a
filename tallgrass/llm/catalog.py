"""Queries over the driver's tables, one for each operator, and their SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import canonical_digest, embedding_whitening, exact_dedup, jaccard_join, language_id, lm_scoring, mixing, packing, quality_classifier, quality_rules, ranked_search, url_filters, warc_zip
from tallgrass.operators.incremental import numbered
from tallgrass.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_rules.judge(_table(spark, sf_dir, "documents"), trusted)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), language_id.held_out())


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"), language_id.held_out(parts=5, part=1))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(_table(spark, sf_dir, "pages"))


def redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL filter with a table of redirects made from the pages, which have none: each third page by id leads to the next one."""
    pages = _table(spark, sf_dir, "pages")
    order = numbered(pages, "page_id", "i")
    urls = pages.join(order, "page_id").select("i", "url")
    redirects = urls.filter("i % 3 = 2").join(urls.select((F.col("i") - 1).alias("i"), F.col("url").alias("dst")), "i").select(F.col("url").alias("src"), "dst")
    return url_filters.judge(pages, redirects=redirects)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, docs.filter(~language_id.held_out()))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "languages")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_canonical_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_digest.compare_edits(_table(spark, sf_dir, "documents"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts that are fingerprinted, without the fingerprints, which SQL has not."""
    return canonical_digest.edited(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))
    # Beyond a long (more than about ten million vectors of unit length) ``deviation`` is null and ``deviation_exact`` has it.
    return white.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.col("deviation").try_cast("long"))


def embedding_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitening's rows without eigenvectors, which SQL has not."""
    return embedding_whitening.deviations(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_mixing": op3_mixing,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_url_filters": op6_url_filters,
        "redirect_equivalence": redirect_equivalence,
        "op7_packing": op7_packing,
        "op8_warc_zip": op8_warc_zip,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_language_id": op10_language_id,
        "op11_ranked_search": op11_ranked_search,
        "op12_canonical_digest": op12_canonical_digest,
        "edited_texts": edited_texts,
        "op13_embedding_whitening": op13_embedding_whitening,
        "embedding_deviations": embedding_deviations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.SQL,
        "op6_url_filters": url_filters.SQL,
        "redirect_equivalence": url_filters.REDIRECTS_SQL,
        "op8_warc_zip": warc_zip.SQL,
        "op9_jaccard_join": jaccard_join.SQL,
        "op11_ranked_search": ranked_search.SQL,
        "edited_texts": canonical_digest.EDITED_SQL,
        "embedding_deviations": embedding_whitening.DEVIATIONS_SQL,
    }
