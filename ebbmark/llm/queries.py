"""Registered queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.llm import (
    fingerprints,
    hard_negatives,
    html_text,
    language_id,
    license_scan,
    near_dedup,
    packing,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_scan,
)
from ebbmark.llm.oracles import ORACLES as ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, encoded chunk by chunk, and the texts they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentencepiece_scan.decode(sentencepiece_scan.encode(docs, path), path)
    return decoded.select(
        "doc_id",
        "n_chunks",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("text").alias("text_crc32"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents, one row per document and licence."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return license_scan.scan(docs)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.model_from(docs, _table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id",
        F.expr(f"NOT NOT {quality_classifier.held_out()}").alias("held_out"),
        "score",
        F.expr("CAST(score >= 0.5 AS INT)").alias("predicted"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules.judge(docs, keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", "band_side"
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.compare(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; a source owns its documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan(docs, keep_text=False)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "live_spans")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on sets of four words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, spark, shingle=4, percent=80)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(f"NOT {language_id.held_out()}"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.expr(f"NOT NOT {language_id.held_out()}").alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 50, out of all rows."""
    relabel = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END")
    rows = hard_negatives.prepare(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", relabel)
    return hard_negatives.mine(rows, "id % 50 = 0")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = pii.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "span_scores")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_license_scan,
        op3_quality_classifier,
        op4_quality_rules,
        op5_html_text,
        op6_packing,
        op7_fingerprints,
        op8_secret_scan,
        op9_near_dedup,
        op10_language_id,
        op11_prefix_trie,
        op12_hard_negatives,
        op13_pii,
    )
}
