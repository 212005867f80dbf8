"""A training corpus from raw documents, stage by stage.

Every stage is one operator on all rows its predecessor kept, and all but the
last return the columns of ``documents``. ``run`` applies them in order and
writes each result before the next stage reads it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.llm import near_dedup, packing, quality_classifier, quality_rules, secret_scan
from ebbmark.llm.arrays import may_hold, membership, stored
from ebbmark.sources.scratch import remove, scratch_folder, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Rows of whole texts that pass between Spark and a Python worker at a time; Spark's
# own 10,000 would hold tens of megabytes of text, several times over, in every task.
BATCH_ROWS = 500


def _in_small_batches(spark: SparkSession) -> None:
    """Sizes the session's Arrow batches for whole texts; the rows are the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores at 0.5 or more."""
    _in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.model_from(docs, labels)
    return quality_classifier.score(docs, model).filter("score >= 0.5").select(*COLUMNS)


def keep_regular(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the base rules and the perplexity bands keep."""
    _in_small_batches(spark)
    return quality_rules.judge(docs).filter("kept").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group (five words, 0.8), that with the smallest id.

    Rows are told apart by a number of their own: of rows that share an id, or
    have none, one stays if their texts are near. A null id comes last; rows
    without a text are no duplicates of each other.
    """
    _in_small_batches(spark)
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), spark, "numbered")
    numbered = rows.select(F.col("row").alias("doc_id"), "text")
    groups = near_dedup.near_duplicates(numbered, spark).select(F.col("doc_id").alias("row"), "component_id")
    # Combined before the shuffle: a group is one row per task, however large it is.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    heads = rows.select("row", "doc_id").join(groups, "row").groupBy("component_id").agg(first).select("first.row")
    gone = rows.select("row").join(heads, "row", "left_anti")
    return _without(rows, stored(gone, spark, "gone"), "row").select(*COLUMNS)


def _without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` but those whose key is in ``gone``; others' whole texts are not shuffled, but for few."""
    shared = rows.sparkSession.sparkContext.broadcast(membership(gone, key))

    @F.pandas_udf("boolean")
    def may_be_gone(hashes: pd.Series) -> pd.Series:
        return pd.Series(may_hold(shared.value, hashes.to_numpy()))

    rows = rows.withColumn("maybe", may_be_gone(F.xxhash64(key)))
    return rows.filter("NOT maybe").unionAll(rows.filter("maybe").join(gone, key, "left_anti").select(rows.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark."""
    _in_small_batches(spark)
    cleaned = secret_scan.redact(secret_scan.scan(docs))
    n_chars = F.when(F.size("secret_spans") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of all documents with their token ids, the corpus to train on."""
    _in_small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("quality_rules", keep_regular),
    ("near_dedup", keep_one_of_each_group),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# Compression, perplexity and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote for itself, and its input, go once its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch_folder(spark)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
