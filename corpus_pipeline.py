"""Cleaning a corpus of documents in five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.chosen_path import near_duplicates
from ledgerloom.llm.common import DOCUMENT, table
from ledgerloom.llm.decontaminate import leaks
from ledgerloom.llm.line_dedup import without_repeated_lines
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.quality_fm import THRESHOLD, score, train
from ledgerloom.session import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. The model learns from the labels of the input's own documents."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.select(*DOCUMENT).where(score(model, F.col("text"), F.col("n_chars").cast("long")) >= THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occurred before, alike (at any length) or nearly so; n_chars follows the text where it changed."""
    before = docs.select(*DOCUMENT).withColumn("n_before", F.length("text"))
    after = without_repeated_lines(before, least_copy=1)
    return after.withColumn("n_chars", F.when(F.length("text").eqNullSafe(F.col("n_before")), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*DOCUMENT)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, similarity 0.8.

    Rows are told apart by doc_id, which may be NULL, and text, so unrelated texts under one doc_id both stay, and rows without
    doc_id are compared like others. Of a group the smallest doc_id stays. Blank texts stay; equal rows are one.
    """
    found = near_duplicates(docs, size=5).withColumn("row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "copy"))
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min("row").alias("row")).select("row")
    blank = found.where("n_shingles = 0").select("row").distinct()
    chosen = first.unionByName(blank).select(F.col("row.doc_id").alias("k_id"), F.col("row.copy").alias("k_copy"))
    rows = docs.select(*DOCUMENT).withColumn("copy", F.xxhash64("text"))
    kept = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("copy") == F.col("k_copy")))
    return kept.dropDuplicates(["doc_id", "copy"]).select(*DOCUMENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Texts are judged by themselves, whatever their doc_id."""
    texts = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("doc_id"), "text")
    found = leaks(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("found")).distinct()
    return docs.select(*DOCUMENT).join(found, F.xxhash64("text") == F.col("found"), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, whole or in part: doc_id, source, size, source_size, target and taken words."""
    return mix(docs).where(F.col("taken") > 0).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
]

#: The classifier's training and the joins on whole texts are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is kept in the shared folder of checkpoints."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
