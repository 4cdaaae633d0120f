"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bpe_count import token_counts
from ledgerloom.llm.chosen_path import near_duplicates
from ledgerloom.llm.common import table
from ledgerloom.llm.decontaminate import leaks
from ledgerloom.llm.html_paths import extract
from ledgerloom.llm.licenses import licence_matches
from ledgerloom.llm.line_dedup import deduplicated_lines
from ledgerloom.llm.mixing import mix, mix_sql
from ledgerloom.llm.multi_index import search
from ledgerloom.llm.multiset_hash import edited_fingerprints
from ledgerloom.llm.packed_negatives import hard_negatives, hard_negatives_sql
from ledgerloom.llm.quality_fm import quality
from ledgerloom.llm.spelling import runs, spelling_groups
from ledgerloom.llm.suffix_dedup import without_repeats


#: Name of the vocabulary file whose tokens op6 counts.
VOCABULARY = "byte_bpe_50k.json"


def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))


def op2_licence_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that documents name, in text order."""
    return licence_matches(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings that occur elsewhere."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word by word or with other numbers and names."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    import public_tokenizers  # vocabulary files are not part of this repository

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that each document loses because they, or lines like them, occurred before."""
    return deduplicated_lines(table(spark, sf_dir, "documents"), least_copy=1)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by components of near-copies."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score nearly as high as each anchor's best rows of its own label."""
    number, label = F.col("vec_id"), F.col("label")
    return hard_negatives(table(spark, sf_dir, "embeddings"), number % 100 == 0, F.when(number % 7 == 0, (label + 1) % 10).otherwise(label))


def op12_edited_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, and of what is left when each takes half of the next."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, slips of letters included, under their most frequent forms."""
    return spelling_groups(runs(table(spark, sf_dir, "documents"), slip_every=97))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_page_text, op2_licence_matches, op3_source_mix, op4_repeated_bytes, op5_benchmark_leaks, op6_token_counts, op7_quality_scores, op8_nearest_vectors, op9_repeated_lines,
        op10_near_duplicates, op11_hard_negatives, op12_edited_fingerprints, op13_spelling_groups,
    )
}
ORACLES: dict[str, str] = {"op3_source_mix": mix_sql(), "op11_hard_negatives": hard_negatives_sql()}
