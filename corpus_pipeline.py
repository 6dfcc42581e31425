"""From raw documents to token counts: five stages, each written before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import decontaminate, jaccard, piece_chunks, pseudonyms, toxicity
from ledgerlane.llm.common import TEXT_WRITERS, drop_written, given, held, in_few_files, ship_package, stored, written
from ledgerlane.llm.queries import DEMO_KEY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the grammar is learned from these documents' labels."""
    ship_package(spark)
    grammar = toxicity.fit_on(docs, given(spark, sf_dir, "labels"))
    docs = in_few_files(docs, TEXT_WRITERS)
    return docs.filter(toxicity.score_of(docs["text"], grammar) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows, also where doc_ids are missing or repeated."""
    ship_package(spark)
    return jaccard.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark window, whatever their doc_id.

    A text alone says whether it is contaminated, so rows are judged and removed under a 128-bit hash of it.
    """
    judged = decontaminate.contamination(
        docs.select(F.md5("text").alias("doc_id"), "text"), given(spark, sf_dir, "benchmark")
    )
    hit = judged.filter("contaminated").select(F.col("doc_id").alias("hit")).distinct()
    return held(docs, hit=F.md5(docs["text"])).join(hit, "hit", "left_anti").select("row.*")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms of the same format (and length)."""
    return docs.withColumn("text", pseudonyms.rewritten(docs["text"], DEMO_KEY)["text"])


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of ids and decoded text."""
    ship_package(spark)
    return piece_chunks.encode_decode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", hide_personal_data),
    ("tokens", count_tokens),
]

# Learned weights, permutations and tokenization are beyond SQL: tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has read and written besides its result is removed after it."""
    docs, first = given(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_written(spark, first)
    return docs
