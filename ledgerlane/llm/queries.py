"""The registered queries of this folder: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import (
    alignment, decontaminate, hard_negatives, jaccard, main_text, piece_chunks, pseudonyms, quality, rp_forest, shards,
    suffixes, token_spans, toxicity,
)
from ledgerlane.llm.common import given, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The secret of the pseudonyms; a caller of the operator gives another.
DEMO_KEY = "demo"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose vec_id is divisible by 20."""
    return rp_forest.search(given(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each sentence of each document; a token on a border counts where most of it lies."""
    return token_spans.section_tokens(
        given(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        starts_of=token_spans.sentence_starts,
    )


@query
def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return shards.shard_by_bytes(given(spark, sf_dir, "documents"))


@query
def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels that are not held out."""
    docs = given(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_on(docs, given(spark, sf_dir, "labels")))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that start anywhere else, too."""
    return suffixes.remove_repeated(given(spark, sf_dir, "documents"))


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of links, at a Jaccard similarity of 0.8 of five-word shingles."""
    return jaccard.near_duplicates(given(spark, sf_dir, "documents"))


@query
def op7_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms of the same format."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, DEMO_KEY)


@query
def op8_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a grammar whose weights are learned from labels that are not held out."""
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = toxicity.fit_on(docs, given(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, grammar).select("doc_id", "held_out", "score", "predicted")


@query
def op9_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return piece_chunks.encode_decode_digests(
        given(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    return decontaminate.contamination(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


@query
def op11_str_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are rows whose vec_id is divisible by 100; labels of every seventh vec_id move on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = given(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op12_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(given(spark, sf_dir, "pages"))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every document, and how often their linked ids meet in the corpus."""
    files = alignment.Vocabularies(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return alignment.align(given(spark, sf_dir, "documents"), files)
