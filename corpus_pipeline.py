"""A corpus, from raw documents to packed sequences, one written stage after the other.

Every stage takes what its predecessor kept, as documents, and calls one operator.
All but the last return documents with all their columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.llm import decontam, line_rules, packing, queries, simhash_anchor
from daymatrix.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Parts of words a packing worker remembers: some 50 MB, as the stages before have left
#: the executor's heap grown.
CACHE_WORDS = 150_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the limit; the model learns from the stage's input.
    Null and empty texts have a score like others; equal texts have equal scores."""
    model = queries.quality_model(docs, queries.table(spark, sf_dir, "labels"))
    return docs.where(model.score_column(F.col("text")) >= queries.QUALITY_LIMIT)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, their texts unchanged.  Null and empty texts have too
    few words; repeated rows are judged each."""
    return line_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the row with the smallest id; links, shingles and
    bits are those of the operator's query."""
    return simhash_anchor.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no part of a benchmark item; those without text hold none."""
    return decontam.without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences; repeated rows are packed
    each, null texts as empty ones."""
    queries.ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cache_words=CACHE_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier and a tokenizer have no counterpart in SQL.
ORACLE_SQL = None
