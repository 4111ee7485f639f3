"""The registered queries of these operators, ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymatrix.llm import chat, context_mixing, decontam, langid, license_scan, line_rules, merkle, packing, quality_rff, simhash_anchor, spelling, toxicity, warc
from daymatrix.llm.text import held_out

QUALITY_LIMIT = 0.7
TOXIC_LIMIT = 0.3


ROOT = Path(__file__).resolve().parents[2]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once, unless their path has it anyway."""
    context = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(":") or context.applicationId in _SHIPPED:
        return
    name = os.path.join(tempfile.mkdtemp(prefix="daymatrix-"), "daymatrix")
    context.addPyFile(shutil.make_archive(name, "zip", ROOT, "daymatrix"))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.apply_rules(table(spark, folder, "documents"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_rff.Model:
    """Learnt from three of four folds, calibrated on the last of them."""
    return quality_rff.fit(docs, labels, "quality", ~held_out(4, 2), held_out(4, 3))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model(docs, table(spark, folder, "labels"))
    score = F.col("score")
    return quality_rff.scored(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), score, (score >= QUALITY_LIMIT).cast("int").alias("predicted")
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_anchor.near_duplicates(table(spark, folder, "documents"))


def op5_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = context_mixing.score(table(spark, folder, "documents"), ~held_out(5, 1))
    return found.select(
        "doc_id", held_out(5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), "toxic", ~held_out(4, 2))
    score = F.col("score")
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), score, (score >= TOXIC_LIMIT).cast("int").alias("predicted")
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.where(~held_out(5, 0)))
    return langid.predicted(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.build(table(spark, folder, "documents")).proofs()


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = chat.EXTRA
    extra = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, chat.ASSISTANT, text)], "conv_id bigint, turn int, role string, text string")
    return chat.round_trip(turns.unionByName(extra))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_quality_rules, op3_quality_classifier, op4_simhash, op5_context_mixing, op6_toxicity,
        op7_warc, op8_language, op9_packing, op10_licenses, op11_merkle, op12_spelling, op13_chat,
    )
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": line_rules.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_merkle": merkle.ORACLE_SQL,
    "op12_spelling": spelling.ORACLE_SQL,
    "op13_chat": chat.ORACLE_SQL,
}
