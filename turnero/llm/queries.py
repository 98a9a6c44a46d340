"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnero.llm import ann, bpe, decontaminate, lexical, mixing, negatives, oracle, passages, pii, quality, sharding, simhash, toxicity, warc
from turnero.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule(table(spark, folder, "documents"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(table(spark, folder, "documents"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with their personal data replaced: ``doc_id, text, n_entities, entity_kinds``."""
    return pii.replace(table(spark, folder, "documents").select("doc_id", "text"))


def op8_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.captures(table(spark, folder, "pages"))


def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeats(table(spark, folder, "documents"))


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """A seventh of the rows are given the next label, so that some neighbours are of another one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.prepared(table(spark, folder, "embeddings"), label=label)
    return negatives.mine(rows, F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_mixing, op3_bpe, op4_quality, op5_simhash, op6_sharding, op7_pii, op8_ann, op9_warc,
                            op10_passages, op11_decontamination, op12_lexical, op13_negatives)}
ORACLES: dict[str, str] = oracle.STATEMENTS
