"""The queries, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from caretrail.llm.byte_bpe import byte_bpe_digest
from caretrail.llm.conversations import conversation_digest
from caretrail.llm.decontaminate import leaks
from caretrail.llm.filter_audit import ORACLE as AUDIT_SQL
from caretrail.llm.filter_audit import filter_audit
from caretrail.llm.near_vectors import near_vectors
from caretrail.llm.ngram_join import document_components
from caretrail.llm.pieces import piece_digest
from caretrail.llm.quality import quality_scores
from caretrail.llm.queries import query
from caretrail.llm.secrets import secret_digest
from caretrail.llm.sharding import shard
from caretrail.llm.stored import table
from caretrail.llm.suffix_dedup import suffix_digest
from caretrail.llm.url_filter import url_verdicts
from caretrail.llm.warc import ORACLE as WARC_SQL
from caretrail.llm.warc import archive_digest


@query("op8_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digest(table(spark, folder, "documents"))


@query("op4_url_filters")
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"))


@query("op6_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents"))


@query("op10_warc", WARC_SQL)
def warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_digest(table(spark, folder, "pages"))


@query("op7_sentencepiece")
def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digest(table(spark, folder, "documents"))


@query("op3_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


@query("op9_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return document_components(table(spark, folder, "documents"))


@query("op1_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_digest(table(spark, folder, "documents"))


@query("op11_filter_interaction_audit", AUDIT_SQL)
def filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe_digest(table(spark, folder, "documents"))


@query("op13_conversation_structure_repair")
def conversation_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_digest(table(spark, folder, "conversations"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
