"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, pieces; each stage is one of the corpus operators.

A stage takes (spark, docs, sf_dir) and returns what it kept; the caller writes that and hands it to the next stage. All but
the last return the columns of `docs`. Rows with null or empty text pass through every stage by the rules of its operator: the
quality model scores them like others, they link with nothing, hold no leak and no secret, and have no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.decontaminate import without_leaks
from caretrail.llm.ngram_join import one_of_each
from caretrail.llm.pieces import Pieces, with_pieces
from caretrail.llm.quality import keep_good
from caretrail.llm.secrets import mask_secrets
from caretrail.llm.stored import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; its labels are those of the corpus."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group whose shingle sets are linked."""
    return one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with `[secret]` for every secret; n_chars follows the text."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, ids and the text decoded from them."""
    out = with_pieces(docs, Pieces.load(), keep=("doc_id", "lang", "source"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", leaks),
    ("secret scans", secrets),
    ("SentencePiece encoding and decoding", pieces),
]

# Learned scores, components and edit distances are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
