"""Corpus pipeline: quality, lines, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
Rows are kept whole: a stage drops documents, or, in the line and token stages, replaces their text.

Defined cases, for every stage: an empty table gives an empty one. Null and empty texts are documents without
words: the quality stage judges them like any other, the line stage keeps them as they are, the others find nothing
in them. Rows that share a doc_id are one document to the stages that drop documents: all of them go or none does;
a row whose doc_id is null can't be named by a decision of the last three and stays. Further columns of
documents, whatever their names, are carried along and never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm import byte_bpe, decontaminate, line_dedup, minhash_dedup, quality
from leafwright.llm.common import read_table, remove, shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all of them if there was no label to learn from."""
    machine = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, machine) if machine.fitted else docs


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document repeats; n_chars follows the text. None is dropped, even if no line is left."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    kept = line_dedup.LineIndex.build(docs).rewrite(docs)
    return kept.select(*rest, "text", F.char_length("text").cast("long").alias("n_chars")).select(docs.columns)


#: Least similarity of near-duplicates here, in percent.
NEAR_PERCENT = 80


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (similarity ``NEAR_PERCENT`` or more); documents without words have none and stay."""
    gone = minhash_dedup.near_duplicates(docs, NEAR_PERCENT).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark.

    A document goes if it holds one window of one item: ``decontaminate.WINDOW`` consecutive words. Items
    of fewer words don't count here, as a few words that a text shares with one are no copy of it.
    """
    phrases = decontaminate.phrases_of(read_table(spark, sf_dir, "benchmark")).where(F.col("length") == decontaminate.WINDOW)
    gone = decontaminate.occurrences(docs, phrases).where("n_hit > 0").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, number of tokens, digests of ids and of the decoded bytes."""
    return byte_bpe.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: The first stage is a trained classifier, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; a stage's output goes when the next one's is there."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            remove(spark, f"{folder}/{k - 1}_{STAGES[k - 1][0]}")
    return docs
