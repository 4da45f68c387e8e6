"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a table; run() writes it to the shared folder as Parquet and reads it again
for the next.  All stages but the last return the columns of documents, and each works on all that the one before kept.

Cases: rows with null texts are empty documents; they are scored, have no lines, are near copies of each other and pack as
their end.  Rows without doc_id are kept by every stage.  Rows that repeat a doc_id are one document, whose rows stay or go
together.  Extra columns stay as they are.  An empty table gives empty tables, and the packing no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import op02_simhash, op05_quality, op08_packing, op10_lines
from tidemark.llm.scratch import keep, without

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of documents of this table, accepts."""
    model = op05_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op05_quality.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source; n_chars is that of the text that is left."""
    cleaned = op10_lines.drop_boilerplate(docs, host="source")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id."""
    found = op02_simhash.near_copies(docs)
    return without(docs, F.col("doc_id").cast("long"), keep(found.filter("doc_id <> component_id").select("doc_id"), "gone"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 2048 tokens."""
    return op08_packing.pack(docs, WORD_VOCABULARY, 2048)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL says what a learnt classifier and a tokenizer do; tests hold the stages against brute force.
ORACLE_SQL = None
