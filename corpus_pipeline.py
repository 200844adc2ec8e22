"""The corpus pipeline: documents through five operators, each stage written as Parquet and read again."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, decontamination, jaccard_join, lang_id, line_dedup
from plumbline.llm.tables import fresh, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach, with the language found as their ``lang``;
    those without a letter or a text go."""
    guess, score = fresh(docs, "lang_pred", "score")
    known = lang_id.with_language(docs, lang_id.fit(docs), lang_pred=guess, score=score).where(F.col(guess) != lang_id.UNKNOWN)
    return known.withColumn("lang", F.col(guess)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; ``n_chars`` follows the text."""
    return line_dedup.drop_boilerplate(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose 5-word shingles are alike to 0.8 or more."""
    return jaccard_join.one_of_each(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in word windows of benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded): what is left, encoded; ids are little-endian
    unsigned 32-bit integers, decoded their text."""
    file = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), file, keep=["doc_id", "lang", "source"])
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", "lang", "source", n_tokens, "ids", "decoded")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: SQL can't express the learned language model or the encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
