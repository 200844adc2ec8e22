"""The registered queries of the training-data operators and the pipeline."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    alignment, bpe, decontamination, fingerprints, html_extract, jaccard_join, lang_id, line_dedup, lm_scoring, quality, suffix_dedup, token_counts,
    vector_codes,
)
from plumbline.llm.tables import id_text, table, written

MAX_TOKENS = 4096


def op1_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    file = Path(path or public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    out = bpe.encode(id_text(table(spark, sf_dir, "documents")), file, keep=["doc_id"])
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = lang_id.remainder(F.col("doc_id"), 3) == 1
    parser = lang_id.fit(docs.where(~held_out))
    out = lang_id.with_language(docs.select("doc_id", "text", held_out.alias("held_out")), parser)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_fingerprints(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        (F.octet_length("kept") + n_removed).alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    model = Path(path or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    docs = id_text(table(spark, sf_dir, "documents"))
    out = token_counts.with_token_counts(docs, model)
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    return out.select("doc_id", n_bytes, "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lang_id.remainder(F.col("doc_id"), 7) == 2
    out = lm_scoring.score(docs.withColumn("held_out", held_out), ~F.col("held_out"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, n_lines="n_lines", n_dropped="n_dropped")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, (n_words, hit, items) = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.size(hit).cast("long")
    return marked.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(F.col(n_words), n_hit).alias("contaminated"),
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lang_id.remainder(F.col("doc_id"), 4) == 2
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    model = quality.fit(docs, labels)
    scored = quality.with_scores(docs.withColumn("held_out", held_out), model, output="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= quality.GOOD).cast("int").alias("predicted"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    a = alignment.ByteTokens(Path(path_a or public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"))
    b = alignment.PieceTokens(Path(path_b or public_tokenizers.path("piece_bpe_32k.model")).read_bytes())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned, new = alignment.align(docs, a, b, digest=True)
    n_a, n_b, n_groups, n_links, groups, pairs, times = new
    aligned = written(aligned.select("doc_id", *new), "aligned")
    summed, (n_best, count_sum) = alignment.with_count_sums(aligned, alignment.pair_counts(aligned, b.size, pairs), b.size, pairs, times)
    return summed.select(
        "doc_id", n_a, n_b, n_groups, n_links, F.col(n_best).alias("n_best"), F.col(count_sum).alias("count_sum"), F.col(groups).alias("groups_sha256")
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_language": op2_language,
    "op3_fingerprints": op3_fingerprints,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_html": op5_html,
    "op6_token_counts": op6_token_counts,
    "op7_lm": op7_lm,
    "op8_jaccard": op8_jaccard,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_quality": op11_quality,
    "op12_vector_codes": op12_vector_codes,
    "op13_alignment": op13_alignment,
}
