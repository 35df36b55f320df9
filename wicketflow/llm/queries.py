"""Registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.llm import (
    ann, bpe, codes, linededup, packing, pieces, prefixes, quality, secrets, simhash, template, toxicity, warc,
)
from wicketflow.session import fresh_path, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = tuple(r.kind for r in secrets.RULES)
    found = secrets.scan(docs)
    counts = [F.size(secrets.of_kinds((k,))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts,
                        F.sha2(secrets.digest(kinds), 256).alias("base_sha256"),
                        secrets.digest().alias("spans"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, F.col("vec_id") % 20 == 0)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "covered_words", "longest_repeat")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_boilerplate(docs).select(
        "doc_id", "source", "n_lines", "n_dropped",
        F.length("clean_text").cast("long").alias("clean_chars"),
        F.sha2("clean_text", 256).alias("clean_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    rows, toxic = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic")
    model = toxicity.fit(rows, toxicity.severity_grades(rows, toxic))
    return toxicity.predict(docs, model).select(
        "doc_id", "expected_severity", "severity",
        (F.col("expected_severity") >= 0.5).alias("toxic"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path).select(
        F.col("page_id").cast("long").alias("page_id"), "record_type", "record_id",
        "refers_to_id", F.length("payload").cast("long").alias("payload_bytes"),
        warc.base32_sha1(F.col("payload")).alias("payload_digest"))
    read = stage(read, "records")
    full = (read.where("record_type = 'response'").dropDuplicates(["record_id"])
            .select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"),
                    "payload_bytes", "payload_digest"))
    again = (read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
             .join(full, F.col("refers_to_id") == F.col("target"), "left"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (read.where("record_type = 'response'")
            .withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
            .union(again.select(*columns)))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    made = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return made.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return made.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scans, op2_nearest_neighbours, op3_simhash_near_dedup,
        op4_quality_rules, op5_line_dedup, op6_toxicity,
        op7_html_extraction, op8_packing, op9_warc, op10_sentencepiece, op11_bpe,
        op12_conversation_trie, op13_vector_codes)
}
