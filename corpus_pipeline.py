"""From raw documents to packed training sequences, a stage at a time.

Each stage works on all rows that the one before kept, and is written as Parquet before the
next one reads it. All stages but the last return the columns of `documents`; other columns
are not carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wicketflow.llm import linededup, packing, quality, secrets, simhash
from wicketflow.llm.queries import table, tokenizer_file
from wicketflow.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a document's source go; a document of such lines alone is empty."""
    clean = linededup.drop_boilerplate(docs.select(*COLUMNS))
    return _with_text(clean, F.col("clean_text"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays; of equal rows one.

    Different texts of one doc_id are different documents, so each of them stays with it. Of
    rows with equal doc_id and text the one with the smallest other columns stays. A document
    without doc_id cannot be told from others and stays.
    """
    docs = docs.select(*COLUMNS)
    kept = (simhash.near_duplicates(docs).where("doc_id = component_id")
            .select("doc_id").distinct())
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    named = (docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text")
             .agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "text", "row.*")
             .select(*COLUMNS))
    return named.union(docs.where("doc_id is null")).select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    found = secrets.scan(docs.select(*COLUMNS))
    return _with_text(found, secrets.redacted(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids as pieces of sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


def _with_text(docs: DataFrame, text) -> DataFrame:
    new = docs.withColumn("__new", text)
    return new.select("doc_id", F.col("__new").alias("text"), "lang", "source",
                      F.length("__new").cast("long").alias("n_chars"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup),
          ("simhash_near_dedup", simhash_near_dedup), ("secret_scans", secret_scans),
          ("packing", pack)]

#: Suffix arrays, SimHash components and packing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
