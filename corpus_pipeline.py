"""Corpus pipeline: documents through the training-data operators, one Parquet table a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm import decontaminate, jaccard_join, packing, quality_rules, suffix_dedup
from cinespark.llm.common import scratch_dir, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines (operator 6)."""
    return quality_rules.clean(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of documents that similarity links connect (operator 7)."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat from earlier documents; documents left without a word go (operator 10)."""
    cut = suffix_dedup.remove_repeats(docs)
    return (cut.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n_chars", F.length("text").cast("long")).select(docs.columns))


def clean_of_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item (operator 4)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences along the curve (operator 9)."""
    return packing.pack(docs, packing.tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", rules), ("n-gram Jaccard join", one_of_each), ("suffix-array dedup", cut_repeats),
          ("benchmark decontamination", clean_of_tests), ("packing", packed)]

#: Suffix sorting, similarity joins and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{scratch_dir(spark)}-stage{i}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
