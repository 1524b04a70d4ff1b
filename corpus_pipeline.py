"""The corpus pipeline: five stages over ``documents``, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import decontaminate, line_dedup, packing, quality, simhash
from flowgauge.llm.common import ship, table
from flowgauge.llm.queries import WORD_TOKENIZER, vocabulary
from flowgauge.session import scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and ``n_chars`` is that of the text that stays."""
    ship(spark)
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in kept.columns else kept


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    ship(spark)
    return simhash.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, placed in sequences."""
    ship(spark)
    return packing.best_fit_packing(docs, vocabulary(WORD_TOKENIZER))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: The classifier, SimHash and the packing have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
