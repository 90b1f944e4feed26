"""From documents to a mix: language, lines, near copies, benchmark leaks, target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written before the
next reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclean.llm.decontaminate import drop_leaks
from tabclean.llm.language import accepted_documents
from tabclean.llm.line_dedup import dedup_lines
from tabclean.llm.minhash import drop_near_duplicates
from tabclean.llm.mixing import mixed
from tabclean.sources.staging import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure; `lang` becomes that language."""
    return accepted_documents(docs.select(*COLUMNS))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; a document of such lines alone stays, empty."""
    out = dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on shingles of five words."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each document that the mix takes: doc_id, size, source_size, target, taken."""
    return mixed(docs.select(*COLUMNS))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: A trigram model, MinHash and edit distances are no SQL; their operators are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole documents table; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
