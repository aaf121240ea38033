"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; the next one reads what it kept. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import decontamination, exact_dedup, ngram_join, packing, toxicity
from hourloom.llm.common import id_remainder, read_table, shared_folder


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from labels of ids whose crc32 is no multiple of 5."""
    learned = read_table(spark, sf_dir, "labels").where(id_remainder(F.col("doc_id"), 5) != 0)
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(*toxicity.training_sample(docs, learned)))


def copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles the smallest id stays."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def contaminated_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("exact_dedup", copies_go),
    ("ngram_join", near_copies_go),
    ("decontamination", contaminated_documents_go),
    ("packing", packed),
]

#: No SQL expresses the network, the join's classes at this size and the packing; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the session's shared folder and read again."""
    docs, folder = read_table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
