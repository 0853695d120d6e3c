"""The corpus pipeline: documents through five of the operators, stage by stage.

Each stage works on all rows that its predecessor kept, is written as Parquet into the shared
folder and read again by the next. All but the last return the columns of ``documents``.

toxicity           documents that score as toxic go
MinHash            of each near-duplicate component the document with the smallest id stays
substring dedup    sentences of repeated spans go from all documents but the first; a document of which nothing is left goes
decontamination    documents that hold a window of a benchmark item go
packing            the rest is tokenised and packed into sequences: a row per piece

Defined cases: null and empty texts score as clean, are near nothing, hold nothing and are packed as their end token. Rows without
doc_id are no near duplicates and else judged by their text like all others; of rows that share doc_id (or have none) and text one stays. Labels, benchmark
and documents may be empty. Columns of ``documents`` beyond doc_id and text are handed on as they are (n_chars is counted anew
where sentences go), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from namewright.llm import decontaminate, minhash, packing, sentences, toxicity
from namewright.llm.common import read, ship, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.dedup(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return sentences.dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("MinHash near-dedup", minhash_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Training, MinHash candidates and tokenising are outside SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
