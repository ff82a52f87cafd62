"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage calls one operator of ``ledgerlens.llm`` on all that the stage before kept;
its result is written as Parquet below ``spark.checkpoint.dir`` and read again, so a
stage that is lost with its executors starts from files, not from the beginning.

1. toxicity: documents that the classifier rejects (their language's threshold) go
2. exact_dedup: of equal normalised texts the smallest doc_id stays
3. simhash: of each component of near copies the smallest doc_id stays
4. secrets: every secret's text is replaced; no document goes
5. packing: the bin of every piece of every document

Null, empty and very long texts, repeated rows, null ids, empty tables and extra columns
are handled as the operators' docstrings say; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from ledgerlens.llm.common import DOCUMENT_COLUMNS, run_folder, ship_package, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.drop_toxic(docs.select(DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.drop_copies(docs.select(DOCUMENT_COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs.select(DOCUMENT_COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = docs.select(DOCUMENT_COLUMNS)
    return secret_scan.redact(docs, secret_scan.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.plan(docs.select(DOCUMENT_COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A trained classifier, a hash that DuckDB lacks, inferred automata and a sequential
#: packing can't be expressed in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    at = run_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
