"""The corpus pipeline: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir), docs having the columns of
``documents``, and its decisions take effect: toxic documents go, later copies
of lines go (and documents that consist of nothing else), one document of each
near-duplicate component stays, contaminated documents go, and the rest is
packed into sequences.  The last stage returns a row per piece; the others
return the columns they got.  Null or empty texts pass through the filters as
texts without words, of which SimHash keeps one.  Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linepulse.llm import decontaminate, linededup, packing, simhash, toxicity
from linepulse.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.keep_first_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, bound=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_documents),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The toxicity model and the fingerprints' 64-bit hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline_{name}")
    return docs
