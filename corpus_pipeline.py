"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before has kept and returns a frame that is
written and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.llm.decontaminate import clean_documents
from salesengine.llm.minhash import near_duplicates
from salesengine.llm.packing import pack
from salesengine.llm.pii import redacted
from salesengine.llm.quality import good_documents
from salesengine.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Shingles of five words and a similarity of 0.8. Rows that repeat an id which stays are
    one document if their texts agree, and all stay if not. Rows without an id stay.
    """
    columns = docs.columns
    gone = near_duplicates(docs).where("doc_id is not null and not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*columns)
    return left.dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("quality", quality),
    ("minhash", deduplicate),
    ("decontaminate", decontaminate),
    ("pii", redact),
    ("packing", packing),
]

#: Training, hashing and tokenizing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
