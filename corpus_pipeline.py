"""The corpus pipeline: stages over `documents`, each written as Parquet and reread as the next one's input.

All stages but the last return the columns they were given. Rows with a null id or text go through every stage; rows that share
an id are one document, so they stay or go together in near-duplicate removal. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lorebase.llm import decontaminate, neardup, pieces, secrets, toxicity
from lorebase.llm.common import Written
from lorebase.sources.readers import read_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; the model learns from the labels of these documents."""
    return toxicity.kept(docs, toxicity.trained(docs, read_table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component by five-word shingles and a similarity of 0.8."""
    found = neardup.near_duplicates(docs, size=5, percent=80)
    # Written, so that the rows of an id that many share can be split; rows without an id go on and are kept out of the join.
    dropped = Written(found.where("NOT kept AND doc_id IS NOT NULL").selectExpr("doc_id AS dropped").distinct(), "dropped").df
    known = docs.where("doc_id IS NOT NULL")
    return known.join(dropped, known["doc_id"] == dropped["dropped"], "left_anti").unionByName(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor a passage within its edit budget."""
    return decontaminate.without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the values of secrets replaced by a mark, and their new length."""
    return secrets.redacted(docs, length="n_chars" if "n_chars" in docs.columns else None)


def with_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their whole texts, their number, and whether they decode to the text again."""
    return pieces.tokenised(docs, MODEL)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("sentencepiece", with_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` through all stages."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Written(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models, similarities and ids of a vocabulary can't be had in SQL; the tests compare with plain Python.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
