"""Corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order by ``run``; each one's result is written as Parquet and read
again as the next one's documents. All but the last return the columns of their input. A
null text counts as empty, is clean, and equals other empty texts; a null id is kept where
its group has no other. Empty tables pass through. Columns of any name are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import exact, near, packing, repeats, toxicity
from riskloom.llm.common import Scope, scratch, stage
from riskloom.session import prepare


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    return toxicity.score(rows, model, keep=["row"]).where("predicted = 0").select("row.*")


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document with the largest id."""
    return exact.dedup(docs, keep="largest")


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links reach, the one with the smallest id; linked are those that share 0.8 or more of their 5-word shingles."""
    return near.keep_first(docs, words=5, similarity=0.8)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 bytes and more that an earlier one has."""
    return repeats.without_repeats(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each tokenised document lies in which sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]

# A trained classifier, connected components and a greedy packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES[:-1]:
        result = step(spark, docs, sf_dir)
        with Scope(spark) as written:
            docs = scratch(result, name.replace(" ", "-"))
        if before:
            before.remove()  # what this stage read
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
