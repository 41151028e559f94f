"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import mixing, packing, quality, simhash, substring
from waybill.sources.sinks import scratch_folder, staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns from every label.

    Decisions go by id: rows that repeat one share its fate, rows without an id stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = quality.classify(docs, labels)
    rejected = found.groupBy("doc_id").agg({"predicted": "max"}).toDF("judged_id", "accepted")
    rejected = rejected.filter("accepted = 0")
    return docs.join(rejected, docs["doc_id"] == rejected["judged_id"], "left_anti")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates.

    Null and blank texts are one group. A row without an id stays only where no member of its
    group has one; an id with several texts is judged text by text.
    """
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has, too; ``n_chars`` follows.

    Null, blank and short texts and rows without an id stay as they are; rows that repeat an id
    take nothing from each other. A document goes only if nothing of it is left.
    """
    left = substring.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order that the curriculum takes them.

    Every row has its own places, with or without an id; null sources are one source.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences.

    Null and blank texts are the end mark alone; long texts are cut into several pieces.
    """
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_copies),
    ("substring dedup", cut_repeats),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]
# Token ids, SHA-256 fingerprints and a fitted classifier are beyond SQL; tests hold the
# stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    scratch = scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), scratch, f"stage-{i}")
    return docs
