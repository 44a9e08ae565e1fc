"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm import exact, mixing, packing, quality, simhash
from rxlake.llm.catalog import labels_for_fit
from rxlake.llm.common import read
from rxlake.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  It is fitted on the
    labelled rows of the documents table outside the held-out third."""
    model = quality.fit_labels(read(spark, sf_dir, "documents"), labels_for_fit(read(spark, sf_dir, "labels")))
    return quality.classify(docs, model).filter("predicted = 1").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each group of equal texts."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each SimHash component."""
    return simhash.simhash_dedup(docs, shingle=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, to the nearest whole
    number, in the order of the mix (so packed sequences follow it); a document
    of no words stays as it is."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the CRC of their ids."""
    return packing.with_crc(packing.pack(docs, window=2048))


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The tokenizer, the fitted classifier and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is
    written to the shared checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
