"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, Spark's external sort
puts equal texts next to each other and full comparisons of neighbours (the
window's run detection) find the groups.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.common import shuffle_width

#: Bytes of the text that a splitter holds; whole texts are compared later.
SPLITTER_BYTES = 48


def content_sort(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """One row per input row: ``row`` (the input row as a struct), ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    Range partitions are cut on (leading bytes, hash, salt) so that the sampled
    splitters stay small; within a partition rows are sorted by the whole
    text, and a group is a run of equal neighbours.  A text held by more than
    a quarter of an average partition's rows is salted by id hash over several
    partitions; its total comes from a pre-aggregated count (at most
    4 x partitions such texts exist, so that side is broadcast).

    Null text counts as empty; a null id sorts below every id; of rows with
    the same text and the same id exactly one is kept; extra columns ride
    along in ``row`` whatever their names.  An empty table gives no rows.
    """
    width = shuffle_width(docs.sparkSession)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("_id"),
        normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
    )
    hashed = rows.select("_id", "_text", F.xxhash64("_text").alias("_h"))
    share = max(1, docs.count() // (4 * width))
    hot = (
        hashed.groupBy("_h")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > share)
        .select(F.col("_h").alias("_hot"), F.ceil(F.col("_n") / share).alias("_salts"))
    )
    totals = (
        hashed.join(F.broadcast(hot), F.col("_h") == F.col("_hot"))
        .groupBy("_h", "_text")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
        .select(F.sha2("_text", 256).alias("_digest"), F.col("_h").alias("_hk"), "_keep", "_size")
    )
    salted = (
        rows.withColumn("_h", F.xxhash64("_text"))
        .join(F.broadcast(hot), F.col("_h") == F.col("_hot"), "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_salts")), F.lit(0)))
        .withColumn("_lead", F.substring(F.col("_text").cast("binary"), 1, SPLITTER_BYTES))
    )
    run = ["_lead", "_h", "_salt", "_text"]
    neighbours = Window.partitionBy(*run)
    by_id = neighbours.orderBy(F.col("_id").desc_nulls_last())
    runs = (
        salted.repartitionByRange("_lead", "_h", "_salt")
        .withColumn("_rank", F.row_number().over(by_id))
        .withColumn("_top", F.first("_id").over(by_id))
        .withColumn("_run", F.count("*").over(neighbours))
        .select("row", "_id", "_h", "_rank", "_top", "_run", F.sha2("_text", 256).alias("text_sha256"))
    )
    joined = runs.join(
        F.broadcast(totals), (F.col("_h") == F.col("_hk")) & (F.col("text_sha256") == F.col("_digest")), "left"
    )
    keep = F.when(F.col("_size").isNull(), F.col("_top")).otherwise(F.col("_keep"))
    return joined.select(
        "row",
        keep.alias("keep_id"),
        F.coalesce("_size", "_run").alias("group_size"),
        ((F.col("_rank") == 1) & F.col("_id").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def exact_groups(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    id_col = options.get("id_col", "doc_id")
    slim = docs.select(id_col, options.get("text_col", "text"))
    return content_sort(slim, **options).select(
        F.col(f"row.{id_col}").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"
    )


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """The input's columns, one row of each group of equal texts."""
    return content_sort(docs, **options).filter("kept").select("row.*")
