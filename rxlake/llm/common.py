"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxlake.session import ensure_checkpoint_dir

#: Words of every contract: runs of bytes outside 0x20 and 0x09-0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder (reliable
    checkpoint, removed by Spark's cleaner once unreferenced where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def once(value: Column) -> Column:
    """``value``, evaluated once per row: the non-deterministic guard (always
    true) keeps the optimizer from copying a costly expression into filters
    and lambdas that use it."""
    return F.when(F.spark_partition_id() >= 0, value)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo: the contracts' fold rule."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def batches(it: Iterator[pa.RecordBatch], weight: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches whose ``weight`` column holds at most
    about ``limit`` bytes (one row at least), so memory is bounded by bytes."""
    for b in it:
        if not b.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(weight)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        edges = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
            yield b.slice(lo, hi - lo)


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat words of all rows and, per row, their end offsets (row i holds
    words ``ends[i]:ends[i + 1]``); null text has no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat = lists.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0
    counts = np.concatenate([[0], np.cumsum(full)])
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return flat.filter(pa.array(full)), counts[offsets - offsets[0]]


def numbered(df: DataFrame, order: list[Column], out: str = "at") -> DataFrame:
    """``df`` (written once) with a gapless 0-based number in ``order``.

    Rows are range-partitioned on the order, numbered inside each partition and
    shifted by the rows of the partitions before, so no task sees more than
    its range however the rows are distributed.  Ties may fall in any order
    but are numbered once: the numbers are part of the written table.
    """
    place = F.monotonically_increasing_id()  # partition in the high bits, place in it in the low 33
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(ranged.withColumn("_place", place))
    part = F.shiftright("_place", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.select("_part", (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"))
    joined = rows.join(before, part == F.col("_part"))
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(out, number).drop("_place", "_part", "_before")


def joined_by_size(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group.  ``groups``: one row per key
    with ``_n``, its rows, ``total`` over all.  Groups of more than a share of the
    rows, of which there are 4 x partitions at most, are joined by broadcast, so
    that their rows stay where they are; all others by shuffle."""
    share = max(1, total // (4 * shuffle_width(rows.sparkSession)))
    large = groups.filter(F.col("_n") > share).drop("_n")
    hot = rows.join(F.broadcast(large), key)
    cold = rows.join(F.broadcast(large.select(key)), key, "left_anti").join(groups.filter(F.col("_n") <= share).drop("_n"), key)
    return hot.unionByName(cold)
