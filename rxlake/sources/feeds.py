"""Feed and zone readers.

CSV feeds are read under their declared schema with ``enforceSchema=false``
so a reordered or renamed header is checked against the schema instead of
silently shifting columns, and only ``*.csv`` files are read (alert JSON
dropped under the same prefix is ignored).  Malformed rows either fail the
read (``FAILFAST``) or are quarantined through ``columnNameOfCorruptRecord``.
A quote inside quoted text is written twice, and feeds with free text may hold
line breaks inside quotes (a file of such a feed is read by one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rxlake.schemas import FEEDS

CORRUPT_COL = "_corrupt_record"
#: Columns whose text may hold line breaks.
FREE_TEXT = ("narrative",)


def _csv(spark: SparkSession, schema: StructType, mode: str, corrupt: bool = False):
    reader = (
        spark.read.option("header", "true")
        .option("enforceSchema", "false")
        .option("pathGlobFilter", "*.csv")
        .option("mode", mode)
        .option("dateFormat", "yyyy-MM-dd")
        .option("escape", '"')
        .option("multiLine", str(any(c in schema.fieldNames() for c in FREE_TEXT)).lower())
    )
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.schema(schema)


def read_feed(spark: SparkSession, path: str, feed: str, mode: str = "FAILFAST") -> DataFrame:
    """Headered CSV under the feed's declared schema.

    ``FAILFAST`` raises on the first malformed row (the claimed strictness);
    ``PERMISSIVE`` nulls bad cells; use :func:`quarantine_feed` to keep them.
    An empty cell is null, quoted or not.
    """
    return _csv(spark, FEEDS[feed].schema, mode).csv(path)


def quarantine_feed(
    spark: SparkSession, path: str, feed: str, work_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split a CSV feed into (good rows, quarantined rows with the raw
    line in ``_corrupt_record`` and the file in ``source_key``).

    The parse is written once as Parquet under the shared folder and both
    sides are read from it: Spark refuses queries on raw CSV that reference
    only the corrupt-record column (e.g. a count of bad rows), and the
    written parse is a cut point that survives executor loss.
    """
    from rxlake.session import scratch_path

    schema = StructType([*FEEDS[feed].schema.fields, StructField(CORRUPT_COL, StringType(), True)])
    parsed = _csv(spark, schema, "PERMISSIVE", corrupt=True).csv(path).withColumn(
        "source_key", F.col("_metadata.file_path")
    )
    work_path = work_path or scratch_path(spark, f"parsed-{feed}")
    parsed.write.mode("overwrite").parquet(work_path)
    df = spark.read.parquet(work_path)
    good = df.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL, "source_key")
    bad = df.filter(F.col(CORRUPT_COL).isNotNull())
    return good, bad


def read_raw_feeds(spark: SparkSession, raw_dir: str, mode: str = "FAILFAST") -> dict[str, DataFrame]:
    """S1 for all four feeds: ``<raw_dir>/<feed>/*.csv`` under declared schemas."""
    base = raw_dir.rstrip("/")
    return {name: read_feed(spark, f"{base}/{name}", name, mode) for name in FEEDS}


def read_zone(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: partitioned Parquet zone (partition column rediscovered from the
    directory names); ``columns`` restores a by-name column order."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named table or temp view."""
    return spark.table(name)
