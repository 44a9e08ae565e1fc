"""Incoming case-report JSON, batch or streaming.

Layouts
-------
``document``  one JSON document per file: an object **or** a list of objects
``lines``     one such document per line (splittable, for bulk drops)

A document is parsed strictly and whole: an unfinished one, one with anything
behind its end (a second document, say), a blank one, a scalar, or one that
repeats a key inside an object is not read in part but handed on as unreadable
with its text; so is a list's element that is no object.  (Spark's file source
does not see files without a byte.)  A field of another type than
declared is null, its report is read.

Only files that match ``pattern`` are picked up, so alert drops that share a
prefix with batch CSVs never leak into either reader.  Every row carries
``source_key``: the file it came from (``_metadata.file_path``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rxlake.schemas import ALERT_REPORT

#: Holds the text of a document or list element that is no report; null for reports.
CORRUPT = "_corrupt_record"
PATTERN = "*.json"
LAYOUTS = ("document", "lines")


def _documents(reader, path: str, layout: str) -> DataFrame:
    """``source_key, document``: every file's (or line's) text."""
    if layout not in LAYOUTS:
        raise ValueError(layout)
    if layout == "document":
        files = reader.format("binaryFile").load(path).withColumn("document", F.col("content").cast("string"))
    else:
        files = reader.format("text").load(path).withColumn("document", F.col("value")).filter(F.trim("value") != "")
    return files.select(F.col("_metadata.file_path").alias("source_key"), "document")


def read_alert_documents(spark: SparkSession, path: str, layout: str = "document", pattern: str = PATTERN) -> DataFrame:
    """``source_key, document`` of all report files under ``path``."""
    return _documents(spark.read.option("pathGlobFilter", pattern), path, layout)


def stream_alert_documents(
    spark: SparkSession, path: str, layout: str = "document", pattern: str = PATTERN, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New report files as a stream of documents (file source)."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if layout == "document":  # a stream asks for the declared columns of the source
        reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    return _documents(reader, path, layout)


def _strict(text: Column) -> Column:
    """The JSON text of a whole document, null unless it is exactly one.

    The parser stops behind the first value, so the text is parsed inside a
    list, where it must stay the only element, and inside an object, where a
    bracket that closes the list early is an error."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(alone, F.to_json(F.try_variant_get(named, "$.v", "variant")))


def with_reports(documents: DataFrame, schema: StructType = ALERT_REPORT) -> DataFrame:
    """``documents`` with ``reports``: array of (``report``, ``_corrupt_record``),
    one of the two per element.  An empty list holds none."""
    text = F.regexp_replace("document", "^﻿", "")

    def element(raw: Column) -> Column:
        is_report = F.startswith(raw, F.lit("{"))
        return F.struct(
            F.when(is_report, F.from_json(raw, schema)).alias("report"), F.when(~is_report, raw).alias(CORRUPT)
        )

    parsed = documents.withColumn("_json", _strict(text))
    listed = F.transform(
        F.try_variant_get(F.try_parse_json("_json"), "$", "array<variant>"), lambda e: F.coalesce(F.to_json(e), F.lit("null"))
    )
    items = (
        F.when(F.startswith("_json", F.lit("{")), F.array(F.col("_json")))
        .when(F.startswith("_json", F.lit("[")), listed)
    )
    unread = F.array(F.struct(F.lit(None).cast(schema).alias("report"), F.col("document").alias(CORRUPT)))
    return parsed.withColumn("_items", items).select(
        *documents.columns, F.coalesce(F.transform("_items", element), unread).alias("reports")
    )


def reports_of(documents: DataFrame, schema: StructType = ALERT_REPORT) -> DataFrame:
    """One row per report or unreadable text: the declared fields,
    ``_corrupt_record`` and ``source_key``."""
    return exploded(with_reports(documents, schema), schema)


def exploded(documents: DataFrame, schema: StructType = ALERT_REPORT) -> DataFrame:
    """The rows of ``reports_of`` from documents parsed before."""
    rows = documents.select("source_key", F.explode("reports").alias("_r"))
    return rows.select(*[F.col(f"_r.report.{c}").alias(c) for c in schema.names], F.col(f"_r.{CORRUPT}").alias(CORRUPT), "source_key")


def read_alert_batch(
    spark: SparkSession, path: str, layout: str = "document", schema: StructType = ALERT_REPORT, pattern: str = PATTERN
) -> DataFrame:
    """Batch read of report files (same parse as the stream)."""
    return reports_of(read_alert_documents(spark, path, layout, pattern), schema)


def read_alert_stream(
    spark: SparkSession,
    path: str,
    layout: str = "document",
    schema: StructType = ALERT_REPORT,
    max_files_per_trigger: int | None = None,
    pattern: str = PATTERN,
) -> DataFrame:
    """The reports of new files as a stream."""
    return reports_of(stream_alert_documents(spark, path, layout, pattern, max_files_per_trigger), schema)
