"""Lazy access to the driver's parquet tables.

Nothing is read until a plan needs it; Catalyst prunes columns and pushes
filters into each scan, so adapters may select freely.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """``Tables(spark, "/root/testdata/sf0.01").lineitem`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The table's DataFrame, read (listed and schema-resolved) once per
        instance; plans that use a table twice get a fresh relation per use
        from Catalyst's self-join de-duplication, and adapters refer to
        columns by name."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return tuple(TABLES)
