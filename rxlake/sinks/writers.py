"""Zone, table, file and model writers (K1, K2, K3, K5, K6).

Zone writes are the job's cut points: later stages read the written zone,
so a lost executor only recomputes from the last written zone, never the
whole lineage.  Partitioned writes do not repartition by the partition
column (that would put a hot region in one task); each task writes its own
files per partition value, bounded by ``maxRecordsPerFile``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MAX_RECORDS_PER_FILE = 5_000_000


def write_zone(df: DataFrame, path: str, partition_by: str | None = "region", mode: str = "overwrite") -> str:
    """K1: overwrite Parquet, partitioned by ``partition_by``."""
    w = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def _located(spark: SparkSession, name: str) -> tuple[str | None, list | None]:
    """(location, fields) of a catalog table, (None, None) where there is none."""
    if not spark.catalog.tableExists(name):
        return None, None
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").collect()
    place = next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)
    return place, spark.table(name).schema.simpleString()


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None, cluster_by: str | None = None) -> str:
    """K2: replace a catalog table with the DataFrame; returns where its files
    lie (below ``path``; unset: below the warehouse folder).

    The rows are written to a folder of their own first, then the table's
    location is swapped, one change of the catalog: readers see the old table or
    the new one, and a load that fails leaves the old one as it was.  The
    replaced files stay for readers that have begun, the ones before them are
    removed.  A table of other columns is dropped and created.  Rows are sorted
    by ``cluster_by`` inside each file, so a filter on it skips row groups (a
    partitioned table could not be swapped in one step)."""
    spark = df.sparkSession
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('.', '/')}_loads").rstrip("/")
    target = f"{base}/load-{uuid.uuid4().hex[:12]}"
    rows = df.sortWithinPartitions(cluster_by) if cluster_by else df
    rows.write.format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).save(target)
    before, fields = _located(spark, name)
    if before is not None and fields == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    else:
        if before is not None:
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=target, source=fmt, schema=df.schema)
    spark.catalog.refreshTable(name)
    remove_other_loads(spark, base, {target, before})
    return target


def remove_other_loads(spark: SparkSession, base: str, keep: set[str | None]) -> None:
    """Remove the loads below ``base`` but those to keep."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS has no Python API
    folder = jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    kept = {k.rstrip("/").rsplit("/", 1)[1] for k in keep if k}
    for f in fs.listStatus(folder):
        if f.getPath().getName().startswith("load-") and f.getPath().getName() not in kept:
            fs.delete(f.getPath(), True)


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> str:
    """K3: staging models as views, marts as tables; returns the view's name
    or where the table's files lie."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return name
    if kind == "table":
        return replace_table(df, name, path=path)
    raise ValueError(kind)


def write_file(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """K5: scored rows / forecast as headered CSV (or Parquet).  Quotes in CSV
    text are doubled and white space is kept, as ``read_feed`` expects."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", "true").option("escape", '"')
        w.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    else:
        w.format(fmt).save(path)
    return path
