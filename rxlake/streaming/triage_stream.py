"""ST1 / ST2 / J5: real-time triage as Structured Streaming.

``alerts(df)`` is a pure DataFrame -> DataFrame transform shared by batch
and stream.  ``start_triage`` drains the file source in micro-batches; each
batch writes three tables into folders named by its id, the ledger last:

``alerts``        one message per severe or life-threatening report, and one
                  per text that could not be read (it may hold a severe one)
``dead_letters``  the texts that could not be read
``ledger``        per file: reports, alerts sent, routine and unreadable ones
                  (a file without an alert has its row too)

A batch that is run again (a lost executor, a restart) overwrites its own
folders, and readers see the batches in the ledger only, so every file counts
once.  The operator is stateless (the original has no watermark, window or
dedup state), so it scales with the input files and needs no state store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rxlake.functions.triage import alert_message, alert_subject, triage_signal
from rxlake.schemas import ALERT_SIGNALS, HIGH_RISK_TERMS, OUTCOME_RISK_TERMS
from rxlake.session import path_exists, scratch_path
from rxlake.sources.alerts import CORRUPT, PATTERN, exploded, stream_alert_documents, with_reports

#: Signal of a report that is not valid JSON; it is alerted with its text.
UNREADABLE = "unreadable"

ALERT_COLUMNS = [
    "case_id", "drug_code", "drug_name", "severity_signal", "country", "narrative", "source_key", "subject", "message",
]


def with_signal(
    reports: DataFrame,
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
) -> DataFrame:
    """P14 applied to every report."""
    return reports.withColumn("severity_signal", triage_signal(terms=terms, outcome_terms=outcome_terms))


def alerts(
    reports: DataFrame,
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
    signals: Sequence[str] = ALERT_SIGNALS,
) -> DataFrame:
    """Reports -> one alert row per severe / life-threatening report (P14+P15),
    and one per report that could not be read."""
    if "source_key" not in reports.columns:
        reports = reports.withColumn("source_key", F.lit(None).cast("string"))
    flagged = with_signal(reports, terms, outcome_terms)
    if CORRUPT in reports.columns:  # a report that cannot be read may be a severe one: never drop it
        unread = F.col(CORRUPT).isNotNull()
        flagged = flagged.withColumn("severity_signal", F.when(unread, UNREADABLE).otherwise(F.col("severity_signal")))
        flagged = flagged.withColumn("narrative", F.when(unread, F.col(CORRUPT)).otherwise(F.col("narrative")))
    flagged = flagged.filter(F.col("severity_signal").isin(*signals, UNREADABLE))
    return flagged.select(
        "case_id", "drug_code", "drug_name", "severity_signal", "country", "narrative", "source_key",
        alert_subject().alias("subject"),
        alert_message().alias("message"),
    )


def dead_letters(reports: DataFrame) -> DataFrame:
    """``source_key, document``: the texts that are no report."""
    return reports.filter(F.col(CORRUPT).isNotNull()).select("source_key", F.col(CORRUPT).alias("document"))


def delivery_ledger(
    documents: DataFrame,
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
) -> DataFrame:
    """ST2: per delivered file, what became of its reports (``with_reports``
    documents in; a file whose documents hold no report has a row of zeros).

    Counted inside each document, so only a few numbers per document are
    summed by file."""
    r = F.col("_r")
    signal = triage_signal(r["report"]["narrative"], r["report"]["outcome"], r["report"]["serious_flag"], terms, outcome_terms)
    rows = documents.select("source_key", F.explode_outer("reports").alias("_r"))
    unread, read = r[CORRUPT].isNotNull(), r["report"].isNotNull()
    alerted = read & signal.isin(*ALERT_SIGNALS)
    return rows.groupBy("source_key").agg(
        F.count_if(read | unread).alias("reports"),
        F.count_if(alerted | unread).alias("alerts_sent"),
        F.count_if(read & ~alerted).alias("routine"),
        F.count_if(unread).alias("unreadable"),
    )


TABLES = {"alerts": ", ".join(f"{c} string" for c in ALERT_COLUMNS), "dead_letters": "source_key string, document string",
          "ledger": "source_key string, reports bigint, alerts_sent bigint, routine bigint, unreadable bigint"}


def start_triage(
    spark: SparkSession,
    source_path: str,
    sink_path: str,
    checkpoint: str | None = None,
    layout: str = "document",
    terms: Sequence[str] = HIGH_RISK_TERMS,
    outcome_terms: Sequence[str] = OUTCOME_RISK_TERMS,
    available_now: bool = False,
    processing_time: str = "10 seconds",
    sink_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    pattern: str = PATTERN,
) -> StreamingQuery:
    """ST1: start the triage stream (``availableNow`` drains and stops).

    ``max_files_per_trigger`` bounds each micro-batch when a large backlog
    of report files lands at once (``availableNow`` still drains it all,
    batch by batch).  ``sink_format`` is that of the alerts; the other tables
    are Parquet."""
    sink = sink_path.rstrip("/")

    def triage(documents: DataFrame, batch: int) -> None:
        parsed = with_reports(documents).persist()  # parsed once for the three tables
        try:
            reports = exploded(parsed)
            for name, rows, fmt in (
                ("alerts", alerts(reports, terms, outcome_terms), sink_format),
                ("dead_letters", dead_letters(reports), "parquet"),
                ("ledger", delivery_ledger(parsed, terms, outcome_terms), "parquet"),  # the commit of the batch
            ):
                rows.write.format(fmt).mode("overwrite").save(f"{sink}/{name}/batch_id={batch}")
        finally:
            parsed.unpersist()

    writer = (
        stream_alert_documents(spark, source_path, layout, pattern, max_files_per_trigger)
        .writeStream.foreachBatch(triage)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "triage-ckpt"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def read_sink(spark: SparkSession, sink_path: str, table: str = "alerts", sink_format: str = "parquet") -> DataFrame:
    """A table of the triage sink, batches in the ledger only."""
    sink = sink_path.rstrip("/")
    if not path_exists(spark, f"{sink}/ledger"):
        return spark.createDataFrame([], TABLES[table])
    fmt = sink_format if table == "alerts" else "parquet"
    read = lambda t, f: spark.read.format(f).schema(f"{TABLES[t]}, batch_id bigint").load(f"{sink}/{t}")
    if table == "ledger":
        return read("ledger", "parquet").drop("batch_id")
    done = read("ledger", "parquet").select("batch_id").distinct()
    return read(table, fmt).join(done, "batch_id", "left_semi").drop("batch_id")


def alerts_sent(ledger: DataFrame) -> DataFrame:
    """ST2: alerts per delivered file, 0 included (the original returned this
    count per invocation, i.e. per delivered file)."""
    return ledger.groupBy("source_key").agg(F.sum("alerts_sent").alias("alerts_sent"))


def reconcile_alerts(alert_rows: DataFrame, classified: DataFrame, label_col: str = "severity_label",
                     serious: Sequence[str] = ALERT_SIGNALS) -> DataFrame:
    """Real-time alerts vs the nightly severity class, per case.

    FULL OUTER join of alerted cases with cases the batch class calls
    serious; ``agreement`` is ``both`` / ``alert_only`` / ``class_only``.
    The class is judged behind the join: a filter on a predicted class would
    be pushed down and run the model's stages a second time.
    """
    a = alert_rows.select("case_id", "severity_signal")
    c = classified.select("case_id", F.col(label_col).alias("_class"))
    called = F.when(F.col("_class").isin(*serious), F.col("_class"))
    j = a.join(c, "case_id", "full").select("case_id", "severity_signal", called.alias("batch_class"))
    j = j.filter(F.col("severity_signal").isNotNull() | F.col("batch_class").isNotNull())
    return j.withColumn(
        "agreement",
        F.when(F.col("severity_signal").isNotNull() & F.col("batch_class").isNotNull(), F.lit("both"))
        .when(F.col("severity_signal").isNotNull(), F.lit("alert_only"))
        .otherwise(F.lit("class_only")),
    )
