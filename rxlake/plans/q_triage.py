"""Registered queries: triage rule (P14), alert messages (P15), alert files
(S4), the triage stream (ST1, ST2) and alert reconciliation (J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rxlake.functions.triage import alert_message_sql, triage_signal_sql
from rxlake.plans.registry import register
from rxlake.plans.staged import Staged, with_ctes
from rxlake.session import scratch_path
from rxlake.sources import adapters
from rxlake.sources.alerts import CORRUPT, read_alert_batch, read_alert_documents, with_reports
from rxlake.sources.tables import Tables
from rxlake.streaming import triage_stream as ts

TERMS = adapters.CASE_REPORT_OUTCOME_TERMS
SIGNAL_SQL = triage_signal_sql(outcome_terms=TERMS)
REPORTS = f"(SELECT *, {SIGNAL_SQL} AS severity_signal FROM ({adapters.CASE_REPORTS_SQL}) r)"
ALERTS_SQL = f"""SELECT case_id, drug_code, drug_name, severity_signal, country, narrative, source_key,
       '[PV ALERT] ' || upper(severity_signal) || ' adverse event — ' || coalesce(drug_name, 'None') AS subject,
       {alert_message_sql()} AS message
  FROM (SELECT *, CAST(NULL AS VARCHAR) AS source_key FROM {REPORTS} x)
 WHERE severity_signal IN ('severe', 'life-threatening')"""


@register("p14_triage_signal", f"SELECT case_id, outcome, serious_flag, severity_signal FROM {REPORTS} x")
def p14_triage_signal(spark, sf_dir):
    reports = adapters.case_reports(Tables(spark, sf_dir))
    return ts.with_signal(reports, outcome_terms=TERMS).select("case_id", "outcome", "serious_flag", "severity_signal")


@register("p15_alert_messages", ALERTS_SQL)
def p15_alert_messages(spark, sf_dir):
    return ts.alerts(adapters.case_reports(Tables(spark, sf_dir)), outcome_terms=TERMS)


#: The registered drop: reports of LOT events travel in one file, every
#: SINGLE-th alone as an object; lots come whole (0), whole beside an empty
#: list (1), as two documents in one file (2) and cut short (3).
LOT, SINGLE = 250, 1000
CUT = 10  # characters that a cut file misses

REPORT_COLS = ["case_id", "drug_code", "drug_name", "report_date", "country", "narrative", "outcome", "serious_flag"]


def _deliveries(spark, sf_dir):
    """``delivery, document`` of the registered drop."""
    events = Tables(spark, sf_dir).events
    reports = adapters.case_reports(Tables(spark, sf_dir))
    lot = F.floor(F.col("event_id") / LOT)
    alone = F.col("event_id") % SINGLE == 7
    rows = reports.select(
        F.substring("case_id", 3, 20).cast("long").alias("event_id"),
        F.to_json(F.struct(*REPORT_COLS), {"ignoreNullFields": "false"}).alias("report"),
    ).select(
        "event_id", "report", lot.alias("lot"),
        F.when(alone, F.concat(F.lit("one-"), F.col("event_id"))).otherwise(F.concat(F.lit("lot-"), lot)).alias("delivery"),
        F.when(alone, "one").when(lot % 4 == 2, "two").when(lot % 4 == 3, "cut").otherwise("list").alias("kind"),
        F.when(lot % 4 == 2, F.floor(F.col("event_id") % LOT / (LOT // 2))).otherwise(F.lit(0)).alias("part"),
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "report"))), lambda r: r["report"])
    parts = rows.groupBy("delivery", "kind", "part").agg(F.array_join(listed, ",").alias("body"))  # a lot is LOT reports at most
    parts = parts.withColumn("body", F.when(F.col("kind") == "one", F.col("body")).otherwise(F.concat(F.lit("["), F.col("body"), F.lit("]"))))
    whole = parts.groupBy("delivery", "kind").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda r: r["body"]), "").alias("body")
    )
    cut = F.when(F.col("kind") == "cut", F.expr(f"substr(body, 1, length(body) - {CUT})")).otherwise(F.col("body"))
    none = events.select(lot.alias("lot")).filter("lot % 4 = 1").distinct().select(F.concat(F.lit("none-"), "lot").alias("delivery"), F.lit("[]").alias("document"))
    return whole.select("delivery", cut.alias("document")).unionAll(none)


_EVENTS = f"""SELECT CAST(substr(case_id, 3) AS BIGINT) AS event_id, r.*, CAST(substr(case_id, 3) AS BIGINT) // {LOT} AS lot
  FROM ({adapters.CASE_REPORTS_SQL}) r"""
_DELIVERED = f"""SELECT *, CASE WHEN event_id % {SINGLE} = 7 THEN 'one-' || event_id ELSE 'lot-' || lot END AS delivery,
       CASE WHEN event_id % {SINGLE} = 7 THEN 'one' WHEN lot % 4 = 2 THEN 'two' WHEN lot % 4 = 3 THEN 'cut' ELSE 'list' END AS kind
  FROM ({_EVENTS}) e"""
_REPORT_JSON = "CAST(json_object(" + ", ".join(f"'{c}', {'CAST(report_date AS VARCHAR)' if c == 'report_date' else c}" for c in REPORT_COLS) + ") AS VARCHAR)"
#: (every file ends with a line break)
DEAD_SQL = f"""SELECT delivery, CASE WHEN kind = 'cut' THEN substr(body, 1, length(body) - {CUT}) ELSE body END || chr(10) AS document FROM (
  SELECT delivery, kind, string_agg(body, '' ORDER BY part) AS body FROM (
    SELECT delivery, kind, CASE WHEN kind = 'two' THEN event_id % {LOT} // {LOT // 2} ELSE 0 END AS part,
           '[' || string_agg({_REPORT_JSON}, ',' ORDER BY event_id) || ']' AS body
      FROM ({_DELIVERED}) d WHERE kind IN ('two', 'cut') GROUP BY 1, 2, 3) p GROUP BY 1, 2) w"""
NONE_SQL = f"SELECT DISTINCT 'none-' || lot AS delivery FROM ({_EVENTS}) e WHERE lot % 4 = 1"
GOOD_SQL = f"SELECT *, {SIGNAL_SQL} AS severity_signal FROM ({_DELIVERED}) d WHERE kind IN ('one', 'list')"


def _drop_reports(spark, sf_dir) -> str:
    """The registered drop as files, one folder per delivery."""
    path = scratch_path(spark, "case-reports")
    # tasks put their files in place themselves: a folder per delivery is too many for the driver to move
    writer = _deliveries(spark, sf_dir).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("delivery").text(path)
    return path


def _delivery():
    return F.regexp_extract("source_key", "delivery=([^/]+)/", 1)


def _run_stream(spark, sf_dir) -> str:
    src = _drop_reports(spark, sf_dir)
    sink = scratch_path(spark, "triage")
    q = ts.start_triage(spark, f"{src}/*", sink, outcome_terms=TERMS, available_now=True, pattern="*.txt")
    q.awaitTermination()
    return sink


ST1_COLS = ["case_id", "drug_code", "drug_name", "severity_signal", "country", "narrative", "subject"]
MESSAGED_SQL = f"""SELECT *, '[PV ALERT] ' || upper(severity_signal) || ' adverse event — ' || coalesce(drug_name, 'None') AS subject,
       {alert_message_sql()} AS message
  FROM (SELECT case_id, drug_code, drug_name, severity_signal, country, narrative, delivery AS source_key FROM ({GOOD_SQL}) g
         WHERE severity_signal IN ('severe', 'life-threatening')
        UNION ALL SELECT NULL, NULL, NULL, 'unreadable', NULL, document, delivery FROM ({DEAD_SQL}) w) a"""


@register("st1_triage_stream", f"SELECT {', '.join(ST1_COLS)}, message, source_key AS delivery FROM ({MESSAGED_SQL}) m")
def st1_triage_stream(spark, sf_dir):
    """Stream the report files through triage; returns the sink's messages
    (their file's path shortened to its delivery, as is the one in the body)."""
    sent = ts.read_sink(spark, _run_stream(spark, sf_dir))
    return sent.select(*ST1_COLS, F.replace("message", F.col("source_key"), _delivery()).alias("message"), _delivery().alias("delivery"))


ST2_SQL = f"""SELECT delivery, count(*) AS reports, count_if(severity_signal <> 'routine') AS alerts_sent,
       count_if(severity_signal = 'routine') AS routine, 0 AS unreadable FROM ({GOOD_SQL}) g GROUP BY 1
UNION ALL SELECT delivery, 1, 1, 0, 1 FROM ({DEAD_SQL}) w
UNION ALL SELECT delivery, 0, 0, 0, 0 FROM ({NONE_SQL}) n"""


@register("st2_alerts_sent", f"SELECT delivery, alerts_sent FROM ({ST2_SQL}) s")
def st2_alerts_sent(spark, sf_dir):
    """Alerts per delivered file, those without one included."""
    ledger = ts.read_sink(spark, _run_stream(spark, sf_dir), "ledger")
    return ts.alerts_sent(ledger).select(_delivery().alias("delivery"), "alerts_sent")


@register("st2_delivery_ledger", ST2_SQL)
def st2_delivery_ledger(spark, sf_dir):
    """What became of every report of every file (batch form of the ledger)."""
    documents = read_alert_documents(spark, f"{_drop_reports(spark, sf_dir)}/*", pattern="*.txt")
    ledger = ts.delivery_ledger(with_reports(documents), outcome_terms=TERMS)
    return ledger.select(_delivery().alias("delivery"), "reports", "alerts_sent", "routine", "unreadable")


@register("st1_dead_letters", f"SELECT delivery, md5(document) AS document_md5 FROM ({DEAD_SQL}) w")
def st1_dead_letters(spark, sf_dir):
    """The stream's dead-letter table: files cut short or holding two documents."""
    dead = ts.read_sink(spark, _run_stream(spark, sf_dir), "dead_letters")
    return dead.select(_delivery().alias("delivery"), F.md5(F.col("document").cast("binary")).alias("document_md5"))


@register(
    "s4_read_alert_files",
    f"SELECT {', '.join(REPORT_COLS)}, delivery FROM ({GOOD_SQL}) g",
)
def s4_read_alert_files(spark, sf_dir):
    """S4/S7 batch path: object and list documents, one file each."""
    df = read_alert_batch(spark, f"{_drop_reports(spark, sf_dir)}/*", pattern="*.txt").filter(F.col(CORRUPT).isNull())
    return df.select(*REPORT_COLS, _delivery().alias("delivery"))


@register("s4_read_alert_lines", f"SELECT {', '.join(REPORT_COLS)} FROM ({adapters.CASE_REPORTS_SQL}) r")
def s4_read_alert_lines(spark, sf_dir):
    """S4 for bulk drops: one report per line."""
    path = scratch_path(spark, "case-lines")
    adapters.case_reports(Tables(spark, sf_dir)).write.option("ignoreNullFields", "false").json(path)
    return read_alert_batch(spark, path, layout="lines").filter(F.col(CORRUPT).isNull()).select(*REPORT_COLS)


J5_SQL = with_ctes(f"""SELECT coalesce(a.case_id, c.case_id) AS case_id, a.severity_signal, c.batch_class,
       CASE WHEN a.severity_signal IS NOT NULL AND c.batch_class IS NOT NULL THEN 'both'
            WHEN a.severity_signal IS NOT NULL THEN 'alert_only' ELSE 'class_only' END AS agreement
  FROM (SELECT case_id, severity_signal FROM
          (SELECT case_id, {triage_signal_sql()} AS severity_signal FROM stg_ae) s
        WHERE severity_signal IN ('severe', 'life-threatening')) a
  FULL OUTER JOIN (SELECT case_id, severity_label AS batch_class FROM stg_ae
                    WHERE severity_label IN ('severe', 'life-threatening')) c
    ON a.case_id = c.case_id""")


@register("j5_reconcile_alerts", J5_SQL)
def j5_reconcile_alerts(spark, sf_dir):
    stg = Staged(spark, sf_dir).stg_cases
    return ts.reconcile_alerts(ts.alerts(stg), stg)
