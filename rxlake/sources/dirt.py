"""Feeds with the faults that cleaning and the quality checks exist for.

The driver's tables are clean, so the adapters' feeds never fail a check.
Here some of their rows, chosen by their keys, get missing keys, ids of other
rows, impossible ages and quantities, unknown codes, dates inside a month and
repeated rows.  One expression text per column serves Spark and DuckDB alike.
The lineage columns are left out, so rows are deduplicated on the business keys
that a real feed has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.schemas import FEEDS, HIGH_RISK_TERMS
from rxlake.sources import adapters

LINE = "(src_orderkey * 7 + src_linenumber)"

#: Per feed: what replaces a column (over the feed's own columns).
FAULTS = {
    "clinical_trials": {
        "trial_id": "CASE WHEN src_orderkey % 53 = 0 THEN NULL WHEN src_orderkey % 47 = 1 THEN '47' ELSE trial_id END",
        "enrolled_patients": "CASE WHEN src_orderkey % 43 = 0 THEN -5 WHEN src_orderkey % 37 = 1 THEN NULL ELSE enrolled_patients END",
        "region": "CASE WHEN src_orderkey % 41 = 0 THEN 'ATLANTIS' ELSE region END",
    },
    "adverse_events": {
        "case_id": f"CASE WHEN {LINE} % 97 = 0 THEN NULL WHEN {LINE} % 89 = 1 THEN concat(src_orderkey, '-1') ELSE case_id END",
        "drug_code": f"CASE WHEN {LINE} % 83 = 0 THEN NULL ELSE drug_code END",
        "drug_name": f"CASE WHEN {LINE} % 103 = 0 THEN concat(drug_name, ' forte') ELSE drug_name END",
        "report_date": f"CASE WHEN {LINE} % 79 = 0 THEN NULL ELSE report_date END",
        "patient_age": f"CASE WHEN {LINE} % 71 = 0 THEN patient_age + 200 WHEN {LINE} % 73 = 0 THEN NULL WHEN {LINE} % 67 = 0 THEN -1 ELSE patient_age END",
        "severity_label": f"CASE WHEN {LINE} % 61 = 0 THEN 'terrible' WHEN {LINE} % 101 = 0 THEN NULL ELSE severity_label END",
        "serious_flag": f"CASE WHEN {LINE} % 59 = 0 THEN FALSE WHEN {LINE} % 107 = 0 THEN NULL ELSE serious_flag END",
    },
    "drug_shipments": {
        "shipment_id": f"CASE WHEN {LINE} % 97 = 0 THEN NULL WHEN {LINE} % 89 = 1 THEN concat(src_orderkey, '-1') ELSE shipment_id END",
        "drug_code": f"CASE WHEN {LINE} % 83 = 0 THEN NULL WHEN {LINE} % 101 = 0 THEN 'Unsold' ELSE drug_code END",
        "quantity_units": f"CASE WHEN {LINE} % 79 = 0 THEN 0 WHEN {LINE} % 71 = 0 THEN -3 WHEN {LINE} % 61 = 0 THEN NULL ELSE quantity_units END",
    },
    "drug_sales": {
        "drug_code": "CASE WHEN units_sold % 37 = 0 THEN NULL ELSE drug_code END",
        "sales_month": "CASE WHEN units_sold % 19 = 0 THEN CAST(sales_month + INTERVAL 14 DAY AS DATE) ELSE sales_month END",
        "revenue_usd": "CASE WHEN units_sold % 31 = 0 THEN CAST(-1 AS DOUBLE) ELSE revenue_usd END",
        "units_sold": "CASE WHEN units_sold % 29 = 0 THEN -units_sold ELSE units_sold END",
    },
}
#: Rows that a feed delivers twice.
REPEATED = {"drug_sales": "units_sold % 23 = 0", "adverse_events": f"{LINE} % 113 = 0"}


def _columns(feed: str) -> list[str]:
    faults = FAULTS[feed]
    return [f"{faults.get(c, c)} AS {c}" for c in FEEDS[feed].schema.fieldNames()]


def spoilt(rows: DataFrame, feed: str) -> DataFrame:
    """The adapter's ``rows`` of a feed with its faults."""
    twice = F.when(F.expr(REPEATED[feed]), 2).otherwise(1) if feed in REPEATED else F.lit(1)
    return rows.withColumn("_times", F.explode(F.sequence(F.lit(1), twice))).selectExpr(*_columns(feed))


def spoilt_sql(source: str, feed: str) -> str:
    """DuckDB twin of :func:`spoilt` over the adapter's SQL."""
    select = f"SELECT {', '.join(_columns(feed))} FROM ({source}) f"
    return f"{select} UNION ALL {select} WHERE {REPEATED[feed]}" if feed in REPEATED else select


# ---------------------------------------------------------------- short series
#: A brand is sold from a month of its own on, so late brands have few months.
LAUNCHED = "year(month) * 12 + month(month) >= 1995 * 12 + 3 * CAST(substr(drug_code, 7) AS INT)"


def launched_units(t) -> DataFrame:
    return adapters.sparse_units(t).filter(LAUNCHED)


LAUNCHED_UNITS_SQL = f"SELECT * FROM ({adapters.SPARSE_UNITS_SQL}) u WHERE {LAUNCHED}"

# ---------------------------------------------------------------- told risks
#: Every sixth report tells of a risk, in turn over the stems, in other cases
#: and inside other words.
_EVENT = "CAST(substr(case_id, 3) AS BIGINT)"
TOLD = (
    f"CASE {_EVENT} % {6 * len(HIGH_RISK_TERMS)} "
    + " ".join(f"WHEN {6 * k} THEN 'Seen: NON-{term.upper() if k % 2 else term.title()}ed, then well'" for k, term in enumerate(HIGH_RISK_TERMS))
    + f" ELSE CASE WHEN {_EVENT} % 11 = 0 THEN NULL ELSE narrative END END"
)


def told_reports(t) -> DataFrame:
    return adapters.case_reports(t).withColumn("narrative", F.expr(TOLD))


TOLD_REPORTS_SQL = f"SELECT * REPLACE ({TOLD} AS narrative) FROM ({adapters.CASE_REPORTS_SQL}) r"
