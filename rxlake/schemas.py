"""Declared feed schemas, required columns, business keys and value domains.

One StructType per feed is used everywhere (CSV reads, adapters, tests), so
types never depend on inference.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _s(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


CLINICAL_TRIALS = _s(
    ("trial_id", StringType()),
    ("drug_code", StringType()),
    ("drug_name", StringType()),
    ("therapeutic_area", StringType()),
    ("phase", StringType()),
    ("status", StringType()),
    ("site_country", StringType()),
    ("region", StringType()),
    ("start_date", DateType()),
    ("estimated_completion_date", DateType()),
    ("enrolled_patients", IntegerType()),
    ("primary_endpoint_met", BooleanType()),
)

ADVERSE_EVENTS = _s(
    ("case_id", StringType()),
    ("drug_code", StringType()),
    ("drug_name", StringType()),
    ("report_date", DateType()),
    ("patient_age", IntegerType()),
    ("patient_sex", StringType()),
    ("country", StringType()),
    ("region", StringType()),
    ("reporter_type", StringType()),
    ("narrative", StringType()),
    ("severity_label", StringType()),
    ("outcome", StringType()),
    ("serious_flag", BooleanType()),
)

DRUG_SHIPMENTS = _s(
    ("shipment_id", StringType()),
    ("drug_code", StringType()),
    ("drug_name", StringType()),
    ("origin_facility", StringType()),
    ("destination_country", StringType()),
    ("region", StringType()),
    ("ship_date", DateType()),
    ("quantity_units", IntegerType()),
    ("batch_id", StringType()),
    ("cold_chain_required", BooleanType()),
    ("delivery_status", StringType()),
)

# units_sold is LongType (the feed declares int): monthly sums per
# drug x region overflow 32 bits well before 100 TB.
DRUG_SALES = _s(
    ("sales_month", DateType()),
    ("drug_code", StringType()),
    ("drug_name", StringType()),
    ("region", StringType()),
    ("units_sold", LongType()),
    ("revenue_usd", DoubleType()),
)

# Alert JSON bodies carry the adverse-event fields.
ALERT_REPORT = ADVERSE_EVENTS


@dataclass(frozen=True)
class FeedSpec:
    """Cleaning contract of one feed."""

    name: str
    schema: StructType
    required: tuple[str, ...]
    # business key; empty = no unique key (only exact duplicate rows removed)
    keys: tuple[str, ...]
    # tie-break order for dedup: (column, ascending) — remaining columns follow
    order: tuple[tuple[str, bool], ...] = field(default_factory=tuple)


FEEDS = {
    "clinical_trials": FeedSpec(
        "clinical_trials", CLINICAL_TRIALS, ("trial_id", "drug_code"), ("trial_id",),
        (("start_date", False),),
    ),
    "adverse_events": FeedSpec(
        "adverse_events", ADVERSE_EVENTS, ("case_id", "drug_code", "report_date"), ("case_id",),
        (("report_date", False), ("drug_code", True), ("patient_age", True)),
    ),
    "drug_shipments": FeedSpec(
        "drug_shipments", DRUG_SHIPMENTS, ("shipment_id", "drug_code"), ("shipment_id",),
        (("ship_date", False), ("drug_code", True), ("quantity_units", True)),
    ),
    # sales has no unique business key (drug x region x month repeats)
    "drug_sales": FeedSpec("drug_sales", DRUG_SALES, ("drug_code", "sales_month"), ()),
}

# ---- fixed values (must equal the reference's domains) --------------------
SEVERITY_ORDER = ["mild", "moderate", "severe", "life-threatening"]
SERIOUS_SEVERITIES = ["severe", "life-threatening"]
ACTIVE_TRIAL_STATUSES = ["Active", "Recruiting"]
PEDIATRIC_BELOW_AGE = 18
GERIATRIC_FROM_AGE = 65
AGE_RANGE = (0, 120)
# keyword stems that force a life-threatening triage signal
HIGH_RISK_TERMS = [
    "anaphylaxis",
    "cardiac arrest",
    "respiratory failure",
    "life-threatening",
    "resuscitat",
    "fatal",
    "intubat",
]
OUTCOME_RISK_TERMS = ["fatal"]
ALERT_SIGNALS = ["severe", "life-threatening"]
ALERT_SUBJECT_PREFIX = "[PV ALERT] "
ALERT_SUBJECT_MIDDLE = " adverse event — "
# alert message body fields, in order
ALERT_FIELDS = ["case_id", "drug_code", "drug_name", "severity_signal", "country", "narrative", "source_key"]
# forecasting
SEASON_LENGTH = 12
HOLDOUT_MONTHS = 3
FORECAST_HORIZON = 3
# ---------------------------------------------------------------------------
