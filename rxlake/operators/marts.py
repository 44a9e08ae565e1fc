"""Staging views and mart tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.functions.columns import count_when, default_zero, guarded_percent, month_start, safe_ratio_percent

STG_AE_COLUMNS = [
    "case_id", "drug_code", "drug_name", "report_date", "patient_age", "patient_sex", "country", "region",
    "reporter_type", "narrative", "severity_label", "outcome", "serious_flag", "active_trial_count",
    "is_pediatric", "is_geriatric",
]
FCT_AE_COLUMNS = [
    "case_id", "drug_code", "report_date", "report_month", "region", "country", "severity_label",
    "serious_flag", "is_pediatric", "is_geriatric", "active_trial_count", "outcome",
]


def stg_adverse_events(curated: DataFrame, columns: Sequence[str] = STG_AE_COLUMNS) -> DataFrame:
    """P3 + P4: explicit projection, rows without case_id dropped."""
    return curated.filter(F.col("case_id").isNotNull()).select(*columns)


def stg_cases(cases: DataFrame, columns: Sequence[str] = STG_AE_COLUMNS) -> DataFrame:
    """P3 + P4 without the trial-context column (see ``curate.with_age_flags``)."""
    return cases.filter(F.col("case_id").isNotNull()).select(*[c for c in columns if c != "active_trial_count"])


def stg_supply_demand(curated: DataFrame) -> DataFrame:
    """P3 + P4 + P7: six columns, counts coalesced, variance passed through."""
    return curated.filter(F.col("drug_code").isNotNull()).select(
        "drug_code",
        "region",
        "ship_month",
        default_zero("units_shipped").cast("bigint").alias("units_shipped"),
        default_zero("units_sold").cast("bigint").alias("units_sold"),
        "supply_demand_variance",
    )


def fct_adverse_events(stg: DataFrame) -> DataFrame:
    """P5: BI projection with report_month."""
    return stg.withColumn("report_month", month_start("report_date")).select(*FCT_AE_COLUMNS)


def fct_adverse_events_monthly(stg: DataFrame) -> DataFrame:
    """A3: per drug x region x month counts and % serious."""
    serious = count_when(F.col("serious_flag"))
    return stg.groupBy("drug_code", "region", month_start("report_date").alias("report_month")).agg(
        F.count(F.lit(1)).alias("total_events"),
        serious.alias("serious_events"),
        count_when(F.col("severity_label") == F.lit("life-threatening")).alias("life_threatening_events"),
        safe_ratio_percent(serious, F.count(F.lit(1))).alias("pct_serious"),
    )


def fct_drug_demand(stg_sd: DataFrame) -> DataFrame:
    """P18 + P11: variance as % of sales, NULL when nothing was sold."""
    return stg_sd.select(
        "drug_code",
        "region",
        "ship_month",
        "units_shipped",
        "units_sold",
        "supply_demand_variance",
        guarded_percent("supply_demand_variance", "units_sold").alias("variance_pct_of_sales"),
    )


def distinct_drugs(stg_ae: DataFrame) -> DataFrame:
    """A4: distinct (drug_code, drug_name) seen in safety data."""
    return stg_ae.select("drug_code", "drug_name").distinct()


def dim_drugs(stg_ae: DataFrame, stg_sd: DataFrame) -> DataFrame:
    """FULL OUTER of the two distinct drug sets, key coalesced.

    A drug with two names yields two rows (the uniqueness check reports it).
    """
    ae = distinct_drugs(stg_ae).withColumnRenamed("drug_code", "ae_code")
    sd = stg_sd.select(F.col("drug_code").alias("sd_code")).distinct()
    return ae.join(sd, ae.ae_code == sd.sd_code, "full").select(
        F.coalesce("ae_code", "sd_code").alias("drug_code"), "drug_name"
    )
