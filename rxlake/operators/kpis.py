"""Board KPIs (D1-D14) as aggregates over staged / mart relations.

Every KPI is a single aggregate (partial aggregation map-side, one small
shuffle) — none collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.functions.columns import count_when, month_start
from rxlake.schemas import ACTIVE_TRIAL_STATUSES


def kpi_cases(stg_ae: DataFrame) -> DataFrame:
    """Total adverse-event cases."""
    return stg_ae.agg(F.count(F.lit(1)).alias("total_cases"))


def kpi_serious_rate(stg_ae: DataFrame) -> DataFrame:
    """% of cases flagged serious (null flag counts as not serious)."""
    return stg_ae.agg(
        F.round(F.lit(100.0) * count_when(F.col("serious_flag")).cast("double") / F.count(F.lit(1)), 2).alias(
            "serious_rate_pct"
        )
    )


def kpi_life_threatening(stg_ae: DataFrame) -> DataFrame:
    """D3: life-threatening case count."""
    return stg_ae.agg(count_when(F.col("severity_label") == "life-threatening").alias("life_threatening_cases"))


def kpi_revenue(sales: DataFrame) -> DataFrame:
    """Total revenue (exact decimal sum, rounded to cents)."""
    return sales.agg(
        F.round(F.sum(F.col("revenue_usd").cast("decimal(20,2)")), 2).cast("double").alias("total_revenue_usd")
    )


def kpi_units_sold(sales: DataFrame) -> DataFrame:
    """Total units sold."""
    return sales.agg(F.sum("units_sold").cast("bigint").alias("total_units_sold"))


def kpi_active_trials(trials: DataFrame) -> DataFrame:
    """Active (Active/Recruiting) and all trials."""
    return trials.agg(
        count_when(F.col("status").isin(*ACTIVE_TRIAL_STATUSES)).alias("active_trials"),
        F.count(F.lit(1)).alias("all_trials"),
    )


def severity_distribution(stg_ae: DataFrame) -> DataFrame:
    """Cases per severity label."""
    return stg_ae.groupBy("severity_label").agg(F.count(F.lit(1)).alias("cases"))


def cases_by_region(stg_ae: DataFrame) -> DataFrame:
    """Cases per region."""
    return stg_ae.groupBy("region").agg(F.count(F.lit(1)).alias("cases"))


def monthly_case_volume(stg_ae: DataFrame) -> DataFrame:
    """Cases per report month."""
    return stg_ae.groupBy(month_start("report_date").alias("report_month")).agg(F.count(F.lit(1)).alias("cases"))


def top_drugs_by_cases(stg_ae: DataFrame, k: int = 10) -> DataFrame:
    """Top-k drugs by case count (ties broken by drug_code).

    The limit is the feature; Spark plans it as TakeOrderedAndProject
    (per-partition top-k, then a single k-row merge).
    """
    return (
        stg_ae.groupBy("drug_code")
        .agg(F.count(F.lit(1)).alias("cases"))
        .orderBy(F.col("cases").desc(), F.col("drug_code").asc())
        .limit(k)
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per sales month."""
    return sales.groupBy(month_start("sales_month").alias("sales_month")).agg(
        F.round(F.sum(F.col("revenue_usd").cast("decimal(20,2)")), 2).cast("double").alias("revenue_usd")
    )


def forecast_units_by_drug(forecast: DataFrame) -> DataFrame:
    """Total forecast units per drug, descending."""
    return (
        forecast.groupBy("drug_code")
        .agg(F.sum("forecast_units").cast("bigint").alias("forecast_units"))
        .orderBy(F.col("forecast_units").desc(), F.col("drug_code"))
    )


def kpi_avg_mape(backtest: DataFrame) -> DataFrame:
    """Mean of per-series backtest MAPE (one value per series)."""
    per_series = backtest.groupBy("drug_code", "region").agg(F.first("backtest_mape", ignorenulls=True).alias("m"))
    return per_series.agg(F.round(F.avg("m"), 2).alias("avg_mape_pct"), F.count("m").alias("series"))
