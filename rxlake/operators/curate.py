"""Staging -> curated: trial context for cases (A1, J1), supply vs demand
(A2, J2).

Both sides of J2 are aggregated to drug x region x month *before* the full
outer join (the original joined un-aggregated sales and could fan out), and
both aggregates hash-partition on the same three keys, so the join reuses
their shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.functions.columns import default_zero, is_geriatric, is_pediatric, month_start, variance
from rxlake.operators.joins import bounded_broadcast
from rxlake.schemas import ACTIVE_TRIAL_STATUSES

MONTH_KEYS = ["drug_code", "region", "ship_month"]


def active_trials_by_drug(trials: DataFrame, statuses: Sequence[str] = ACTIVE_TRIAL_STATUSES) -> DataFrame:
    """A1 (+P2): trials in an active status, counted per drug across regions."""
    return (
        trials.filter(F.col("status").isin(*statuses))
        .groupBy("drug_code")
        .agg(F.count("trial_id").alias("active_trial_count"))
    )


def curated_adverse_events(
    events: DataFrame,
    trials: DataFrame,
    statuses: Sequence[str] = ACTIVE_TRIAL_STATUSES,
    broadcast_counts: bool = True,
) -> DataFrame:
    """Cases LEFT JOIN per-drug active-trial counts, count defaulted to 0,
    age-band flags (P9, null age -> null flags)."""
    counts = active_trials_by_drug(trials, statuses)
    if broadcast_counts:
        counts = bounded_broadcast(counts)
    return with_age_flags(
        events.join(counts, on="drug_code", how="left").withColumn(
            "active_trial_count", default_zero("active_trial_count").cast("bigint")
        )
    )


def with_age_flags(events: DataFrame) -> DataFrame:
    """P9 flags alone: the part of J1 that does not need trial context.

    J1's join is a LEFT join on a key that is unique on the right, so it
    neither adds nor drops cases; consumers that never read
    ``active_trial_count`` use this and skip the trial scan altogether.
    """
    return events.withColumn("is_pediatric", is_pediatric()).withColumn("is_geriatric", is_geriatric())


def shipments_monthly(shipments: DataFrame) -> DataFrame:
    """A2: units shipped per drug x region x month (DATE month key)."""
    return shipments.groupBy(
        "drug_code", "region", month_start("ship_date").alias("ship_month")
    ).agg(F.sum("quantity_units").cast("bigint").alias("units_shipped"))


def sales_monthly(sales: DataFrame) -> DataFrame:
    """A5-shaped: sales summed per drug x region x month (P6 rename).

    Keeps the sales side's ``drug_name`` and ``revenue_usd`` (exact decimal
    sum, then DOUBLE).
    """
    return sales.groupBy(
        "drug_code", "region", month_start("sales_month").alias("ship_month")
    ).agg(
        F.sum("units_sold").cast("bigint").alias("units_sold"),
        F.max("drug_name").alias("drug_name"),
        F.round(F.sum(F.col("revenue_usd").cast("decimal(20,2)")), 2).cast("double").alias("revenue_usd"),
    )


def curated_supply_demand(shipments: DataFrame, sales: DataFrame) -> DataFrame:
    """FULL OUTER on (drug, region, month); zero defaults; variance."""
    joined = shipments_monthly(shipments).join(sales_monthly(sales), on=MONTH_KEYS, how="full")
    return (
        joined.withColumn("units_shipped", default_zero("units_shipped").cast("bigint"))
        .withColumn("units_sold", default_zero("units_sold").cast("bigint"))
        .withColumn("supply_demand_variance", variance())
        .select(
            *MONTH_KEYS, "units_shipped", "units_sold", "supply_demand_variance", "drug_name", "revenue_usd"
        )
    )
