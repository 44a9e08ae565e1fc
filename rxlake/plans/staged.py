"""Feeds -> staging -> curated -> staging views, as lazy DataFrames, plus the
DuckDB CTE text that computes the same relations for oracle checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from rxlake import schemas
from rxlake.operators import curate, marts
from rxlake.operators.clean import clean, clean_sql
from rxlake.sources import adapters
from rxlake.sources.tables import Tables

# what the drug dimension (J3) reads of each feed, with the columns that J1, J2
# and the staging views compute with on the way
DIM_DRUGS_READS = {
    "adverse_events": ("case_id", "drug_code", "drug_name", "patient_age"),
    "clinical_trials": ("trial_id", "drug_code", "status"),
    "drug_shipments": ("drug_code", "region", "ship_date", "quantity_units"),
}

AE_FEED_COLUMNS = schemas.ADVERSE_EVENTS.fieldNames() + ["src_orderkey", "src_linenumber", "src_price"]
TRIALS_FEED_COLUMNS = schemas.CLINICAL_TRIALS.fieldNames() + ["src_orderkey"]
SHIP_FEED_COLUMNS = schemas.DRUG_SHIPMENTS.fieldNames() + ["src_orderkey", "src_linenumber"]
SALES_FEED_COLUMNS = schemas.DRUG_SALES.fieldNames()


class Staged:
    """Lazily built relations of the daily flow over one driver directory.

    ``columns`` names, per feed, those that the caller reads (a feed not named:
    all); cleaning keeps the same rows, with these columns."""

    def __init__(self, spark: SparkSession, sf_dir: str, broadcast_counts: bool = True, columns: dict[str, Sequence[str]] | None = None):
        self.spark = spark
        self.tables = Tables(spark, sf_dir)
        self.broadcast_counts = broadcast_counts
        self.columns = columns or {}

    # feeds
    @cached_property
    def events_feed(self) -> DataFrame:
        return adapters.adverse_events(self.tables)

    @cached_property
    def trials_feed(self) -> DataFrame:
        return adapters.clinical_trials(self.tables)

    @cached_property
    def shipments_feed(self) -> DataFrame:
        return adapters.drug_shipments(self.tables)

    @cached_property
    def sales_feed(self) -> DataFrame:
        return adapters.drug_sales(self.tables)

    def feeds(self) -> dict[str, DataFrame]:
        return {
            "clinical_trials": self.trials_feed,
            "adverse_events": self.events_feed,
            "drug_shipments": self.shipments_feed,
            "drug_sales": self.sales_feed,
        }

    # staging
    @cached_property
    def events(self) -> DataFrame:
        return clean(self.events_feed, "adverse_events", self.columns.get("adverse_events"))

    @cached_property
    def trials(self) -> DataFrame:
        return clean(self.trials_feed, "clinical_trials", self.columns.get("clinical_trials"))

    @cached_property
    def shipments(self) -> DataFrame:
        return clean(self.shipments_feed, "drug_shipments", self.columns.get("drug_shipments"))

    @cached_property
    def sales(self) -> DataFrame:
        return clean(self.sales_feed, "drug_sales")

    # curated
    @cached_property
    def curated_events(self) -> DataFrame:
        return curate.curated_adverse_events(self.events, self.trials, broadcast_counts=self.broadcast_counts)

    @cached_property
    def curated_supply_demand(self) -> DataFrame:
        return curate.curated_supply_demand(self.shipments, self.sales)

    # staging views
    @cached_property
    def stg_events(self) -> DataFrame:
        return marts.stg_adverse_events(self.curated_events, self._staged_columns)

    @cached_property
    def stg_cases(self) -> DataFrame:
        """Staged cases for consumers that never read trial context (no J1 join)."""
        return marts.stg_cases(curate.with_age_flags(self.events), self._staged_columns)

    @property
    def _staged_columns(self) -> list[str]:
        read = self.columns.get("adverse_events", schemas.ADVERSE_EVENTS.fieldNames())
        return [c for c in marts.STG_AE_COLUMNS if c in read or c not in schemas.ADVERSE_EVENTS.fieldNames()]

    @cached_property
    def stg_supply_demand(self) -> DataFrame:
        return marts.stg_supply_demand(self.curated_supply_demand)


def _cte(name: str, body: str) -> str:
    return f"{name} AS (\n{body}\n)"


STG_AE_COLS = ", ".join(marts.STG_AE_COLUMNS)

CTES = {
    "ae_feed": adapters.ADVERSE_EVENTS_SQL,
    "trials_feed": adapters.CLINICAL_TRIALS_SQL,
    "ship_feed": adapters.DRUG_SHIPMENTS_SQL,
    "sales_feed": adapters.DRUG_SALES_SQL,
    "stg_events_raw": clean_sql("ae_feed", "adverse_events", AE_FEED_COLUMNS),
    "stg_trials": clean_sql("trials_feed", "clinical_trials", TRIALS_FEED_COLUMNS),
    "stg_shipments": clean_sql("ship_feed", "drug_shipments", SHIP_FEED_COLUMNS),
    "stg_sales": clean_sql("sales_feed", "drug_sales", SALES_FEED_COLUMNS),
    "active_trials": """SELECT drug_code, count(trial_id) AS active_trial_count
  FROM stg_trials WHERE status IN ('Active', 'Recruiting') GROUP BY drug_code""",
    "curated_ae": """SELECT e.*, CAST(coalesce(a.active_trial_count, 0) AS BIGINT) AS active_trial_count,
       e.patient_age < 18 AS is_pediatric, e.patient_age >= 65 AS is_geriatric
  FROM stg_events_raw e LEFT JOIN active_trials a ON e.drug_code = a.drug_code""",
    "stg_ae": f"SELECT {STG_AE_COLS} FROM curated_ae WHERE case_id IS NOT NULL",
    "ship_monthly": """SELECT drug_code, region, CAST(date_trunc('month', ship_date) AS DATE) AS ship_month,
       CAST(sum(quantity_units) AS BIGINT) AS units_shipped
  FROM stg_shipments GROUP BY 1, 2, 3""",
    "sales_monthly": """SELECT drug_code, region, CAST(date_trunc('month', sales_month) AS DATE) AS ship_month,
       CAST(sum(units_sold) AS BIGINT) AS units_sold, max(drug_name) AS drug_name,
       CAST(round(sum(CAST(revenue_usd AS DECIMAL(20,2))), 2) AS DOUBLE) AS revenue_usd
  FROM stg_sales GROUP BY 1, 2, 3""",
    "curated_sd": """SELECT coalesce(s.drug_code, d.drug_code) AS drug_code,
       coalesce(s.region, d.region) AS region,
       coalesce(s.ship_month, d.ship_month) AS ship_month,
       CAST(coalesce(s.units_shipped, 0) AS BIGINT) AS units_shipped,
       CAST(coalesce(d.units_sold, 0) AS BIGINT) AS units_sold,
       CAST(coalesce(s.units_shipped, 0) - coalesce(d.units_sold, 0) AS BIGINT) AS supply_demand_variance,
       d.drug_name, d.revenue_usd
  FROM ship_monthly s FULL OUTER JOIN sales_monthly d
    ON s.drug_code = d.drug_code AND s.region = d.region AND s.ship_month = d.ship_month""",
    "stg_sd": """SELECT drug_code, region, ship_month, CAST(coalesce(units_shipped, 0) AS BIGINT) AS units_shipped,
       CAST(coalesce(units_sold, 0) AS BIGINT) AS units_sold, supply_demand_variance
  FROM curated_sd WHERE drug_code IS NOT NULL""",
}


def with_ctes(select: str) -> str:
    """Prefix ``select`` with every staged CTE (DuckDB skips unused ones)."""
    body = ",\n".join(_cte(k, v) for k, v in CTES.items())
    return f"WITH {body}\n{select}"
