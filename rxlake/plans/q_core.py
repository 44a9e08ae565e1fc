"""Registered queries: staging, curated and mart relations (A1-A6, J1-J4,
P2-P12, P18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rxlake.operators import curate, marts, quality
from rxlake.plans.registry import register
from rxlake.plans.staged import DIM_DRUGS_READS, Staged, with_ctes

FCT_AE_SQL_COLS = """case_id, drug_code, report_date, CAST(date_trunc('month', report_date) AS DATE) AS report_month,
       region, country, severity_label, serious_flag, is_pediatric, is_geriatric, active_trial_count, outcome"""


@register(
    "a1_active_trials_by_drug",
    with_ctes("SELECT drug_code, count(trial_id) AS active_trial_count FROM stg_trials "
              "WHERE status IN ('Active', 'Recruiting') GROUP BY drug_code"),
)
def a1_active_trials_by_drug(spark, sf_dir):
    return curate.active_trials_by_drug(Staged(spark, sf_dir).trials)


@register("a6_dedup_adverse_events", with_ctes("SELECT * FROM stg_events_raw"))
def a6_dedup_adverse_events(spark, sf_dir):
    return Staged(spark, sf_dir).events


@register("a6_dedup_shipments", with_ctes("SELECT * FROM stg_shipments"))
def a6_dedup_shipments(spark, sf_dir):
    return Staged(spark, sf_dir).shipments


@register("a6_dedup_trials", with_ctes("SELECT * FROM stg_trials"))
def a6_dedup_trials(spark, sf_dir):
    return Staged(spark, sf_dir).trials


@register("a6_dedup_sales_exact_rows", with_ctes("SELECT * FROM stg_sales"))
def a6_dedup_sales_exact_rows(spark, sf_dir):
    return Staged(spark, sf_dir).sales


@register("j1_curated_adverse_events", with_ctes("SELECT * FROM curated_ae"))
def j1_curated_adverse_events(spark, sf_dir):
    return Staged(spark, sf_dir).curated_events


@register("p4_stg_adverse_events", with_ctes("SELECT * FROM stg_ae"))
def p4_stg_adverse_events(spark, sf_dir):
    return Staged(spark, sf_dir).stg_events


@register("p5_fct_adverse_events", with_ctes(f"SELECT {FCT_AE_SQL_COLS} FROM stg_ae"))
def p5_fct_adverse_events(spark, sf_dir):
    return marts.fct_adverse_events(Staged(spark, sf_dir).stg_events)


A3_SQL = """SELECT drug_code, region, CAST(date_trunc('month', report_date) AS DATE) AS report_month,
       count(*) AS total_events,
       CAST(sum(CASE WHEN serious_flag THEN 1 ELSE 0 END) AS BIGINT) AS serious_events,
       CAST(sum(CASE WHEN severity_label = 'life-threatening' THEN 1 ELSE 0 END) AS BIGINT)
           AS life_threatening_events,
       round(100.0 * CAST(sum(CASE WHEN serious_flag THEN 1 ELSE 0 END) AS DOUBLE)
             / CAST(nullif(count(*), 0) AS DOUBLE), 2) AS pct_serious
  FROM stg_ae GROUP BY 1, 2, 3"""


@register("a3_fct_adverse_events_monthly", with_ctes(A3_SQL))
def a3_fct_adverse_events_monthly(spark, sf_dir):
    return marts.fct_adverse_events_monthly(Staged(spark, sf_dir).stg_cases)


@register("a2_shipments_monthly", with_ctes("SELECT * FROM ship_monthly"))
def a2_shipments_monthly(spark, sf_dir):
    return curate.shipments_monthly(Staged(spark, sf_dir).shipments)


@register("a5_sales_monthly", with_ctes("SELECT * FROM sales_monthly"))
def a5_sales_monthly(spark, sf_dir):
    return curate.sales_monthly(Staged(spark, sf_dir).sales)


@register("j2_curated_supply_demand", with_ctes("SELECT * FROM curated_sd"))
def j2_curated_supply_demand(spark, sf_dir):
    return Staged(spark, sf_dir).curated_supply_demand


@register("p4_stg_supply_demand", with_ctes("SELECT * FROM stg_sd"))
def p4_stg_supply_demand(spark, sf_dir):
    return Staged(spark, sf_dir).stg_supply_demand


P18_SQL = """SELECT drug_code, region, ship_month, units_shipped, units_sold, supply_demand_variance,
       CASE WHEN units_sold = 0 THEN NULL
            ELSE round(100.0 * CAST(supply_demand_variance AS DOUBLE) / CAST(units_sold AS DOUBLE), 2)
       END AS variance_pct_of_sales
  FROM stg_sd"""


@register("p18_fct_drug_demand", with_ctes(P18_SQL))
def p18_fct_drug_demand(spark, sf_dir):
    return marts.fct_drug_demand(Staged(spark, sf_dir).stg_supply_demand)


@register("a4_distinct_drugs", with_ctes("SELECT DISTINCT drug_code, drug_name FROM stg_ae"))
def a4_distinct_drugs(spark, sf_dir):
    return marts.distinct_drugs(Staged(spark, sf_dir).stg_cases)


J3_SQL = """SELECT coalesce(ae.drug_code, sd.drug_code) AS drug_code, ae.drug_name
  FROM (SELECT DISTINCT drug_code, drug_name FROM stg_ae) ae
  FULL OUTER JOIN (SELECT DISTINCT drug_code FROM stg_sd) sd ON ae.drug_code = sd.drug_code"""


@register("j3_dim_drugs", with_ctes(J3_SQL))
def j3_dim_drugs(spark, sf_dir):
    s = Staged(spark, sf_dir, columns=DIM_DRUGS_READS)
    return marts.dim_drugs(s.stg_cases, s.stg_supply_demand)


@register(
    "j4_orphan_drug_codes",
    with_ctes("SELECT DISTINCT drug_code FROM stg_shipments WHERE drug_code NOT IN "
              "(SELECT drug_code FROM stg_sales WHERE drug_code IS NOT NULL)"),
)
def j4_orphan_drug_codes(spark, sf_dir):
    s = Staged(spark, sf_dir)
    return quality.orphan_codes(s.shipments, s.sales, "drug_code")


@register(
    "j4_drugs_without_trials",
    with_ctes("SELECT DISTINCT drug_code FROM stg_ae WHERE drug_code NOT IN "
              "(SELECT drug_code FROM stg_trials WHERE drug_code IS NOT NULL)"),
)
def j4_drugs_without_trials(spark, sf_dir):
    s = Staged(spark, sf_dir)
    return quality.orphan_codes(s.stg_cases, s.trials, "drug_code")


P2_SQL = with_ctes("SELECT * FROM stg_trials WHERE status IN ('Active', 'Recruiting')")


@register("p2_filter_active_trials", P2_SQL)
def p2_filter_active_trials(spark, sf_dir):
    from rxlake.schemas import ACTIVE_TRIAL_STATUSES

    return Staged(spark, sf_dir).trials.filter(F.col("status").isin(*ACTIVE_TRIAL_STATUSES))
