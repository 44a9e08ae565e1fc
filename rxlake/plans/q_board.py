"""Registered queries: board KPIs (D1-D3, D5-D7, D9-D12, D14), load audit
(A7/A8) and data-quality reports (Q1-Q8)."""

from __future__ import annotations

from rxlake.operators import kpis, quality
from rxlake.operators.clean import load_audit
from rxlake.operators.quality import Check
from rxlake.plans.q_core import J3_SQL
from rxlake.plans.registry import register
from rxlake.plans.staged import DIM_DRUGS_READS, Staged, with_ctes
from rxlake.schemas import AGE_RANGE, SERIOUS_SEVERITIES, SEVERITY_ORDER


@register("d1_kpi_cases", with_ctes("SELECT count(*) AS total_cases FROM stg_ae"))
def d1_kpi_cases(spark, sf_dir):
    return kpis.kpi_cases(Staged(spark, sf_dir).stg_cases)


@register(
    "d2_kpi_serious_rate",
    with_ctes("SELECT round(100.0 * CAST(sum(CASE WHEN serious_flag THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) "
              "AS serious_rate_pct FROM stg_ae"),
)
def d2_kpi_serious_rate(spark, sf_dir):
    return kpis.kpi_serious_rate(Staged(spark, sf_dir).stg_cases)


@register(
    "d3_kpi_life_threatening",
    with_ctes("SELECT CAST(sum(CASE WHEN severity_label = 'life-threatening' THEN 1 ELSE 0 END) AS BIGINT) "
              "AS life_threatening_cases FROM stg_ae"),
)
def d3_kpi_life_threatening(spark, sf_dir):
    return kpis.kpi_life_threatening(Staged(spark, sf_dir).stg_cases)


@register(
    "d5_kpi_revenue",
    with_ctes("SELECT CAST(round(sum(CAST(revenue_usd AS DECIMAL(20,2))), 2) AS DOUBLE) AS total_revenue_usd "
              "FROM stg_sales"),
)
def d5_kpi_revenue(spark, sf_dir):
    return kpis.kpi_revenue(Staged(spark, sf_dir).sales)


@register("d6_kpi_units_sold", with_ctes("SELECT CAST(sum(units_sold) AS BIGINT) AS total_units_sold FROM stg_sales"))
def d6_kpi_units_sold(spark, sf_dir):
    return kpis.kpi_units_sold(Staged(spark, sf_dir).sales)


@register(
    "d7_kpi_active_trials",
    with_ctes("SELECT CAST(sum(CASE WHEN status IN ('Active', 'Recruiting') THEN 1 ELSE 0 END) AS BIGINT) "
              "AS active_trials, count(*) AS all_trials FROM stg_trials"),
)
def d7_kpi_active_trials(spark, sf_dir):
    return kpis.kpi_active_trials(Staged(spark, sf_dir).trials)


@register("d9_severity_distribution",
          with_ctes("SELECT severity_label, count(*) AS cases FROM stg_ae GROUP BY 1"))
def d9_severity_distribution(spark, sf_dir):
    return kpis.severity_distribution(Staged(spark, sf_dir).stg_cases)


@register("d10_cases_by_region", with_ctes("SELECT region, count(*) AS cases FROM stg_ae GROUP BY 1"))
def d10_cases_by_region(spark, sf_dir):
    return kpis.cases_by_region(Staged(spark, sf_dir).stg_cases)


@register(
    "d11_monthly_case_volume",
    with_ctes("SELECT CAST(date_trunc('month', report_date) AS DATE) AS report_month, count(*) AS cases "
              "FROM stg_ae GROUP BY 1"),
)
def d11_monthly_case_volume(spark, sf_dir):
    return kpis.monthly_case_volume(Staged(spark, sf_dir).stg_cases)


@register(
    "d12_top_drugs_by_cases",
    with_ctes("SELECT drug_code, count(*) AS cases FROM stg_ae GROUP BY 1 ORDER BY cases DESC, drug_code LIMIT 10"),
)
def d12_top_drugs_by_cases(spark, sf_dir):
    return kpis.top_drugs_by_cases(Staged(spark, sf_dir).stg_cases, k=10)


@register(
    "d14_monthly_revenue",
    with_ctes("SELECT CAST(date_trunc('month', sales_month) AS DATE) AS sales_month, "
              "CAST(round(sum(CAST(revenue_usd AS DECIMAL(20,2))), 2) AS DOUBLE) AS revenue_usd "
              "FROM stg_sales GROUP BY 1"),
)
def d14_monthly_revenue(spark, sf_dir):
    return kpis.monthly_revenue(Staged(spark, sf_dir).sales)


# ---- A7 load audit -----------------------------------------------------------
def audit_rows() -> str:
    rows = []
    for feed, raw, req, out in (
        ("clinical_trials", "trials_feed", "trial_id IS NOT NULL AND drug_code IS NOT NULL", "stg_trials"),
        ("adverse_events", "ae_feed", "case_id IS NOT NULL AND drug_code IS NOT NULL AND report_date IS NOT NULL",
         "stg_events_raw"),
        ("drug_shipments", "ship_feed", "shipment_id IS NOT NULL AND drug_code IS NOT NULL", "stg_shipments"),
        ("drug_sales", "sales_feed", "drug_code IS NOT NULL AND sales_month IS NOT NULL", "stg_sales"),
    ):
        rows.append(
            f"SELECT '{feed}' AS feed, i AS rows_in, o AS rows_out, i - r AS dropped_missing, "
            f"r - o AS dropped_duplicate, i - o AS dropped FROM "
            f"(SELECT (SELECT count(*) FROM {raw}) AS i, (SELECT count(*) FROM {raw} WHERE {req}) AS r, "
            f"(SELECT count(*) FROM {out}) AS o)"
        )
    return "\nUNION ALL\n".join(rows)


def audit_sql() -> str:
    return with_ctes(audit_rows())


@register("a7_load_audit", audit_sql())
def a7_load_audit(spark, sf_dir):
    return load_audit(Staged(spark, sf_dir).feeds())


# ---- Q1-Q8 data-quality suites ------------------------------------------------
# The reference's contract tests on the four feeds.  Region validity is a
# subset check against the driver's region dimension (its names are the
# domain here), the pharma region list stays the operator default.
FEED_CHECKS = [
    Check("not_null", "clinical_trials", "trial_id"),
    Check("unique", "clinical_trials", "trial_id"),
    Check("non_negative", "clinical_trials", "enrolled_patients"),
    Check("subset", "clinical_trials", "region", other="region_dim", other_column="r_name"),
    Check("not_null", "adverse_events", "case_id"),
    Check("unique", "adverse_events", "case_id"),
    Check("accepted_values", "adverse_events", "severity_label", tuple(SEVERITY_ORDER)),
    Check("range", "adverse_events", "patient_age", AGE_RANGE),
    Check("implies", "adverse_events", "severity_label", tuple(SERIOUS_SEVERITIES), other="serious_flag"),
    Check("unique", "drug_shipments", "shipment_id"),
    Check("positive", "drug_shipments", "quantity_units"),
    Check("subset", "drug_shipments", "drug_code", other="drug_sales"),
    Check("non_negative", "drug_sales", "revenue_usd"),
    Check("non_negative", "drug_sales", "units_sold"),
    Check("month_start", "drug_sales", "sales_month"),
]

# model and source tests on the marts
MART_CHECKS = [
    Check("unique", "dim_drugs", "drug_code"),
    Check("not_null", "dim_drugs", "drug_code"),
    Check("unique", "fct_adverse_events", "case_id"),
    Check("not_null", "fct_adverse_events", "case_id"),
    Check("accepted_values", "fct_adverse_events", "severity_label", tuple(SEVERITY_ORDER)),
    Check("unique", "adverse_events", "case_id"),
    Check("not_null", "adverse_events", "case_id"),
    Check("not_null", "adverse_events", "drug_code"),
]


@register(
    "q_feed_quality_report",
    with_ctes(quality.checks_sql(FEED_CHECKS, {
        "clinical_trials": "trials_feed", "adverse_events": "ae_feed", "drug_shipments": "ship_feed",
        "drug_sales": "sales_feed", "region_dim": "region"})),
)
def q_feed_quality_report(spark, sf_dir):
    s = Staged(spark, sf_dir)
    tables = dict(s.feeds())
    tables["region_dim"] = s.tables.region
    return quality.run_checks(tables, FEED_CHECKS)


DIM_SQL = f"({J3_SQL})"


@register(
    "q_mart_quality_report",
    with_ctes(quality.checks_sql(MART_CHECKS, {
        "dim_drugs": DIM_SQL, "fct_adverse_events": "stg_ae", "adverse_events": "curated_ae"})),
)
def q_mart_quality_report(spark, sf_dir):
    from rxlake.operators import marts

    # the cases whole: the mart of events and the dimension read the same rows
    s = Staged(spark, sf_dir, columns={f: c for f, c in DIM_DRUGS_READS.items() if f != "adverse_events"})
    tables = {
        "dim_drugs": marts.dim_drugs(s.stg_events, s.stg_supply_demand),
        "fct_adverse_events": marts.fct_adverse_events(s.stg_events),
        "adverse_events": s.curated_events,
    }
    return quality.run_checks(tables, MART_CHECKS)
